"""Tables in buckets: merges that touch few of them, runs that meet."""

import os
import random

import pytest
from pyspark.sql import functions as F

from keyferry import operators as O
from keyferry.sources import Conflict, TableStore
from keyferry.specs import MergeSpec, TableSpec, columns

SPEC = TableSpec("things", columns("code bigint, name string, price double, stamp bigint"))
HOW = MergeSpec(("code",), ("stamp",), {"price": "greatest"})


def things(spark, rows):
    return spark.createDataFrame(rows, SPEC.schema)


def content(df):
    return sorted(map(tuple, df.collect()), key=repr)


def files(root):
    """Path to bytes of every data file of the table."""
    out = {}
    for folder, _, names in os.walk(f"{root}/things"):
        for n in names:
            if n.endswith(".parquet"):
                with open(f"{folder}/{n}", "rb") as f:
                    out[f"{folder}/{n}"] = f.read()
    return out


@pytest.fixture
def store(quick, tmp_path):
    store = TableStore(quick, str(tmp_path / "store"), buckets=16)
    rnd = random.Random(1)
    rows = [(i, f"n{i}", float(rnd.randrange(100)), 1) for i in range(2000)] + [(None, "loose", 1.0, 1)] * 3
    store.commit(SPEC, things(quick, rows), ("code",))
    return store


def test_small_delta_touches_few_buckets(quick, store):
    delta = things(quick, [(5, "new5", 1000.0, 2), (5, "older5", 2000.0, 1), (7, "new7", 0.0, 2), (99999, "added", 3.0, 2), (None, "loose2", 2.0, 2)])
    want = content(O.merge(store.read(SPEC), delta, HOW))
    before, held = files(store.root), store._current("things").paths
    got = store.merge_into(SPEC, delta, HOW)
    assert content(got) == want == content(TableStore(quick, store.root).read(SPEC))
    after = files(store.root)
    assert all(after[p] == data for p, data in before.items())  # nothing is overwritten
    now = store._current("things").paths
    moved = {b for b in now if now[b] != held.get(b)}
    assert len(held) == 17 and moved - {-1} and len(moved - {-1}) <= 3
    assert len(now[-1]) == len(held[-1]) + 1 and now[-1][0] == held[-1][0]
    new = [p for p in after if p not in before]
    assert len({p.split("_bucket=")[1].split("/")[0] for p in new}) == len(moved)


@pytest.mark.parametrize("seed", range(3))
def test_random_deltas_equal_full_merges(quick, tmp_path, seed):
    rnd = random.Random(seed)
    store = TableStore(quick, str(tmp_path / "s"), buckets=rnd.choice([2, 7, 64]))
    plain = None
    for turn in range(4):
        rows = [(rnd.choice([None, rnd.randrange(60)]), f"{turn}-{k}", float(rnd.randrange(50)), turn * 100 + k) for k in range(rnd.choice([0, 3, 40]))]
        delta = things(quick, rows)
        plain = O.merge(plain if plain is not None else things(quick, []), delta, HOW)
        plain = quick.createDataFrame(plain.collect(), SPEC.schema)
        assert content(store.merge_into(SPEC, delta, HOW)) == content(plain)
    fresh = TableStore(quick, store.root)
    assert content(fresh.read(SPEC)) == content(plain)
    store.commit(SPEC, store.read(SPEC).where("code < 10"))
    assert content(TableStore(quick, store.root).read(SPEC)) == content(plain.where("code < 10"))


def test_other_keys_and_one_piece_are_rewritten_whole(quick, store, tmp_path):
    by_name = MergeSpec(("name",), ("stamp",))
    delta = things(quick, [(77777, "n3", 1.0, 5)])
    want = content(O.merge(store.read(SPEC), delta, by_name))
    assert content(store.merge_into(SPEC, delta, by_name)) == want
    assert store._current("things").key == "`code`" and len(store._current("things").paths) > 10
    plain = TableStore(quick, str(tmp_path / "plain"))
    plain.merge_into(SPEC, things(quick, [(1, "a", 1.0, 1)]), HOW)
    plain.merge_into(SPEC, things(quick, [(2, "b", 1.0, 1)]), HOW)
    assert plain._current("things").buckets == 1 and plain.read(SPEC).count() == 2


def test_keys_of_several_columns(quick, tmp_path):
    store = TableStore(quick, str(tmp_path / "s"), buckets=8)
    how = MergeSpec(("name", "code"), ("stamp",))
    plain = things(quick, [])
    for rows in ([(1, "a", 1.0, 1), (2, None, 1.0, 1)], [(9, "a", 2.0, 2), (2, None, 2.0, 2), (None, None, 0.0, 2)]):
        plain = quick.createDataFrame(O.merge(plain, things(quick, rows), how).collect(), SPEC.schema)
        assert content(store.merge_into(SPEC, things(quick, rows), how)) == content(plain)


def bucket_of(store, code):
    row = things(store.spark, [(code, "x", 0.0, 0)])
    return row.select(store._bucket(row, store._current("things"))).first()[0]


def test_two_runs_lose_no_commit(quick, store):
    first, second = TableStore(quick, store.root), TableStore(quick, store.root)
    first.begin()
    second.begin()
    a = 5
    b = next(k for k in range(2000) if bucket_of(store, k) != bucket_of(store, a))
    first.merge_into(SPEC, things(quick, [(a, "first", 1.0, 9)]), HOW)
    second.merge_into(SPEC, things(quick, [(b, "second", 1.0, 9)]), HOW)
    first.publish()
    second.publish()  # other buckets: both stay
    names = {r["code"]: r["name"] for r in second.read(SPEC).collect()}
    assert names[a] == "first" and names[b] == "second"
    assert content(TableStore(quick, store.root).read(SPEC)) == content(second.read(SPEC))


def test_the_same_bucket_is_a_conflict(quick, store):
    first, second = TableStore(quick, store.root), TableStore(quick, store.root)
    first.begin()
    second.begin()
    first.merge_into(SPEC, things(quick, [(5, "first", 1.0, 9)]), HOW)
    second.merge_into(SPEC, things(quick, [(5, "second", 1.0, 9)]), HOW)
    first.publish()
    with pytest.raises(Conflict):
        second.publish()
    assert {r["name"] for r in second.read(SPEC).where("code = 5").collect()} == {"n5"}
    second.refresh()
    assert {r["name"] for r in second.read(SPEC).where("code = 5").collect()} == {"first"}


def test_a_single_merge_starts_again(quick, store, monkeypatch):
    late = TableStore(quick, store.root)
    assert late.read(SPEC).count() == 2003
    store.merge_into(SPEC, things(quick, [(5, "first", 500.0, 9)]), HOW)
    late.merge_into(SPEC, things(quick, [(5, "second", 1.0, 10)]), HOW)  # began on the state before
    row = late.read(SPEC).where("code = 5").collect()
    assert [(r["name"], r["price"]) for r in row] == [("second", 500.0)]


def test_whole_commits_conflict_with_everything(quick, store):
    late = TableStore(quick, store.root)
    late.begin()
    store.merge_into(SPEC, things(quick, [(5, "first", 1.0, 9)]), HOW)
    late.commit(SPEC, late.read(SPEC).where("code > 10"))
    with pytest.raises(Conflict):
        late.publish()
    assert TableStore(quick, store.root).read(SPEC).where("code = 5").first()["name"] == "first"


def test_a_step_shows_nothing_before_it_ends(quick, store):
    other = TableSpec("others", columns("id bigint"))
    store.begin()
    store.merge_into(SPEC, things(quick, [(5, "step", 1.0, 9)]), HOW)
    store.merge_into(SPEC, things(quick, [(5, "step2", 1.0, 10), (6, "six", 1.0, 10)]), HOW)
    store.commit(other, quick.range(3).select("id"))
    staged = store.stage("s", quick.range(2))
    assert staged.count() == 2 and store.read(SPEC).where("code = 5").first()["name"] == "step2"
    reader = TableStore(quick, store.root)
    assert not reader.exists("others") and reader.read(SPEC).where("code = 5").first()["name"] == "n5"
    store.publish()
    reader.refresh()
    assert reader.read(other).count() == 3 and reader.read(SPEC).where("code = 5").first()["name"] == "step2"
    assert reader.read(SPEC).where("code = 6").first()["name"] == "six"
    assert not os.path.exists(f"{store.root}/_stage/{store._run}")
    store.begin()
    store.commit(other, quick.range(9).select("id"))
    store.abandon()
    assert store.read(other).count() == 3


def test_an_empty_table_exists(quick, store):
    empty = TableSpec("empty", columns("id bigint"))
    store.commit(empty, quick.range(0).select("id"), ("id",))
    assert TableStore(quick, store.root).exists("empty") and store.read(empty).count() == 0


def test_rows_without_a_key_are_spread(quick, tmp_path):
    store = TableStore(quick, str(tmp_path / "s"), buckets=8)
    rows = quick.range(4000).select(F.lit(None).cast("bigint").alias("code"), F.concat(F.lit("n"), "id").alias("name"), F.lit(1.0).alias("price"), F.col("id").alias("stamp"))
    store.commit(SPEC, rows, ("code",))
    sizes = [n for n in os.listdir(store._current("things").paths[-1][0]) if n.endswith(".parquet")]
    assert len(sizes) > 4 and store.read(SPEC).count() == 4000
