"""The guarded upsert in input order against a loop over the records."""

import random

import pytest
from pyspark.sql import functions as F

from keyferry import operators as O
from keyferry.session import cut_lineage
from keyferry.specs import MergeSpec

SCHEMA = "id string, sf string, sub string, name string, note string, created long"
SPEC = MergeSpec(("sf",), ("seq",), {"created": "least", "note": "target"})


def loop(target, records):
    table = {r[0]: dict(zip(("id", "sf", "sub", "name", "note", "created"), r)) for r in target}
    actions = {}
    for seq, (id, sf, sub, name, note, created) in enumerate(records):
        found = [r for r in table.values() if (sf is not None and r["sf"] == sf) or (sub is not None and r["sub"] == sub)]
        if len(found) > 1:
            actions[id] = (None, "duplicate_conflict")
        elif found:
            row = found[0]
            row.update(name=name, sf=row["sf"] if row["sf"] is not None else sf, sub=sub if sub is not None else row["sub"], created=min(row["created"], created))
            actions[id] = (row["id"], "updated")
        else:
            table[id] = dict(id=id, sf=sf, sub=sub, name=name, note=note, created=created)
            actions[id] = (id, "inserted")
    return sorted((tuple(r.values()) for r in table.values()), key=repr), actions


def run(spark, target, records, limit=None):
    rounds = []

    def stage(df):
        rounds.append(1)
        return cut_lineage(df)

    t = spark.createDataFrame(target, SCHEMA)
    s = spark.createDataFrame([(*r, k) for k, r in enumerate(records)], SCHEMA + ", seq long").repartition(3)
    merged, actions = O.merge_in_order(t, s, ("sf", "sub"), SPEC, stage=stage)
    got = sorted((tuple(r) for r in merged.select("id", "sf", "sub", "name", "note", "created").collect()), key=repr)
    acts = {r["source_id"]: (r["target_id"], r["action"]) for r in actions.collect()}
    assert (got, acts) == loop(target, records)
    n = (len(rounds) - 1) // 2
    if limit is not None:
        assert n <= limit, n
    return n


@pytest.mark.parametrize("seed", range(8))
def test_random_batches_equal_a_loop(quick, seed):
    rnd = random.Random(seed)
    keys = rnd.choice([4, 8, 30])
    target = [(f"t{i}", f"S{i}" if rnd.random() < 0.6 else None, f"C{i}" if rnd.random() < 0.8 else None, "old", "n", 100) for i in range(rnd.choice([0, 3, 12]))]
    records = [
        (f"r{i}", rnd.choice([None, f"S{rnd.randrange(keys)}"]), rnd.choice([None, f"C{rnd.randrange(keys)}", f"C{rnd.randrange(keys)}"]), f"v{i}", "s", rnd.randrange(200))
        for i in range(rnd.choice([15, 30]))
    ]
    run(quick, target, records)


def test_released_keys_and_takeovers(quick):
    target = [("t1", "a", "x", "old", "n", 5), ("t2", None, "y", "old", "n", 5)]
    records = [
        ("r1", "b", "x", "by alt", "s", 9),  # t1 keeps its first key
        ("r2", "a", "z", "moves", "s", 9),  # t1 leaves x
        ("r3", "b", "x", "new", "s", 9),  # x is free now
        ("r4", "a", "x", "refused", "s", 9),
        ("r5", "c", "y", "gains", "s", 9),  # t2 gets its first key
        ("r6", "c", None, "by first", "s", 1),
        ("r7", None, None, "alone", "s", 9),
        ("r8", None, None, "alone", "s", 9),
    ]
    run(quick, target, records, limit=4)


def test_many_records_of_one_key_take_few_rounds(quick):
    target = [("t0", "a", "x", "old", "n", 5)]
    star = [(f"r{i}", f"S{i}", "hot", f"v{i}", "s", i) for i in range(300)]
    assert run(quick, target, star) <= 3
    same = [(f"r{i}", "a", None if i % 3 else "x", f"v{i}", "s", i) for i in range(300)]
    assert run(quick, target, same) <= 2
    moves = [(f"r{i}", "a", f"m{i % 7}", f"v{i}", "s", i) for i in range(300)]
    assert run(quick, target, moves) <= 2
    fresh = [(f"r{i}", "new", f"m{i}", f"v{i}", "s", i) for i in range(300)]
    assert run(quick, target, fresh) <= 3


def test_a_chain_ends_within_its_length(quick):
    target = [(f"t{i}", f"S{i}", f"C{i}", "old", "n", 5) for i in range(8)]
    chain = [(f"r{i}", f"S{i}", f"C{i + 1}", f"v{i}", "s", i) for i in reversed(range(8))]  # each takes what the one before released
    assert run(quick, target, chain) <= 9
    empty = run(quick, target, [])
    assert empty == 1


def test_equal_records_and_repeats(quick):
    s = quick.createDataFrame([("r", "a", "x", "v", "s", 1, 1)] * 5, SCHEMA + ", seq long")
    t = quick.createDataFrame([], SCHEMA)
    merged, actions = O.merge_in_order(t, s, ("sf", "sub"), SPEC)
    assert [tuple(r) for r in merged.collect()] == [("r", "a", "x", "v", "s", 1)]
    assert actions.groupBy("action").count().orderBy("action").collect() == [("inserted", 1), ("updated", 4)]
    again, actions = O.merge_in_order(merged, s, ("sf", "sub"), SPEC)
    assert again.collect() == merged.collect() and actions.select(F.collect_set("action")).first()[0] == ["updated"]
