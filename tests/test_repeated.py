"""Only rows whose key repeats are gathered; all others pass as they are."""

import random

from pyspark.sql import functions as F

from keyferry import operators as O
from keyferry.operators import dedupe
from keyferry.specs import MergeSpec


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def _source(spark, keys):
    data = [(k, n % 7, f"v{n}" if n % 3 else None) for n, k in enumerate(keys)]
    return spark.createDataFrame(data, "k string, seq int, v string")


def _plan(df, capsys):
    capsys.readouterr()
    df.explain()
    return capsys.readouterr().out


def test_unique_keys_are_not_shuffled(quick, capsys):
    folded = O.match_source(_source(quick, [f"k{n}" for n in range(50)]), MergeSpec(("k",), ("seq",)))
    assert folded.count() == 50
    assert "Exchange" not in _plan(folded, capsys)


def test_few_and_many_repeated_keys_give_what_collapse_gives(quick, monkeypatch):
    rnd = random.Random(3)
    source = _source(quick, [rnd.choice(["a", "b", *[f"k{n}" for n in range(80)]]) for _ in range(120)])
    rules = {"v": "coalesce_source", "seq": "least"}
    want = rows(O.collapse(source, ["k"], ["seq"], rules), "k", "seq", "v")
    assert rows(dedupe.collapse_repeated(source, ["k"], ["seq"], rules), "k", "seq", "v") == want
    monkeypatch.setattr(dedupe, "FEW", 0)
    staged = []
    folded = dedupe.collapse_repeated(source, ["k"], ["seq"], rules, stage=lambda df: staged.append(df) or df)
    assert rows(folded, "k", "seq", "v") == want and len(staged) == 1


def test_a_null_key_group_stays_one_group(quick):
    source = _source(quick, [None, None, "a"])
    assert rows(dedupe.collapse_repeated(source, ["k"], ["seq"]), "k", "seq") == rows(O.collapse(source, ["k"], ["seq"]), "k", "seq")


def test_guarded_records_of_an_empty_target_are_not_written_again(quick):
    target = quick.createDataFrame([], "id string, sf_id string, case_id string, name string")
    records = quick.createDataFrame(
        [("x1", "s1", "c1", "one", 1), ("x2", "s2", "c1", "two", 2), ("x3", "s3", "c3", "three", 3)], "id string, sf_id string, case_id string, name string, seq int"
    )
    staged = []
    spec = MergeSpec(("sf_id",), ("seq",))
    merged, actions = O.guarded_merge(target, records, ("sf_id", "case_id"), spec, stage=lambda df: staged.append(df) or df)
    assert rows(merged, "id", "sf_id", "case_id", "name") == [("x1", "s1", "c1", "two"), ("x3", "s3", "c3", "three")]
    assert rows(actions, "source_id", "target_id", "action") == [("x1", "x1", "inserted"), ("x2", "x1", "updated"), ("x3", "x3", "inserted")]
    assert not staged


def test_files_of_many_row_groups_are_not_spread_again(quick, tmp_path, capsys):
    from keyferry.queries.base import Data

    lines = quick.range(64).select(F.col("id").alias("l_orderkey"))
    lines.repartition(8).write.parquet(f"{tmp_path}/lineitem.parquet")
    quick.conf.set("spark.sql.files.openCostInBytes", str(128 << 20))
    try:
        assert "Exchange" not in _plan(Data(quick, str(tmp_path)).wide()("lineitem"), capsys)
    finally:
        quick.conf.unset("spark.sql.files.openCostInBytes")
    lines.coalesce(1).write.mode("overwrite").parquet(f"{tmp_path}/lineitem.parquet")
    assert "Exchange" in _plan(Data(quick, str(tmp_path)).wide()("lineitem"), capsys)
