import random

import pytest
from pyspark.sql import functions as F

from keyferry import operators as O
from keyferry.specs import ForeignKey, Lookup, TableSpec, columns


def test_lookup_spreads_null_keys(spark):
    left = spark.range(8000).select(F.col("id"), F.when(F.col("id") % 4 == 0, F.concat(F.lit("k"), F.col("id") % 8)).alias("k"))
    keys = spark.createDataFrame([("k0", "zero")], "k string, v string")
    got = O.lookup_key(left, keys, "k", "out")
    assert got.count() == 8000 and got.filter("out = 'zero'").count() == 1000
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = [r[0] for r in O.lookup_key(left, keys, "k", "out").groupBy(F.spark_partition_id()).count().select("count").collect()]
        assert len(sizes) == 4 and max(sizes) < 4000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_required_lookup_splits_every_row(quick):
    df = quick.createDataFrame([(1, "a"), (2, "x"), (3, None)], "i int, k string")
    keys = quick.createDataFrame([("a", "A")], "k string, v string")
    marked = O.lookup_required(df, [Lookup("k", keys, "v", required=True, reason="no v")])
    kept, bad = O.split_rejects(marked)
    assert [r["i"] for r in kept.collect()] == [1]
    assert {r["i"]: r[O.REJECT] for r in bad.collect()} == {2: "no v", 3: "no v"}
    assert O.load_summary(marked).first().asDict() == {"rows_in": 3, "rows_loaded": 1, "rows_skipped": 2}


def test_match_any_key_counts_distinct_rows(quick):
    t = quick.createDataFrame([("1", "a", "x"), ("2", "b", "y"), ("3", "c", "y")], "id string, k1 string, k2 string")
    s = quick.createDataFrame([(1, "a", "x"), (2, "a", "y"), (3, "z", "x"), (4, "z", None), (5, None, "y")], "i int, k1 string, k2 string")
    got = {r["i"]: (r["n_matches"], r["target_id"]) for r in O.match_any_key(s, t, ["k1", "k2"]).collect()}
    assert got == {1: (1, "1"), 2: (2, None), 3: (1, "1"), 4: (0, None), 5: (2, None)}


def test_constraints(quick):
    spec = TableSpec(
        "t", columns("id string, a string, n int, d decimal(4,2), ref string"), required=("a",), unique=(("a",),),
        foreign=(ForeignKey("ref", "p"),), domains={"a": ("x", "y", "z")},
    )
    df = quick.createDataFrame(
        [("1", "x", "5", 1.239, "p1"), ("2", None, "6", 1.0, None), ("3", "q", "6", 1.0, None), ("4", "y", "six", 1.0, None),
         ("5", "y", "6", 999.0, None), ("6", "y", "6", 1.0, "p9"), ("7", "x", "6", 1.0, None), ("8", "y", "6", 1.0, None)],
        "id string, a string, n string, d double, ref string",
    )
    parents = quick.createDataFrame([("p1",)], "id string")
    got = {r["id"]: r for r in O.validate(O.cast_to_spec(df, spec), spec, {"p": parents}, order=["id"]).collect()}
    assert {k: v[O.REJECT] for k, v in got.items()} == {
        "1": None, "2": "required:a", "3": "domain:a", "4": "cast:n", "5": "cast:d", "6": "fk:ref", "7": "unique:a", "8": None,
    }
    assert str(got["1"]["d"]) == "1.24"


@pytest.mark.parametrize("seed", range(3))
def test_resolve_within_follows_the_chains(quick, seed):
    rnd = random.Random(seed)
    rows = [(f"r{i:03}", rnd.choice([None, *[f"a{j}" for j in range(12)]]), rnd.choice([None, *[f"b{j}" for j in range(8)]])) for i in range(60)]
    known = {"a3": "T3", "a7": "T7"}
    first = {}
    for own, a, b in rows:
        first.setdefault(("a", a), own)
        first.setdefault(("b", b), own)
    actual = {}
    for own, a, b in rows:
        if a in known:
            actual[own] = known[a]
        elif a is not None and first["a", a] < own:
            actual[own] = actual[first["a", a]]
        elif b is not None and first["b", b] < own:
            actual[own] = actual[first["b", b]]
        else:
            actual[own] = own
    df = quick.createDataFrame(rows, "own string, a string, b string").repartition(3)
    hits = quick.createDataFrame(list(known.items()), "k string, id string")
    none = quick.createDataFrame([], "k string, id string")
    got = O.resolve_within(df, "own", [("a", hits), ("b", none)], [], "actual")
    assert {r["own"]: r["actual"] for r in got.collect()} == actual


def test_assign_unique_is_unique_and_stable(quick):
    df = quick.createDataFrame([(f"k{i}", "same" if i % 3 == 0 else f"n{i % 5}") for i in range(90)], "key string, base string")
    taken = quick.createDataFrame([("n1", "other"), ("n2", "k2")], "n string, o string")
    got = {r["key"]: r["name"] for r in O.assign_unique(df, "base", "key", [], "name", taken).collect()}
    assert len(set(got.values())) == 90 and "n1" not in got.values() and got["k2"] == "n2"
    stored = quick.createDataFrame([(v, k) for k, v in got.items()] + [("n1", "other")], "n string, o string")
    more = df.union(quick.createDataFrame([("a0", "same")], "key string, base string"))
    again = {r["key"]: r["name"] for r in O.assign_unique(more, "base", "key", [], "name", stored).collect()}
    assert {k: again[k] for k in got} == got and len(set(again.values())) == 91


def test_parent_path(quick):
    a = quick.createDataFrame([(1, "g1"), (2, "g2"), (3, None), (4, "g9")], "i int, g string")
    g = quick.createDataFrame([("g1", "p1"), ("g2", "p2")], "id string, p string")
    p = quick.createDataFrame([("p1", "Active"), ("p2", "Old")], "id string, status string")
    got = O.filter_by_parent(a, [O.Hop("g", g, "id"), O.Hop("p", p, "id")], F.col("status") == "Active")
    assert [r["i"] for r in got.collect()] == [1]


def test_hot_key_is_split_over_tasks(spark):
    """A third of the rows share one key: adaptive execution splits that partition."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000", "spark.sql.shuffle.partitions": "8",
    }
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(60000, numPartitions=8).selectExpr(
            "id", "uuid() AS pad", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3 = 1 THEN concat('k', id % 500) END AS k"
        )
        keys = spark.range(500).selectExpr("concat('k', id) AS k", "id AS v").union(spark.sql("SELECT 'hot', -1L"))
        df = O.lookup_key(rows, keys, "k", "v")
        assert df.filter("v = -1").count() == 20000
        df.collect()
        assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in conf:
            spark.conf.unset(k)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
