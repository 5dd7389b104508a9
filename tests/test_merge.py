import random

import pytest
from pyspark.sql import functions as F

from keyferry import operators as O
from keyferry.queries import QUERIES
from keyferry.specs import MergeSpec

T_SCHEMA = "id string, sf_id string, case_id string, name string, note string, created long"


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def test_column_rules_and_actions(quick):
    t = quick.createDataFrame([("1", "a", 5, "x", 1), ("2", "b", 5, "y", 1), ("3", None, 5, "z", 1)], "id string, k string, c int, note string, v int")
    s = quick.createDataFrame(
        [("n1", "a", 3, None, 1, 1), ("n2", "a", 4, "q", 2, 2), ("n3", "b", 9, None, 1, 1), ("n4", None, 1, "w", 1, 1), ("n5", "c", 2, None, 1, 1)],
        "id string, k string, c int, note string, v int, seq int",
    )
    spec = MergeSpec(("k",), ("seq",), {"id": "target", "c": "least", "note": "coalesce_source"}, changed="v")
    got = rows(O.merge_with_actions(t, s, spec), "id", "k", "c", "note", "v", "_action")
    assert got == sorted([
        ("1", "a", 3, "q", 2, "updated"), ("2", "b", 5, "y", 1, "unchanged"), ("3", None, 5, "z", 1, "kept"),
        ("n4", None, 1, "w", 1, "inserted"), ("n5", "c", 2, None, 1, "inserted"),
    ], key=repr)


def test_delta_equals_full_and_repeat_changes_nothing(quick):
    rnd = random.Random(1)
    t = quick.createDataFrame([(i, f"t{i}", i) for i in range(200)], "k long, v string, c long")
    s = quick.createDataFrame([(rnd.randrange(300), f"s{i}", i) for i in range(150)], "k long, v string, c long")
    spec = MergeSpec(("k",), ("c",), {"c": "least"})
    full = O.merge(t, s, spec)
    small = O.merge(t, s, MergeSpec(("k",), ("c",), {"c": "least"}, delta=True))
    assert rows(full, "k", "v", "c") == rows(small, "k", "v", "c")
    assert rows(O.merge(full, s.repartition(7), spec), "k", "v", "c") == rows(full, "k", "v", "c")
    assert full.count() == full.select("k").distinct().count()


def test_insert_only_keeps_stored_rows(quick):
    t = quick.createDataFrame([("a", 1)], "k string, v int")
    s = quick.createDataFrame([("a", 9), ("b", 2), ("b", 1)], "k string, v int")
    assert rows(O.insert_only(t, s, ["k"], ["v"]), "k", "v") == [("a", 1), ("b", 1)]


def test_fallback_key(quick):
    t = quick.createDataFrame([("s1", "x1", 0), (None, "x2", 0)], "sub string, sf string, v int")
    s = quick.createDataFrame([("s1", "x9", 1), (None, "x2", 2), (None, "x3", 3)], "sub string, sf string, v int")
    got = rows(O.merge(t, s, MergeSpec(("sub", "sf"), ("v",))), "sub", "sf", "v")
    assert got == sorted([("s1", "x9", 1), (None, "x2", 2), (None, "x3", 3)], key=repr)


def one_by_one(target, records):
    """Apply the records one after the other, as the guarded upsert describes."""
    table = {r[0]: dict(zip(("id", "sf_id", "case_id", "name", "note", "created"), r)) for r in target}
    snapshot = [dict(r) for r in table.values()]

    def hits(state, rec):
        return {
            r["id"] for r in state
            if (rec["sf_id"] is not None and r["sf_id"] == rec["sf_id"]) or (rec["case_id"] is not None and r["case_id"] == rec["case_id"])
        }

    def step(rec):
        found = hits(snapshot, rec)
        if len(found) != 1:
            return 0 if found else 3
        row = next(r for r in snapshot if r["id"] in found)
        return 1 if rec["case_id"] in (None, row["case_id"]) else 2

    actions = {}
    for rec in sorted(records, key=lambda r: (step(r), r["seq"])):
        found = hits(table.values(), rec)
        if len(found) > 1:
            actions[rec["id"]] = "duplicate_conflict"
        elif found:
            row = table[found.pop()]
            row["name"] = rec["name"]
            row["sf_id"] = row["sf_id"] if row["sf_id"] is not None else rec["sf_id"]
            row["case_id"] = rec["case_id"] if rec["case_id"] is not None else row["case_id"]
            row["created"] = min(row["created"], rec["created"])
            actions[rec["id"]] = "updated"
        else:
            table[rec["id"]] = {k: rec[k] for k in ("id", "sf_id", "case_id", "name", "note", "created")}
            actions[rec["id"]] = "inserted"
    return table, actions


@pytest.mark.parametrize("seed", range(4))
def test_guarded_merge_equals_one_by_one(quick, seed):
    rnd = random.Random(seed)
    target = [(f"t{i}", f"S{i}" if rnd.random() < 0.7 else None, f"C{i}", "old", "n", 100) for i in range(25)]
    records = []
    for i in rnd.sample(range(60), 45):
        case = rnd.choice([f"C{rnd.randrange(30)}", f"N{rnd.randrange(6)}", "hot", None])
        records.append({"id": f"r{i}", "sf_id": f"S{i}", "case_id": case, "name": f"v{i}", "note": "s", "created": rnd.randrange(200), "seq": i})
    t = quick.createDataFrame(target, T_SCHEMA)
    s = quick.createDataFrame([tuple(r.values()) for r in records], T_SCHEMA + ", seq long").repartition(3)
    spec = MergeSpec(("sf_id",), ("seq",), {"created": "least", "note": "target"})
    merged, actions = O.guarded_merge(t, s, ("sf_id", "case_id"), spec)
    table, done = one_by_one(target, records)
    cols = ("id", "sf_id", "case_id", "name", "note", "created")
    assert rows(merged, *cols) == sorted((tuple(r[c] for c in cols) for r in table.values()), key=repr)
    assert dict(rows(actions, "source_id", "action")) == done


def test_hot_key_is_combined_before_the_shuffle(spark):
    hot = spark.range(20000).select((F.col("id") % 7).alias("u"), F.concat(F.lit("hot"), F.col("id") % 1).alias("k"), F.col("id").alias("v"))
    plan = O.dedupe_last(hot, ["k"], ["v"])._jdf.queryExecution().toString()
    assert plan.index("WindowGroupLimit") < plan.index("Exchange hashpartitioning") < plan.rindex("WindowGroupLimit")
    assert O.dedupe_last(hot, ["k"], ["v"]).first()["v"] == 19999
    got = O.collapse(hot, ["k"], ["v"], {"u": "least"})
    assert "partial_max_by" in got._jdf.queryExecution().toString()
    assert [tuple(r) for r in got.select("k", "u", "v").collect()] == [("hot0", 0, 19999)]


def test_repeated_guarded_merge_changes_nothing(quick):
    t = quick.createDataFrame([], "id string, sf_id string, case_id string, name string")
    s = quick.createDataFrame(
        [("r1", "S1", "C1", "first", 1), ("r2", "S2", "C1", "second", 2), ("r3", "S3", None, "alone", 3)],
        "id string, sf_id string, case_id string, name string, seq long",
    )
    spec = MergeSpec(("sf_id",), ("seq",))
    once, _ = O.guarded_merge(t, s, ("sf_id", "case_id"), spec)
    twice, actions = O.guarded_merge(once, s, ("sf_id", "case_id"), spec)
    cols = ("id", "sf_id", "case_id", "name")
    assert rows(once, *cols) == [("r1", "S1", "C1", "second"), ("r3", "S3", None, "alone")] == rows(twice, *cols)
    assert {r["action"] for r in actions.collect()} == {"updated"}


def _keyless_tables(spark, path):
    """One order with two lines that have no key and are equal in every column but their number."""
    spark.sql("SELECT 3L AS o_orderkey, 1.0D AS o_totalprice, 'O' AS o_orderstatus").write.parquet(f"{path}/orders.parquet")
    lines = "SELECT 3L AS l_orderkey, 5.0D AS l_quantity, 'N' AS l_returnflag, {} AS l_linenumber"
    spark.sql(" UNION ALL ".join(lines.format(n) for n in (2, 3))).write.parquet(f"{path}/lineitem.parquet")
    return str(path)


def test_merge_null_int_keys_returns_every_row(quick, tmp_path):
    found = QUERIES["merge_null_int_keys"](quick, _keyless_tables(quick, tmp_path))
    assert found.columns == ["code", "price", "note"]
    assert [tuple(r) for r in found.collect()] == [(None, 5.0, "N")] * 2


def test_insert_only_null_keys_returns_every_row(quick, tmp_path):
    found = QUERIES["insert_only_null_keys"](quick, _keyless_tables(quick, tmp_path))
    assert found.columns == ["code", "price", "note"]
    assert [tuple(r) for r in found.collect()] == [(None, 5.0, "N")] * 2
