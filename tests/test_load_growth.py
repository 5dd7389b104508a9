"""What a load shuffles does not grow faster than its extracts."""

from pyspark.sql import functions as F

from keyferry import operators as O
from keyferry.operators import dedupe
from keyferry.specs import Lookup


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def test_of_many_repeated_keys_only_their_rows_are_gathered(quick, monkeypatch):
    source = quick.range(300).select(F.concat(F.lit("k"), F.when(F.col("id") < 40, F.col("id") % 20).otherwise(F.col("id"))).alias("k"), F.col("id").alias("seq"))
    want = rows(O.collapse(source, ["k"], ["seq"]), "k", "seq")
    monkeypatch.setattr(dedupe, "FEW", 5)
    staged = []
    folded = dedupe.collapse_repeated(source, ["k"], ["seq"], stage=lambda df: staged.append(df) or df)
    assert rows(folded, "k", "seq") == want
    assert staged[0].count() == 20  # not the 280 keys there are


def test_keys_that_share_a_mark_are_collapsed_each_by_itself(quick, monkeypatch):
    source = quick.range(2000).select((F.col("id") % 1500).alias("k"), F.col("id").alias("seq"))
    want = rows(O.collapse(source, ["k"], ["seq"]), "k", "seq")
    monkeypatch.setattr(dedupe, "FEW", 5)
    monkeypatch.setattr(dedupe, "WORDS", 2)
    assert rows(dedupe.collapse_repeated(source, ["k"], ["seq"]), "k", "seq") == want


def test_a_null_key_among_many_repeated_ones(quick, monkeypatch):
    source = quick.range(60).select(F.when(F.col("id") % 3 > 0, (F.col("id") % 15).cast("string")).alias("k"), F.col("id").alias("seq"))
    monkeypatch.setattr(dedupe, "FEW", 2)
    assert rows(dedupe.collapse_repeated(source, ["k"], ["seq"]), "k", "seq") == rows(O.collapse(source, ["k"], ["seq"]), "k", "seq")


def test_a_lookup_after_a_filter_by_the_same_column_does_not_shuffle_again(quick, capsys):
    quick.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    quick.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        records = quick.range(50).select(F.col("id").cast("string").alias("Id"), (F.col("id") % 9).cast("string").alias("up"))
        parents = quick.range(6).select(F.col("id").cast("string").alias("key"))
        ids = parents.select(F.col("key").alias("sf_id"), F.concat(F.lit("p"), "key").alias("id")).filter("key <> '2'")
        src = O.filter_by_parent(records, [O.Hop("up", parents, "key")], F.lit(True))
        out = O.lookup_required(src, [Lookup("up", ids, "parent_id", required=True, filled=True)])
        capsys.readouterr()
        out.explain()
        assert capsys.readouterr().out.count("Exchange") == 3  # records, allowed keys, key map
        plain = O.lookup_required(src, [Lookup("up", ids, "parent_id", required=True)])
        assert rows(out, "Id", "parent_id", "_reject") == rows(plain, "Id", "parent_id", "_reject")
    finally:
        quick.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        quick.conf.set("spark.sql.adaptive.enabled", "true")
