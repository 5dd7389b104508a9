"""Exact dedup of documents that are equal once ASCII white space is deleted.

Skew-safe combining in three steps, each comparing the full normalised text, never the digest alone:

1. local: Spark's map-side aggregation keyed by (digest, salt, text) leaves one row per text and task;
2. salted: the salt is the task's number, so the local winners of a hot text meet in ``salts`` groups;
3. global: the salt winners, at most ``salts`` rows per text, are dealt by digest and combined.

The result goes back to the documents by digest. A digest whose texts differ (found in step 3, where
all its texts have met) is not trusted: its documents are joined by digest and full text instead.

Defined cases: a null text counts as empty and all empty texts are one group; a null id loses ties and
``keep_id`` is null only when every id of the longest texts is null; a repeated row belongs to its
group each time, and each repetition of the winning row is marked kept (``drop_copies`` leaves one);
an empty table gives an empty result; further columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import squeezed, whole

# A winner's rank is one number, longest text first and then smallest id, so that aggregation buffers
# stay fixed-width: code points * 10^20 + (2^63 - id), with 0 in the place of a null id.
ID_SPAN, ID_TOP = 10**20, 2**63


def sha256_hex(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _decimal(n: int) -> Column:
    return F.lit(str(n)).cast(f"decimal({len(str(n))},0)")


def _rank(n_chars: Column, doc_id: Column) -> Column:
    below = F.coalesce(_decimal(ID_TOP) - doc_id.cast("decimal(20,0)"), _decimal(0))
    return (n_chars.cast("decimal(10,0)") * _decimal(ID_SPAN) + below).cast("decimal(38,0)")


def _unrank(best: Column) -> tuple[Column, Column]:
    below = best % _decimal(ID_SPAN)
    keep_id = F.when(below > 0, (_decimal(ID_TOP) - below).cast("bigint"))
    return keep_id, ((best - below) / _decimal(ID_SPAN)).cast("bigint")


def _combined(rows: DataFrame, salts: int) -> DataFrame:
    """One row per (digest, text), dealt by digest."""
    salted = (
        rows.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
        .groupBy("digest", "salt", "norm")
        .agg(F.max("rank").alias("best"), F.count(F.lit(1)).alias("n"))
    )
    return salted.repartition("digest").groupBy("digest", "norm").agg(F.max("best").alias("best"), F.sum("n").alias("n"))


def exact_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    salts: int = 32,
    digest: Callable[[Column], Column] = sha256_hex,
) -> DataFrame:
    """One row per document: id, n_code_points, digest, keep_id, group_size, best_code_points, kept."""
    rows = docs.select(F.col(id_col).alias("id"), F.length(whole(text_col)).alias("cp"), squeezed(whole(text_col)).alias("norm"))
    rows = rows.select("id", "cp", "norm", digest(F.col("norm")).alias("digest"))
    ranked = rows.select("digest", "norm", _rank(F.col("cp"), F.col("id")).alias("rank"))
    # dealt by digest already: counting the texts of a digest needs no further shuffle
    classes = cut_lineage(
        _combined(ranked, salts)
        .groupBy("digest")
        .agg(F.count(F.lit(1)).alias("variants"), F.max("best").alias("best"), F.sum("n").alias("n"))
    )
    out = rows.select("id", "cp", "digest").join(classes.where("variants = 1").drop("variants"), "digest")
    clashing = classes.where("variants > 1").select("digest")
    if not clashing.isEmpty():
        differ = rows.join(clashing, "digest", "left_semi")
        exact = _combined(ranked.join(clashing, "digest", "left_semi"), salts)
        out = out.unionByName(differ.join(exact, ["digest", "norm"]).drop("norm"))
    keep_id, best_cp = _unrank(F.col("best"))
    return out.select(
        F.col("id").alias(id_col),
        F.col("cp").alias("n_code_points"),
        "digest",
        keep_id.alias("keep_id"),
        F.col("n").alias("group_size"),
        best_cp.alias("best_code_points"),
        (F.col("id").eqNullSafe(keep_id) & (F.col("cp") == best_cp)).alias("kept"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 32) -> DataFrame:
    """The documents that stay, all their columns, one row per group of equal texts."""
    winners = (
        exact_classes(docs, id_col, text_col, salts)
        .where("kept")
        .select(F.col("digest").alias("keep_digest"), F.col(id_col).alias("keep_id"), F.col("n_code_points").alias("keep_cp"))
        .distinct()
    )
    # the row travels as one column: no name of its own can clash
    keyed = docs.select(
        F.struct(*docs.columns).alias("row"),
        sha256_hex(squeezed(whole(text_col))).alias("digest"),
        F.length(whole(text_col)).alias("cp"),
        F.col(id_col).alias("id"),
    )
    match = (F.col("digest") == F.col("keep_digest")) & (F.col("cp") == F.col("keep_cp")) & F.col("id").eqNullSafe(F.col("keep_id"))
    # repetitions of the winning row meet here; one stays
    return keyed.join(winners, match).dropDuplicates(["digest", "cp", "id"]).select("row.*")
