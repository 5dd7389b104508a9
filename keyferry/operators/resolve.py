"""Entity resolution by several keys in priority order, against the target and within one run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .dedupe import dedupe_first
from .lookup import lookup_key


def resolve_entity(
    df: DataFrame, candidates: Sequence[tuple[str, DataFrame]], out: str, fallback: Column | None = None
) -> DataFrame:
    """First match over (source column, key map) pairs in the given order, else the fallback."""
    for i, (src, keys) in enumerate(candidates):
        df = lookup_key(df, keys, src, f"_c{i}")
    found = [F.col(f"_c{i}") for i in range(len(candidates))]
    if fallback is not None:
        found.append(fallback)
    return df.withColumn(out, F.coalesce(*found)).drop(*[f"_c{i}" for i in range(len(candidates))])


def resolve_within(
    df: DataFrame,
    own: str,
    keys: Sequence[tuple[str, DataFrame]],
    order: Sequence[str],
    out: str,
) -> DataFrame:
    """Resolve each row to a target entity or to the entity of an earlier row of the same run.

    ``own`` is the row's own unique id, ``keys`` lists (column, target key map) by priority. For
    each key the target's match counts first, then the earliest row of the run with that value;
    the first key with either decides. A row that leads to an earlier row takes over what that
    row resolves to; a row that leads nowhere is its own entity.

    Of rows that repeat an id the first in order counts; all of them get what it resolves to. A row
    without an id resolves to nothing.

    The pointers form a forest (each leads to an earlier row). Their ends are found by pointer
    doubling, so a chain of n rows takes log2(n) rounds, and only rows that are still under way
    take part. Between rounds the open pointers are written to the checkpoint folder.
    """
    seq = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)], F.col(own).alias("own"))
    values = [F.col(col).alias(f"_v{i}") for i, (col, _) in enumerate(keys)]
    rows = df.filter(F.col(own).isNotNull()).select(F.col(own).alias("_row"), seq.alias("_seq"), *values)
    base = cut_lineage(dedupe_first(rows, ["_row"], ["_seq"]))
    nodes = base
    for i, (_, hits) in enumerate(keys):
        # found over the written rows alone, so the aggregates carry none of the joins before them
        firsts = base.filter(f"_v{i} IS NOT NULL").groupBy(F.col(f"_v{i}").alias("_value")).agg(
            F.min_by(F.struct(F.col("_row").alias("row"), "_seq"), "_seq").alias("_first")
        )
        nodes = lookup_key(nodes, hits, f"_v{i}", f"_t{i}")
        nodes = lookup_key(nodes, firsts, f"_v{i}", f"_e{i}")
    target, pointer = F.lit(None), F.lit(None)
    for i in reversed(range(len(keys))):
        t, e = F.col(f"_t{i}"), F.col(f"_e{i}")
        earlier = e.isNotNull() & (e["_seq"] < F.col("_seq"))
        target = F.when(t.isNotNull(), t).when(earlier, F.lit(None)).otherwise(target)
        pointer = F.when(t.isNotNull(), F.lit(None)).when(earlier, e["row"]).otherwise(pointer)
    kind = df.schema[own].dataType
    # A row is settled when it has no pointer: it is a target entity or its own.
    nodes = nodes.select(
        "_row",
        F.coalesce(target.cast(kind), F.when(pointer.isNull(), F.col("_row"))).alias("_end"),
        pointer.cast(kind).alias("_next"),
    )
    nodes = cut_lineage(nodes)
    settled = nodes.filter(F.col("_next").isNull()).select("_row", "_end")
    under_way = nodes.filter(F.col("_next").isNotNull()).select("_row", "_next")
    while not under_way.isEmpty():
        jump = under_way.select(F.col("_row").alias("_via"), F.col("_next").alias("_far"))
        ends = settled.select(F.col("_row").alias("_via"), "_end")
        step = (
            under_way.join(ends, F.col("_next") == F.col("_via"), "left")
            .drop("_via")
            .join(jump, F.col("_next") == F.col("_via"), "left")
            .select("_row", F.coalesce("_far", "_next").alias("_next"), "_end")
        )
        step = cut_lineage(step)
        settled = settled.unionByName(step.filter(F.col("_end").isNotNull()).select("_row", "_end"))
        under_way = step.filter(F.col("_end").isNull()).select("_row", "_next")
    return lookup_key(df, settled, own, out)
