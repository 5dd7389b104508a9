"""Row filters: flags, parent paths, required values, scope."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.clean import has_value
from .dedupe import dedupe_first
from .quality import reject_first


@dataclass(frozen=True)
class Hop:
    """One step up a parent path: this frame's column refers to ``key`` of ``parent``."""

    column: str
    parent: DataFrame
    key: str


def filter_active(df: DataFrame, deleted_flag: str) -> DataFrame:
    """Rows that are not soft-deleted; a plain predicate, so it reaches the scan."""
    return df.filter(~F.col(deleted_flag))


def filter_by_parent(df: DataFrame, hops: Sequence[Hop], predicate: Column) -> DataFrame:
    """Keep rows whose ancestor at the end of the path satisfies the predicate.

    The predicate is applied to the farthest table first and only key columns travel back down,
    one semi join per hop.
    """
    allowed = hops[-1].parent.filter(predicate).select(F.col(hops[-1].key).alias("_hop"))
    for hop, upper in zip(reversed(hops[:-1]), reversed(hops[1:])):
        near = hop.parent.select(F.col(hop.key).alias("_near"), F.col(upper.column).alias("_up"))
        allowed = near.join(allowed, F.col("_up") == F.col("_hop"), "left_semi").select(
            F.col("_near").alias("_hop")
        )
    return df.join(allowed, F.col(hops[0].column) == F.col("_hop"), "left_semi")


def require_all(df: DataFrame, columns: Sequence[str], falsy: bool = False) -> DataFrame:
    """Mark rows with a missing value: null or blank, and with ``falsy`` also 0 and false."""
    checks, schema = [], df.schema
    for name in columns:
        kind = schema[name].dataType
        if isinstance(kind, T.StringType):
            ok = F.col(name).isNotNull() & (F.col(name) != "") if falsy else has_value(F.col(name))
        elif falsy and isinstance(kind, T.NumericType):
            ok = F.col(name).isNotNull() & (F.col(name) != 0)
        elif falsy and isinstance(kind, T.BooleanType):
            ok = F.col(name).isNotNull() & F.col(name)
        else:
            ok = F.col(name).isNotNull()
        checks.append((~ok, f"missing:{name}"))
    return reject_first(df, checks)


def in_scope(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows whose key occurs in the other frame's first column."""
    scope = keys.select(F.col(keys.columns[0]).alias("_scope"))
    return df.join(scope, F.col(on) == F.col("_scope"), "left_semi")


def not_existing(
    df: DataFrame, existing: DataFrame, key: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """First row per composite key whose key the existing table does not hold yet."""
    firsts = dedupe_first(df, key, order)
    held = existing.select(*[F.col(c).alias(f"_h{i}") for i, c in enumerate(key)])
    on = F.lit(True)
    for i, c in enumerate(key):
        on = on & (F.col(c) == F.col(f"_h{i}"))
    return firsts.join(held, on, "left_anti")
