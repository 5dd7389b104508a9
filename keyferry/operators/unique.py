"""Collision-free names: the first row keeps the plain name, the others get a key-based suffix."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .dedupe import dedupe_first
from .lookup import lookup_key

DIGITS = 8  # hex digits the suffix grows by per round
SHA1_DIGITS = 40


def _dashed(base: Column, tag: Column) -> Column:
    return F.concat(base, F.lit("-"), tag)


def before_domain(base: Column, tag: Column) -> Column:
    """Suffix for e-mail addresses: before the @ sign."""
    return F.concat(
        F.substring_index(base, "@", 1), F.lit("."), tag, F.lit("@"), F.substring_index(base, "@", -1)
    )


def assign_unique(
    df: DataFrame,
    base: str,
    key: str,
    order: Sequence[str],
    out: str,
    taken: DataFrame | None = None,
    suffixed: Callable[[Column, Column], Column] = _dashed,
) -> DataFrame:
    """Give every row a name no other row and no other owner in ``taken`` has.

    ``taken`` holds (name, owner key); a name the row itself owned before counts as free, so a
    second run changes nothing. Rows that lose a name try again with more digits of the hash of
    their key; with 8 digits the second round already settles nearly all rows, however many share
    one base. Rows of one key share its name, made from the first of them in order. A row without a
    name or without a key gets none. If the full hash does not tell two rows apart (a suffixed name
    that is taken by somebody else), the run ends with an error.
    """
    seq = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)], F.col(key).alias("key"))
    named = df.filter(F.col(key).isNotNull() & F.col(base).isNotNull())
    rows = named.select(F.col(key).alias("_key"), F.col(base).alias("_base"), seq.alias("_seq"))
    open_rows = cut_lineage(dedupe_first(rows, ["_key"], ["_seq", "_base"]))
    if taken is not None:
        name, owner = taken.columns
        held = taken.select(F.col(name).alias("_name"), F.col(owner).alias("_owner"))
    else:
        held = None
    done: DataFrame | None = None
    size = 0
    while not open_rows.isEmpty():
        if size > SHA1_DIGITS:
            raise ValueError(f"{out}: names are still taken after all digits of the suffix")
        tag = F.sha1(F.col("_key").cast("string")).substr(1, size)
        cand = F.col("_base") if size == 0 else suffixed(F.col("_base"), tag)
        tries = open_rows.withColumn("_cand", cand)
        if held is not None:
            tries = lookup_key(tries, held, "_cand", "_held")
        else:
            tries = tries.withColumn("_held", F.lit(None).cast(df.schema[key].dataType))
        if done is not None:
            tries = lookup_key(tries, done.select("_cand", F.col("_key").alias("_by")), "_cand", "_used")
        else:
            tries = tries.withColumn("_used", F.lit(None).cast(df.schema[key].dataType))
        may = (F.col("_held").isNull() | (F.col("_held") == F.col("_key"))) & F.col("_used").isNull()
        # An owner that is part of the run keeps its name before anyone else may claim it.
        rank = F.struct((F.col("_held").isNull()).cast("int"), F.col("_seq"))
        best = tries.filter(may).groupBy("_cand").agg(F.min_by("_key", rank).alias("_best"))
        tries = cut_lineage(lookup_key(tries, best, "_cand", "_best"))
        won = F.coalesce(F.col("_best") == F.col("_key"), F.lit(False))
        winners = tries.filter(won).select("_key", "_cand")
        done = winners if done is None else done.unionByName(winners)
        open_rows = tries.filter(~won).select("_key", "_base", "_seq")
        size += DIGITS
    if done is None:
        return df.withColumn(out, F.lit(None).cast("string"))
    return lookup_key(df, done, key, out)
