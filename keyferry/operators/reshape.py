"""Projection maps and wide-to-long reshaping; all narrow, one pass over the source each.

Cells are exploded first and filtered as rows then: both steps run in generated code, which functions
over array elements do not.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clean import has_value, strip
from ..functions.keys import composite_key


def project_map(df: DataFrame, mapping: Mapping[str, Column | str]) -> DataFrame:
    """Select ``{canonical name: source field or expression}``."""
    return df.select(
        *[(F.col(e) if isinstance(e, str) else e).alias(name) for name, e in mapping.items()]
    )


def sorted_projection(df: DataFrame, *groups: Iterable[str]) -> DataFrame:
    """Union of several field lists, each field once, in name order."""
    return df.select(*sorted({f for group in groups for f in group}))


def explode_groups(
    df: DataFrame,
    groups: Mapping[str, Sequence[str]],
    id: str,
    alt: str,
    carry: Sequence[str] = (),
    out: str = "group_name",
    sep: str = ":",
) -> DataFrame:
    """One header row per record and group that has any value.

    ``groups`` maps a group name to its fields. Header keys are ``<id>:<group>`` and
    ``<alt>:<group>``.
    """
    present = [F.when(_any_value(fields), F.lit(name)) for name, fields in groups.items()]
    rows = df.select(id, alt, *carry, F.explode(F.array(*present)).alias(out)).filter(F.col(out).isNotNull())
    return rows.select(
        composite_key(sep, F.col(id), F.col(out)).alias("header_id"),
        composite_key(sep, F.col(alt), F.col(out)).alias("header_alt_id"),
        out,
        *carry,
    )


def _any_value(fields: Sequence[str]) -> Column:
    seen = F.lit(False)
    for f in fields:
        seen = seen | has_value(F.col(f))
    return seen


def unpivot_fields(
    df: DataFrame,
    groups: Mapping[str, Sequence[str]],
    id: str,
    alt: str,
    names: Mapping[str, str] | None = None,
    default_name=None,
    carry: Sequence[str] = (),
    sep: str = ":",
) -> DataFrame:
    """One row per non-blank field: owner header key, row keys, field, question key, raw value.

    ``names`` maps a field to its question key; without an entry ``default_name(field)`` is used,
    or the field itself.
    """
    names = names or {}
    cells = [
        F.struct(
            F.lit(group).alias("g"),
            F.lit(f).alias("f"),
            F.lit(names.get(f) or (default_name(f) if default_name else f)).alias("q"),
            F.col(f).cast("string").alias("v"),
        )
        for group, fields in groups.items()
        for f in fields
    ]
    rows = df.select(id, alt, *carry, F.explode(F.array(*cells)).alias("_c")).filter(has_value(F.col("_c.v")))
    c = F.col("_c")
    return rows.select(
        composite_key(sep, F.col(id), c["g"]).alias("header_id"),
        composite_key(sep, F.col(id), c["g"], c["q"]).alias("row_id"),
        composite_key(sep, F.col(alt), c["g"], c["q"]).alias("row_alt_id"),
        c["g"].alias("group_name"),
        c["f"].alias("field"),
        c["q"].alias("question_key"),
        strip(c["v"]).alias("raw_value"),
        *carry,
    )


def fan_out(
    df: DataFrame,
    parts: Sequence[tuple[str, str, bool]],
    id: str,
    carry: Sequence[str] = (),
    key: str = "row_key",
    value: str = "value",
) -> DataFrame:
    """Fixed fan-out of several columns to rows: ``(column, key suffix, always emitted)``."""
    cells = [
        F.struct(
            F.concat(F.col(id).cast("string"), F.lit(suffix)).alias("k"),
            F.col(col).alias("v"),
            (F.lit(True) if always else F.coalesce(F.col(col) != "", F.lit(False))).alias("on"),
        )
        for col, suffix, always in parts
    ]
    rows = df.select(id, *carry, F.explode(F.array(*cells)).alias("_c")).filter("_c.on")
    return rows.select(id, *carry, F.col("_c.k").alias(key), F.col("_c.v").alias(value))


def multi_emit(
    df: DataFrame,
    emits: Sequence[tuple[str, Column, Column]],
    carry: Sequence[str],
    kind: str = "kind",
    value: str = "value",
) -> DataFrame:
    """Up to one row per ``(kind, value, condition)`` and record, values as text."""
    cells = [
        F.struct(F.lit(k).alias("k"), v.cast("string").alias("v"), F.coalesce(on, F.lit(False)).alias("on"))
        for k, v, on in emits
    ]
    rows = df.select(*carry, F.explode(F.array(*cells)).alias("_c")).filter("_c.on")
    return rows.select(*carry, F.col("_c.k").alias(kind), F.col("_c.v").alias(value))
