"""Lenient conversions. ANSI mode raises on bad casts, so every cast here is a ``try_cast``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .clean import clean_str, strip, to_bool3

# Accepted number shapes. Spark itself would also accept "1d" and "1f".
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
SPECIAL = r"(?i)^[+-]?(nan|inf|infinity)$"
URL_PREFIXES = ("http://", "https://")


def to_double(c: Column) -> Column:
    """Number or null. NaN and infinities are accepted as texts, as a float parser would."""
    s = strip(c.cast("string"))
    sign = F.when(s.startswith("-"), F.lit(-1.0)).otherwise(F.lit(1.0))
    special = F.when(F.lower(s).endswith("nan"), F.lit(float("nan"))).otherwise(
        sign * F.lit(float("inf"))
    )
    return F.when(s.rlike(NUMBER), s.try_cast("double")).when(s.rlike(SPECIAL), special)


def to_int(c: Column) -> Column:
    """Whole number, truncated toward zero; null when not a finite number.

    Returned as bigint. ``cast_to_spec`` rejects what does not fit the declared column.
    """
    s = strip(c.cast("string"))
    return F.when(
        s.rlike(NUMBER), F.coalesce(s.try_cast("bigint"), s.try_cast("double").try_cast("bigint"))
    )


def to_date_safe(c: Column) -> Column:
    return clean_str(c).try_cast("date")


def to_ts_utc(c: Column) -> Column:
    """Instant or null. Texts without a zone are read in the session zone, which is pinned to UTC."""
    return clean_str(c).try_cast("timestamp")


def to_ts_ntz(c: Column) -> Column:
    """Instant in UTC with the zone dropped."""
    return to_ts_utc(c).cast("timestamp_ntz")


def typed_value(c: Column) -> Column:
    """Exactly one of text / numeric / boolean / url from a raw answer.

    Yes/no texts win over numbers (so "1" is true), numbers over links, links over text.
    """
    s = strip(c.cast("string"))
    flag = to_bool3(c)
    number = F.when(flag.isNull() & s.rlike(NUMBER), s.try_cast("double"))
    is_url = F.lower(s).startswith(URL_PREFIXES[0]) | F.lower(s).startswith(URL_PREFIXES[1])
    rest = flag.isNull() & number.isNull()
    return F.struct(
        F.when(rest & ~is_url, s).alias("text"),
        number.alias("numeric"),
        flag.alias("boolean"),
        F.when(rest & is_url, s).alias("url"),
    )
