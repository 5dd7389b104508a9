"""Null-token cleaning, tri-state booleans, fallbacks and token maps.

Every function takes and returns a Column built from JVM functions only, so a whole cleaning
projection stays inside one whole-stage-codegen span and never leaves the scan's stage.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters treated as blank at either end of a text.
WHITESPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# Texts that mean "no value", and the accepted yes/no texts.
NULL_TOKENS = ("nan", "null", "none", "nil")
TRUE_TOKENS = ("true", "1", "yes", "y")
FALSE_TOKENS = ("false", "0", "no", "n")
LEGACY_TRUE_TOKENS = ("true", "1", "t", "yes", "y")


def strip(c: Column) -> Column:
    """Trim Unicode blanks from both ends (Spark's plain ``trim`` only removes U+0020)."""
    return F.btrim(c, F.lit(WHITESPACE))


def clean_str(c: Column) -> Column:
    """Trimmed text; blank texts and null tokens become null."""
    s = strip(c.cast("string"))
    return F.when((s != "") & ~F.lower(s).isin(*NULL_TOKENS), s)


def has_value(c: Column) -> Column:
    """True when the value is neither null nor blank."""
    return c.isNotNull() & (strip(c.cast("string")) != "")


def to_bool3(c: Column, default: bool | None = None) -> Column:
    """Yes/no text to boolean; anything else is null, or ``default`` when one is given."""
    s = F.lower(strip(c.cast("string")))
    out = F.when(s.isin(*TRUE_TOKENS), F.lit(True)).when(s.isin(*FALSE_TOKENS), F.lit(False))
    return out if default is None else F.coalesce(out, F.lit(default))


def to_bool2(c: Column, keep_null: bool = False) -> Column:
    """Two-state boolean of the legacy files: listed texts are true, all else false.

    With ``keep_null`` a null-token input stays null instead of becoming false.
    """
    s = F.lower(strip(c.cast("string")))
    out = F.coalesce(s.isin(*LEGACY_TRUE_TOKENS), F.lit(False))
    return F.when(clean_str(c).isNotNull(), out) if keep_null else out


def truthy(c: Column) -> Column:
    """Boolean flag with null read as false."""
    return F.coalesce(c.cast("boolean"), F.lit(False))


def equals_flag(c: Column, text: str) -> Column:
    return F.coalesce(c == text, F.lit(False))


def first_truthy(*cols: Column, numeric: bool = False) -> Column:
    """First value that is neither null nor empty ("" for text, 0 with ``numeric``)."""
    empty = F.lit(0) if numeric else F.lit("")
    return F.coalesce(*[F.when(c != empty, c) for c in cols])


def null_safe_sum(*cols: Column) -> Column:
    total = F.coalesce(cols[0], F.lit(0))
    for c in cols[1:]:
        total = total + F.coalesce(c, F.lit(0))
    return total


def join_nonempty(sep: str, *cols: Column) -> Column:
    """Join the non-empty values, each trimmed; null when there is none.

    A value of blanks only counts as present and contributes an empty piece.
    """
    parts = [F.when(c != "", strip(c)) for c in cols]
    return F.when(F.coalesce(*parts).isNotNull(), F.concat_ws(sep, *parts))


def map_tokens(c: Column, groups: Mapping[str, Sequence[str]], default: str | None = None) -> Column:
    """Map lower-cased, trimmed texts to labels: ``{label: [texts]}``."""
    s = F.lower(strip(c.cast("string")))
    out = F.lit(default).cast("string")
    for label, tokens in reversed(list(groups.items())):
        out = F.when(s.isin(*tokens), F.lit(label)).otherwise(out)
    return out
