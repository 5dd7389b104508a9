"""Status, gender, attendance and record-kind labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .clean import map_tokens, strip

# Accepted texts per label.
INACTIVE_TOKENS = ("inactive", "disabled", "false", "0")
PRESENT_TOKENS = ("present", "attended", "yes", "true")
ABSENT_TOKENS = ("absent", "no", "false")


def status_label(c: Column) -> Column:
    return map_tokens(c, {"Inactive": INACTIVE_TOKENS}, default="Active")


def gender(c: Column, default: str | None = None) -> Column:
    s = F.lower(strip(c))
    out = F.when(s.startswith("m"), F.lit("Male")).when(s.startswith("f"), F.lit("Female"))
    return out if default is None else F.coalesce(out, F.lit(default))


def attendance(status: Column, attended: Column) -> Column:
    """Status text if it is a known one, else the attended count, else Absent."""
    label = map_tokens(status, {"Present": PRESENT_TOKENS, "Absent": ABSENT_TOKENS})
    by_count = F.when(attended > 0, F.lit("Present")).otherwise(F.lit("Absent"))
    return F.coalesce(label, by_count)


def kind_by_substring(c: Column, text: str, if_found: str, otherwise: str) -> Column:
    """One of two labels by a case-insensitive substring; null for null and empty texts."""
    return F.when(
        F.coalesce(c, F.lit("")) != "",
        F.when(F.lower(c).contains(text), F.lit(if_found)).otherwise(F.lit(otherwise)),
    )
