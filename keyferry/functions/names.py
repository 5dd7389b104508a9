"""Person names, e-mail addresses and user names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .clean import clean_str, strip

# Stand-ins for a missing name.
UNKNOWN_FIRST = "Unknown"
UNKNOWN_LAST = "User"
BLANKS = r"(?U)\s+"


def _tokens(c: Column) -> Column:
    return F.split(strip(c), BLANKS)


def split_name(c: Column) -> Column:
    """Full name to first / middle / last; one token serves as both first and last."""
    full = F.coalesce(c, F.lit(""))
    t = _tokens(full)
    n = F.size(t)
    blank = strip(full) == ""
    return F.struct(
        F.when(blank, F.lit(UNKNOWN_FIRST)).otherwise(F.get(t, F.lit(0))).alias("first_name"),
        F.when(~blank & (n > 2), F.array_join(F.slice(t, F.lit(2), F.greatest(n - 2, F.lit(0))), " ")).alias(
            "middle_name"
        ),
        F.when(blank, F.lit(UNKNOWN_LAST)).otherwise(F.get(t, n - 1)).alias("last_name"),
    )


def split_name_last(c: Column, last: Column) -> Column:
    """First and last name when the last name is known.

    The last whole token equal to ``last`` starts the last name. Without such a token the first
    token is the first name and the rest the last name.
    """
    t = _tokens(c)
    n = F.size(t)
    back = F.array_position(F.reverse(t), last)
    at = (n - back).cast("int")
    known = (F.coalesce(last, F.lit("")) != "") & (back > 0) & (n >= 2)
    empty = F.coalesce(strip(c), F.lit("")) == ""
    head = F.array_join(F.slice(t, F.lit(1), F.greatest(at, F.lit(0))), " ")
    tail = F.array_join(F.slice(t, F.greatest(at, F.lit(0)) + 1, n), " ")
    rest = F.array_join(F.slice(t, F.lit(2), n), " ")
    return F.struct(
        F.when(empty, F.lit(None).cast("string"))
        .when(known, F.nullif(head, F.lit("")))
        .otherwise(F.get(t, F.lit(0)))
        .alias("first_name"),
        F.when(empty, last)
        .when(known, tail)
        .when(n >= 2, rest)
        .otherwise(F.nullif(last, F.lit("")))
        .alias("last_name"),
    )


def norm_email(c: Column) -> Column:
    return F.lower(clean_str(c))


def username(email: Column, name: Column) -> Column:
    """Local part of the e-mail, else the dotted lower-case full name."""
    local = F.lower(strip(F.split_part(clean_str(email), F.lit("@"), F.lit(1))))
    dotted = F.array_join(_tokens(F.lower(clean_str(name))), ".")
    return F.when(clean_str(email).isNotNull(), local).otherwise(dotted)


def fabricated_login(email: Column, key: Column, domain: str) -> Column:
    """Usable e-mail and user name; both are made up from the record key when the e-mail is
    missing or malformed."""
    e = F.lower(strip(email))
    local = F.substring_index(e, "@", 1)
    good = F.coalesce(e.contains("@") & (local != ""), F.lit(False))
    made = F.concat(F.lit("user-"), F.sha1(key).substr(1, 6))
    return F.struct(
        F.when(good, local).otherwise(made).alias("username"),
        F.when(good, e).otherwise(F.concat(made, F.lit(f"@{domain}"))).alias("email"),
        good.alias("from_source"),
    )
