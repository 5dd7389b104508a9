"""Keys: deterministic ids, hashes, composites, slices and literal replacements.

Ids are content hashes, never random: a task retried after an executor loss, or a whole load run
again, produces the same id.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .clean import clean_str, strip


def stable_id(*cols: Column) -> Column:
    """UUID-shaped id from the md5 of the natural key parts; null when every part is null."""
    joined = F.concat_ws("\u0001", *[c.cast("string") for c in cols])
    h = F.md5(joined)
    parts = [h.substr(1, 8), h.substr(9, 4), h.substr(13, 4), h.substr(17, 4), h.substr(21, 12)]
    return F.when(F.coalesce(*[c.cast("string") for c in cols]).isNotNull(), F.concat_ws("-", *parts))


def hash_key(prefix: str, c: Column, n: int = 40) -> Column:
    """``prefix`` + first ``n`` hex digits of the sha1 of the text; keys that must be unique take all 40."""
    return F.concat(F.lit(prefix), F.sha1(c.cast("string")).substr(1, n))


def prefixed_key(prefix: str, raw: Column, external: Column | None = None) -> Column:
    """External id first, else the raw id, else a hash of the uncleaned raw text."""
    choices = []
    if external is not None:
        choices.append(F.concat(F.lit(f"{prefix}-sf-"), clean_str(external)))
    choices.append(F.concat(F.lit(f"{prefix}-"), clean_str(raw)))
    choices.append(hash_key(f"{prefix}-", F.coalesce(raw.cast("string"), F.lit(""))))
    return F.coalesce(*choices)


def composite_key(sep: str, *cols: Column) -> Column:
    """Joined key; null when any part is null (never the text "None")."""
    pieces: list[Column] = []
    for i, c in enumerate(cols):
        if i:
            pieces.append(F.lit(sep))
        pieces.append(c.cast("string"))
    return F.concat(*pieces)


def key_slice(c: Column, head: int | None = None, tail: int | None = None) -> Column:
    return F.left(c, F.lit(head)) if head is not None else F.right(c, F.lit(tail))


def replace_chain(c: Column, pairs: Sequence[tuple[str, str]]) -> Column:
    """Literal replacements applied in the given order."""
    for old, new in pairs:
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def title_case(c: Column) -> Column:
    """Upper-case each letter that does not follow a letter, lower-case the others.

    ``initcap`` only looks at blanks, so it differs after digits, hyphens and apostrophes.
    """
    chars = F.split(c, "")
    return F.array_join(
        F.transform(
            chars,
            lambda ch, i: F.when(
                (i > 0) & F.get(chars, i - 1).rlike(r"^\p{L}$"), F.lower(ch)
            ).otherwise(F.upper(ch)),
        ),
        "",
    )


def title_key(c: Column) -> Column:
    return F.replace(title_case(c), F.lit(" "), F.lit("_"))


def strip_suffix(c: Column, text: str) -> Column:
    return strip(F.replace(c, F.lit(text), F.lit("")))


def is_digits(c: Column) -> Column:
    return c.cast("string").rlike(r"^\p{Nd}+$")


def is_external_id(c: Column) -> Column:
    """Shape of a source record id: 15 or 18 letters and digits."""
    return F.coalesce(strip(c.cast("string")).rlike(r"^([A-Za-z0-9]{15}|[A-Za-z0-9]{18})$"), F.lit(False))


def household_number(number: Column, name: Column) -> Column:
    """The number given, or the whole number spelled in the name when it is 0 or missing."""
    given = F.coalesce(number, F.lit(0))
    return F.when(given == 0, name.try_cast("bigint")).otherwise(given)
