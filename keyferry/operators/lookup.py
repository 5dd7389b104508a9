"""Foreign-key resolution: key maps, single, required, chained and multi-key lookups.

No lookup forces a broadcast. The key map is joined plainly, so Spark broadcasts it when its
measured size allows and sort-merges (splitting hot partitions) when it does not. Rows with a null
key are spread over all partitions instead of meeting in one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.clean import clean_str
from ..specs import Lookup
from .dedupe import hashable, quoted
from .quality import reject_first


def spread(df: DataFrame, key: str) -> Column:
    """The key, or a value that differs from row to row where the key is null.

    The filler is a hash of the first other column: by convention that identifies the record, and
    no further column has to be read for it.
    """
    kind = df.schema[key].dataType
    others = [c for c in hashable(df) if c != key][:1]
    if not others or not isinstance(kind, (T.IntegerType, T.LongType, T.StringType)):
        return F.col(f"`{key}`")
    h = f"xxhash64({quoted(others)})"
    if isinstance(kind, T.IntegerType):
        h = f"pmod({h}, 2147483647)"
    return F.expr(f"coalesce(`{key}`, CAST({h} AS {kind.simpleString()}))")


def key_map(
    df: DataFrame,
    key: str,
    value: str = "id",
    clean: bool = False,
    lower: bool = False,
    keep: str = "first",
    order: str | None = None,
    unique: bool = False,
) -> DataFrame:
    """Two columns (key, value), one row per non-null key.

    ``keep`` and ``order`` decide between several rows of one key; ``unique`` skips that step for
    keys a constraint already makes unique.
    """
    k = F.col(key)
    if clean:
        k = clean_str(k)
    if lower:
        k = F.lower(k)
    pairs = df.select(
        k.alias("_key"), F.col(value).alias("_value"), F.col(order or value).alias("_order")
    ).filter(F.col("_key").isNotNull())
    if unique:
        return pairs.select("_key", "_value")
    pick = F.min_by if keep == "first" else F.max_by
    seq = F.struct("_order", "_value")
    return pairs.groupBy("_key").agg(pick("_value", seq).alias("_value"))


def lookup_key(
    df: DataFrame, keys: DataFrame, src: str, out: str, default: Column | None = None, filled: bool = False
) -> DataFrame:
    """Add ``out``: the value of ``src`` in the map, null (or ``default``) without a match.

    ``filled`` says that ``src`` holds no null, so there is nothing to spread.
    """
    k, v = keys.columns
    right = keys.select(F.col(k).alias("_lk"), F.col(v).alias("_lv"))
    if filled:
        joined = df.join(right, F.expr(f"`{src}` = _lk"), "left")
    else:
        left = df.select("*", spread(df, src).alias("_ls"))
        joined = left.join(right, F.expr(f"_ls = _lk AND `{src}` IS NOT NULL"), "left")
    value = F.col("_lv") if default is None else F.coalesce(F.col("_lv"), default)
    kept = [value.alias(out) if c == out else F.col(f"`{c}`") for c in df.columns]
    return joined.select(*kept, *([] if out in df.columns else [value.alias(out)]))


def _missing(lk: Lookup) -> tuple[Column, str]:
    return F.col(lk.out).isNull(), lk.reason or f"missing:{lk.out}"


def lookup_required(df: DataFrame, lookups: Sequence[Lookup]) -> DataFrame:
    """Resolve several keys in turn; rows without a required match are marked, not dropped."""
    for lk in lookups:
        df = lookup_key(df, lk.keys, lk.src, lk.out, lk.default, lk.filled)
    checks = [_missing(lk) for lk in lookups if lk.required]
    return reject_first(df, checks) if checks else df


def lookup_chain(df: DataFrame, hops: Sequence[Lookup]) -> DataFrame:
    """Follow one map after the other, each from the column the hop before has added.

    Every required hop has its own reject reason; the first hop without a match gives it.
    """
    return lookup_required(df, hops)


def remap_cascade(child: DataFrame, remap: DataFrame, fk: str, out: str) -> DataFrame:
    """Replace an old parent id by the actual one; children of unknown parents are marked."""
    return lookup_required(child, [Lookup(fk, remap, out, required=True, reason=f"orphan:{fk}")])


def match_any_key(
    src: DataFrame, target: DataFrame, keys: Sequence[str], target_id: str = "id", unique: bool = False
) -> DataFrame:
    """Add ``n_matches`` (0, 1 or 2 for several) and ``target_id`` where exactly one row matches.

    An OR over two keys would be planned as a nested loop over both tables. Here the target is
    first reduced to one row per key value (``unique`` skips that where a constraint already
    guarantees it), so each key is one equi join that cannot multiply rows, however many rows
    share a value.
    """
    for i, key in enumerate(keys):
        rows = target.filter(F.col(key).isNotNull())
        if unique:
            per_key = rows.select(
                F.col(key), F.struct(F.col(target_id).alias("lo"), F.col(target_id).alias("hi"))
            )
        else:
            per_key = (
                rows.groupBy(F.col(key))
                .agg(F.min(target_id).alias("lo"), F.max(target_id).alias("hi"))
                .select(key, F.struct("lo", "hi"))
            )
        src = lookup_key(src, per_key, key, f"_m{i}")
    none = F.lit(None).cast(target.schema[target_id].dataType)
    hits = [F.col(f"_m{i}") for i in range(len(keys))]
    lo = F.least(*[h["lo"] for h in hits], none)
    hi = F.greatest(*[h["hi"] for h in hits], none)
    n = F.when(lo.isNull(), 0).when(lo == hi, 1).otherwise(2)
    out = src.withColumn("n_matches", n).withColumn("target_id", F.when(n == 1, lo))
    return out.drop(*[f"_m{i}" for i in range(len(keys))])


def map_codes(
    df: DataFrame, src: str, mapping: Mapping[str, str], out: str, fallback: Column | None = None
) -> DataFrame:
    """Translate codes by a small fixed dictionary that travels inside the plan."""
    entries = [F.lit(x) for pair in mapping.items() for x in pair]
    value = F.try_element_at(F.create_map(*entries), F.col(src))
    return df.withColumn(out, value if fallback is None else F.coalesce(value, fallback))


def unmapped(df: DataFrame, codes: Sequence[str], out: str) -> DataFrame:
    """Distinct codes that are present but have no translation."""
    return df.filter(F.col(codes[-1]).isNotNull() & F.col(out).isNull()).select(*codes).distinct()


def link_parent(
    df: DataFrame,
    key: str,
    parent_key: str,
    id: str = "id",
    out: str = "parent_id",
    now: Column | None = None,
    stamp: str | None = None,
) -> DataFrame:
    """Resolve the parent reference of a hierarchy held in one table.

    Without a match the stored link stays. ``link_changed`` tells changed rows; with ``now`` their
    ``stamp`` moves to the later of both times.
    """
    parents = key_map(df, key, id, unique=True)
    linked = lookup_key(df, parents, parent_key, "_parent")
    changed = F.col("_parent").isNotNull() & ~F.col(out).eqNullSafe(F.col("_parent"))
    linked = linked.withColumn("link_changed", changed).withColumn(
        out, F.coalesce(F.col("_parent"), F.col(out))
    )
    if now is not None and stamp:
        linked = linked.withColumn(
            stamp, F.when(F.col("link_changed"), F.greatest(F.col(stamp), now)).otherwise(F.col(stamp))
        )
    return linked.drop("_parent")
