"""One row per key, safe for keys that hold a large share of the table.

``dedupe_*`` filter ``row_number() = 1``: Spark then keeps only the best row per key and task
before it shuffles (WindowGroupLimit), so a hot key sends one row per task, not all its rows.
``collapse`` does the same with aggregates, which combine before the shuffle as well.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage

FEW = 100_000  # hashes that are joined as they are
WORDS = 1 << 20  # words of 64 marks that stand for more hashes than that


def hashable(df: DataFrame) -> list[str]:
    """Columns a hash can be taken over (maps and variants are left out)."""
    bad = (T.MapType, T.VariantType)
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, bad)]


def quoted(names: Sequence[str]) -> str:
    return ", ".join(f"`{n}`" for n in names)


def row_hash(df: DataFrame) -> Column:
    return F.expr(f"xxhash64({quoted(hashable(df))})")


def _keep_one(df: DataFrame, key: Sequence[str], order: Sequence[Column], total: bool) -> DataFrame:
    # The row hash makes the order total, so the winner does not depend on partitioning. It needs
    # every column; where the given order is total already, unused columns stay unread.
    w = Window.partitionBy(*key).orderBy(*order, *([] if total else [row_hash(df)]))
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def dedupe_latest(df: DataFrame, key: Sequence[str], stamp: str, seq: Sequence[str] = (), total: bool = False) -> DataFrame:
    """Newest row per key; of rows with the same stamp the first by ``seq`` stays.

    ``total`` says that the order columns tell any two rows of a key apart.
    """
    order = [F.col(stamp).desc_nulls_last(), *[F.col(c).asc() for c in seq]]
    return _keep_one(df, key, order, total)


def dedupe_first(df: DataFrame, key: Sequence[str], order: Sequence[str], total: bool = False) -> DataFrame:
    return _keep_one(df, key, [F.col(c).asc() for c in order], total)


def dedupe_last(df: DataFrame, key: Sequence[str], order: Sequence[str], total: bool = False) -> DataFrame:
    return _keep_one(df, key, [F.col(c).desc() for c in order], total)


def distinct_keys(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).filter(F.col(column).isNotNull()).distinct()


def collapse(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    rules: Mapping[str, str] | None = None,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """What is left of several source rows of one group after they were applied in order.

    The last row wins; ``least`` / ``greatest`` columns take the smallest / largest value,
    ``coalesce_source`` the last and ``coalesce_target`` the first value that is not null, and
    ``target`` columns stay as the first row set them. Group columns are kept as they are, of the
    others those in ``keep`` (all by default), so ordering columns need not be shuffled twice.
    """
    rules = rules or {}
    rest = [c for c in df.columns if c not in group and (keep is None or c in keep)]
    seq = "_seq"
    # The hash of the kept columns decides between rows of equal order.
    total = quoted([*order]) + ", " if order else ""
    hashed = [c for c in hashable(df) if c in rest]
    df = df.select("*", F.expr(f"struct({total}xxhash64({quoted(hashed)})) AS {seq}"))
    last = [c for c in rest if rules.get(c, "source") == "source"]
    first = [c for c in rest if rules.get(c) == "target"]
    pick = {
        "least": "min(`{c}`)",
        "greatest": "max(`{c}`)",
        "coalesce_source": "max_by(`{c}`, CASE WHEN `{c}` IS NOT NULL THEN {seq} END)",
        "coalesce_target": "min_by(`{c}`, CASE WHEN `{c}` IS NOT NULL THEN {seq} END)",
    }
    aggs = [
        F.expr(pick[rules[c]].format(c=c, seq=seq)).alias(c) for c in rest if rules.get(c, "source") in pick
    ]
    if last:
        aggs.append(F.expr(f"max_by(struct({quoted(last)}), {seq})").alias("_last"))
    if first:
        aggs.append(F.expr(f"min_by(struct({quoted(first)}), {seq})").alias("_first"))
    out = df.groupBy(*group).agg(*aggs)
    place = {c: f"_last.`{c}`" for c in last} | {c: f"_first.`{c}`" for c in first}
    return out.selectExpr(*[f"`{c}`" for c in group], *[f"{place.get(c, f'`{c}`')} AS `{c}`" for c in rest])


def repeated_hashes(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """``_rh``: hashes of the keys that more than one row has, written.

    Only hashes are shuffled. Two keys of one hash are listed like a repeated one, so what is listed may be
    more than what repeats, never less.
    """
    hashes = df.select(F.xxhash64(*key).alias("_rh"))
    return cut_lineage(hashes.groupBy("_rh").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_rh"))


def split_repeated(df: DataFrame, key: Sequence[str], hashes: DataFrame, n: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows whose key no other row has, and the others.

    Many hashes (``n`` of them) become marks in a table of bounded size, which is broadcast, so the rows are not shuffled to
    be split. A row that meets the mark of another key goes with the others, hence these must be gathered by key.
    """
    if (hashes.count() if n is None else n) <= FEW:
        on = F.xxhash64(*key) == F.col("_rh")
        return df.join(hashes, on, "left_anti"), df.join(hashes, on, "left_semi")
    word, mark = "shiftrightunsigned({h}, 6) & %d" % (WORDS - 1), "shiftleft(1L, CAST({h} & 63 AS INT))"
    marks = hashes.groupBy(F.expr(word.format(h="_rh")).alias("_word")).agg(F.expr(f"bit_or({mark.format(h='_rh')})").alias("_marks"))
    marks = F.broadcast(cut_lineage(marks))
    h = f"xxhash64({quoted(key)})"
    on = F.expr(f"({word.format(h=h)}) = _word AND (_marks & {mark.format(h=h)}) <> 0")
    return df.join(marks, on, "left_anti"), df.join(marks, on, "left_semi")


def collapse_repeated(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    rules: Mapping[str, str] | None = None,
    keep: Sequence[str] | None = None,
    stage: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """``collapse`` that leaves rows alone whose key no other row has.

    Which keys repeat is found from their hashes. Only their rows are shuffled, and the others pass as they
    are; where many repeat, ``stage`` may write what is left of them. ``df`` is read several times, so it should
    be a written frame.
    """
    rest = [c for c in df.columns if c not in group and (keep is None or c in keep)]
    hashes = repeated_hashes(df, group)
    n = hashes.count()
    if not n:
        return df.select(*group, *rest)
    single, several = split_repeated(df, group, hashes, n)
    folded = collapse(several, group, order, rules, keep)
    if stage and n > FEW:
        folded = stage(folded)
    return single.select(*group, *rest).unionByName(folded)
