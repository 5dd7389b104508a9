"""Delimited text with quoted line breaks, read by many tasks.

Whether a line break ends a record depends on all quotes before it, so a task that starts in the middle of a
file can't tell. Here every split is read under both assumptions, outside and inside a quoted field. What a
split does to the assumption is one of four small functions (keep, flip, always out, always in); composing
those of a file's splits in order, a row each, gives the state each split really starts in and thereby the
one right reading. Records that lie across splits are put together from their lines; all others stay where
they were read.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

DAMAGED = "_damaged"
QUOTED = '"[^"]*+(?:""[^"]*+)*+'  # a quoted field up to, without, its closing quote
OPTIONS = {"quote": '"', "escape": '"', "multiLine": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": DAMAGED}


def _ends_inside(text: Column) -> Column:
    """Whether a line that starts outside of quotes ends inside: a quote only counts at a field's start."""
    closed = F.regexp_replace(text, rf'(^|,){QUOTED}"(?=,|\r?$)', "$1")
    return F.rlike(closed, F.lit(f"(^|,){QUOTED}$"))


def _effects(line: Column) -> tuple[Column, Column]:
    """State after the line (1: inside quotes) if it starts outside, and if it starts inside."""
    quote = F.contains(line, F.lit('"'))
    closing = f"^{QUOTED[1:]}\""
    from_out = F.when(quote & _ends_inside(line), 1).otherwise(0)
    from_in = F.when(quote & F.rlike(line, F.lit(closing)) & ~_ends_inside(F.regexp_replace(line, closing, "")), 0).otherwise(1)
    return from_out, from_in


def _composed(rows: DataFrame, part: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``after_out`` and ``after_in``: the effects ``o`` and ``i`` of all rows up to this one, composed.

    Since the last row that always ends in one state, flips alone count.
    """
    w = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_flips", F.sum(F.expr("CASE WHEN o = 1 AND i = 0 THEN 1 ELSE 0 END")).over(w))
    fixed = F.when(F.col("o") == F.col("i"), F.struct(F.col("o").alias("o"), F.col("_flips").alias("f")))
    rows = rows.withColumn("_fixed", F.last(fixed, ignorenulls=True).over(w))
    since = (F.col("_fixed.o") + F.col("_flips") - F.col("_fixed.f")) % 2
    return rows.select(
        "*", F.coalesce(since, F.col("_flips") % 2).alias("after_out"), F.coalesce(since, (F.col("_flips") + 1) % 2).alias("after_in")
    ).drop("_flips", "_fixed")


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their split, place, and the states before and after under both assumptions."""
    raw = spark.read.option("lineSep", "\n").text(path)
    lines = raw.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"))
    out, inside = _effects(F.col("value"))
    lines = lines.select("*", F.monotonically_increasing_id().alias("no"), out.alias("o"), inside.alias("i"))
    lines = _composed(lines, ["file", "split"], ["no"])
    w = Window.partitionBy("file", "split").orderBy("no")
    lines = lines.select("*", F.lag("after_out", 1, 0).over(w).alias("before_out"), F.lag("after_in", 1, 1).over(w).alias("before_in"))
    begun = lambda state: F.last(F.when(F.col(f"before_{state}") == 0, F.col("no")), ignorenulls=True).over(w)
    return lines.select("*", begun("out").alias("begin_out"), begun("in").alias("begin_in")).drop("o", "i")


def _splits(lines: DataFrame) -> DataFrame:
    """file, split, inside (its true start), owner (the line, in an earlier split, that began the record this
    split starts in), and of the file: top (its first line with content), crlf (how its first line ends)."""
    ends = lines.groupBy("file", "split").agg(
        F.max_by("after_out", "no").alias("o"), F.max_by("after_in", "no").alias("i"),
        F.max("begin_out").alias("begin_out"), F.max("begin_in").alias("begin_in"),
        F.min(F.when(~F.col("value").isin("", "\r"), F.col("no"))).alias("first"),
        F.min_by(F.right("value", F.lit(1)) == "\r", "no").alias("crlf"),
    )
    w = Window.partitionBy("file").orderBy("split")
    splits = _composed(ends, ["file"], ["split"])
    splits = splits.withColumn("inside", F.lag("after_out", 1, 0).over(w))
    begun = F.when(F.col("inside") == 0, F.col("begin_out")).otherwise(F.col("begin_in"))
    mark = F.when(begun.isNotNull(), F.struct(F.col("split").alias("split"), begun.alias("no")))
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    owner = F.last(mark, ignorenulls=True).over(before)
    file = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    top = F.first(F.when(F.col("first").isNotNull(), F.struct("split", F.col("first").alias("no"))), ignorenulls=True).over(file)
    return splits.select("file", "split", "inside", owner.alias("owner"), top.alias("top"), F.first("crlf").over(file).alias("crlf"))


def records(spark: SparkSession, path: str, stage: Callable[[DataFrame], DataFrame] = cut_lineage) -> DataFrame:
    """``record`` and ``header`` (whether it is its file's first) for every record that is not empty."""
    lines = stage(_lines(spark, path))
    splits = stage(_splits(lines))
    placed = lines.join(splits, ["file", "split"])
    actual = lambda name: F.when(F.col("inside") == 0, F.col(f"{name}_out")).otherwise(F.col(f"{name}_in"))
    own = F.when(actual("begin").isNotNull(), F.struct("split", actual("begin").alias("no")))
    placed = placed.select(
        "file", "split", "no", "value", "top", "crlf", actual("before").alias("before"), actual("after").alias("after"), F.coalesce(own, "owner").alias("begin")
    )
    header = (F.col("begin") == F.col("top")).alias("header")
    simple = placed.filter("before = 0 AND after = 0").select(F.col("value").alias("record"), header, "crlf")
    parts = placed.filter("before = 1 OR after = 1").groupBy("file", "begin", header, "crlf").agg(F.array_sort(F.collect_list(F.struct("split", "no", "value"))).alias("parts"))
    broken = parts.select(F.array_join(F.transform("parts", lambda p: p["value"]), "\n").alias("record"), "header", "crlf")
    both = simple.unionByName(broken)
    # lines of a file that ends them in two characters: at the end both go, inside quotes one break stays
    bare = F.expr("CASE WHEN crlf THEN replace(regexp_replace(record, '\\r$', ''), '\r\n', '\n') ELSE record END")
    return both.select(bare.alias("record"), "header").filter("record <> ''")


def scan_csv(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, stage: Callable[[DataFrame], DataFrame] = cut_lineage
) -> tuple[DataFrame, DataFrame]:
    """Rows of a CSV file or folder with headers, every column a text, and what is no such row: (raw, reason).

    Empty fields arrive as null. A record with more or fewer fields than the header is ``malformed``. Each
    record is parsed once, whole; both results are cut from the written copy, so they never overlap.
    """
    if columns is None:
        columns = spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').csv(path).columns
    rows = records(spark, path, stage).filter("NOT header")
    parsed = F.from_csv("record", F.lit(", ".join(f"`{c}` STRING" for c in [*columns, DAMAGED])), OPTIONS)
    staged = stage(rows.select(parsed.alias("r")).select("r.*"))
    kept = staged.filter(F.col(DAMAGED).isNull()).select(*[F.col(f"`{c}`") for c in columns])
    bad = staged.filter(F.col(DAMAGED).isNotNull()).select(F.col(DAMAGED).alias("raw"), F.lit("malformed").alias("reason"))
    return kept, bad
