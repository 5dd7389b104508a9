"""Landed inputs: object extracts (JSON or Parquet) and all-text CSV files."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from ..specs import SourceSpec
from .delimited import DAMAGED, scan_csv

VERDICT = "_verdict"


def require_inputs(spark: SparkSession, paths: Iterable[str]) -> None:
    """Fail with every missing path before any plan is built."""
    missing = []
    for path in paths:
        try:
            spark.read.format("text").load(path)
        except AnalysisException as err:
            if "PATH_NOT_FOUND" not in str(err):
                raise
            missing.append(path)
    if missing:
        raise FileNotFoundError("Required input not found: " + ", ".join(missing))


def scan_object(
    spark: SparkSession, path: str, spec: SourceSpec, fmt: str = "json", where=None
) -> DataFrame:
    """Declared fields of one object, deleted records left out when the spec names a flag.

    The schema is given, so nothing is inferred and unlisted fields (transport metadata) are never
    read. On Parquet both the field list and the filters reach the scan.
    """
    kept, _ = scan_marked(spark, path, spec, fmt)
    return kept if where is None else kept.filter(where)


def scan_marked(
    spark: SparkSession, path: str, spec: SourceSpec, fmt: str = "json", stage: Callable[[DataFrame], DataFrame] = cut_lineage
) -> tuple[DataFrame, DataFrame]:
    """Records of an object that are not deleted, and what can't be read as one: (raw, reason).

    A line is ``malformed`` if it is no record or a field doesn't have its declared type; a record
    without the deletion flag is ``missing:<flag>``, for nobody can tell whether it still counts.

    A text line is parsed once, with all declared fields, and written with its verdict; both results are
    cut from the written copy. So a line is either kept or rejected, whichever columns are read later.
    """
    schema = spec.schema()
    flag = F.col(spec.active_flag) if spec.active_flag else F.lit(False)
    row = F.to_json(F.struct(*schema.names))
    lost = F.lit(f"missing:{spec.active_flag}")
    if fmt != "json":  # typed files hold no damaged lines, and their filters reach the scan
        df = spark.read.schema(schema).format(fmt).load(path)
        return df.filter(~flag), df.filter(flag.isNull()).select(row.alias("raw"), lost.alias("reason"))
    reader = spark.read.schema(T.StructType([*schema.fields, T.StructField(DAMAGED, T.StringType())]))
    df = reader.option("columnNameOfCorruptRecord", DAMAGED).format(fmt).load(path)
    reason = F.when(F.col(DAMAGED).isNotNull(), F.lit("malformed")).when(flag.isNull(), lost)
    raw = F.when(reason.isNotNull(), F.coalesce(F.col(DAMAGED), row))
    staged = stage(df.select(*schema.names, raw.alias(DAMAGED), reason.alias(VERDICT)))
    kept = staged.filter(F.col(VERDICT).isNull() & ~flag).select(*schema.names)
    return kept, staged.filter(F.col(VERDICT).isNotNull()).select(F.col(DAMAGED).alias("raw"), F.col(VERDICT).alias("reason"))


def count_rows(df: DataFrame, name: str = "n_rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def read_csv_strings(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, stage: Callable[[DataFrame], DataFrame] = cut_lineage
) -> DataFrame:
    """CSV with a header, every column read as text and nothing turned into null by a token.

    Empty fields arrive as null, which the cleaning functions treat like an empty text. Large files are
    split among tasks, whatever line breaks their fields hold. See ``scan_csv`` for what is left out.
    """
    return scan_csv(spark, path, columns, stage)[0]


def csv_bundle(
    spark: SparkSession, files: Mapping[str, str], stage: Callable[[DataFrame], DataFrame] = cut_lineage
) -> dict[str, tuple[DataFrame, DataFrame]]:
    """Rows and damaged records of each file, all of which must be there."""
    require_inputs(spark, files.values())
    return {name: scan_csv(spark, path, stage=stage) for name, path in files.items()}


def resolve_column(df: DataFrame, candidates: Sequence[str], label: str) -> str:
    for name in candidates:
        if name in df.columns:
            return name
    raise ValueError(f"{label}: none of {list(candidates)} in {df.columns}")
