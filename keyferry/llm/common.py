"""Column helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import gc
import sys

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\x0c\r"


def whole(text: Column | str) -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def squeezed(text: Column) -> Column:
    """The text without ASCII white space."""
    for c in SPACES:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def documents_of(docs: DataFrame, *cols: str) -> DataFrame:
    """Only the named columns, so that further columns of any name never clash with working ones."""
    return docs.select(*cols)


def held_out(doc_id: Column | str) -> Column:
    """Fold 0 of five by crc32 of the id's text; a null id is held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % 5 == 0, F.lit(True))


def bounded_batches(spark: SparkSession) -> SparkSession:
    """Few rows to an Arrow batch, so that a batch of long texts stays small in a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    return spark


def give_back() -> None:
    """Return freed memory to the system: an idle Python worker is kept for further stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)


def tidy(spark: SparkSession) -> None:
    """Have the driver let go of what finished jobs have left, for jobs of many small steps.

    Spark frees broadcast tables and plans only when the driver's collector finds them unused, which in a
    roomy heap is late.
    """
    gc.collect()
    spark.sparkContext._jvm.java.lang.System.gc()
