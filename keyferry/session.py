"""Session settings and lineage cuts shared by all jobs."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Runtime SQL settings the plans rely on. Adaptive execution turns a join into a broadcast only
# after it has seen the real size of the built side, splits hot shuffle partitions, and may add a
# shuffle to do so. Zone-less texts are read as UTC.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
SPLIT = "spark.sql.files.maxPartitionBytes"
SPLIT_MB, SHARE_MB = 32, 8  # of a load: most a task reads of a table's files, extract per shuffle partition at the start


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings and let shuffles start with several partitions per core.

    Adaptive execution merges what turns out small, so many initial partitions cost little, while
    a fixed low number would make the merge of a large table spill. A number set by the user stays.
    """
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    sc = spark.sparkContext
    if spark.conf.get(INITIAL, None) is None:
        least = int(spark.conf.get("spark.sql.shuffle.partitions"))
        _initial[sc.applicationId] = max(least, 5 * sc.defaultParallelism)
        spark.conf.set(INITIAL, str(_initial[sc.applicationId]))
    return spark


_initial: dict[str, int] = {}  # what ``prepare`` and ``fit_tasks`` have set, not the user


def fit_tasks(spark: SparkSession, frames: Sequence[DataFrame]) -> None:
    """Keep the tasks of a load of one size, whatever the size of its extracts.

    Adaptive execution merges shuffle partitions but does not split them, so their number at the start has to
    grow with what comes in; it goes by Spark's estimate. Numbers set by the user stay.
    """
    if spark.conf.get(SPLIT, None) is None:
        spark.conf.set(SPLIT, f"{SPLIT_MB}m")
    app = spark.sparkContext.applicationId
    if spark.conf.get(INITIAL) != str(_initial.get(app)):
        return
    size = sum(int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) for df in frames)
    _initial[app] = max(_initial[app], min(size // (SHARE_MB << 20), 20_000))
    spark.conf.set(INITIAL, str(_initial[app]))


_local_dirs: dict[str, str] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables, as named by the cluster.

    Only a local test session without the setting gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    sc = spark.sparkContext
    if sc.master.startswith("local"):
        if sc.applicationId not in _local_dirs:
            _local_dirs[sc.applicationId] = tempfile.mkdtemp(prefix="keyferry-")
        return _local_dirs[sc.applicationId]
    raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")


def scratch(spark: SparkSession) -> str:
    """A new folder name below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/keyferry/{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, group_mb: int | None = None, keep: bool = False) -> DataFrame:
    """Write the frame as a table to the shared checkpoint folder and go on from there.

    The table stays until its job releases it (``cuts_released``, unless ``keep``) or the folder is cleared. Used for staged
    extracts and between the rounds of the iterative operators: plans stay small,
    a lost executor costs no recomputation of what is written, and unlike a checkpointed RDD the
    table has a known size, so later joins broadcast it exactly when it is small enough. Row groups of
    ``group_mb`` let tasks read parts of its files.
    """
    path = scratch(df.sparkSession)
    if getattr(_made, "paths", None) is not None and not keep:
        _made.paths.append(path)
    writer = df.write.option("compression", "zstd")
    with shuffles_released(df.sparkSession):
        (writer if group_mb is None else writer.option("parquet.block.size", group_mb << 20)).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._cut = path
    return out


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a write inside go when it has ended, not when the driver's collector meets what is left of its plan."""
    given = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, given) if given is not None else spark.conf.unset(CLEANUP)


def release(*frames: DataFrame) -> None:
    """Remove the tables of frames that ``cut_lineage`` has written, as soon as nothing will read them; other frames stay."""
    for df in frames:
        if (path := getattr(df, "__dict__", {}).get("_cut")) is not None:
            remove_folder(df.sparkSession, path)


_made = threading.local()  # what the job under way in this thread has cut


@contextmanager
def cuts_released(spark: SparkSession) -> Iterator[None]:
    """Remove the tables that ``cut_lineage`` writes inside, for a job whose results are written when it ends."""
    outer = getattr(_made, "paths", None)
    _made.paths = []
    try:
        yield
    finally:
        for path in _made.paths:
            remove_folder(spark, path)
        _made.paths = outer


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder of intermediate tables, on whatever file system it lies."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return one_row(spark, schema, [None] * len(schema)).limit(0)


def one_row(spark: SparkSession, schema: T.StructType, values: Sequence) -> DataFrame:
    """A single row built from literals, without a Python worker."""
    return spark.range(1, numPartitions=1).select(
        *[F.lit(v).cast(f.dataType).alias(f.name) for f, v in zip(schema.fields, values)]
    )
