"""Registry of demonstration queries over the driver tables, each with its DuckDB counterpart.

Sources are derived by SQL text that both engines run, always over whole tables; the operator
under test is the only thing expressed twice.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import prepare

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
SOURCES: dict[str, str] = {}


class Data:
    """Driver tables and derived sources of one scale factor."""

    def __init__(self, spark: SparkSession, sf_dir: str, wide: bool = False):
        self.spark = prepare(spark)
        self.dir = sf_dir.rstrip("/")
        self._wide = wide

    def wide(self) -> Data:
        """The same data with its two large files spread over all tasks, for CPU-bound loads."""
        return Data(self.spark, self.dir, True)

    def __call__(self, name: str) -> DataFrame:
        if name in TABLES:
            df = self.spark.read.parquet(f"{self.dir}/{name}.parquet")
            # a small file may be one row group, which is one task; files of many are spread as they are read
            cores = self.spark.sparkContext.defaultParallelism
            if self._wide and name in ("lineitem", "orders") and df.groupBy(F.spark_partition_id()).count().count() < cores:
                return df.repartition(cores, df.columns[0])
            return df
        text = SOURCES[name]
        return self.spark.sql(text, **{n: self(n) for n in _uses(text)})


def _uses(text: str) -> list[str]:
    return sorted(set(re.findall(r"\{([a-z_]\w*)\}", text)))


def source(name: str, text: str) -> None:
    SOURCES[name] = text


def _order(names: list[str], seen: list[str]) -> list[str]:
    for n in names:
        if n in SOURCES and n not in seen:
            _order(_uses(SOURCES[n]), seen)
            seen.append(n)
    return seen


def oracle(text: str) -> str:
    """DuckDB text: the derived sources it uses come first as common table expressions."""
    parts = [f"{n} AS ({_plain(SOURCES[n])})" for n in _order(_uses(text), [])]
    body = _plain(text).strip()
    if not parts:
        return body
    if body.startswith("WITH RECURSIVE "):
        return "WITH RECURSIVE " + ", ".join(parts) + ", " + body[15:]
    if body.startswith("WITH "):
        return "WITH " + ", ".join(parts) + ", " + body[5:]
    return "WITH " + ", ".join(parts) + " " + body


def _plain(text: str) -> str:
    return re.sub(r"\{([a-z_]\w*)\}", r"\1", text)


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(Data(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = oracle(sql)
        return fn

    return register
