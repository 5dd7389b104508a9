"""Versioned Parquet tables in hash buckets of their merge key, published through one log.

A table is never read and overwritten in one plan. Its rows lie in buckets; a whole write makes new files
for all buckets, a merge only for those that hold a key of its source, the others stay where they are and
are carried over by name. What a table consists of is the sum of the log: one file per publish, numbered,
with a row for every bucket that got new files. Readers see a publish whole or not at all, and a load that
dies half-way leaves files that no log row names.

Several runs may write under one root. Files lie below the run's id, so runs never overwrite each other, and
a log file of a number can be created once only. A run that comes second re-reads the log: if the other one
changed other tables, or other buckets of the same table, it publishes under the next number; otherwise it
fails with ``Conflict`` and nothing of it becomes visible. A single merge starts again by itself.

The file system must refuse to rename onto a file that exists (HDFS does; object stores need a
connector that does).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.dedupe import hashable, quoted
from ..operators.merge import key_expr, merge
from ..session import empty_frame, remove_folder
from ..specs import MergeSpec, TableSpec, columns

LOG = columns("entry bigint, table_name string, bucket int, whole boolean, key string, buckets int, path string, run string")
BUCKET = "_bucket"
LOOSE = -1  # rows without a merge key: no merge ever finds them, so files are only added


class Conflict(RuntimeError):
    """Another run has published a change to the same rows since this one began to read."""


@dataclass(frozen=True)
class Content:
    """What a table consists of: folders by bucket, and the log entry that made it so.

    ``key`` is the expression rows are dealt by, None for a table in one piece.
    """

    key: str | None
    buckets: int
    paths: Mapping[int, tuple[str, ...]] = field(default_factory=dict)

    def folders(self, buckets: Sequence[int] | None = None) -> list[str]:
        return [p for b, some in sorted(self.paths.items()) if buckets is None or b in buckets for p in some]


@dataclass
class _Change:
    """What a step has done to a table so far."""

    whole: bool
    touched: set[int]


class TableStore:
    """Target tables under one root folder all executors share.

    ``buckets`` is the number of buckets of tables that get their first rows here; choose it so that a
    bucket of the largest table fits a task (about 1 GB). With 1 a table is one piece and every merge
    rewrites it.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = 1):
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets
        self._entry: int | None = None  # newest log entry this store has seen
        self._tables: dict[str, Content] = {}
        self._before: dict[str, Content] = {}
        self._changes: dict[str, _Change] | None = None  # of the step under way
        self._run = uuid.uuid4().hex

    # --- the log

    def refresh(self) -> None:
        """Read what others have published."""
        if self._changes:
            raise RuntimeError("a step is under way")
        log = self.read_appended("_log", LOG, "json")
        rows = log.filter("entry IS NOT NULL")
        start = rows.filter("whole").groupBy("table_name").agg(F.max("entry").alias("_start"))
        live = rows.join(start, "table_name").filter("entry >= _start")
        newest = F.max(F.struct("entry", "path")).alias("newest")
        every = F.array_sort(F.collect_set(F.struct("entry", "path"))).alias("every")
        found = live.groupBy("table_name", "key", "buckets", "bucket").agg(newest, every)  # a row per bucket
        tables: dict[str, dict] = {}
        shape: dict[str, tuple] = {}
        for r in found.collect():
            shape[r["table_name"]] = (r["key"], r["buckets"])
            held = tables.setdefault(r["table_name"], {})
            if r["bucket"] is not None:
                held[r["bucket"]] = tuple(e["path"] for e in r["every"]) if r["bucket"] == LOOSE else (r["newest"]["path"],)
        self._tables = {n: Content(*shape[n], paths) for n, paths in tables.items()}
        self._entry = rows.agg(F.max("entry")).first()[0] or 0

    def _current(self, name: str) -> Content | None:
        if self._entry is None:
            self.refresh()
        return self._tables.get(name)

    def _rows_of(self, entry: int) -> list[dict]:
        out = []
        for name, change in self._changes.items():
            now = self._tables[name]
            base = {"entry": entry, "table_name": name, "whole": change.whole, "key": now.key, "buckets": now.buckets, "run": self._run}
            new = [(b, p) for b, some in now.paths.items() if change.whole or b in change.touched for p in some]
            if not change.whole:
                old = self._before[name].paths.get(LOOSE, ())
                new = [(b, p) for b, p in new if b != LOOSE or p not in old]
            out += [base | {"bucket": b, "path": p} for b, p in new]
            if change.whole and not new:
                out.append(base | {"bucket": None, "path": None})
        return out

    def _create(self, entry: int, rows: list[dict]) -> bool:
        """Write the log file of this number, unless there is one."""
        jvm = self.spark._jvm
        conf = self.spark._jsc.hadoopConfiguration()
        place = lambda name: jvm.org.apache.hadoop.fs.Path(f"{self.root}/_log/{name}")
        draft, final = place(f".{self._run}-{entry}"), place(f"{entry:020d}.json")
        files = draft.getFileSystem(conf)
        out = files.create(draft, True)
        out.write(bytearray("".join(json.dumps(r) + "\n" for r in rows).encode()))
        out.close()
        if files.exists(final):
            files.delete(draft, False)
            return False
        try:
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), conf)
            keep = jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename")
            context.rename(draft, final, jvm.java.lang.reflect.Array.newInstance(keep, 0))  # no option: never overwrite
        except Exception as err:
            if "FileAlreadyExists" not in str(err):
                raise
            files.delete(draft, False)
            return False
        return True

    def _others_since(self, entry: int) -> list[dict]:
        log = self.read_appended("_log", LOG, "json")
        named = log.filter(F.col("entry") > entry).filter(F.col("table_name").isin(*self._changes))
        return [r.asDict() for r in named.select("entry", "table_name", "bucket", "whole").distinct().collect()]

    def _conflicts(self, others: list[dict]) -> list[str]:
        hit = set()
        for r in others:
            mine = self._changes[r["table_name"]]
            if mine.whole or r["whole"] or (r["bucket"] in mine.touched and r["bucket"] != LOOSE):
                hit.add(r["table_name"])
        return sorted(hit)

    # --- steps

    def begin(self) -> None:
        """From now on changes are seen by this store only, until ``publish``. Starts from the newest state."""
        self.refresh()
        self._before, self._changes = dict(self._tables), {}
        self._run = uuid.uuid4().hex

    def publish(self) -> None:
        """Publish all changes since ``begin`` with one log file: readers see all tables change or none."""
        try:
            if self._changes:
                seen, entry = self._entry, self._entry + 1
                while not self._create(entry, self._rows_of(entry)):
                    if lost := self._conflicts(self._others_since(seen)):
                        raise Conflict(f"another run has changed {', '.join(lost)}")
                    entry += 1
                self._changes = None
                if entry > seen + 1:
                    self.refresh()
                self._entry = entry
            self._changes = None
            self._clear_stage()
        except Exception:
            self.abandon()
            raise

    def abandon(self) -> None:
        """Forget the changes since ``begin``; no log row names their files."""
        if self._changes is not None:
            self._tables, self._changes = self._before, None
            self._clear_stage()

    # --- tables

    def exists(self, name: str) -> bool:
        return self._current(name) is not None

    def read(self, spec: TableSpec, buckets: Sequence[int] | None = None) -> DataFrame:
        """Current content, or that of some buckets; an empty frame of the declared shape where there is none."""
        current = self._current(spec.name)
        folders = current.folders(buckets) if current else []
        if not folders:
            return empty_frame(self.spark, spec.schema)
        return self.spark.read.schema(spec.schema).option("recursiveFileLookup", "true").parquet(*folders)

    def commit(self, spec: TableSpec, df: DataFrame, key: Sequence[str] = ()) -> DataFrame:
        """Write the whole table anew and return it; it is published at once, or with the others of a step.

        A new table is dealt by ``key`` if the store has more than one bucket.
        """
        current = self._current(spec.name)
        if current is not None and current.paths and current.buckets > 1:
            shape = Content(current.key, current.buckets)
        elif key and self.buckets > 1:
            shape = Content(key_expr(key), self.buckets)
        else:
            shape = Content(None, 1)
        paths = self._write(spec, df, shape, shape.buckets)
        return self._changed(spec, replace(shape, paths=paths), _Change(True, set(paths)))

    def merge_into(self, spec: TableSpec, source: DataFrame, how: MergeSpec, attempts: int = 5) -> DataFrame:
        """Merge a source and publish; only buckets that hold one of its keys are read and written.

        A table in one piece, or dealt by another key, is rewritten whole. The source is read twice, so it
        should be a written frame. Outside a step a merge that meets a conflict starts again.
        """
        for attempt in range(attempts):
            try:
                return self._merge_into(spec, source, how)
            except Conflict:
                if self._changes is not None or attempt == attempts - 1:
                    raise
                self.refresh()

    def _merge_into(self, spec: TableSpec, source: DataFrame, how: MergeSpec) -> DataFrame:
        current = self._current(spec.name)
        if current is None or current.key != key_expr(how.key):
            return self.commit(spec, merge(self.read(spec), source, how), how.key)
        keys = source.select(self._bucket(source, current).alias(BUCKET)).filter(F.col(BUCKET) != LOOSE).distinct()
        touched = {r[0] for r in keys.collect()}  # at most ``buckets`` numbers
        merged = merge(self.read(spec, sorted(touched)) if touched else empty_frame(self.spark, spec.schema), source, replace(how, delta=False))
        written = self._write(spec, merged, current, len(touched) + 1)
        paths = dict(current.paths) | {b: p for b, p in written.items() if b != LOOSE}
        if LOOSE in written:
            paths[LOOSE] = current.paths.get(LOOSE, ()) + written[LOOSE]
        return self._changed(spec, replace(current, paths=paths), _Change(False, set(written)))

    def _bucket(self, df: DataFrame, shape: Content):
        return F.expr(f"CASE WHEN {shape.key} IS NULL THEN {LOOSE} ELSE CAST(pmod(xxhash64(CAST({shape.key} AS STRING)), {shape.buckets}) AS INT) END")

    def _write(self, spec: TableSpec, df: DataFrame, shape: Content, tasks: int) -> dict[int, tuple[str, ...]]:
        """Write rows below the run's folder, a task per bucket; rows without a key are spread over all tasks."""
        path = f"{self.root}/{spec.name}/{self._run}-{uuid.uuid4().hex[:8]}"
        rows = df.select(spec.columns)
        if shape.key is None:
            rows.write.parquet(path)
            return {0: (path,)}
        loose = F.expr(f"CASE WHEN {BUCKET} = {LOOSE} THEN pmod(xxhash64({quoted(hashable(rows))}), {tasks}) END")
        dealt = rows.withColumn(BUCKET, self._bucket(rows, shape))
        dealt.repartition(tasks, BUCKET, loose).write.partitionBy(BUCKET).parquet(path)
        there = self.spark.read.schema(T.StructType([*spec.schema.fields, T.StructField(BUCKET, T.IntegerType())])).parquet(path)
        return {r[0]: (f"{path}/{BUCKET}={r[0]}",) for r in there.select(BUCKET).distinct().collect()}

    def _changed(self, spec: TableSpec, content: Content, change: _Change) -> DataFrame:
        alone = self._changes is None
        if alone:
            self._before, self._changes = dict(self._tables), {}
        self._tables[spec.name] = content
        earlier = self._changes.get(spec.name)
        if earlier is not None:
            change = _Change(earlier.whole or change.whole, earlier.touched | change.touched)
        self._changes[spec.name] = change
        if alone:
            self.publish()
        return self.read(spec)

    # --- further files

    def stage(self, name: str, df: DataFrame) -> DataFrame:
        """Write an intermediate result once and go on from the written copy; it goes when the step ends."""
        path = f"{self.root}/_stage/{self._run}/{uuid.uuid4().hex}-{name}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _clear_stage(self) -> None:
        remove_folder(self.spark, f"{self.root}/_stage/{self._run}")

    def write_json(self, name: str, df: DataFrame) -> str:
        """Reports lie below the run's id, so a later run leaves them alone."""
        path = f"{self.root}/_reports/{self._run}/{name}"
        df.write.mode("overwrite").json(path)
        return path

    def append(self, name: str, df: DataFrame) -> None:
        """Each in a folder of its own: writers into one folder would clear each other's temporary files."""
        df.write.parquet(f"{self.root}/{name}/{uuid.uuid4().hex}")

    def read_appended(self, name: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
        try:
            return self.spark.read.schema(schema).format(fmt).option("recursiveFileLookup", "true").load(f"{self.root}/{name}")
        except AnalysisException as err:
            if "PATH_NOT_FOUND" not in str(err):
                raise
            return empty_frame(self.spark, schema)
