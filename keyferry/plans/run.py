"""What a load works on: extracts in, target tables out, rejects and counts on the side.

Each cleaned and resolved extract is written once; merge, rejects and counts derive from the
written copy. ``FrameRun`` works on frames and leaves the merged tables lazy (tests, queries),
``StoreRun`` reads landed files and commits to a ``TableStore``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import stable_id
from ..operators.in_order import writes_in_order
from ..operators.merge import guarded_writes, match_source, merge
from ..operators.quality import (
    REJECT, cast_to_spec, reject_first, reject_report, repeated_values, split_rejects, unique_violations, validate,
)
from ..session import cut_lineage, empty_frame, fit_tasks, one_row, prepare
from ..sources.extracts import csv_bundle, scan_marked
from ..sources.store import TableStore
from ..specs import MergeSpec, SourceSpec, TableSpec, columns
from .extracts import SOURCES
from .tables import TABLES


@dataclass(frozen=True)
class LoadConfig:
    """Deployment settings.

    ``project_ids``    limits households and farmers to groups of these projects; None means all.
    ``number_fields``  further participant fields that may hold the record number.
    ``reject_zero``    observations with a 0 coordinate are rejected, like missing ones.
    ``delta``          extracts hold changed records only: of tables in buckets just those that hold one of
                       their keys are rewritten, tables in one piece without a shuffle.
    ``in_order``       tables matched by two keys take records one after the other, as the source does;
                       otherwise in the fixed order of classes that ``guarded_merge`` names, in fewer passes.
    ``now``            time of the run, for update times that are not the source's.
    """

    system_user: str
    email_domain: str = "users.invalid"
    project_ids: tuple[str, ...] | None = None
    number_fields: tuple[str, ...] = ()
    reject_zero: bool = True
    delta: bool = False
    in_order: bool = True
    now: str = "1970-01-01 00:00:00"


def target_rows(
    df: DataFrame,
    table: TableSpec,
    cfg: LoadConfig,
    mapping: Mapping[str, Column | str],
    key: Column,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Project to target columns: ids, audit users and reject marks added, missing ones defaulted."""
    given = {n: (F.col(e) if isinstance(e, str) else e) for n, e in mapping.items()}
    base: dict[str, Column] = {
        "id": stable_id(F.lit(table.name), key),
        "deleted_at": F.lit(None).cast("timestamp"),
        "created_by_id": F.lit(cfg.system_user),
        "last_updated_by_id": F.lit(cfg.system_user),
    }
    if "from_sf" in table.columns:
        base["from_sf"] = F.lit(True)
    cols = base | given
    for name, value in table.defaults.items():
        cols.setdefault(name, F.lit(value))
    extra = [c for c in (REJECT, *carry) if c in df.columns]
    return df.select(*[c.alias(n) for n, c in cols.items()], *extra)


def merge_spec(
    key: tuple[str, ...],
    rows: DataFrame,
    table: TableSpec,
    mapped: Mapping[str, object],
    rules: Mapping[str, str] | None = None,
    order: tuple[str, ...] = ("updated_at",),
    changed: str | None = None,
) -> MergeSpec:
    """Usual rules: stored id and creator stay, earliest creation date, defaults only on insert.

    Extracts carry no order of their own; records apply by ``order``, then by record id.
    """
    order += tuple(k for k in ("sf_id", "submission_id") if k in rows.columns and k not in order)
    usual = {"id": "target", "created_by_id": "target", "created_at": "least"}
    usual |= {name: "target" for name in table.defaults if name not in mapped}
    return MergeSpec(key, order, usual | dict(rules or {}), changed)


def _identity(key: tuple[str, ...]) -> Column:
    return F.expr("coalesce(" + ", ".join(f"'{i}:' || `{c}`" for i, c in enumerate(key)) + ")")


def clashing(df: DataFrame, target: DataFrame, columns: list[str], spec: MergeSpec) -> DataFrame | None:
    """Mark rows whose further unique values an earlier row of the batch or another stored row has.

    Whether any value is in question is found from the key columns alone, and what is found is small;
    None if there is nothing.
    """
    keys = [[c] for c in columns]
    # a row without a merge key goes by its unique values
    own = F.coalesce(_identity(spec.key), F.to_json(F.struct(*columns)))
    mine = df.select(*columns, _identity(spec.key).alias("_key"), own.alias("_own"))
    held = []
    for n, name in enumerate(columns):
        holders = target.filter(F.col(name).isNotNull()).select(F.col(name).alias("_name"), _identity(spec.key).alias("_holder"))
        hit = mine.join(holders, F.col(name) == F.col("_name")).filter("NOT (_key <=> _holder)")
        held.append(hit.select("_own", F.lit(n).alias("_at")))
    others = cut_lineage(reduce(DataFrame.unionByName, held).groupBy("_own").agg(F.min("_at").alias("_at")))
    repeated = cut_lineage(repeated_values(mine, keys))
    none, single = others.isEmpty(), repeated.isEmpty()
    if none and single:
        return None
    marked = df.withColumn(REJECT, F.lit(None).cast("string"))
    if not single:
        marked = unique_violations(marked, keys, [c for c in spec.order if c in df.columns], repeated)
    if not none:
        names = F.array(*[F.lit(f"unique:{c}") for c in columns])
        marked = marked.join(others, own == F.col("_own"), "left")
        marked = reject_first(marked, [(F.col("_at").isNotNull(), F.get(names, "_at"))]).drop("_own", "_at")
    return marked.select(*[c for c in df.columns if c != REJECT], REJECT)


@dataclass
class FrameRun:
    """Run over frames: ``extracts`` and ``targets`` by name."""

    spark: SparkSession
    cfg: LoadConfig
    extracts: dict[str, DataFrame]
    targets: dict[str, DataFrame] = field(default_factory=dict)
    marked: dict[str, list[DataFrame]] = field(default_factory=dict)
    reports: dict[str, DataFrame] = field(default_factory=dict)
    _counted: dict[int, tuple[DataFrame, list[Observation]]] = field(default_factory=dict)

    def __post_init__(self):
        prepare(self.spark)
        fit_tasks(self.spark, list(self.extracts.values()))

    def extract(self, name: str, spec: SourceSpec | None = None) -> DataFrame:
        return self.extracts[name]

    def files(self, names: Mapping[str, str]) -> dict[str, DataFrame]:
        return {n: self.extracts[n] for n in names}

    def target(self, name: str) -> DataFrame:
        if name not in self.targets:
            self.targets[name] = empty_frame(self.spark, TABLES[name].schema)
        return self.targets[name]

    def ids(self, name: str, key: str = "sf_id") -> DataFrame:
        """Key map of a target table; the key is unique there."""
        rows = self.target(name)
        return rows.filter(F.col(key).isNotNull()).select(key, "id")

    def stage(self, name: str, df: DataFrame | Sequence[DataFrame], made: Mapping[str, Column] | None = None) -> DataFrame:
        """Compute an intermediate result once; what follows reads the written copy.

        Rows with a reject mark are counted by the write itself. Several frames are written one after the other and read as one.
        Columns that are ``made`` of others are not written but made again where they are read.
        """
        parts, made = [df] if isinstance(df, DataFrame) else list(df), made or {}
        names, seen, written = parts[0].columns, [], []
        for part in parts:
            part = part.drop(*made)
            if REJECT in names:
                seen.append(Observation())
                part = part.observe(seen[-1], F.count(F.lit(1)).alias("rows"), F.count_if(F.col(REJECT).isNotNull()).alias("bad"))
            written.append(self._write(name, part))
        staged = reduce(DataFrame.unionByName, written)
        if made:
            staged = staged.select(*[made[c].alias(c) if c in made else F.col(c) for c in names])
        if seen:
            self._counted[id(staged)] = (staged, seen)
        return staged

    def settle(self, name: str, df: DataFrame) -> DataFrame:
        """What only reports and counts need."""
        return df

    def _write(self, name: str, df: DataFrame) -> DataFrame:
        return cut_lineage(df, group_mb=32)

    def publish(self, table: TableSpec, df: DataFrame) -> DataFrame:
        self.targets[table.name] = df
        return df

    def report(self, name: str, df: DataFrame) -> None:
        self.reports[name] = df

    def begin(self) -> None:
        """A step begins: what it publishes becomes visible when it has finished, all tables at once."""

    def finish(self) -> None:
        """The step has ended well."""

    def abandon(self) -> None:
        """The step has failed: nothing of it becomes visible."""

    def mark(self, name: str, df: DataFrame) -> None:
        self.marked.setdefault(name, []).append(df)

    def load(
        self,
        table: TableSpec,
        rows: DataFrame | Sequence[DataFrame],
        spec: MergeSpec,
        guard: tuple[str, str] | None = None,
        check_unique: bool = True,
        check_id: bool = False,
        made: Mapping[str, Column] | None = None,
    ) -> DataFrame:
        """Cast, check, collapse and merge marked rows; returns the new table content.

        Rows may come in several frames, which are computed one after the other. ``made`` columns follow from others of the same
        row, so they are not written with them.

        ``check_id`` is for tables whose stored merge keys another load may clear: a new row must not
        come in under the id of a stored one.

        Rejected rows are kept aside. After the collapse, rows that clash on a further unique
        column, with each other or with the stored table, are rejected as well.
        """
        spec = replace(spec, delta=self.cfg.delta)
        parts = [rows] if isinstance(rows, DataFrame) else rows
        fits = [validate(cast_to_spec(part, table), table, unique=False) for part in parts]
        staged = self.stage(f"{table.name}_rows", fits, made)
        self.mark(table.name, staged)
        kept, _ = split_rejects(staged)
        target = self.target(table.name)
        if guard:
            keep = lambda df: self.stage(f"{table.name}_round", df)
            writes = writes_in_order if self.cfg.in_order else guarded_writes
            ready, final, actions = writes(target, kept, guard, spec, stage=keep)
            clash = F.when(F.col("action") == "duplicate_conflict", F.col("action"))
            actions = self.settle(f"{table.name}_actions", actions.withColumn(REJECT, clash))
            self.mark(table.name + ":late", actions)
            self.report(table.name + "_actions", actions.drop(REJECT))
            return self.apply(table, ready, final)
        # a key of several columns keeps none of them unique by itself
        merged_by = spec.key if len(spec.key) == 1 else ()
        others = [k[0] for k in table.unique if k[0] not in merged_by and k[0] in kept.columns] if check_unique else []
        others += ["id"] if check_id else []
        once = lambda df: self.stage(f"{table.name}_single", df)
        kept = match_source(kept, spec, [c for c in kept.columns if c in table.columns], once)
        spec = replace(spec, unique=True)
        if others:
            if (marked := clashing(kept, target, others, spec)) is not None:
                marked = self.stage(f"{table.name}_judged", marked)
                self.mark(table.name + ":late", marked)
                kept, _ = split_rejects(marked)
        return self.apply(table, kept, spec)

    def apply(self, table: TableSpec, rows: DataFrame, spec: MergeSpec) -> DataFrame:
        """Merge rows into the table."""
        return self.publish(table, merge(self.target(table.name), rows, spec))

    def counts(self) -> dict[str, tuple[int, int]]:
        """Rows in and rows rejected by table; staged frames know theirs, others are counted now."""
        out: dict[str, tuple[int, int]] = {}
        for name, frames in self.marked.items():
            table, late = name.split(":")[0], name.endswith(":late")
            for df in frames:
                if id(df) in self._counted:
                    seen = [one.get for one in self._counted[id(df)][1]]
                else:
                    seen = [df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col(REJECT).isNotNull()).alias("bad")).first()]
                rows, bad = out.get(table, (0, 0))
                out[table] = (rows + (0 if late else sum(one["rows"] for one in seen)), bad + sum(one["bad"] for one in seen))
        return out

    def summary(self) -> DataFrame:
        """One row per loaded table: rows_in, rows_loaded, rows_skipped."""
        schema = columns("table_name string, rows_in bigint, rows_loaded bigint, rows_skipped bigint")
        out = empty_frame(self.spark, schema)
        for table, (rows, bad) in self.counts().items():
            out = out.unionByName(one_row(self.spark, schema, (table, rows, rows - bad, bad)))
        return out

    def rejects(self) -> DataFrame:
        """All rejected rows of the run in report form."""
        out = None
        for name, frames in self.marked.items():
            table = name.split(":")[0]
            for df in frames:
                raw = [c for c in df.columns if c != REJECT]
                key = next(c for c in ("sf_id", "submission_id", "id", "source_id") if c in raw)
                one = reject_report(df, table, key, raw)
                out = one if out is None else out.unionByName(one)
        return out


@dataclass
class StoreRun(FrameRun):
    """Run over landed files and a table store."""

    store: TableStore | None = None
    landing: str = ""
    fmt: str = "json"
    inputs: list[str] = field(default_factory=list)

    def beside(self) -> StoreRun:
        """A run of its own over the same files and tables."""
        store = TableStore(self.spark, self.store.root, self.store.buckets)
        return StoreRun(self.spark, self.cfg, {}, store=store, landing=self.landing, fmt=self.fmt)

    def fingerprint(self, paths: Sequence[str]) -> str:
        """Names, sizes and times of all files below the paths, as one number; their content is not read."""
        if not paths:
            return ""
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths))
        seen = files.select("path", "length", "modificationTime")
        return str(seen.agg(F.count(F.lit(1)), F.sum("length"), F.bit_xor(F.xxhash64("path", "length", "modificationTime"))).first())

    def extract(self, name: str, spec: SourceSpec | None = None) -> DataFrame:
        """What can't be read as a record is counted and reported with the rejects of the step."""
        spec = spec or SOURCES[name]
        self.inputs.append(f"{self.landing}/{spec.name}")
        df, bad = scan_marked(self.spark, self.inputs[-1], spec, self.fmt, lambda d: self.stage(f"{name}_landed", d))
        self._damaged(name, bad)
        return df

    def files(self, names: Mapping[str, str]) -> dict[str, DataFrame]:
        paths = {n: f"{self.landing}/{f}" for n, f in names.items()}
        self.inputs += paths.values()
        out = {}
        for n, (df, bad) in csv_bundle(self.spark, paths, lambda d: self.stage("files_landed", d)).items():
            self._damaged(n, bad)
            out[n] = df
        return out

    def _damaged(self, name: str, bad: DataFrame) -> None:
        bad = bad.select(F.lit(None).cast("string").alias("id"), "raw", F.col("reason").alias(REJECT))
        self.mark(f"{name}:landed", self.stage(f"{name}_damaged", bad))

    def target(self, name: str) -> DataFrame:
        return self.store.read(TABLES[name])

    def settle(self, name: str, df: DataFrame) -> DataFrame:
        return self.stage(name, df)

    def _write(self, name: str, df: DataFrame) -> DataFrame:
        return self.store.stage(name, df)

    def publish(self, table: TableSpec, df: DataFrame) -> DataFrame:
        return self.store.commit(table, df)

    def apply(self, table: TableSpec, rows: DataFrame, spec: MergeSpec) -> DataFrame:
        """Merge rows into the table; with ``delta`` only its touched buckets are rewritten."""
        if self.cfg.delta:
            return self.store.merge_into(table, self.stage(f"{table.name}_delta", rows), spec)
        return self.store.commit(table, merge(self.target(table.name), rows, spec), spec.key)

    def begin(self) -> None:
        self.store.begin()

    def finish(self) -> None:
        self.store.publish()

    def abandon(self) -> None:
        self.store.abandon()

    def report(self, name: str, df: DataFrame) -> None:
        self.store.write_json(name, df)
