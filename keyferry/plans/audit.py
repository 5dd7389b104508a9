"""Run and task audit as append-only events; the newest event of an id is its state."""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import empty_frame, one_row
from ..sources.store import TableStore
from ..specs import columns

RUN_EVENTS = columns(
    "run_id string, seq int, at timestamp, operator_email string, status string, notes string"
)
TASK_EVENTS = columns(
    "task_id string, run_id string, object_name string, seq int, at timestamp, status string, "
    "rows_in bigint, rows_out bigint, error string"
)
STEP_EVENTS = columns("step string, run_id string, at timestamp, state string, inputs string, rows_in bigint, rows_loaded bigint, rows_skipped bigint")


class Audit:
    """Records runs and their tasks in the store. Times are UTC."""

    def __init__(self, store: TableStore):
        self.store = store

    def _add(self, table: str, schema: T.StructType, row: tuple) -> None:
        self.store.append(table, one_row(self.store.spark, schema, row))

    def ensure_tables(self) -> None:
        for table, schema in (("etl_runs", RUN_EVENTS), ("etl_tasks", TASK_EVENTS), ("etl_steps", STEP_EVENTS)):
            self.store.append(table, empty_frame(self.store.spark, schema))

    def start_run(self, operator_email: str) -> str:
        run_id = str(uuid.uuid4())
        self._add("etl_runs", RUN_EVENTS, (run_id, 0, _now(), operator_email, "RUNNING", None))
        return run_id

    def finish_run(self, run_id: str, status: str = "SUCCESS", notes: str | None = None) -> None:
        self._add("etl_runs", RUN_EVENTS, (run_id, 1, _now(), None, status, notes or ""))

    def start_task(self, run_id: str, object_name: str) -> str:
        task_id = str(uuid.uuid4())
        self._add("etl_tasks", TASK_EVENTS, (task_id, run_id, object_name, 0, _now(), "RUNNING", 0, 0, None))
        return task_id

    def finish_task(
        self, task_id: str, rows_in: int, rows_out: int, status: str = "SUCCESS", error: str | None = None
    ) -> None:
        self._add("etl_tasks", TASK_EVENTS, (task_id, None, None, 1, _now(), status, rows_in, rows_out, error))

    def record_step(self, run_id: str, name: str, made: dict) -> None:
        """Remember what a published step was made from."""
        counts = (made["rows_in"], made["rows_loaded"], made["rows_skipped"])
        self._add("etl_steps", STEP_EVENTS, (name, run_id, _now(), made["state"], json.dumps(made["inputs"]), *counts))

    def steps(self) -> dict[str, dict]:
        """The last published state of every step."""
        events = self.store.read_appended("etl_steps", STEP_EVENTS)
        last = events.groupBy("step").agg(F.max_by(F.struct("state", "inputs", "rows_in", "rows_loaded", "rows_skipped"), "at").alias("e"))
        return {r["step"]: r["e"].asDict() | {"inputs": json.loads(r["e"]["inputs"])} for r in last.collect()}  # a row per load

    def runs(self) -> DataFrame:
        """Current state per run; notes of all events are joined in order."""
        events = self.store.read_appended("etl_runs", RUN_EVENTS)
        at = F.struct("seq", "at")
        return events.groupBy("run_id").agg(
            F.min("at").alias("started_at"),
            F.max(F.when(F.col("status") != "RUNNING", F.col("at"))).alias("ended_at"),
            F.max("operator_email").alias("operator_email"),
            F.max_by("status", at).alias("status"),
            F.array_join(
                F.transform(F.array_sort(F.collect_list(F.struct("seq", "at", "notes"))), lambda e: F.coalesce(e["notes"], F.lit(""))),
                "",
            ).alias("notes"),
        )

    def tasks(self) -> DataFrame:
        events = self.store.read_appended("etl_tasks", TASK_EVENTS)
        at = F.struct("seq", "at")
        return events.groupBy("task_id").agg(
            F.max("run_id").alias("run_id"),
            F.max("object_name").alias("object_name"),
            F.min("at").alias("started_at"),
            F.max(F.when(F.col("status") != "RUNNING", F.col("at"))).alias("ended_at"),
            *[F.max_by(n, at).alias(n) for n in ("status", "rows_in", "rows_out", "error")],
        )


def _now() -> datetime:
    return datetime.now(timezone.utc)
