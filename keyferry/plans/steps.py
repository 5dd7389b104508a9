"""The loads by name, their order, and audited runs of one or several of them."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from . import legacy, people, programme, surveys, visits
from ..session import cuts_released
from ..sources.store import Conflict
from .audit import Audit
from .run import FrameRun, LoadConfig, StoreRun
from .tables import TABLES, load_order


@dataclass(frozen=True)
class Step:
    """One load: its name, what it does, the table that places it in the run order, and further tables it writes."""

    name: str
    load: Callable[[FrameRun], object]
    table: str
    also: tuple[str, ...] = ()

    @property
    def tables(self) -> tuple[str, ...]:
        return (self.table, *self.also)


STEPS = {
    s.name: s
    for s in (
        Step("users", people.users, "users"),
        Step("programs", programme.programs, "programs"),
        Step("locations", programme.locations, "locations"),
        Step("projects", programme.projects, "projects"),
        Step("project_staff_roles", people.project_staff_roles, "project_staff_roles"),
        Step("training_modules", programme.training_modules, "training_modules"),
        Step("farmer_groups", programme.farmer_groups, "farmer_groups"),
        Step("training_sessions", programme.training_sessions, "training_sessions"),
        Step("training_session_images", programme.training_session_images, "training_sessions", ("images",)),
        Step("households", people.households, "households"),
        Step("farmers", people.farmers, "farmers"),
        Step("attendances", people.attendances, "attendances"),
        Step("observations", visits.observations, "observations"),
        Step("observation_results", visits.observation_results, "observation_results"),
        Step("farm_visits", visits.farm_visits, "farm_visits"),
        Step("fv_best_practices", visits.fv_best_practices, "fv_best_practices", ("fv_best_practice_answers", "images")),
        Step("old_users_accounts", legacy.legacy_accounts, "project_staff_roles", ("users",)),
        Step("wetmills", surveys.wetmill_surveys, "wetmills", ("wetmill_visits", "wv_survey_responses", "wv_survey_question_responses")),
    )
}
# The two CSV loads have their own files and are started by name.
FULL_RUN = [n for n in STEPS if n not in ("old_users_accounts", "wetmills")]


def ordered(names: Sequence[str]) -> list[str]:
    """Steps so that referenced tables are loaded first (from the declared foreign keys)."""
    rank = {t: i for i, t in enumerate(load_order())}
    return sorted(names, key=lambda n: (rank[STEPS[n].table], list(STEPS).index(n)))


def run_step(audit: Audit, run_id: str, name: str, run: FrameRun) -> dict:
    """One audited step; a failure is recorded with 0 rows and raised again.

    What a stored run writes in between is removed when the step ends.
    """
    if not isinstance(run, StoreRun):
        return _run_step(audit, run_id, name, run)
    with cuts_released(run.spark):
        return _run_step(audit, run_id, name, run)


def _run_step(audit: Audit, run_id: str, name: str, run: FrameRun) -> dict:
    task = audit.start_task(run_id, name)
    before = run.marked
    run.marked = {}
    run.inputs = []
    try:
        run.begin()
        STEPS[name].load(run)
        seen = run.counts().values()
        rows, bad = sum(n for n, _ in seen), sum(n for _, n in seen)
        counts = {"rows_in": rows, "rows_loaded": rows - bad, "rows_skipped": bad}
        if isinstance(run, StoreRun):
            run.report(f"{name}_rejects", run.rejects())
        run.finish()
        audit.finish_task(task, counts["rows_in"], counts["rows_loaded"])
        return counts
    except Exception as err:
        run.abandon()
        audit.finish_task(task, 0, 0, "FAILED", str(err))
        raise
    finally:
        run.marked = before


def needs(names: Sequence[str]) -> dict[str, list[str]]:
    """For each step the earlier ones it must wait for: they write a table that it references or writes too."""
    out: dict[str, list[str]] = {}
    for name in ordered(names):
        mine = set(STEPS[name].tables)
        mine |= {fk.table for t in STEPS[name].tables for fk in TABLES[t].foreign}
        out[name] = [before for before in out if mine & set(STEPS[before].tables)]
    return out


def waves(names: Sequence[str]) -> list[list[str]]:
    """Steps that may run side by side, wave after wave."""
    level: dict[str, int] = {}
    for name, before in needs(names).items():
        level[name] = 1 + max((level[b] for b in before), default=-1)
    return [[n for n in level if level[n] == k] for k in range(max(level.values(), default=-1) + 1)]


def _state(name: str, run: StoreRun, inputs: Sequence[str], before: Mapping[str, str | None]) -> str:
    """Digest of all a step's result hangs on: its files, the settings, and the states of the steps before it."""
    what = [name, repr(run.cfg), run.fingerprint(inputs), sorted(before.items())]
    return hashlib.sha256(json.dumps(what).encode()).hexdigest()


def run_steps(
    audit: Audit,
    run: FrameRun,
    names: Sequence[str] | None = None,
    operator: str = "",
    resume: bool = False,
    side_by_side: int = 1,
) -> dict[str, dict]:
    """Audited run of several steps in dependency order; the first failure ends it as FAILED.

    With ``resume`` a step is skipped if the last thing it published came from the same files, settings
    and steps before it; so a run that failed goes on where it failed, and a changed file redoes its step
    and those that hang on it. Steps are recorded after they are published: one that dies in between is
    done again, which changes nothing.

    Up to ``side_by_side`` steps without a path of references between them run at once, each with a store of
    its own. Should two of them change the same rows all the same, the later one starts again.
    """
    audit.ensure_tables()
    run_id = audit.start_run(operator)
    results: dict[str, dict] = {}
    wanted = ordered(names or FULL_RUN)
    known = audit.steps() if isinstance(run, StoreRun) else {}
    before_of = needs(wanted)
    failed = None

    def one(name: str, alone: FrameRun) -> None:
        before = {b: known.get(b, {}).get("state") for b in before_of[name]}
        last = known.get(name)
        if resume and last is not None and last["state"] == _state(name, alone, last["inputs"], before):
            results[name] = {k: last[k] for k in ("rows_in", "rows_loaded", "rows_skipped")}
            audit.finish_task(audit.start_task(run_id, name), last["rows_in"], last["rows_loaded"], "SKIPPED")
            return
        results[name] = run_step(audit, run_id, name, alone)
        if isinstance(alone, StoreRun):
            inputs = sorted(set(alone.inputs))
            known[name] = results[name] | {"inputs": inputs, "state": _state(name, alone, inputs, before)}
            audit.record_step(run_id, name, known[name])

    def again(name: str, alone: FrameRun) -> None:
        for left in (2, 1, 0):
            try:
                return one(name, alone)
            except Conflict:
                if not left:
                    raise

    try:
        if side_by_side > 1 and isinstance(run, StoreRun):
            with ThreadPoolExecutor(side_by_side) as pool:
                for wave in waves(wanted):
                    tasks = {n: pool.submit(again, n, run.beside()) for n in wave}
                    for failed, task in tasks.items():
                        task.result()
            run.store.refresh()
        else:
            for failed in wanted:
                one(failed, run)
    except Exception as err:
        audit.finish_run(run_id, "FAILED", f"{failed}: {err}")
        raise
    audit.finish_run(run_id, "SUCCESS", str(results))
    return results


__all__ = ["FULL_RUN", "LoadConfig", "STEPS", "Step", "needs", "ordered", "run_step", "run_steps", "waves"]
