"""Every load over synthetic landed files, then the same files again."""

import json
import os
from dataclasses import replace
from itertools import combinations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import sample_extracts
from keyferry.plans import FULL_RUN, STEPS, TABLES, Audit, LoadConfig, StoreRun, load_order, run_steps
from keyferry.plans.extracts import SOURCES
from keyferry.plans.steps import needs, waves
from keyferry.sources.extracts import scan_marked
from keyferry.sources import TableStore, require_inputs, resolve_column
from keyferry.session import checkpoint_dir
from keyferry.specs import SourceSpec


@pytest.fixture(scope="module")
def loaded(quick, tmp_path_factory):
    land = sample_extracts.land(str(tmp_path_factory.mktemp("land")))
    store = TableStore(quick, str(tmp_path_factory.mktemp("store")))
    run = StoreRun(quick, LoadConfig("sys", now="2025-01-01 00:00:00"), {}, store=store, landing=land)
    audit = Audit(store)
    counts = run_steps(audit, run, FULL_RUN, "op@x.test")
    counts |= run_steps(audit, run, ["old_users_accounts", "wetmills"], "op@x.test")
    return store, run, audit, counts


def table(store, name, *cols, key="sf_id"):
    return {r[key]: tuple(r[c] for c in cols) for r in store.read(TABLES[name]).collect()}


def test_counts(loaded):
    counts = {n: (c["rows_in"], c["rows_loaded"], c["rows_skipped"]) for n, c in loaded[3].items()}
    assert counts == {
        "users": (7, 5, 2), "programs": (3, 3, 0), "locations": (3, 3, 0), "projects": (3, 2, 1), "project_staff_roles": (4, 2, 2),
        "training_modules": (2, 2, 0), "farmer_groups": (3, 2, 1), "training_sessions": (3, 1, 2), "training_session_images": (4, 4, 0),
        "households": (5, 2, 3), "farmers": (4, 3, 1), "attendances": (4, 3, 1), "observations": (3, 2, 1), "observation_results": (10, 7, 3),
        "farm_visits": (4, 2, 2), "fv_best_practices": (11, 7, 4), "old_users_accounts": (12, 6, 6), "wetmills": (12, 8, 4),
    }


def test_logins_are_unique_and_made_up_when_needed(loaded):
    users = table(loaded[0], "users", "username", "email", key="id")
    names = [u for u, _ in users.values() if u]
    assert len(names) == len(set(names)) and "ada" in names and any(n.startswith("ada-") for n in names)
    assert any(e and e.endswith("@users.invalid") for _, e in users.values())


def test_hierarchy_and_lookups(loaded):
    store = loaded[0]
    places = table(store, "locations", "id", "parent_location_id", "location_type")
    assert places["L2"][1] == places["L1"][0] and places["L3"][1] is None and places["L3"][2] == "Unknown"
    assert set(places) == {"L1", "L2", "L3"}
    projects = table(store, "projects", "program_id", "location_id", "project_unique_id")
    assert projects["J1"][1] == places["L1"][0] and projects["J2"] == (None, None, "J2")


def test_sessions_households_farmers(loaded):
    store = loaded[0]
    session = table(store, "training_sessions", "male_attendees_session_1", "female_attendees_session_1", "male_attendees_agg", "total_attendees_agg")
    assert session == {"S1": (12, 7, 16, 0)}
    homes = table(store, "households", "household_number", "number_of_trees")
    assert homes == {"H1": (12, 30), "H5": (21, 0)}
    farmers = table(store, "farmers", "first_name", "gender", "commcare_case_id")
    assert farmers["F1"] == ("Dup", "Male", "fc1") and farmers["F2"][:2] == ("Unknown", "Male") and "F3" not in farmers


def test_results_and_best_practices(loaded):
    store = loaded[0]
    results = table(store, "observation_results", "result_text", "result_numeric", "criterion", key="question_key")
    assert results["Sucker_Selection_Taken_Place"][0] == "Yes. Sucker selection completed"
    assert int(results["number_of_suckers"][1]) == 4 and results["pruning_methods"][0] == "newer"
    assert results["Clear_Voice"][2] == "Participant Feedback" and len(results) == 6
    answers = table(store, "fv_best_practice_answers", "answer_boolean", "answer_numeric", "answer_url", "answer_text", key="question_key")
    assert answers["do_you_have_compost_manure"][0] is True and answers["year_stumping"][2] == "https://x/y"
    images = table(store, "images", "image_reference_type", "image_url", key="submission_id")
    assert images["S2_1"] == ("training_session", None) and images["bs1:Compost:photo_of_the_compost_manure__c"][1] == "http://i/1"


def test_files(loaded):
    store = loaded[0]
    mills = table(store, "wetmills", "name", "is_deleted", "office_gps_srid", key="id")
    assert mills == {"w-1": ("Mill again", True, 4326), "w-4": ("No case 4", True, None)}
    assert set(table(store, "wetmill_visits", "wetmill_id", key="id").values()) == {("w-1",)}
    roles = table(store, "project_staff_roles", "staff_id", "role", key="id")
    assert {k for k in roles if k.startswith("pr-")} == {"pr-1", "pr-9"}


def test_audit(loaded):
    runs = loaded[2].runs().collect()
    assert [r["status"] for r in runs] == ["SUCCESS", "SUCCESS"] and all(r["ended_at"] >= r["started_at"] for r in runs)
    tasks = {r["object_name"]: r for r in loaded[2].tasks().collect()}
    assert tasks["households"]["rows_in"] == 5 and tasks["households"]["rows_out"] == 2 and len(tasks) == 18


def test_second_run_changes_nothing(loaded):
    store, run, audit, _ = loaded
    # the account files have cleared a user's record id, so loads that look up users find one less now
    by_user = {"users", "project_staff_roles", "farmer_groups", "training_sessions", "observations", "farm_visits"}
    names = [n for n in FULL_RUN if n not in by_user] + ["old_users_accounts", "wetmills"]
    tables = [t for t in TABLES.values() if store.exists(t.name)]
    before = {t.name: sorted(map(repr, store.read(t).collect())) for t in tables}
    run_steps(audit, run, names, "op@x.test")
    for t in tables:
        assert sorted(map(repr, store.read(t).collect())) == before[t.name], t.name


def test_failed_step_keeps_the_old_version(loaded, monkeypatch):
    store, run, audit, _ = loaded
    before = store.read(TABLES["programs"]).count()
    monkeypatch.setattr(run, "landing", "/nowhere")
    with pytest.raises(Exception):
        run_steps(audit, run, ["programs"], "op@x.test")
    assert store.read(TABLES["programs"]).count() == before
    last = audit.runs().orderBy(F.col("started_at").desc()).first()
    assert last["status"] == "FAILED" and last["notes"].startswith("programs: ")


def test_inputs(quick, loaded):
    with pytest.raises(FileNotFoundError):
        require_inputs(quick, [loaded[1].landing + "/tbl_users.csv", "/nowhere/a.csv"])
    df = quick.createDataFrame([(1, 2)], "a int, b int")
    assert resolve_column(df, ["z", "b"], "x") == "b"
    with pytest.raises(ValueError):
        resolve_column(df, ["z"], "x")


def test_order_follows_the_references():
    order = load_order()
    for t in TABLES.values():
        for fk in t.foreign:
            assert fk.table == t.name or order.index(fk.table) < order.index(t.name)


LINES = [
    '{"Id": "P1", "Name": "good", "IsDeleted": false, "CreatedDate": "2024-01-01T00:00:00Z", "LastModifiedDate": "2024-01-01T00:00:00Z"}',
    '{"Id": "P2", "Name": "cut o',
    '{"Id": "P3", "Name": "no flag"}',
    '{"Id": "P4", "Name": "text flag", "IsDeleted": "false"}',
    '{"Id": "P5", "Name": "gone", "IsDeleted": true}',
]


def test_damaged_lines_are_rejects(quick, tmp_path):
    folder = tmp_path / "land" / SOURCES["programs"].name
    folder.mkdir(parents=True)
    (folder / "a.json").write_text("\n".join(LINES))
    store = TableStore(quick, str(tmp_path / "store"))
    run = StoreRun(quick, LoadConfig("sys"), {}, store=store, landing=str(tmp_path / "land"))
    counts = run_steps(Audit(store), run, ["programs"], "op@x.test")["programs"]
    assert (counts["rows_in"], counts["rows_loaded"], counts["rows_skipped"]) == (len(LINES), 1, 4)  # this load keeps deleted ones
    report = quick.read.json(f"{store.root}/_reports/{store._run}/programs_rejects").collect()
    assert sorted(r["error_type"] for r in report) == ["malformed", "malformed", "required", "required"]

    flagged = replace(SOURCES["programs"], active_flag="IsDeleted")
    kept, bad = scan_marked(quick, str(folder), flagged)
    assert [r["Id"] for r in kept.collect()] == ["P1"]
    assert sorted(r["reason"] for r in bad.collect()) == ["malformed", "malformed", "missing:IsDeleted"]


def test_a_failing_step_publishes_none_of_its_tables(loaded, monkeypatch):
    store, run, audit, _ = loaded
    log = lambda: store.spark.read.json(f"{store.root}/_log").count()
    before, published, marked = log(), dict(store._tables), dict(run.marked)
    commit = store.commit

    def failing(spec, df, key=()):
        if spec.name == "fv_best_practice_answers":
            raise RuntimeError("disk full")
        return commit(spec, df, key)

    monkeypatch.setattr(store, "commit", failing)
    with pytest.raises(RuntimeError):
        run_steps(audit, run, ["fv_best_practices"], "op@x.test")
    assert log() == before and store._tables == published and run.marked == marked
    monkeypatch.undo()
    run_steps(audit, run, ["fv_best_practices"], "op@x.test")
    assert log() == before + 3
    assert TableStore(store.spark, store.root)._current("fv_best_practices") == store._current("fv_best_practices")


def test_unique_columns_hold_after_every_load(loaded):
    store = loaded[0]
    for t in TABLES.values():
        if store.exists(t.name):
            for key in t.unique:
                rows = store.read(t).dropna(subset=list(key))
                assert rows.count() == rows.select(*key).distinct().count(), (t.name, key)


DAMAGED_RECORD = {"Id": "P6", "Name": "typed", "IsDeleted": False, "CreatedDate": "2024-01-01T00:00:00Z"}


def test_kept_and_rejected_lines_do_not_depend_on_the_columns_read(quick, tmp_path):
    lines = [json.dumps(DAMAGED_RECORD), json.dumps(DAMAGED_RECORD | {"Id": "P7", "Count": "many"}), json.dumps(DAMAGED_RECORD | {"Id": "P8", "Count": 3}), "{", "[1]"]
    (tmp_path / "a.json").write_text("\n".join(lines))
    spec = SourceSpec("things", ("Id", "Name", "IsDeleted", "CreatedDate", "Count"), {"IsDeleted": T.BooleanType(), "Count": T.LongType()})
    kept, bad = scan_marked(quick, str(tmp_path), spec)
    for n in (1, 2):
        for names in combinations(spec.fields, n):
            got = kept.select(*names).collect()
            assert len(got) == 2 and len(got) + bad.select("reason").count() == len(lines), names
    assert sorted(r["Id"] for r in kept.select("Id").collect()) == ["P6", "P8"]
    assert json.dumps(DAMAGED_RECORD | {"Id": "P7", "Count": "many"}) in {r["raw"] for r in bad.collect()}


def some(store, names=("programs", "locations", "projects", "training_modules")):
    return {n: sorted(map(repr, store.read(TABLES[n]).collect())) for n in names}


SOME = ["programs", "locations", "projects", "training_modules"]


def new_run(quick, root, land, buckets=1):
    store = TableStore(quick, str(root), buckets)
    return Audit(store), StoreRun(quick, LoadConfig("sys", now="2025-01-01 00:00:00"), {}, store=store, landing=land)


def test_a_failed_run_goes_on_where_it_failed(quick, tmp_path, monkeypatch):
    land = sample_extracts.land(str(tmp_path / "land"))
    audit, run = new_run(quick, tmp_path / "store", land)
    clean_audit, clean = new_run(quick, tmp_path / "clean", land)
    run_steps(clean_audit, clean, SOME, "op@x.test")
    load = STEPS["projects"].load
    monkeypatch.setitem(STEPS, "projects", replace(STEPS["projects"], load=lambda r: 1 / 0))
    with pytest.raises(ZeroDivisionError):
        run_steps(audit, run, SOME, "op@x.test")
    monkeypatch.setitem(STEPS, "projects", replace(STEPS["projects"], load=load))
    first = run_steps(audit, run, SOME, "op@x.test", resume=True)
    done = {(r["object_name"], r["status"]) for r in audit.tasks().collect()}
    assert {("programs", "SKIPPED"), ("locations", "SKIPPED"), ("projects", "FAILED"), ("projects", "SUCCESS"), ("training_modules", "SUCCESS")} <= done
    assert some(run.store) == some(clean.store)
    # nothing has changed: all are skipped; a changed file redoes its step and what hangs on it
    assert run_steps(audit, run, SOME, "op@x.test", resume=True) == first
    with open(f"{land}/{SOURCES['locations'].name}/more.json", "w") as f:
        f.write(json.dumps({"Id": "L9", "IsDeleted": False, "Name": "nine", "CreatedDate": sample_extracts.OLD, "LastModifiedDate": sample_extracts.OLD}))
    before = audit.tasks().count()
    run_steps(audit, run, SOME, "op@x.test", resume=True)
    last = {r["object_name"]: r["status"] for r in audit.tasks().orderBy("started_at").collect()[before:]}
    assert last == {"programs": "SKIPPED", "locations": "SUCCESS", "projects": "SUCCESS", "training_modules": "SUCCESS"}
    assert run.store.read(TABLES["locations"]).count() == 4


def test_steps_leave_nothing_behind(quick, tmp_path):
    land = sample_extracts.land(str(tmp_path / "land"))
    audit, run = new_run(quick, tmp_path / "store", land)
    folder = f"{checkpoint_dir(quick)}/keyferry"
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    run_steps(audit, run, ["programs", "users"], "op@x.test")
    assert (set(os.listdir(folder)) if os.path.isdir(folder) else set()) == before
    assert os.listdir(f"{run.store.root}/_stage") == [] and run.store.read(TABLES["users"]).count() > 0


def test_steps_side_by_side_give_the_same_tables(quick, tmp_path):
    land = sample_extracts.land(str(tmp_path / "land"))
    audit, run = new_run(quick, tmp_path / "store", land, buckets=4)
    clean_audit, clean = new_run(quick, tmp_path / "clean", land)
    assert waves(SOME) == [["programs", "locations"], ["projects"], ["training_modules"]]
    assert run_steps(audit, run, SOME, "op@x.test", side_by_side=3) == run_steps(clean_audit, clean, SOME, "op@x.test")
    assert some(run.store) == some(clean.store)
    assert needs(FULL_RUN)["fv_best_practices"] == ["training_session_images", "farm_visits"]
