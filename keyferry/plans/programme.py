"""Loads of programs, locations, projects, modules, groups, sessions and session photos."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import functions as X
from ..operators import dedupe_last, fan_out, lookup_key, lookup_required
from ..specs import Lookup
from .run import FrameRun, merge_spec, target_rows
from .tables import (
    FARMER_GROUPS, IMAGES, LOCATIONS, PROGRAMS, PROJECTS, TRAINING_MODULES, TRAINING_SESSIONS,
)

c = F.col


def stamps(updated: str = "LastModifiedDate") -> dict:
    """Columns every source object shares."""
    return {
        "sf_id": "Id",
        "is_deleted": X.truthy(c("IsDeleted")),
        "created_at": X.to_ts_utc(c("CreatedDate")),
        "updated_at": X.to_ts_utc(c(updated)),
    }


def _upsert(run: FrameRun, table, df, mapping, rules=None, key=("sf_id",), order=("updated_at",), carry=(), check_id=False):
    rows = target_rows(df, table, run.cfg, mapping, c("Id"), carry)
    return run.load(table, rows, merge_spec(key, rows, table, mapping, rules, order), check_id=check_id)


def programs(run: FrameRun):
    """The name doubles as code."""
    mapping = stamps() | {"program_name": "Name", "program_code": "Name"}
    return _upsert(run, PROGRAMS, run.extract("programs"), mapping)


def locations(run: FrameRun):
    """Upsert, then link parents over the whole table.

    Records of the extract get the parent they name, or none; others keep theirs. The update time
    moves to now only when the link really changes, and never back.
    """
    src = run.extract("locations")
    mapping = stamps() | {
        "location_name": "Name",
        "location_type": X.first_truthy(c("Type__c"), F.lit("Unknown")),
    }
    rows = target_rows(src, LOCATIONS, run.cfg, mapping, c("Id"))
    before = run.target("locations")
    stored = before.select("sf_id", "parent_location_id").filter(c("sf_id").isNotNull())
    rules = {"updated_at": "greatest"}
    merged = run.load(LOCATIONS, rows, merge_spec(("sf_id",), rows, LOCATIONS, mapping, rules))
    named = dedupe_last(src, ["Id"], ["LastModifiedDate"]).select("Id", F.struct(c("Parent_Location__c").alias("ref")))
    linked = lookup_key(merged, named, "sf_id", "_named").withColumn("_ref", c("_named.ref"))
    linked = lookup_key(linked, merged.filter(c("sf_id").isNotNull()).select("sf_id", "id"), "_ref", "_parent")
    linked = lookup_key(linked, stored, "sf_id", "_old")
    parent = F.when(c("_named").isNotNull(), c("_parent")).otherwise(c("parent_location_id"))
    moved = c("_parent").isNotNull() & ~c("_old").eqNullSafe(c("_parent"))
    now = F.lit(run.cfg.now).cast("timestamp")
    final = linked.withColumn("updated_at", F.when(moved, F.greatest("updated_at", now)).otherwise(c("updated_at")))
    final = final.withColumn("parent_location_id", parent).select(*LOCATIONS.columns)
    return run.publish(LOCATIONS, final)


def projects(run: FrameRun):
    df = lookup_key(run.extract("projects"), run.ids("programs"), "Program__c", "program_id")
    df = lookup_key(df, run.ids("locations"), "Project_Country__c", "location_id")
    mapping = stamps() | {
        "project_name": "Name",
        "project_unique_id": X.first_truthy(c("Project_Unique_Id__c"), c("Id")),
        "status": X.first_truthy(c("Project_Status__c"), F.lit("Active")),
        "start_date": "Project_Start_Date__c",
        "end_date": "Project_End_Date__c",
        "program_id": "program_id",
        "location_id": "location_id",
    }
    return _upsert(run, PROJECTS, df, mapping)


def training_modules(run: FrameRun):
    df = lookup_key(run.extract("training_modules"), run.ids("projects"), "Project__c", "project_id")
    mapping = stamps() | {
        "project_id": "project_id",
        "module_name": X.first_truthy(c("Module_Title__c"), c("Name")),
        "module_number": X.to_int(c("Module_Number__c")),
        "current_module": X.truthy(c("Current_Training_Module__c")),
        "current_previous": "Current_Previous_Module__c",
        "status": X.first_truthy(c("Module_Status__c"), F.lit("Active")),
        "sample_fv_aa_households": X.truthy(c("Sample_AA_FV_Farmers__c")),
        "sample_fv_aa_households_status": F.lit(None).cast("string"),
    }
    return _upsert(run, TRAINING_MODULES, df, mapping)


def farmer_groups(run: FrameRun):
    df = lookup_required(
        run.extract("farmer_groups"),
        [
            Lookup("Project__c", run.ids("projects"), "project_id", required=True),
            Lookup("Responsible_Staff__c", run.ids("users"), "responsible_staff_id", required=True),
            Lookup("Location__c", run.ids("locations"), "location_id"),
        ],
    )
    mapping = stamps() | {
        "project_id": "project_id",
        "responsible_staff_id": "responsible_staff_id",
        "location_id": "location_id",
        "tns_id": X.first_truthy(c("TNS_Id__c"), X.hash_key("", c("Id"))),
        "commcare_case_id": X.first_truthy(c("CommCare_Case_Id__c"), X.hash_key("CC-", c("Id"))),
        "ffg_name": X.first_truthy(c("Name"), F.concat(F.lit("FG-"), c("Id"))),
        "send_to_commcare": X.truthy(c("Create_In_CommCare__c")),
        "send_to_commcare_status": X.first_truthy(c("Sent_to_OpenFn_Status__c"), F.lit("Pending")),
        "status": X.first_truthy(c("Group_Status__c"), F.lit("Active")),
        "fv_aa_sampling_round": X.to_int(c("FV_AA_Current_Sampling_Round__c")),
    }
    return _upsert(run, FARMER_GROUPS, df, mapping)


def training_sessions(run: FrameRun):
    df = lookup_required(
        run.extract("training_sessions"),
        [
            Lookup("Training_Module__c", run.ids("training_modules"), "module_id", required=True),
            Lookup("Training_Group__c", run.ids("farmer_groups"), "farmer_group_id", required=True),
            Lookup("Trainer__c", run.ids("users"), "trainer_id"),
        ],
    )
    people = {
        "male": ("Male_Attendance__c", "Second_Male_Attendance__c", "Male_Count_Light_Full__c"),
        "female": ("Female_Attendance__c", "Second_Female_Attendance__c", "Female_Count_Light_Full__c"),
        "total": ("Number_in_Attendance__c", "Second_Number_in_Attendance__c", "Total_Count_Light_Full__c"),
    }
    counts = {}
    for who, (first, second, full) in people.items():
        one, two = X.to_int(c(first)), X.to_int(c(second))
        # A full count that is missing or 0 gives way to the session's own count.
        full_count = X.to_int(c(full))
        counts[f"{who}_attendees_session_1"] = F.when(F.coalesce(full_count, F.lit(0)) != 0, full_count).otherwise(one)
        counts[f"{who}_attendees_session_2"] = two
        counts[f"{who}_attendees_agg"] = X.null_safe_sum(one, two)
    places = {
        "latitude": ("Location_GPS__Latitude__s", "Second_Location_GPS__Latitude__s"),
        "longitude": ("Location_GPS__Longitude__s", "Second_Location_GPS__Longitude__s"),
        "altitude": ("Altitude__c", "Second_Altitude__c"),
    }
    points = {
        f"location_gps_{axis}_session_{i}": X.to_double(c(f))
        for axis, pair in places.items()
        for i, f in enumerate(pair, 1)
    }
    mapping = stamps() | counts | points | {
        "module_id": "module_id",
        "farmer_group_id": "farmer_group_id",
        "trainer_id": "trainer_id",
        "commcare_case_id": X.first_truthy(c("CommCare_Case_Id__c"), c("Id")),
        "send_to_commcare": X.truthy(c("Create_In_CommCare__c")),
        "send_to_commcare_status": X.first_truthy(c("Sent_to_OpenFn_Status__c"), F.lit("Pending")),
        "date_session_1": "Date__c",
        "date_session_2": "Date_2__c",
    }
    return _upsert(run, TRAINING_SESSIONS, df, mapping)


def training_session_images(run: FrameRun):
    """One or two photo rows per session; the first is written even without a link."""
    parts = [("Session_Photo_URL__c", "_1", True), ("Session_Photo_URL_2__c", "_2", False)]
    df = fan_out(
        run.extract("training_session_images"), parts, "Id",
        ["IsDeleted", "CreatedDate", "LastModifiedDate"], "submission_id", "image_url",
    )
    df = lookup_key(df, run.ids("training_sessions"), "Id", "image_reference_id")
    mapping = {k: v for k, v in stamps().items() if k != "sf_id"} | {
        "image_reference_type": F.lit("training_session"),
        "image_reference_id": "image_reference_id",
        "image_url": "image_url",
        "submission_id": "submission_id",
        "verification_status": F.lit("unverified"),
    }
    rows = target_rows(df, IMAGES, run.cfg, mapping, c("submission_id"))
    rules = {"created_at": "target"}
    return run.load(IMAGES, rows, merge_spec(("submission_id",), rows, IMAGES, mapping, rules))


