"""Loads of users, staff roles, households, farmers and attendances."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import functions as X
from ..operators import (
    Hop, assign_unique, dedupe_last, filter_by_parent, key_map, lookup_key, lookup_required, reject_if,
)
from ..operators.unique import before_domain
from ..specs import Lookup
from .extracts import participant
from .programme import _upsert, stamps
from .run import FrameRun, merge_spec, target_rows
from .tables import ATTENDANCES, FARMERS, HOUSEHOLDS, PROJECT_STAFF_ROLES, USERS

c = F.col


def users(run: FrameRun):
    """Contacts become users with a unique user name and e-mail.

    Names the record itself got in an earlier run count as free, so a second run changes nothing.
    """
    src = dedupe_last(run.extract("users"), ["Id"], ["LastModifiedDate"])
    src = src.withColumn("_login", X.fabricated_login(c("Email"), c("Id"), run.cfg.email_domain))
    src = src.withColumn("_name", c("_login.username")).withColumn("_mail", c("_login.email"))
    owner = F.coalesce("sf_id", F.concat(F.lit("id:"), c("id")))
    stored = run.target("users")
    names = stored.filter(c("username").isNotNull()).groupBy(F.lower("username").alias("n")).agg(F.min(owner).alias("o"))
    mails = stored.filter(c("email").isNotNull()).groupBy(F.lower("email").alias("n")).agg(F.min(owner).alias("o"))
    src = run.stage("users_logins", src)
    src = assign_unique(src, "_name", "Id", ["CreatedDate"], "_user_name", names)
    src = assign_unique(src, "_mail", "Id", ["CreatedDate"], "_user_mail", mails, before_domain)
    mapping = stamps() | {
        "first_name": "FirstName",
        "last_name": "LastName",
        "email": "_user_mail",
        "username": "_user_name",
        "tns_id": X.first_truthy(c("TNS_Id__c"), X.hash_key("", c("Id"))),
        "phone_number": "Phone",
        "job_title": "Role_In_Hierarchy__c",
        "user_role": "Role_In_Hierarchy__c",
        "status": "contact_status__c",
        "commcare_mobile_worker_id": F.lit(None).cast("string"),
    }
    # the account files clear the record id of users they update
    return _upsert(run, USERS, src, mapping, {"created_at": "target"}, check_id=True)


def project_staff_roles(run: FrameRun):
    """Staff roles; the worker group of the role's location is looked up, empty without a match."""
    groups = run.extract("worker_groups").withColumn(
        "_group", F.coalesce("CC_Mobile_Worker_Group_Id__c", F.lit(""))
    )
    df = reject_if(
        run.extract("project_staff_roles"),
        F.coalesce("Project_Location__c", F.lit("")) == "",
        "missing:project_location",
    )
    df = lookup_key(
        df, key_map(groups, "Location_Id__c", "_group", keep="last"), "Project_Location__c",
        "commcare_location_id", F.lit(""),
    )
    df = lookup_key(df, run.ids("users"), "Staff__c", "staff_id")
    df = lookup_key(df, run.ids("projects"), "Project__c", "project_id")
    mapping = stamps() | {
        "staff_id": "staff_id",
        "project_id": "project_id",
        "tns_id": "TNS_Id__c",
        "role": X.first_truthy(c("Role__c"), F.lit("Unknown")),
        "status": "Roles_Status__c",
        "commcare_location_id": "commcare_location_id",
        "commcare_case_id": "CommCare_Case_Id__c",
        "send_to_commcare": X.truthy(c("Create_In_CommCare__c")),
        "send_to_commcare_status": X.first_truthy(c("Sent_to_OpenFn_Status__c"), F.lit("Pending")),
    }
    return _upsert(run, PROJECT_STAFF_ROLES, df, mapping, {"created_by_id": "source"})


def _of_projects(run: FrameRun, df):
    """Rows whose training group belongs to one of the configured projects."""
    if run.cfg.project_ids is None:
        return df
    hop = Hop("Training_Group__c", run.extract("farmer_groups"), "Id")
    return filter_by_parent(df, [hop], c("Project__c").isin(*run.cfg.project_ids))


def households(run: FrameRun):
    """Only households named by a whole number; it stands in for a missing household number."""
    df = lookup_required(
        _of_projects(run, run.extract("households")),
        [Lookup("Training_Group__c", run.ids("farmer_groups"), "farmer_group_id", required=True)],
    )
    name = X.first_truthy(c("Name"), F.concat(F.lit("HH-"), c("Id")))
    df = df.withColumn("_name", name)
    df = reject_if(df, c("Household_ID__c").isNull(), "missing:tns_id")
    df = reject_if(df, ~X.is_digits(c("_name")), "format:household_name")
    zero = F.lit(0).cast("bigint")
    mapping = stamps() | {
        "farmer_group_id": "farmer_group_id",
        "household_name": "_name",
        "household_number": X.household_number(X.to_int(c("Household_Number__c")), c("_name")),
        "tns_id": "Household_ID__c",
        "commcare_case_id": "CommCare_Case_Id__c",
        "number_of_trees": F.coalesce(X.to_int(c("Coffee_Seedlings__c")), zero),
        "farm_size": X.to_double(c("Farm_Size__c")),
        "sampled_for_fv_aa": X.truthy(c("FV_AA_Sampled__c")),
        "farm_size_before": X.to_double(c("Farm_Size_Before__c")),
        "farm_size_after": X.to_double(c("Farm_Size_After__c")),
        "farm_size_since": X.to_double(c("Planted_After_Maria__c")),
        "status": X.first_truthy(c("Status__c"), F.lit("Active")),
        "visited_for_fv_aa": X.truthy(c("FV_AA_Visited__c")),
        "fv_aa_sampling_round": F.coalesce(X.to_int(c("FV_AA_Current_Sampling_Round__c")), zero),
    }
    return _upsert(run, HOUSEHOLDS, df, mapping)


def farmers(run: FrameRun):
    """Guarded upsert on the record id or the case id; ambiguous records are refused and reported."""
    extra = run.cfg.number_fields
    df = lookup_required(
        _of_projects(run, run.extract("farmers", participant(extra))),
        [
            Lookup("Training_Group__c", run.ids("farmer_groups"), "farmer_group_id", required=True),
            Lookup("Household__c", run.ids("households"), "household_id", required=True),
        ],
    )
    unknown, number = F.lit("Unknown"), [c("TNS_Id__c"), *[c(f) for f in extra], X.hash_key("", c("Id"))]
    mapping = stamps() | {
        "farmer_group_id": "farmer_group_id",
        "household_id": "household_id",
        "tns_id": X.first_truthy(*number),
        "commcare_case_id": X.first_truthy(c("CommCare_Case_Id__c"), X.hash_key("CC-", c("Id"))),
        "first_name": X.first_truthy(c("Name"), unknown),
        "middle_name": "Middle_Name__c",
        "last_name": X.first_truthy(c("Last_Name__c"), unknown),
        "other_id": X.first_truthy(c("Other_ID_Number__c"), c("National_ID_Number__c")),
        "gender": X.gender(c("Gender__c"), "Male"),
        "age": F.coalesce(X.to_int(c("Age__c")), F.lit(0).cast("bigint")),
        "phone_number": "Phone_Number__c",
        "is_primary_household_member": X.equals_flag(c("Primary_Household_Member__c"), "Yes"),
        "status": X.first_truthy(c("Status__c"), F.lit("Active")),
        "send_to_commcare": X.truthy(c("Create_In_CommCare__c")),
        "send_to_commcare_status": X.first_truthy(c("Sent_to_OpenFn_Status__c"), F.lit("Pending")),
        "status_notes": "Status_Notes__c",
    }
    rows = target_rows(df, FARMERS, run.cfg, mapping, c("Id"))
    spec = merge_spec(("sf_id",), rows, FARMERS, mapping)
    return run.load(FARMERS, rows, spec, guard=("sf_id", "commcare_case_id"))


def attendances(run: FrameRun):
    df = lookup_required(
        run.extract("attendances"),
        [
            Lookup("Participant__c", run.ids("farmers"), "farmer_id", required=True),
            Lookup("Training_Session__c", run.ids("training_sessions"), "training_session_id", required=True),
        ],
    )
    mapping = stamps() | {
        "farmer_id": "farmer_id",
        "training_session_id": "training_session_id",
        "date_attended": "Date__c",
        "submission_id": "Submission_ID__c",
        "status": X.attendance(c("Status__c"), X.to_double(c("Attended__c"))),
    }
    # Without a submission id the record id identifies the attendance.
    return _upsert(run, ATTENDANCES, df, mapping, key=("submission_id", "sf_id"))
