"""Load of legacy accounts and their project roles from CSV files."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import functions as X
from ..operators import (
    REJECT, in_scope, insert_only, key_map, lookup_chain, lookup_key, map_codes, not_existing,
    reject_if, resolve_within, split_rejects, unmapped,
)
from ..sources.extracts import resolve_column
from ..specs import Lookup
from .extracts import LEGACY_FILES, LEGACY_ROLES, OLD_PROJECT_ID, OLD_PROJECT_SOURCE_ID, ROLES_WITHOUT_PROJECT
from .run import FrameRun, merge_spec, target_rows
from .tables import PROJECT_STAFF_ROLES, USERS

c = F.col


def _with_role(df, roles, code: str):
    """Legacy role name of a role code, and the role it became."""
    df = lookup_key(df.withColumn("_code", X.strip(c(code))), roles, "_code", "_old_role")
    df = df.withColumn("_old_key", F.lower("_old_role"))
    return map_codes(df, "_old_key", LEGACY_ROLES, "_role")


def legacy_accounts(run: FrameRun):
    """Accounts are resolved by id, source id, e-mail or user name, against the users table and
    among each other; roles are resolved, filtered and added where the table lacks them."""
    files = run.files(LEGACY_FILES)
    roles = files["roles"].select(X.strip(c("role_id")).alias("k"), X.clean_str(c("role_name")).alias("v"))
    roles = key_map(roles.filter(X.clean_str(c("k")).isNotNull() & c("v").isNotNull()), "k", "v", keep="last")

    people = _with_role(files["users"].withColumn("_user", X.strip(c("user_id"))), roles, "role_id")
    people = (
        people.withColumn("_email", X.norm_email(c("user_email")))
        .withColumn("_login", F.lower(X.clean_str(X.username(c("user_email"), c("user_name")))))
        .withColumn("_source_id", X.clean_str(c("sf_user_id")))
        .withColumn("_name", X.split_name(c("user_name")))
        .withColumn("_updated", X.to_ts_utc(c("updatedAt")))
    )
    people = run.stage("legacy_people", people)
    run.report("unmapped_user_roles", unmapped(people, ["_code", "_old_role"], "_role"))

    stored = run.target("users")
    by = lambda col: key_map(stored.withColumn("_k", X.clean_str(c(col))), "_k", "id", lower=True, keep="last")
    people = resolve_within(
        people,
        "_user",
        [
            ("_user", stored.select(c("id").alias("k"), "id")),
            ("_source_id", key_map(stored, "sf_id", "id", clean=True, keep="last")),
            ("_email", by("email")),
            ("_login", by("username")),
        ],
        ["createdAt"],
        "_actual",
    )
    people = run.stage("legacy_resolved", people)
    mapping = {
        "id": "_actual",
        "from_sf": F.lit(False),
        "sf_id": "_source_id",
        "first_name": c("_name.first_name"),
        "middle_name": c("_name.middle_name"),
        "last_name": c("_name.last_name"),
        "email": "_email",
        "username": "_login",
        "created_at": X.to_ts_utc(c("createdAt")),
        "updated_at": "_updated",
        "tns_id": X.prefixed_key("legacy-user", c("_user"), c("sf_user_id")),
        "phone_number": X.clean_str(c("mobile_no")),
        "job_title": F.lit(None).cast("string"),
        "user_role": "_role",
        "status": X.status_label(c("account_status")),
    }
    rows = target_rows(people, USERS, run.cfg, mapping, c("_user"), ("_user",))
    rules = {"created_at": "target", "from_sf": "target"}
    users = run.load(USERS, rows, merge_spec(("id",), rows, USERS, mapping, rules, ("updated_at", "_user")))

    assigned = _legacy_roles(run, files, roles, people)
    kept, rejected = split_rejects(assigned)
    actual = people.select("_user", "_actual")
    kept = lookup_key(kept, key_map(actual, "_user", "_actual"), "_user", "staff_id")
    # Only accounts that made it into the users table can hold a role.
    kept = in_scope(kept, users.select("id"), "staff_id")
    stored_roles = run.target("project_staff_roles")
    key = ["staff_id", "project_id", "role"]
    new = not_existing(kept.withColumn("role", c("_role")), stored_roles, key, ["_updated", "_pr"])
    mapping = {
        "id": "_pr",
        "from_sf": F.lit(False),
        "sf_id": F.lit(None).cast("string"),
        "staff_id": "staff_id",
        "project_id": "project_id",
        "tns_id": X.prefixed_key("legacy-pr", c("_pr")),
        "role": "role",
        "status": F.lit("Active"),
        "commcare_case_id": X.hash_key("LEGACY-PR-", c("_pr")),
        "send_to_commcare_status": F.lit("Pending"),
        "created_at": X.to_ts_utc(c("createdAt")),
        "updated_at": "_updated",
    }
    added = target_rows(new, PROJECT_STAFF_ROLES, run.cfg, mapping, c("_pr"))
    run.report("rejected_roles", rejected.select("_pr", "_user", "_project", "_old_role", "_role", REJECT))
    run.mark("project_staff_roles", assigned.select(c("_pr").alias("id"), "_user", "_project", "_role", REJECT))
    held = kept.join(new.select("_pr"), "_pr", "left_anti").withColumn(REJECT, F.lit("already_held"))
    run.mark("project_staff_roles:late", held.select(c("_pr").alias("id"), *key[:2], "_role", REJECT))
    merged = insert_only(stored_roles, added, ["id"], ["updated_at"])
    return run.publish(PROJECT_STAFF_ROLES, merged)


def _legacy_roles(run: FrameRun, files, roles, people):
    """Project roles of the accounts in the file, each marked with the first reason against it."""
    old = files["old_projects"]
    old_id = resolve_column(old, OLD_PROJECT_ID, "old project id")
    old_source = resolve_column(old, OLD_PROJECT_SOURCE_ID, "old project source id")
    old_map = old.select(X.strip(c(old_id)).alias("k"), X.clean_str(c(old_source)).alias("v"))
    old_map = key_map(old_map.filter(X.clean_str(c("k")).isNotNull() & c("v").isNotNull()), "k", "v", keep="last")

    df = files["project_roles"].select(
        X.strip(c("user_id")).alias("_user"), X.strip(c("pr_id")).alias("_pr"),
        X.strip(c("project_id")).alias("_project"), c("role").alias("_role_id"), "createdAt",
        X.to_ts_utc(c("updatedAt")).alias("_updated"),
    )
    df = _with_role(in_scope(df, people.select("_user"), "_user"), roles, "_role_id")
    run.report("unmapped_project_roles", unmapped(df, ["_code", "_old_role"], "_role"))
    df = reject_if(df, c("_old_role").isNotNull() & c("_role").isNull(), "unmapped_role")
    df = reject_if(df, c("_role").isin(*ROLES_WITHOUT_PROJECT), "skipped_role")
    df = lookup_chain(
        df,
        [
            Lookup("_project", old_map, "_project_source", required=True, reason="missing_old_project"),
            Lookup("_project_source", run.ids("projects"), "project_id", required=True, reason="missing_new_project"),
        ],
    )
    return reject_if(df, c("_role").isNull(), "unknown_role_code")
