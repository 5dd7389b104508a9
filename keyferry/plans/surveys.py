"""Load of wet mills, their visits, survey responses and answers from CSV files."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import functions as X
from ..operators import key_map, lookup_key, reject_if, remap_cascade, resolve_entity
from ..operators.dedupe import repeated_hashes, split_repeated
from ..session import cut_lineage
from .extracts import SURVEY_FILES
from .run import FrameRun, merge_spec, target_rows
from .tables import WETMILL_VISITS, WETMILLS, WV_SURVEY_QUESTION_RESPONSES, WV_SURVEY_RESPONSES

c = F.col
ORDER = ("updated_at", "_old")


def _texts(*names: str) -> dict:
    return {n: X.clean_str(c(n)) for n in names}


def _stamps() -> dict:
    return {"created_at": X.to_ts_utc(c("created_at")), "updated_at": X.to_ts_utc(c("updated_at"))}


def _point(df, name: str):
    """Parse a point; text that is no point rejects the row."""
    df = df.withColumn("_point", X.ewkb_to_wkb(c(name)))
    bad = X.clean_str(c(name)).isNotNull() & c("_point").isNull()
    mapping = {name: c("_point.wkb"), f"{name}_srid": c("_point.srid")}
    return reject_if(df, bad, f"cast:{name}"), mapping, {name: "coalesce_source", f"{name}_srid": "coalesce_source"}


def _user(run: FrameRun, df, legacy):
    """Stored user by id, else through the legacy account by source id, e-mail or user name, else
    the system user."""
    stored = run.target("users")
    by = lambda col: key_map(stored, col, "id", clean=True, lower=True, keep="last")
    df = lookup_key(df.withColumn("_uid", X.clean_str(c("user_id"))), legacy, "_uid", "_account")
    for part in ("sf", "email", "login"):
        df = df.withColumn(f"_{part}", c(f"_account.{part}"))
    candidates = [
        ("_uid", stored.select(c("id").alias("k"), "id")),
        ("_sf", key_map(stored, "sf_id", "id", clean=True, keep="last")),
        ("_email", by("email")),
        ("_login", by("username")),
    ]
    return resolve_entity(df, candidates, "_actual_user", F.lit(run.cfg.system_user))


def _own_id(run: FrameRun, df, table, merge_key):
    """Old id of the file, unless it is missing, repeated, or held by another stored row."""
    df = df.withColumn("_old", X.clean_str(c("id"))).withColumn("_mk", merge_key)
    stored = run.target(table.name)
    held = stored.select("id", F.struct(_stored_key(table).alias("k")))
    # an id of one row alone is its own; the others go to the first row that has it
    named = df.filter(c("_old").isNotNull())
    _, several = split_repeated(named, ["_old"], repeated_hashes(named, ["_old"]))
    seq = F.struct(X.to_ts_utc(c("updated_at")), "_mk")
    first = cut_lineage(several.groupBy("_old").agg(F.min_by(F.struct(c("_mk").alias("k")), seq).alias("f")))
    df = lookup_key(df, held, "_old", "_held")
    df = lookup_key(df, first, "_old", "_first")
    free = (
        c("_old").isNotNull()
        & (c("_held").isNull() | c("_held.k").eqNullSafe(c("_mk")))
        & (c("_first").isNull() | c("_first.k").eqNullSafe(c("_mk")))
    )
    own = F.when(free, c("_old")).otherwise(X.stable_id(F.lit(table.name), c("_mk")))
    return df.withColumn("_id", own).drop("_mk", "_held", "_first")


def _file_key(name: str):
    """Merge identity of a file row: the natural key, else the old id."""
    return F.coalesce(F.concat(F.lit("0:"), X.clean_str(c(name))), F.concat(F.lit("1:"), X.clean_str(c("id"))))


def _stored_key(table):
    natural = "commcare_case_id" if table is WETMILLS else "submission_id"
    return F.coalesce(F.concat(F.lit("0:"), X.clean_str(c(natural))), F.concat(F.lit("1:"), c("id")))


def _remap(run: FrameRun, table, merged, natural: str):
    """(old id, actual id) pairs: the merged row with the natural key, else the row's own id.

    The rows are those the load has written, rejected ones among them.
    """
    rows = run.marked[table.name][-1]
    pairs = rows.select("_old", c("id").alias("_id"), X.clean_str(c(natural)).alias("_nk")).filter(c("_old").isNotNull())
    pairs = lookup_key(pairs, key_map(merged, natural, "id", clean=True), "_nk", "_actual")
    pairs = pairs.withColumn("_actual", F.coalesce("_actual", "_id"))
    present = merged.select(c("id").alias("_actual"))
    return key_map(pairs.join(present, "_actual", "left_semi"), "_old", "_actual", keep="last")


def wetmill_surveys(run: FrameRun):
    """Four levels; each resolves its parent among the actual ids of the level above.

    A stored row with the same natural key is updated and keeps its id and creation; an empty point
    never overwrites a stored one. Rows without a parent are rejected.
    """
    files = run.files(SURVEY_FILES)
    legacy = files["legacy_users"].select(
        X.clean_str(c("user_id")).alias("k"),
        F.struct(
            X.clean_str(c("sf_user_id")).alias("sf"),
            X.norm_email(c("user_email")).alias("email"),
            F.lower(F.split_part(X.clean_str(c("user_email")), F.lit("@"), F.lit(1))).alias("login"),
        ).alias("v"),
    )
    legacy = key_map(legacy, "k", "v", keep="last")
    keep = {"created_at": "target"}

    mills = _user(run, _own_id(run, files["wetmills"], WETMILLS, _file_key("commcare_case_id")), legacy)
    mills, point, rules = _point(mills, "office_gps")
    mapping = point | _stamps() | _texts(
        "wet_mill_unique_id", "commcare_case_id", "name", "mill_status", "exporting_status", "programme", "country",
        "manager_name", "manager_role", "comments", "ba_signature", "manager_signature", "tor_page_picture",
        "office_entrance_picture",
    ) | {
        "id": "_id",
        "user_id": "_actual_user",
        "wetmill_counter": X.to_int(X.clean_str(c("wetmill_counter"))),
        "registration_date": X.to_date_safe(c("registration_date")),
        "is_deleted": X.to_bool2(c("is_deleted")),
    }
    rows = target_rows(mills, WETMILLS, run.cfg, mapping, c("_id"), ("_old",))
    spec = merge_spec(("commcare_case_id", "id"), rows, WETMILLS, mapping, rules | keep, ORDER)
    remap = _remap(run, WETMILLS, run.load(WETMILLS, rows, spec), "commcare_case_id")

    visits = _own_id(run, files["wetmill_visits"], WETMILL_VISITS, _file_key("submission_id"))
    visits = remap_cascade(visits.withColumn("_up", X.clean_str(c("wetmill_id"))), remap, "_up", "_parent")
    visits, point, rules = _point(_user(run, visits, legacy), "geo_location")
    mapping = point | _stamps() | _texts("form_name", "entrance_photograph", "submission_id") | {
        "id": "_id",
        "wetmill_id": "_parent",
        "user_id": "_actual_user",
        "visit_date": X.to_date_safe(c("visit_date")),
    }
    rows = target_rows(visits, WETMILL_VISITS, run.cfg, mapping, c("_id"), ("_old",))
    spec = merge_spec(("submission_id", "id"), rows, WETMILL_VISITS, mapping, rules | keep, ORDER)
    remap = _remap(run, WETMILL_VISITS, run.load(WETMILL_VISITS, rows, spec), "submission_id")

    answers = _own_id(run, files["survey_responses"], WV_SURVEY_RESPONSES, _file_key("submission_id"))
    answers = remap_cascade(answers.withColumn("_up", X.clean_str(c("form_visit_id"))), remap, "_up", "_parent")
    mapping = _stamps() | _texts("survey_type", "general_feedback", "submission_id") | {
        "id": "_id",
        "form_visit_id": "_parent",
        "completed_date": X.to_date_safe(c("completed_date")),
    }
    rows = target_rows(answers, WV_SURVEY_RESPONSES, run.cfg, mapping, c("_id"), ("_old",))
    spec = merge_spec(("submission_id", "id"), rows, WV_SURVEY_RESPONSES, mapping, keep, ORDER)
    remap = _remap(run, WV_SURVEY_RESPONSES, run.load(WV_SURVEY_RESPONSES, rows, spec), "submission_id")

    items = _own_id(run, files["survey_question_responses"], WV_SURVEY_QUESTION_RESPONSES, _file_key("submission_id"))
    items = remap_cascade(items.withColumn("_up", X.clean_str(c("survey_response_id"))), remap, "_up", "_parent")
    items, point, rules = _point(items, "value_gps")
    mapping = point | _stamps() | _texts("section_name", "question_name", "field_type", "value_text", "submission_id") | {
        "id": "_id",
        "survey_response_id": "_parent",
        "value_number": X.to_double(X.clean_str(c("value_number"))),
        "value_boolean": X.to_bool2(c("value_boolean"), keep_null=True),
        "value_date": X.to_ts_ntz(c("value_date")),
    }
    rows = target_rows(items, WV_SURVEY_QUESTION_RESPONSES, run.cfg, mapping, c("_id"), ("_old",))
    spec = merge_spec(("submission_id", "id"), rows, WV_SURVEY_QUESTION_RESPONSES, mapping, rules | keep, ORDER)
    return run.load(WV_SURVEY_QUESTION_RESPONSES, rows, spec)
