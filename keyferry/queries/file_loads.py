"""The two CSV loads, fed by files derived from whole driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import STEPS, TABLES, FrameRun, LoadConfig
from .base import query, source
from .loads import _shaped, out

# --- legacy accounts and project roles --------------------------------------------------------
source(
    "f_users",
    """
    SELECT 'acc' || lpad(CAST(c_custkey AS STRING), 9, '0') AS user_id, c_name || '  ' || c_mktsegment AS user_name,
      CASE WHEN c_nationkey < 12 THEN ' M' || CAST(CAST(floor(c_custkey / 3) AS BIGINT) AS STRING) || '@Mail.test' WHEN c_nationkey < 18 THEN 'NULL'
        ELSE 'solo' || CAST(c_custkey AS STRING) || '@mail.test' END AS user_email, 'NULL' AS mobile_no, 'r' || CAST(c_nationkey AS STRING) AS role_id,
      CASE WHEN c_acctbal < 0 THEN 'Disabled' ELSE 'active' END AS account_status, '2023-11-28 10:00:00+00' AS createdAt,
      '2023-11-28 12:00:00+02' AS updatedAt, CASE WHEN c_nationkey >= 18 THEN 'SF' || CAST(c_custkey AS STRING) ELSE 'null' END AS sf_user_id
    FROM {customer}
    """,
)
source(
    "f_roles",
    """
    SELECT 'r' || CAST(n_nationkey AS STRING) AS role_id, CASE n_nationkey % 6 WHEN 0 THEN 'ci_leadership' WHEN 1 THEN 'Project_Manager' WHEN 2 THEN 'gardener'
        WHEN 3 THEN 'standard' WHEN 4 THEN 'farmer_trainer' ELSE 'super_admin' END AS role_name FROM {nation} WHERE n_nationkey <> 22
    """,
)
source(
    "f_old_projects",
    "SELECT 'old' || CAST(s_suppkey AS STRING) AS project_id, CASE WHEN s_nationkey > 1 THEN 'J' || CAST(s_suppkey + 2 AS STRING) ELSE 'null' END AS sf_project_id FROM {supplier}",
)
source(
    "f_project_roles",
    """
    SELECT 'pr' || CAST(o_orderkey AS STRING) AS pr_id, 'acc' || lpad(CAST(o_custkey + 20 AS STRING), 9, '0') AS user_id, 'old' || CAST(o_custkey % 12 AS STRING) AS project_id,
      'r' || CAST(o_orderkey % 26 AS STRING) AS role, CAST(o_orderdate AS STRING) AS createdAt, CAST(o_orderdate AS STRING) AS updatedAt
    FROM {orders}
    """,
)
source(
    "t_accounts",
    """
    SELECT 't' || CAST(s_suppkey AS STRING) AS id, 'SF' || CAST(s_suppkey * 7 AS STRING) AS sf_id, 'm' || CAST(s_suppkey * 2 AS STRING) || '@mail.test' AS email,
      'zz' || CAST(s_suppkey AS STRING) AS username, 'stored' AS first_name, 'stored' || CAST(s_suppkey AS STRING) AS tns_id FROM {supplier}
    """,
)
source(
    "t_projects",
    "SELECT 'J' || CAST(s_suppkey AS STRING) AS sf_id, 'j' || CAST(s_suppkey AS STRING) AS id FROM {supplier}",
)
source(
    "t_staff_roles",
    "SELECT 'held' || CAST(s_suppkey AS STRING) AS id, 't' || CAST(s_suppkey AS STRING) AS staff_id, 'j' || CAST(s_suppkey + 2 AS STRING) AS project_id, 'Agronomy Advisor' AS role FROM {supplier}",
)
NEW_ROLE = """CASE lower({0}) WHEN 'ci_leadership' THEN 'CI Leadership' WHEN 'project_manager' THEN 'Project Manager' WHEN 'standard' THEN 'Agronomy Advisor'
    WHEN 'farmer_trainer' THEN 'Farmer Trainer' WHEN 'super_admin' THEN 'Super Admin' END"""
ACCOUNTS = """
    WITH p AS (SELECT *, lower(nullif(trim(user_email), 'NULL')) AS email, nullif(sf_user_id, 'null') AS sf FROM {f_users}),
    f AS (SELECT email, min(user_id) AS first_user FROM p WHERE email IS NOT NULL GROUP BY 1),
    a AS (SELECT p.*, coalesce(t1.id, t2.id, f.first_user, p.user_id) AS actual, r.role_name FROM p LEFT JOIN {t_accounts} t1 ON p.sf = t1.sf_id
          LEFT JOIN {t_accounts} t2 ON p.email = t2.email LEFT JOIN f ON p.email = f.email LEFT JOIN {f_roles} r ON p.role_id = r.role_id),
    last_a AS (SELECT *, row_number() OVER (PARTITION BY actual ORDER BY user_id DESC) AS rn FROM a)"""


def _accounts(d) -> FrameRun:
    run = FrameRun(
        d.spark,
        LoadConfig("sys"),
        {"users": d("f_users"), "roles": d("f_roles"), "old_projects": d("f_old_projects"), "project_roles": d("f_project_roles")},
        {
            "users": _shaped(d("t_accounts"), TABLES["users"].schema),
            "projects": _shaped(d("t_projects"), TABLES["projects"].schema),
            "project_staff_roles": _shaped(d("t_staff_roles"), TABLES["project_staff_roles"].schema),
        },
    )
    STEPS["old_users_accounts"].load(run)
    return run


@query(
    "load_legacy_users",
    ACCOUNTS
    + f""" SELECT coalesce(t.id, actual) AS id, CASE WHEN actual IS NULL THEN t.email ELSE a.email END AS email,
         CASE WHEN actual IS NULL THEN t.username ELSE coalesce(split_part(a.email, '@', 1), lower(regexp_replace(user_name, ' +', '.', 'g'))) END AS username,
         coalesce(split_part(user_name, '  ', 1), t.first_name) AS first_name, split_part(user_name, '  ', 2) AS last_name, {NEW_ROLE.format("role_name")} AS user_role,
         CASE account_status WHEN 'Disabled' THEN 'Inactive' WHEN 'active' THEN 'Active' END AS status, CASE WHEN actual IS NULL THEN t.sf_id ELSE a.sf END AS sf_id,
         CASE WHEN actual IS NULL THEN t.tns_id WHEN a.sf IS NOT NULL THEN 'legacy-user-sf-' || a.sf ELSE 'legacy-user-' || user_id END AS tns_id,
         CASE WHEN actual IS NOT NULL THEN TIMESTAMP '2023-11-28 10:00:00' END AS updated_at
       FROM {{t_accounts}} t FULL JOIN (SELECT * FROM last_a WHERE rn = 1) a ON t.id = a.actual""".replace("{{", "{").replace("}}", "}"),
)
def _(d):
    return out(_accounts(d).target("users"), "id", "email", "username", "first_name", "last_name", "user_role", "status", "sf_id", "tns_id",
               "updated_at")


ROLE_ROWS = (
    ACCOUNTS
    + f""", r AS (SELECT x.*, a.actual AS staff_id, {NEW_ROLE.format("q.role_name")} AS new_role, q.role_name, nullif(o.sf_project_id, 'null') AS project_source, j.id AS jid
            FROM {{f_project_roles}} x JOIN a ON x.user_id = a.user_id LEFT JOIN {{f_roles}} q ON x.role = q.role_id
            LEFT JOIN {{f_old_projects}} o ON x.project_id = o.project_id LEFT JOIN {{t_projects}} j ON j.sf_id = nullif(o.sf_project_id, 'null')),
       m AS (SELECT *, CASE WHEN role_name IS NOT NULL AND new_role IS NULL THEN 'unmapped_role' WHEN new_role IN ('Super Admin', 'CI Leadership') THEN 'skipped_role'
               WHEN project_source IS NULL THEN 'missing_old_project' WHEN jid IS NULL THEN 'missing_new_project' WHEN new_role IS NULL THEN 'unknown_role_code' END AS reason FROM r),
       n AS (SELECT *, row_number() OVER (PARTITION BY staff_id, jid, new_role ORDER BY updatedAt, pr_id) AS rn FROM m WHERE reason IS NULL)"""
).replace("{{", "{").replace("}}", "}")


@query(
    "load_legacy_project_roles",
    ROLE_ROWS
    + """ SELECT pr_id AS id, staff_id, jid AS project_id, new_role AS role, 'LEGACY-PR-' || sha1(pr_id) AS commcare_case_id, 'legacy-pr-' || pr_id AS tns_id,
         'Pending' AS send_to_commcare_status FROM n WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM {t_staff_roles} h WHERE h.staff_id = n.staff_id AND h.project_id = jid AND h.role = new_role)
       UNION ALL SELECT id, staff_id, project_id, role, NULL, NULL, NULL FROM {t_staff_roles}""",
)
def _(d):
    return out(_accounts(d).target("project_staff_roles"), "id", "staff_id", "project_id", "role", "commcare_case_id", "tns_id",
               "send_to_commcare_status")


@query("legacy_role_rejects", ROLE_ROWS + " SELECT pr_id, user_id, reason FROM m WHERE reason IS NOT NULL")
def _(d):
    rows = _accounts(d).reports["rejected_roles"]
    return rows.select(F.col("_pr").alias("pr_id"), F.col("_user").alias("user_id"), F.col("_reject").alias("reason"))


# --- wet mills, visits, responses, answers ----------------------------------------------------
source(
    "f_mills",
    """
    SELECT 'w' || CAST(c_custkey AS STRING) AS id, CASE WHEN c_nationkey < 8 THEN 't' || CAST(c_custkey AS STRING) ELSE 'acc' || lpad(CAST(c_custkey AS STRING), 9, '0') END AS user_id,
      'wm' || CAST(c_custkey AS STRING) AS wet_mill_unique_id, CASE WHEN c_mktsegment = 'BUILDING' THEN 'none' ELSE 'wc' || CAST(CAST(floor(c_custkey / 2) AS BIGINT) AS STRING) END AS commcare_case_id,
      ' ' || c_name AS name, CASE WHEN c_nationkey = 9 THEN 'x' ELSE CAST(c_nationkey AS STRING) || '.0' END AS wetmill_counter, '2024-01-02' AS registration_date,
      CASE WHEN c_acctbal > 0 THEN '0101000020E6100000' || md5(c_name) ELSE '' END AS office_gps, CASE WHEN c_nationkey = 2 THEN 'True' ELSE 'False' END AS is_deleted,
      '2024-01-02 00:00:00+00' AS created_at, CASE WHEN c_acctbal > 500 THEN '2024-01-03 00:00:00+00' ELSE '2024-01-04 00:00:00+00' END AS updated_at,
      '' AS mill_status, '' AS exporting_status, '' AS programme, '' AS country, '' AS manager_name, '' AS manager_role, '' AS comments, '' AS ba_signature,
      '' AS manager_signature, '' AS tor_page_picture, '' AS office_entrance_picture
    FROM {customer}
    """,
)
source(
    "f_visits",
    """
    SELECT 'v' || CAST(o_orderkey AS STRING) AS id, CASE WHEN o_orderpriority = '5-LOW' THEN 'w?' ELSE 'w' || CAST(o_custkey AS STRING) END AS wetmill_id, '' AS user_id, 'form' AS form_name,
      CAST(CAST(o_orderdate AS DATE) AS STRING) AS visit_date, '' AS entrance_photograph, '' AS geo_location, 'sub' || CAST(o_orderkey AS STRING) AS submission_id,
      CAST(o_orderdate AS STRING) AS created_at, CAST(o_orderdate AS STRING) AS updated_at
    FROM {orders}
    """,
)
source(
    "f_responses",
    """
    SELECT 's' || CAST(o_orderkey AS STRING) AS id, 'v' || CAST(o_orderkey AS STRING) AS form_visit_id, 'cpqi' AS survey_type, '' AS completed_date, o_orderpriority AS general_feedback,
      'ss' || CAST(o_orderkey AS STRING) AS submission_id, CAST(o_orderdate AS STRING) AS created_at, CAST(o_orderdate AS STRING) AS updated_at FROM {orders}
    """,
)
source(
    "f_questions",
    """
    SELECT 'q' || CAST(l_orderkey AS STRING) || '-' || CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || CAST(CAST(floor(l_extendedprice) AS BIGINT) AS STRING) AS id,
      's' || CAST(l_orderkey AS STRING) AS survey_response_id, 'sec' AS section_name, 'q' || CAST(l_linenumber AS STRING) AS question_name, 'number' AS field_type, 'None' AS value_text,
      CASE WHEN l_returnflag = 'A' THEN CAST(l_linenumber AS STRING) || '.5' END AS value_number, CASE WHEN l_returnflag = 'N' THEN 'T' WHEN l_returnflag = 'R' THEN 'no' END AS value_boolean,
      '' AS value_date, '' AS value_gps,
      'qs' || CAST(l_orderkey AS STRING) || '-' || CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || CAST(CAST(floor(l_extendedprice) AS BIGINT) AS STRING) AS submission_id,
      CAST(l_shipdate AS STRING) AS created_at, CAST(l_shipdate AS STRING) AS updated_at
    FROM {lineitem}
    """,
)
source(
    "t_mills",
    """
    SELECT 'w9' || CAST(s_suppkey AS STRING) AS id, 'wc' || CAST(s_suppkey * 3 AS STRING) AS commcare_case_id, 'stored' AS wet_mill_unique_id, 'first' AS created_by_id,
      '2020-01-01 00:00:00' AS created_at, s_nationkey AS office_gps_srid FROM {supplier}
    """,
)
MILLS = """
    WITH u AS (SELECT x.*, coalesce(t0.id, t1.id, t2.id, 'sys') AS actual_user, nullif(commcare_case_id, 'none') AS cc FROM {f_mills} x
          LEFT JOIN {t_accounts} t0 ON x.user_id = t0.id LEFT JOIN {f_users} l ON x.user_id = l.user_id
          LEFT JOIN {t_accounts} t1 ON nullif(l.sf_user_id, 'null') = t1.sf_id LEFT JOIN {t_accounts} t2 ON lower(trim(l.user_email)) = t2.email),
    h AS (SELECT 'wetmills' || chr(1) || '0:' || cc AS basis, u.*, id IN (SELECT id FROM {t_mills}) AS taken, 'wc' || 'x' AS pad FROM u),
    o AS (SELECT h.*, CASE WHEN taken AND NOT EXISTS (SELECT 1 FROM {t_mills} s WHERE s.id = h.id AND s.commcare_case_id = h.cc)
             THEN substr(md5(coalesce(basis, 'wetmills' || chr(1) || '1:' || id)), 1, 8) || '-' || substr(md5(coalesce(basis, 'wetmills' || chr(1) || '1:' || id)), 9, 4) || '-'
               || substr(md5(coalesce(basis, 'wetmills' || chr(1) || '1:' || id)), 13, 4) || '-' || substr(md5(coalesce(basis, 'wetmills' || chr(1) || '1:' || id)), 17, 4) || '-'
               || substr(md5(coalesce(basis, 'wetmills' || chr(1) || '1:' || id)), 21, 12) ELSE id END AS own FROM h),
    k AS (SELECT *, coalesce('0:' || cc, '1:' || own) AS mk FROM o),
    w AS (SELECT mk, cc, arg_max(wet_mill_unique_id, (updated_at, own_order)) AS wet_mill_unique_id, arg_max(trim(name), (updated_at, own_order)) AS name,
            arg_max(actual_user, (updated_at, own_order)) AS user_id, arg_max(is_deleted = 'True', (updated_at, own_order)) AS is_deleted,
            arg_max(coalesce(try_cast(wetmill_counter AS DOUBLE)::INT, -1), (updated_at, own_order)) AS counter, count(*) AS n
          FROM (SELECT *, 0 AS own_order FROM k) GROUP BY 1, 2)"""


def _surveys(d) -> FrameRun:
    wide = d.wide()
    run = FrameRun(
        d.spark,
        LoadConfig("sys"),
        {n: wide(f"f_{s}") for n, s in (
            ("wetmills", "mills"), ("wetmill_visits", "visits"), ("survey_responses", "responses"),
            ("survey_question_responses", "questions"), ("legacy_users", "users"),
        )},
        {"users": _shaped(d("t_accounts"), TABLES["users"].schema), "wetmills": _shaped(d("t_mills"), TABLES["wetmills"].schema)},
    )
    STEPS["wetmills"].load(run)
    return run


# Which mills the table holds after the load, and what became of each file row's visits. Rows of one
# case and one time stamp apply in no given order, so the columns compared do not depend on it.
@query(
    "load_wetmills",
    MILLS
    + """ SELECT coalesce(t.commcare_case_id, w.cc) AS commcare_case_id, CASE WHEN w.mk IS NULL THEN t.wet_mill_unique_id WHEN n = 1 THEN w.wet_mill_unique_id END AS single_unique_id,
         CASE WHEN n = 1 THEN w.user_id END AS single_user_id, CASE WHEN n = 1 THEN w.is_deleted END AS single_deleted, CASE WHEN n = 1 THEN nullif(counter, -1) END AS single_counter,
         coalesce(t.created_by_id, 'sys') AS created_by_id, least(t.created_at::TIMESTAMP, CASE WHEN w.mk IS NOT NULL THEN TIMESTAMP '2024-01-02' END) AS created_at
       FROM {t_mills} t FULL JOIN w ON '0:' || t.commcare_case_id = w.mk""",
)
def _(d):
    run = _surveys(d)
    merged = run.target("wetmills")
    file_case = F.when(F.col("commcare_case_id") != "none", F.col("commcare_case_id"))
    per_case = d("f_mills").groupBy(file_case.alias("_cc")).agg(F.count(F.lit(1)).alias("_n")).filter("_cc IS NOT NULL")
    rows = merged.join(per_case, F.col("commcare_case_id") == F.col("_cc"), "left")
    n = F.when(F.col("commcare_case_id").isNull(), 1).otherwise(F.col("_n"))
    one = n == 1
    return out(
        rows.select(
            "commcare_case_id",
            F.when(n.isNull() | one, F.col("wet_mill_unique_id")).alias("single_unique_id"),
            F.when(one, F.col("user_id")).alias("single_user_id"),
            F.when(one, F.col("is_deleted")).alias("single_deleted"),
            F.when(one, F.col("wetmill_counter")).alias("single_counter"),
            "created_by_id", "created_at",
        ),
        "commcare_case_id", "single_unique_id", "single_user_id", "single_deleted", "single_counter", "created_by_id", "created_at",
    )


@query(
    "load_survey_answers",
    """SELECT q.id, survey_response_id, question_name, field_type, CAST(NULL AS VARCHAR) AS value_text, CAST(value_number AS DOUBLE) AS value_number,
         CASE value_boolean WHEN 'T' THEN true WHEN 'no' THEN false END AS value_boolean, q.submission_id, q.created_at::TIMESTAMP AS created_at
       FROM {f_questions} q JOIN {f_responses} r ON survey_response_id = r.id JOIN {f_visits} v ON form_visit_id = v.id JOIN {f_mills} m ON wetmill_id = m.id""",
)
def _(d):
    return out(_surveys(d).target("wv_survey_question_responses"), "id", "survey_response_id", "question_name", "field_type", "value_text",
               "value_number", "value_boolean", "submission_id", "created_at")


@query(
    "load_survey_summary",
    """WITH v AS (SELECT *, wetmill_id IN (SELECT id FROM {f_mills}) AS ok FROM {f_visits}), r AS (SELECT *, form_visit_id IN (SELECT id FROM v WHERE ok) AS ok FROM {f_responses}),
         q AS (SELECT *, survey_response_id IN (SELECT id FROM r WHERE ok) AS ok FROM {f_questions})
       SELECT 'wetmills' AS table_name, count(*) AS rows_in, count(*) AS rows_loaded, 0::BIGINT AS rows_skipped FROM {f_mills}
       UNION ALL SELECT 'wetmill_visits', count(*), count(*) FILTER (WHERE ok), count(*) FILTER (WHERE NOT ok) FROM v
       UNION ALL SELECT 'wv_survey_responses', count(*), count(*) FILTER (WHERE ok), count(*) FILTER (WHERE NOT ok) FROM r
       UNION ALL SELECT 'wv_survey_question_responses', count(*), count(*) FILTER (WHERE ok), count(*) FILTER (WHERE NOT ok) FROM q""",
)
def _(d):
    return _surveys(d).summary()


# Which mill a visit leads to depends on the order of two mills of one case, so that column is not compared.
@query(
    "load_wetmill_visits",
    """SELECT v.id, v.submission_id, form_name, 'sys' AS user_id, CAST(visit_date AS DATE) AS visit_date, v.created_at::TIMESTAMP AS created_at
       FROM {f_visits} v JOIN {f_mills} m ON wetmill_id = m.id""",
)
def _(d):
    return out(_surveys(d).target("wetmill_visits"), "id", "submission_id", "form_name", "user_id", "visit_date", "created_at")


@query(
    "load_survey_responses",
    """SELECT r.id, form_visit_id, survey_type, general_feedback, r.submission_id, r.created_at::TIMESTAMP AS created_at
       FROM {f_responses} r JOIN {f_visits} v ON form_visit_id = v.id JOIN {f_mills} m ON wetmill_id = m.id""",
)
def _(d):
    return out(_surveys(d).target("wv_survey_responses"), "id", "form_visit_id", "survey_type", "general_feedback", "submission_id", "created_at")
