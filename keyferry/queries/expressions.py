"""Scalar expressions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import functions as X
from .base import query, source

# Every event becomes one raw text; the shapes cycle so that each token class occurs.
source(
    "raw_tokens",
    """
    SELECT event_id, user_id, event_type,
      CASE event_id % 14
        WHEN 0 THEN ' ' || event_type || ' '
        WHEN 1 THEN 'NULL'
        WHEN 2 THEN '  none '
        WHEN 3 THEN ''
        WHEN 4 THEN '   '
        WHEN 5 THEN 'Yes'
        WHEN 6 THEN ' n '
        WHEN 7 THEN 'TRUE'
        WHEN 8 THEN '0'
        WHEN 9 THEN 'T'
        WHEN 10 THEN '1'
        WHEN 11 THEN 'nan'
        WHEN 12 THEN CAST(NULL AS STRING)
        ELSE props END AS raw
    FROM {events}
    """,
)
source(
    "raw_numbers",
    """
    SELECT event_id, user_id, event_type,
      CASE event_id % 12
        WHEN 0 THEN CAST(event_id AS STRING)
        WHEN 1 THEN ' ' || CAST(event_id AS STRING) || '.75 '
        WHEN 2 THEN '-' || CAST(event_id AS STRING) || '.75'
        WHEN 3 THEN ''
        WHEN 4 THEN CAST(NULL AS STRING)
        WHEN 5 THEN CAST(user_id AS STRING) || 'd'
        WHEN 6 THEN CAST(user_id AS STRING) || 'e2'
        WHEN 7 THEN event_type
        WHEN 8 THEN '.5'
        WHEN 9 THEN '+' || CAST(user_id AS STRING) || '.'
        WHEN 10 THEN '9007199254740993'
        ELSE '1,' || CAST(event_id AS STRING) END AS raw
    FROM {events}
    """,
)
source(
    "people",
    """
    SELECT c_custkey, c_mktsegment, c_acctbal,
      CASE c_custkey % 9
        WHEN 0 THEN c_name
        WHEN 1 THEN ' ' || c_mktsegment || ' ' || c_name
        WHEN 2 THEN c_mktsegment || '  van  der ' || c_name || ' '
        WHEN 3 THEN ''
        WHEN 4 THEN CAST(NULL AS STRING)
        WHEN 5 THEN '   '
        WHEN 6 THEN lower(c_mktsegment) || ' ' || c_name || ' ' || c_mktsegment
        WHEN 7 THEN 'Null'
        ELSE c_name || ' O''' || lower(c_mktsegment) END AS full_name,
      CASE c_custkey % 7
        WHEN 0 THEN ' ' || c_name || '@Example.org '
        WHEN 1 THEN ''
        WHEN 2 THEN 'none'
        WHEN 3 THEN CAST(NULL AS STRING)
        WHEN 4 THEN c_mktsegment || '.' || c_name || '@example.net'
        WHEN 5 THEN c_name
        ELSE '@example.org' END AS email,
      CASE c_custkey % 6
        WHEN 0 THEN 'Inactive' WHEN 1 THEN ' disabled ' WHEN 2 THEN 'FALSE'
        WHEN 3 THEN CAST(NULL AS STRING) WHEN 4 THEN '0' ELSE c_mktsegment END AS status,
      CASE c_custkey % 5
        WHEN 0 THEN ' male' WHEN 1 THEN 'F' WHEN 2 THEN CAST(NULL AS STRING)
        WHEN 3 THEN 'x' ELSE c_mktsegment END AS gender
    FROM {customer}
    """,
)
# Blank characters the oracle has to trim: the sources only hold these.
CLEAN = "CASE WHEN trim({0}) <> '' AND lower(trim({0})) NOT IN ('nan','null','none','nil') THEN trim({0}) END"
NUM = r"regexp_full_match(trim({0}), '[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?')"
BOOL3 = "CASE WHEN lower(trim({0})) IN ('true','1','yes','y') THEN true WHEN lower(trim({0})) IN ('false','0','no','n') THEN false END"


@query("clean_null_tokens", f"SELECT event_id, {CLEAN.format('raw')} AS cleaned FROM {{raw_tokens}}")
def _(d):
    return d("raw_tokens").select("event_id", X.clean_str(F.col("raw")).alias("cleaned"))


@query(
    "clean_whole_texts",
    r"""SELECT conv_id, turn, trim(text, E' \t\n\r\x0b\x0c') AS cleaned, trim(text, E' \t\n\r\x0b\x0c') <> '' AS filled
        FROM conversations""",
)
def _(d):
    t = F.col("text")
    return d("conversations").select("conv_id", "turn", X.strip(t).alias("cleaned"), X.has_value(t).alias("filled"))


@query("has_value_flags", "SELECT event_id, raw IS NOT NULL AND trim(raw) <> '' AS filled FROM {raw_tokens}")
def _(d):
    return d("raw_tokens").select("event_id", X.has_value(F.col("raw")).alias("filled"))


@query(
    "lenient_int",
    f"""SELECT event_id, CASE WHEN {NUM.format('raw')} THEN
          coalesce(CASE WHEN regexp_full_match(trim(raw), '[+-]?[0-9]+') THEN try_cast(trim(raw) AS BIGINT) END,
                   try_cast(trunc(try_cast(trim(raw) AS DOUBLE)) AS BIGINT)) END AS n
        FROM {{raw_numbers}}""",
)
def _(d):
    return d("raw_numbers").select("event_id", X.to_int(F.col("raw")).alias("n"))


@query(
    "lenient_float",
    f"SELECT event_id, CASE WHEN {NUM.format('raw')} THEN try_cast(trim(raw) AS DOUBLE) END AS x FROM {{raw_numbers}}",
)
def _(d):
    return d("raw_numbers").select("event_id", X.to_double(F.col("raw")).alias("x"))


@query(
    "bool_tristate",
    f"SELECT event_id, {BOOL3.format('raw')} AS b, coalesce({BOOL3.format('raw')}, true) AS b_or_true FROM {{raw_tokens}}",
)
def _(d):
    r = F.col("raw")
    return d("raw_tokens").select("event_id", X.to_bool3(r).alias("b"), X.to_bool3(r, True).alias("b_or_true"))


@query(
    "bool_twostate",
    f"""SELECT event_id, coalesce(lower(trim(raw)) IN ('true','1','t','yes','y'), false) AS b,
          CASE WHEN ({CLEAN.format('raw')}) IS NOT NULL
               THEN lower(trim(raw)) IN ('true','1','t','yes','y') END AS b_or_null
        FROM {{raw_tokens}}""",
)
def _(d):
    r = F.col("raw")
    return d("raw_tokens").select("event_id", X.to_bool2(r).alias("b"), X.to_bool2(r, True).alias("b_or_null"))


@query(
    "flag_truthiness",
    """SELECT o_orderkey, coalesce(o_orderstatus = 'F', false) AS is_f,
         coalesce(CASE WHEN o_totalprice > 200000 THEN true WHEN o_totalprice > 100000 THEN false END, false) AS flag
       FROM orders""",
)
def _(d):
    raw = F.when(F.col("o_totalprice") > 200000, True).when(F.col("o_totalprice") > 100000, False)
    return d("orders").select(
        "o_orderkey", X.equals_flag(F.col("o_orderstatus"), "F").alias("is_f"), X.truthy(raw).alias("flag")
    )


source(
    "raw_times",
    """
    SELECT o_orderkey,
      CASE o_orderkey % 8
        WHEN 0 THEN CAST(CAST(o_orderdate AS DATE) AS STRING)
        WHEN 1 THEN CAST(CAST(o_orderdate AS DATE) AS STRING) || ' 15:08:22.577582+02'
        WHEN 2 THEN CAST(CAST(o_orderdate AS DATE) AS STRING) || 'T10:00:00Z'
        WHEN 3 THEN 'null'
        WHEN 4 THEN o_orderpriority
        WHEN 5 THEN ''
        WHEN 6 THEN CAST(CAST(o_orderdate AS DATE) AS STRING) || ' 23:30:00-05'
        ELSE ' ' || CAST(CAST(o_orderdate AS DATE) AS STRING) || ' 01:02:03 ' END AS raw
    FROM {orders}
    """,
)


@query(
    "parse_timestamps",
    r"""SELECT o_orderkey, CASE WHEN regexp_matches(trim(raw), ':.*[+-]\d\d$')
          THEN try_cast(left(trim(raw), len(trim(raw)) - 3) AS TIMESTAMP) - to_hours(CAST(right(trim(raw), 3) AS INT))
          ELSE try_cast(replace(trim(raw), 'Z', '') AS TIMESTAMP) END AS ts_utc FROM {raw_times}""",
)
def _(d):
    return d("raw_times").select("o_orderkey", X.to_ts_ntz(F.col("raw")).alias("ts_utc"))


@query(
    "parse_dates",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 8 IN (0, 1, 2, 6, 7) THEN CAST(left(trim(raw), 10) AS DATE) END AS day
       FROM {raw_times}""",
)
def _(d):
    return d("raw_times").select("o_orderkey", X.to_date_safe(F.col("raw")).alias("day"))


@query(
    "first_truthy",
    """SELECT c_custkey, coalesce(nullif(email, ''), nullif(full_name, ''), 'Unknown') AS label,
         coalesce(nullif(c_custkey % 3, 0), nullif(c_custkey % 2, 0), 99)::BIGINT AS n
       FROM {people}""",
)
def _(d):
    k = F.col("c_custkey")
    return d("people").select(
        "c_custkey",
        X.first_truthy(F.col("email"), F.col("full_name"), F.lit("Unknown")).alias("label"),
        X.first_truthy(k % 3, k % 2, F.lit(99).cast("bigint"), numeric=True).alias("n"),
    )


@query(
    "name_split",
    r"""WITH t AS (SELECT c_custkey, trim(coalesce(full_name, '')) AS s,
            regexp_split_to_array(trim(coalesce(full_name, '')), '\s+') AS p FROM {people})
        SELECT c_custkey, CASE WHEN s = '' THEN 'Unknown' ELSE p[1] END AS first_name,
          CASE WHEN s <> '' AND len(p) > 2 THEN array_to_string(p[2:len(p)-1], ' ') END AS middle_name,
          CASE WHEN s = '' THEN 'User' ELSE p[len(p)] END AS last_name FROM t""",
)
def _(d):
    return d("people").withColumn("n", X.split_name(F.col("full_name"))).select("c_custkey", "n.*")


@query(
    "name_split_known_last",
    r"""WITH t AS (SELECT c_custkey, c_mktsegment AS last, regexp_split_to_array(trim(full_name), '\s+') AS p,
            trim(full_name) AS s FROM {people}),
        u AS (SELECT *, CASE WHEN list_contains(p, last) AND len(p) >= 2
                 THEN len(p) - list_position(list_reverse(p), last) END AS head FROM t)
        SELECT c_custkey,
          CASE WHEN coalesce(s, '') = '' THEN NULL
               WHEN head IS NOT NULL THEN nullif(array_to_string(p[1:head], ' '), '') ELSE p[1] END AS first_name,
          CASE WHEN coalesce(s, '') = '' THEN last
               WHEN head IS NOT NULL THEN array_to_string(p[head+1:len(p)], ' ')
               WHEN len(p) >= 2 THEN array_to_string(p[2:len(p)], ' ') ELSE last END AS last_name
        FROM u""",
)
def _(d):
    n = X.split_name_last(F.col("full_name"), F.col("c_mktsegment"))
    return d("people").withColumn("n", n).select("c_custkey", "n.*")


@query(
    "username_from_email",
    rf"""WITH t AS (SELECT c_custkey, {CLEAN.format('email')} AS e, {CLEAN.format('full_name')} AS n FROM {{people}})
        SELECT c_custkey, lower(e) AS email,
          CASE WHEN e IS NOT NULL THEN lower(trim(split_part(e, '@', 1)))
               ELSE regexp_replace(lower(n), '\s+', '.', 'g') END AS username FROM t""",
)
def _(d):
    e, n = F.col("email"), F.col("full_name")
    return d("people").select("c_custkey", X.norm_email(e).alias("email"), X.username(e, n).alias("username"))


@query(
    "fabricated_login",
    """WITH t AS (SELECT c_custkey, lower(trim(email)) AS e, 'user-' || left(sha1(c_custkey::VARCHAR), 6) AS made FROM {people}),
       u AS (SELECT *, coalesce(contains(e, '@') AND split_part(e, '@', 1) <> '', false) AS ok FROM t)
       SELECT c_custkey, CASE WHEN ok THEN split_part(e, '@', 1) ELSE made END AS username,
         CASE WHEN ok THEN e ELSE made || '@users.invalid' END AS email, ok AS from_source FROM u""",
)
def _(d):
    login = X.fabricated_login(F.col("email"), F.col("c_custkey").cast("string"), "users.invalid")
    return d("people").withColumn("x", login).select("c_custkey", "x.*")


@query(
    "status_normalize",
    "SELECT c_custkey, CASE WHEN lower(trim(status)) IN ('inactive','disabled','false','0') THEN 'Inactive' ELSE 'Active' END AS status FROM {people}",
)
def _(d):
    return d("people").select("c_custkey", X.status_label(F.col("status")).alias("status"))


@query(
    "gender_letter",
    """SELECT c_custkey, CASE left(lower(trim(gender)), 1) WHEN 'm' THEN 'Male' WHEN 'f' THEN 'Female' END AS gender,
         CASE left(lower(trim(gender)), 1) WHEN 'f' THEN 'Female' ELSE 'Male' END AS gender_or_default FROM {people}""",
)
def _(d):
    g = F.col("gender")
    return d("people").select("c_custkey", X.gender(g).alias("gender"), X.gender(g, "Male").alias("gender_or_default"))


source(
    "raw_attendance",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
      CASE l_returnflag || l_linestatus WHEN 'AF' THEN ' Attended' WHEN 'AO' THEN 'NO' WHEN 'NF' THEN ''
        WHEN 'NO' THEN 'excused' WHEN 'RF' THEN CAST(NULL AS STRING) ELSE 'present' END AS status,
      CASE WHEN l_quantity < 10 THEN CAST(NULL AS DOUBLE) WHEN l_quantity < 25 THEN 0.0 ELSE l_quantity END AS attended
    FROM {lineitem}
    """,
)


@query(
    "attendance_status",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
         CASE WHEN lower(trim(status)) IN ('present','attended','yes','true') THEN 'Present'
              WHEN lower(trim(status)) IN ('absent','no','false') THEN 'Absent'
              WHEN attended > 0 THEN 'Present' ELSE 'Absent' END AS status
       FROM {raw_attendance}""",
)
def _(d):
    return d("raw_attendance").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        X.attendance(F.col("status"), F.col("attended")).alias("status"),
    )


@query(
    "kind_by_substring",
    "SELECT p_partkey, CASE WHEN contains(lower(p_type), 'econ') THEN 'Demo Plot' ELSE 'Training' END AS kind FROM part",
)
def _(d):
    return d("part").select("p_partkey", X.kind_by_substring(F.col("p_type"), "econ", "Demo Plot", "Training").alias("kind"))


@query(
    "hash_key",
    "SELECT p_partkey, 'LEGACY-' || left(sha1(p_name || '#' || p_partkey), 20) AS case_id FROM part",
)
def _(d):
    raw = F.concat("p_name", F.lit("#"), F.col("p_partkey").cast("string"))
    return d("part").select("p_partkey", X.hash_key("LEGACY-", raw, 20).alias("case_id"))


@query(
    "prefixed_key",
    f"""SELECT event_id, coalesce('u-sf-' || ({CLEAN.format('raw')}),
          'u-' || CASE WHEN event_type <> 'error' THEN event_type END,
          'u-' || sha1(CASE WHEN event_type = 'error' THEN 'null' ELSE event_type END)) AS k
        FROM {{raw_tokens}}""",
)
def _(d):
    raw = F.when(F.col("event_type") == "error", F.lit("null")).otherwise(F.col("event_type"))
    return d("raw_tokens").select("event_id", X.prefixed_key("u", raw, F.col("raw")).alias("k"))


@query(
    "stable_id",
    """WITH t AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
            md5(l_orderkey || chr(1) || l_partkey || chr(1) || l_suppkey) AS h FROM lineitem)
       SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4)
         || '-' || substr(h, 17, 4) || '-' || substr(h, 21, 12) AS id FROM t""",
)
def _(d):
    k = ["l_orderkey", "l_partkey", "l_suppkey"]
    return d("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                X.stable_id(*[F.col(c) for c in k]).alias("id"))


@query(
    "composite_key",
    """SELECT c_custkey, c_custkey || ':' || email AS k FROM {people}""",
)
def _(d):
    return d("people").select("c_custkey", X.composite_key(":", F.col("c_custkey"), F.col("email")).alias("k"))


@query(
    "key_slice",
    "SELECT page_id, left(url, 36) AS head, right(url, 2) AS tail2, right(url, 1) AS tail1 FROM pages",
)
def _(d):
    u = F.col("url")
    return d("pages").select(
        "page_id", X.key_slice(u, head=36).alias("head"), X.key_slice(u, tail=2).alias("tail2"),
        X.key_slice(u, tail=1).alias("tail1"),
    )


@query(
    "replace_chain",
    "SELECT doc_id, replace(replace(replace(text, ' ', '_'), 'th', 'TH'), '_TH', '_Th') AS text FROM documents",
)
def _(d):
    pairs = [(" ", "_"), ("th", "TH"), ("_TH", "_Th")]
    return d("documents").select("doc_id", X.replace_chain(F.col("text"), pairs).alias("text"))


@query("strip_suffix", "SELECT p_partkey, trim(replace(p_name || '__c', '__c', '')) AS k FROM part")
def _(d):
    return d("part").select("p_partkey", X.strip_suffix(F.concat("p_name", F.lit("__c")), "__c").alias("k"))


@query(
    "title_key",
    """WITH t AS (SELECT p_partkey, lower(p_type) || ' ' || p_name || ' o''' || p_name || ' ' || p_size || 'mm' AS s FROM part)
       SELECT p_partkey, replace(array_to_string(list_transform(range(1, len(s) + 1),
           lambda i: CASE WHEN i > 1 AND regexp_full_match(s[i - 1], '[A-Za-z]') THEN lower(s[i]) ELSE upper(s[i]) END), ''),
           ' ', '_') AS k FROM t""",
)
def _(d):
    s = F.concat(F.lower("p_type"), F.lit(" "), "p_name", F.lit(" o'"), "p_name", F.lit(" "),
                 F.col("p_size").cast("string"), F.lit("mm"))
    return d("part").select("p_partkey", X.title_key(s).alias("k"))


source(
    "raw_comments",
    """
    SELECT conv_id, turn, text AS c1,
      CASE role WHEN 'user' THEN '  ' WHEN 'assistant' THEN ' ' || role || ' ' ELSE CAST(NULL AS STRING) END AS c2,
      CASE WHEN turn % 2 = 0 THEN '' ELSE role END AS c3
    FROM {conversations}
    """,
)


@query(
    "join_comments",
    r"""SELECT conv_id, turn, CASE WHEN coalesce(c1, '') <> '' OR coalesce(c2, '') <> '' OR coalesce(c3, '') <> '' THEN
          array_to_string(list_filter([CASE WHEN c1 <> '' THEN trim(c1, E' \t\n\r') END, CASE WHEN c2 <> '' THEN trim(c2, E' \t\n\r') END,
                                       CASE WHEN c3 <> '' THEN trim(c3, E' \t\n\r') END], lambda x: x IS NOT NULL), chr(10)) END AS comments
        FROM {raw_comments}""",
)
def _(d):
    return d("raw_comments").select(
        "conv_id", "turn", X.join_nonempty("\n", F.col("c1"), F.col("c2"), F.col("c3")).alias("comments")
    )


source(
    "raw_answers",
    """
    SELECT event_id, user_id, ts,
      CASE event_id % 8
        WHEN 0 THEN 'Yes' WHEN 1 THEN '1' WHEN 2 THEN CAST(user_id AS STRING) || '.5'
        WHEN 3 THEN ' HTTPS://files.example/' || event_type || ' ' WHEN 4 THEN event_type || ' ' || props
        WHEN 5 THEN CAST(event_id AS STRING) WHEN 6 THEN ' no ' ELSE 'http:/' || event_type END AS raw
    FROM {events}
    """,
)


@query(
    "typed_answer",
    f"""WITH t AS (SELECT event_id, trim(raw) AS s, {BOOL3.format('raw')} AS b, {NUM.format('raw')} AS is_num FROM {{raw_answers}}),
        u AS (SELECT *, CASE WHEN b IS NULL AND is_num THEN CAST(s AS DOUBLE) END AS n,
                lower(s) LIKE 'http://%' OR lower(s) LIKE 'https://%' AS is_url FROM t)
        SELECT event_id, CASE WHEN b IS NULL AND n IS NULL AND NOT is_url THEN s END AS answer_text, n AS answer_numeric,
          b AS answer_boolean, CASE WHEN b IS NULL AND n IS NULL AND is_url THEN s END AS answer_url FROM u""",
)
def _(d):
    v = d("raw_answers").withColumn("v", X.typed_value(F.col("raw")))
    return v.select("event_id", *[F.col(f"v.{k}").alias(f"answer_{k}") for k in ("text", "numeric", "boolean", "url")])


source(
    "raw_households",
    """
    SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN CAST(o_custkey AS STRING) WHEN 'O' THEN 'HH' || CAST(o_custkey AS STRING)
        ELSE CAST(NULL AS STRING) END AS hh_name,
      CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN CAST(NULL AS BIGINT) ELSE o_orderkey END AS hh_number
    FROM {orders}
    """,
)


@query(
    "household_number",
    """SELECT o_orderkey, coalesce(regexp_full_match(hh_name, '[0-9]+'), false) AS digits,
         CASE WHEN coalesce(hh_number, 0) = 0 THEN CASE WHEN regexp_full_match(hh_name, '[0-9]+') THEN hh_name::BIGINT END
              ELSE hh_number END AS n
       FROM {raw_households}""",
)
def _(d):
    name, n = F.col("hh_name"), F.col("hh_number")
    return d("raw_households").select(
        "o_orderkey", F.coalesce(X.is_digits(name), F.lit(False)).alias("digits"), X.household_number(n, name).alias("n")
    )


@query(
    "external_id_shape",
    """SELECT c_custkey, regexp_full_match(trim(replace(c_name, '#', '')), '[A-Za-z0-9]{15}|[A-Za-z0-9]{18}') AS short_ok,
         regexp_full_match(trim(c_name), '[A-Za-z0-9]{15}|[A-Za-z0-9]{18}') AS name_ok,
         regexp_full_match(left(md5(c_name), 15), '[A-Za-z0-9]{15}|[A-Za-z0-9]{18}') AS hash_ok FROM customer""",
)
def _(d):
    return d("customer").select(
        "c_custkey",
        X.is_external_id(F.replace("c_name", F.lit("#"), F.lit(""))).alias("short_ok"),
        X.is_external_id(F.col("c_name")).alias("name_ok"),
        X.is_external_id(F.md5("c_name").substr(1, 15)).alias("hash_ok"),
    )


@query(
    "null_safe_sum",
    """SELECT event_id, (coalesce(CASE WHEN event_type <> 'click' THEN user_id END, 0)
         + coalesce(CASE WHEN event_type <> 'view' THEN event_id END, 0))::BIGINT AS total FROM events""",
)
def _(d):
    t = F.col("event_type")
    return d("events").select(
        "event_id",
        X.null_safe_sum(F.when(t != "click", F.col("user_id")), F.when(t != "view", F.col("event_id"))).alias("total"),
    )


# Points as extended WKB text: 8-byte coordinates taken from the md5 of the key.
source(
    "raw_points",
    """
    SELECT c_custkey,
      CASE c_custkey % 5
        WHEN 0 THEN '0101000020E6100000' || md5(c_name)
        WHEN 1 THEN '0020000001000010e6' || md5(c_name)
        WHEN 2 THEN '0101000000' || md5(c_name)
        WHEN 3 THEN 'NULL'
        ELSE '0101000020E6100000' || c_mktsegment END AS gps
    FROM {customer}
    """,
)


@query(
    "ewkb_points",
    """SELECT c_custkey, CASE WHEN c_custkey % 5 IN (0, 1) THEN 4326 END AS srid,
         CASE c_custkey % 5 WHEN 0 THEN '0101000000' || upper(md5(c_name)) WHEN 1 THEN '0000000001' || upper(md5(c_name))
           WHEN 2 THEN '0101000000' || upper(md5(c_name)) END AS wkb_hex
       FROM customer""",
)
def _(d):
    g = d("raw_points").withColumn("g", X.ewkb_to_wkb(F.col("gps")))
    return g.select("c_custkey", F.col("g.srid").alias("srid"), F.hex("g.wkb").alias("wkb_hex"))


@query(
    "least_greatest",
    """SELECT o_orderkey, least(CASE WHEN o_orderstatus <> 'F' THEN o_totalprice END, o_custkey * 200.0) AS lo,
         greatest(CASE WHEN o_orderstatus <> 'F' THEN o_totalprice END, o_custkey * 200.0) AS hi FROM orders""",
)
def _(d):
    a = F.when(F.col("o_orderstatus") != "F", F.col("o_totalprice"))
    b = F.col("o_custkey") * 200.0
    return d("orders").select("o_orderkey", F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi"))
