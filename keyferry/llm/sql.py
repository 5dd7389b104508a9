"""DuckDB counterparts of the queries that SQL can express."""

EXACT_DEDUP = r"""
WITH n AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents
), w AS (
  SELECT doc_id, norm, first_value(doc_id) OVER (PARTITION BY norm ORDER BY length(t) DESC, doc_id NULLS LAST
                                                 ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS keep_id,
         count(*) OVER (PARTITION BY norm) AS group_size
  FROM n
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM w
"""

COLLOCATIONS = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM p
), g AS MATERIALIZED (
  SELECT lang, size, array_to_string(words[i:i + size - 1], ' ') AS phrase, count(*) AS a
  FROM w, range(1, 5) AS s(size), range(1, len(words) + 1) AS t(i) WHERE i + size - 1 <= len(words) GROUP BY ALL
), n AS (SELECT lang, sum(a)::BIGINT AS n FROM g WHERE size = 1 GROUP BY lang
), often AS MATERIALIZED (SELECT * FROM g WHERE a >= 30
), c AS (SELECT * FROM often WHERE size > 1
), cut AS (SELECT lang, phrase, a, k, string_split(phrase, ' ') AS words, size FROM c, range(1, 4) AS t(k) WHERE k < size
), s AS (
  SELECT x.lang, x.phrase, x.a, k, f.a AS l, b.a AS r, (2000000::HUGEINT * x.a // (f.a + b.a))::BIGINT AS score
  FROM cut x JOIN often f ON f.lang = x.lang AND f.phrase = array_to_string(words[1:k], ' ')
             JOIN often b ON b.lang = x.lang AND b.phrase = array_to_string(words[k + 1:], ' ')
), best AS (SELECT lang, phrase, a, unnest(arg_min({'l': l, 'r': r, 'score': score}, {'score': score, 'k': k})) FROM s GROUP BY lang, phrase, a
), kept AS (
  SELECT * FROM best x WHERE NOT EXISTS (
    SELECT 1 FROM c WHERE c.lang = x.lang AND len(c.phrase) > len(x.phrase) AND contains(' ' || c.phrase || ' ', ' ' || x.phrase || ' ') AND 100 * c.a >= 80 * x.a)
)
SELECT lang, rank, phrase, a, l, r, n, score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) JOIN n USING (lang) WHERE rank <= 2000
"""


def _after_inserts(states: str) -> str:
    """States n, s, u, a after rows put in: u from n, s or a, then a from u, then u once more."""
    u = "list_min([{0}.u, CASE WHEN {0}.n IS NOT NULL THEN {{'c': {0}.n.c + 5, 'a': {0}.n.a || 'I'}} END, CASE WHEN {0}.s IS NOT NULL THEN {{'c': {0}.s.c + 5, 'a': {0}.s.a || 'I'}} END, CASE WHEN {0}.a IS NOT NULL THEN {{'c': {0}.a.c + 5, 'a': {0}.a.a || 'I'}} END])".format(states)
    a = f"list_min([{states}.a, CASE WHEN {u} IS NOT NULL THEN {{'c': {u}.c + 5, 'a': {u}.a || 'I'}} END])"
    return f"{{'n': {states}.n, 's': {states}.s, 'u': {u}, 'a': {a}}}"


_GONE = "x.f IN ('blank', 'duplicate')"
_MORE = "CASE WHEN x.f = 'truncated' THEN 5 ELSE 0 END"


def _read_row() -> str:
    """States after a row x, from states s (rows put in before it included)."""
    stay = f"NOT {_GONE}"

    def way(state: str, when: str, cost: str, edit: str) -> str:
        return f"CASE WHEN s.{state} IS NOT NULL AND {when} THEN {{'c': s.{state}.c + {cost}, 'a': s.{state}.a || '{edit}'}} END"

    keep = lambda state, initial: way(state, f"{stay} AND x.i = '{initial}'", _MORE, "K")
    rerole = lambda state: way(state, stay, f"1 + {_MORE}", "R")
    gone = lambda state: way(state, "true", "2", "D")
    u = ", ".join([gone("u"), *[f(k) for k in "nsa" for f in (lambda k: keep(k, "u"), rerole)]])
    a = ", ".join([gone("a"), keep("u", "a"), rerole("u")])
    return f"{{'n': list_min([{gone('n')}]), 's': list_min([{gone('s')}, {keep('n', 's')}]), 'u': list_min([{u}]), 'a': list_min([{a}])}}"


_STATE = "STRUCT(c BIGINT, a VARCHAR)"
_STATES = f"STRUCT(n {_STATE}, s {_STATE}, u {_STATE}, a {_STATE})"
_BYTES = "list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ascii(c)::BIGINT)"

CONVERSATION_REPAIR = rf"""
WITH h AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(flatten(list_transform({_BYTES}, lambda b: [b, -1, -1, -1, -1, -1, -1, -1, -1])),
                         lambda v, e: CASE WHEN e >= 0 THEN xor(v, e) WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, 4294967295), 4294967295) % 20 AS h
  FROM conversations
), d AS (
  SELECT conv_id, turn, CASE h WHEN 4 THEN 'user' ELSE role END AS role,
         CASE h WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(CASE h WHEN 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM h WHERE h <> 0
), o AS (
  SELECT *, row_number() OVER w AS pos, left(role, 1) AS i, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS t,
         lag(left(role, 1)) OVER w AS before, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen
  FROM d WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)
), f AS (
  SELECT *, CASE WHEN t = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate' WHEN right(t, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS f FROM o
), c AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (f = 'blank') AS blank, count(*) FILTER (f = 'duplicate') AS duplicate,
         count(*) FILTER (f = 'truncated') AS truncated, count(*) FILTER (before IS NOT NULL AND before || i NOT IN ('su', 'ua', 'au')) AS illegal,
         list({{'i': i, 'f': f}} ORDER BY pos) AS items
  FROM f GROUP BY conv_id
), RECURSIVE_STEPS AS (
  SELECT conv_id, 0 AS k, {{'n': {{'c': 0, 'a': ''}}, 's': NULL, 'u': NULL, 'a': NULL}}::{_STATES} AS s, items FROM c
  UNION ALL
  SELECT conv_id, k + 1, {_read_row()}, items FROM (SELECT conv_id, k, {_after_inserts('s')} AS s, items, items[k + 1] AS x FROM RECURSIVE_STEPS WHERE k < len(items))
), e AS (
  SELECT conv_id, list_min([s.n, s.a]) AS best FROM (SELECT conv_id, {_after_inserts('s')} AS s FROM RECURSIVE_STEPS WHERE k = len(items))
), l AS (
  SELECT conv_id, unnest(string_split(best.a, '')) AS edit, generate_subscripts(string_split(best.a, ''), 1) AS p FROM e WHERE best.a <> ''
), n AS (
  SELECT *, count(*) FILTER (edit <> 'I') OVER w AS pos, count(*) FILTER (edit <> 'D') OVER w AS line FROM l WINDOW w AS (PARTITION BY conv_id ORDER BY p)
), r AS (
  SELECT n.conv_id, line, edit, CASE WHEN edit = 'I' THEN '' ELSE text END AS text, role,
         max(line = 1 AND edit = 'K' AND i = 's') OVER (PARTITION BY n.conv_id) AS opened
  FROM n LEFT JOIN o ON o.conv_id IS NOT DISTINCT FROM n.conv_id AND o.pos = n.pos AND edit <> 'I' WHERE edit <> 'D'
), z AS (
  SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (line + opened::INT) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY line) AS lines
  FROM r GROUP BY conv_id
)
SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(best.c, 0)::BIGINT AS cost, coalesce(best.a, '') AS audit, sha256(coalesce(lines, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN c ON c.conv_id IS NOT DISTINCT FROM a.conv_id
     LEFT JOIN e ON e.conv_id IS NOT DISTINCT FROM a.conv_id LEFT JOIN z ON z.conv_id IS NOT DISTINCT FROM a.conv_id
""".replace("WITH h AS", "WITH RECURSIVE h AS").replace("RECURSIVE_STEPS", "steps")


def mixing(powers: dict[str, float], rounds: int, budget: float) -> str:
    """Raking unrolled into one table expression for each round and dimension; the factor by sorted sums."""
    of = lambda chars: "(" + " + ".join(f"length(t) - length(replace(t, '{c}', ''))" for c in chars) + ")"
    parts = [
        f"""d AS (
  SELECT doc_id, coalesce(source, '(none)') AS source, coalesce(lang, '(none)') AS lang,
         CASE WHEN {of("|")} * 100 >= n THEN 'table' WHEN {of("$%&#*!")} * 100 >= n * 3 THEN 'marked'
              WHEN {of("0123456789")} * 100 >= n THEN 'figures' ELSE 'prose' END AS topic,
         len(regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+'))::BIGINT AS n_tokens
  FROM (SELECT *, coalesce(text, '') AS t, greatest(length(coalesce(text, '')), 1) AS n FROM documents)
)""",
        "cells AS (SELECT source, lang, topic, sum(n_tokens)::DOUBLE AS tokens FROM d GROUP BY ALL)",
        "total AS (SELECT sum(tokens) AS total FROM cells)",
        "w0 AS (SELECT *, tokens AS weight FROM cells)",
    ]
    for dim, power in powers.items():
        parts.append(f"t_{dim} AS (SELECT {dim}, pow(sum(tokens), {power}) / sum(pow(sum(tokens), {power})) OVER () AS share FROM cells GROUP BY {dim})")
    step = 0
    for _ in range(rounds):
        for dim in powers:
            parts.append(
                f"""w{step + 1} AS MATERIALIZED (
  SELECT w.source, w.lang, w.topic, w.tokens,
         CASE WHEN s.now > 0 THEN w.weight * (t.share * total / s.now) ELSE 0 END AS weight
  FROM w{step} w JOIN (SELECT {dim}, sum(weight) AS now FROM w{step} GROUP BY {dim}) s USING ({dim}) JOIN t_{dim} t USING ({dim}), total)"""
            )
            step += 1
    parts.append(
        f"""r AS (
  SELECT *, coalesce(sum(tokens) OVER up, 0) AS full_tokens, sum(weight) OVER down AS open_weight
  FROM w{step} WHERE weight > 0
  WINDOW up AS (ORDER BY weight / tokens DESC, source, lang, topic ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         down AS (ORDER BY weight / tokens DESC, source, lang, topic ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
)"""
    )
    factor = f"({budget} * total - full_tokens) / open_weight"
    parts.append(f"f AS (SELECT arg_max({factor}, weight / tokens) FILTER (weight * {factor} < tokens) AS factor FROM r, total)")
    return (
        "WITH " + ",\n".join(parts) + f"""
SELECT doc_id, source, lang, topic, n_tokens,
       round(CASE WHEN n_tokens = 0 THEN 1 WHEN factor IS NULL THEN CAST(weight > 0 AS DOUBLE) ELSE least(1, factor * weight / tokens) END, 6)::DOUBLE AS probability,
       n_tokens = 0 OR ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '(none)') || ':mix'), 1, 13))::BIGINT / {16**13}::DOUBLE
         < CASE WHEN factor IS NULL THEN CAST(weight > 0 AS DOUBLE) ELSE least(1, factor * weight / tokens) END AS kept
FROM d JOIN w{step} USING (source, lang, topic), f"""
    )
