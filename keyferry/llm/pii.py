"""Personal data in whole texts, and the words around it that give it away; DataFrame functions only.

Base spans are e-mail addresses, IPv4 addresses, card numbers (Luhn) and phone numbers. The values
found are the protected entities. The method then asks, for each word within ``near`` words of a
mention, how much it tells about the entity over the whole corpus: with p(e), p(t) and p(e, t) the
shares of documents that hold the entity, the word, and the word next to the entity,

    disclosure(e; t) = PMI(e; t) / IC(e) = ln(p(e, t) / (p(e) p(t))) / -ln p(e),

which is 1 where the word never occurs without the entity. Words seen with the entity in at least
``support`` documents are generalised to their shape from ``generalise`` on and removed from
``remove`` on; their spans, next to that entity, are added to the base ones as kind ``term``.

Patterns are written so that a search is linear in the text: possessive where nothing follows that
could need a character back, and started only where a run starts or the last match ended.

Defined cases: a null text counts as empty and has no spans; texts of any length are read whole; equal
texts get equal spans; repeated rows and null ids come out as they came in; each row counts as a
document; further columns are ignored; an empty table gives an empty result. A mention's value is
compared without case, card and phone numbers by their digits. A single entity that all documents hold
has no information to give away and adds no spans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import whole

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# what a text must hold for a match, told faster than by the pattern
NEEDED = {"email": "@", "ip": ".", "phone": "+"}
WORD = r"[\p{L}\p{N}]++"
BETWEEN_WORDS = r"[^\p{L}\p{N}]++"
SPANS = "array<struct<kind:string,start:int,end:int,value:string>>"
CONTEXTS = "array<struct<entity:string,term:string,start:int,end:int>>"


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Every second digit from the right counts double, its digits added; the sum ends in 0."""
    doubled = F.transform(
        F.split(F.reverse(digits), "(?<=[0-9])(?=[0-9])"),
        lambda d, k: F.when(k % 2 == 0, d.cast("int")).otherwise(F.get(F.array(*map(F.lit, (0, 2, 4, 6, 8, 1, 3, 5, 7, 9))), d.cast("int"))),
    )
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        parts = F.transform(F.split(match, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
        return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.coalesce(p.try_cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        # a long run of digits is no number to cast or to split
        return F.when(F.length(_digits(match)).between(16, 19), _luhn(_digits(match))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(match)).between(8, 15)
    return F.lit(True)


def _value(kind: str, match: Column) -> Column:
    return F.concat(F.lit(f"{kind}:"), F.lower(match) if kind == "email" else match if kind == "ip" else _digits(match))


def _matches(kind: str, text: Column) -> Column:
    """All matches of a pattern, valid or not."""
    found = F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0))
    if kind in NEEDED:
        found = F.when(F.contains(text, F.lit(NEEDED[kind])), found).otherwise(F.array().cast("array<string>"))
    return found


def _lengths(parts: Column) -> Column:
    return F.transform(parts, lambda p: F.length(p))


def _starts(pieces: Column, found: Column) -> Column:
    """Where each match starts: after all pieces and matches before it."""
    steps = F.zip_with(F.slice(_lengths(pieces), F.lit(1), F.size(found)), _lengths(found), lambda p, m: F.struct(p.alias("p"), m.alias("m")))
    empty = F.struct(F.lit(0).alias("end"), F.array().cast("array<int>").alias("starts"))
    return F.aggregate(
        steps,
        empty,
        lambda a, s: F.struct((a["end"] + s["p"] + s["m"]).alias("end"), F.concat(a["starts"], F.array(a["end"] + s["p"])).alias("starts")),
        lambda a: a["starts"],
    )


def _words_after(piece: Column, at: Column, near: int) -> Column:
    """(term, start, end) of the first words of a piece that starts at ``at``."""
    words = F.slice(F.regexp_extract_all(piece, F.lit(WORD), F.lit(0)), 1, near)
    gaps = F.slice(F.split(piece, WORD, -1), 1, near)
    return _placed(words, gaps, lambda end, gap, word: end + gap, at)


def _words_before(piece: Column, end: Column, near: int) -> Column:
    """(term, start, end) of the last words of a piece that ends at ``end``, backwards."""
    words = F.slice(F.reverse(F.regexp_extract_all(piece, F.lit(WORD), F.lit(0))), 1, near)
    gaps = F.slice(F.reverse(F.split(piece, WORD, -1)), 1, near)
    return _placed(words, gaps, lambda at, gap, word: at - gap - word, end, back=True)


def _placed(words: Column, gaps: Column, start, at: Column, back: bool = False) -> Column:
    steps = F.zip_with(words, F.slice(gaps, F.lit(1), F.size(words)), lambda w, g: F.struct(w.alias("w"), F.length(g).alias("g")))
    kind = "array<struct<term:string,start:int,end:int>>"
    state = F.struct(at.alias("at"), F.array().cast(kind).alias("out"))

    def step(a: Column, s: Column) -> Column:
        first = start(a["at"], s["g"], F.length(s["w"]))
        last = first + F.length(s["w"])
        one = F.struct(F.lower(s["w"]).alias("term"), first.alias("start"), last.alias("end"))
        return F.struct((first if back else last).alias("at"), F.concat(a["out"], F.array(one)).alias("out"))

    return F.aggregate(steps, state, step, lambda a: a["out"])


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", near: int = 3) -> DataFrame:
    """id, key of the text (null without mentions), base spans, and the words near each mention."""
    text = F.col("text")
    rows = docs.select(F.col(id_col).alias("id"), whole(text_col).alias("text"))
    rows = rows.select("id", "text", *[_matches(k, text).alias(f"m_{k}") for k in KINDS])
    for k in KINDS:
        pieces = F.when(F.size(f"m_{k}") > 0, F.split(text, PATTERNS[k], -1)).otherwise(F.array().cast("array<string>"))
        rows = rows.withColumn(f"p_{k}", pieces)
    for k in KINDS:
        starts = F.when(F.size(f"m_{k}") > 0, _starts(F.col(f"p_{k}"), F.col(f"m_{k}"))).otherwise(F.array().cast("array<int>"))
        rows = rows.withColumn(f"s_{k}", starts)
    spans, contexts = [], []
    for k in KINDS:
        found, pieces, starts = F.col(f"m_{k}"), F.col(f"p_{k}"), F.col(f"s_{k}")
        valid = F.filter(_mentions(k, found, pieces, starts), lambda s: s["ok"])
        spans.append(F.transform(valid, _span(k)))
        contexts.append(F.flatten(F.transform(valid, _context(k, near))))
    some = F.size("spans") > 0
    return (
        rows.withColumn("spans", F.concat(*spans).cast(SPANS))
        .withColumn("contexts", F.when(some, F.concat(*contexts)).otherwise(F.array()).cast(CONTEXTS))
        .select("id", F.when(some, F.md5(text.cast("binary"))).alias("key"), "spans", "contexts")
    )


def _mentions(kind: str, found: Column, pieces: Column, starts: Column) -> Column:
    def one(m: Column, n: Column) -> Column:
        return F.struct(
            m.alias("m"),
            F.get(starts, n).alias("at"),
            F.get(pieces, n).alias("before"),
            F.get(pieces, n + 1).alias("after"),
            _valid(kind, m).alias("ok"),
        )

    return F.transform(found, one)


def _span(kind: str):
    return lambda s: F.struct(F.lit(kind).alias("kind"), s["at"].alias("start"), (s["at"] + F.length(s["m"])).alias("end"), _value(kind, s["m"]).alias("value"))


def _context(kind: str, near: int):
    def words(s: Column) -> Column:
        around = F.concat(_words_before(s["before"], s["at"], near), _words_after(s["after"], s["at"] + F.length(s["m"]), near))
        entity = _value(kind, s["m"])
        return F.transform(around, lambda w: F.struct(entity.alias("entity"), w["term"].alias("term"), w["start"].alias("start"), w["end"].alias("end")))

    return words


def document_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(term, df): in how many documents of the whole corpus each word occurs."""
    words = F.array_distinct(F.split(F.lower(whole(text_col)), BETWEEN_WORDS, -1))
    return docs.select(F.explode(words).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def disclosures(found: DataFrame, docs: DataFrame, text_col: str = "text", support: int = 3) -> DataFrame:
    """(entity, term, disclosure) of the words seen next to an entity in at least ``support`` documents."""
    total = docs.agg(F.count(F.lit(1)).alias("total"))
    mentions = found.where(F.col("key").isNotNull())
    entities = (
        mentions.select(F.explode(F.array_distinct(F.transform("spans", lambda s: s["value"]))).alias("entity"))
        .groupBy("entity")
        .agg(F.count(F.lit(1)).alias("n_e"))
    )
    pairs = (
        mentions.select(F.explode(F.array_distinct(F.transform("contexts", lambda c: F.struct(c["entity"].alias("entity"), c["term"].alias("term"))))).alias("x"))
        .groupBy("x.entity", "x.term")
        .agg(F.count(F.lit(1)).alias("n_et"))
        .where(F.col("n_et") >= support)
    )
    n = total.first()["total"]
    information = -F.log(F.col("n_e") / F.lit(float(max(n, 1))))
    pmi = F.log(F.col("n_et") * F.lit(float(n)) / (F.col("n_e") * F.col("df")))
    joined = pairs.join(entities, "entity").join(document_counts(docs, text_col), "term")
    return joined.where(F.col("n_e") < n).select("entity", "term", (pmi / information).alias("disclosure"))


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    near: int = 3,
    support: int = 3,
    generalise: float = 0.8,
    remove: float = 0.95,
) -> DataFrame:
    """id, spans (kind, start, end, value) and terms (start, end, action) of every whole text."""
    found = cut_lineage(find(docs, id_col, text_col, near))
    action = F.when(F.col("disclosure") >= remove, "remove").otherwise("generalise")
    telling = disclosures(found, docs, text_col, support).where(F.col("disclosure") >= generalise).select("entity", "term", action.alias("action"))
    # equal texts have equal words around equal entities: one of them is enough here
    around = found.where(F.col("key").isNotNull()).groupBy("key").agg(F.any_value("contexts").alias("contexts"))
    around = around.select("key", F.explode("contexts").alias("c")).select("key", "c.*")
    added = (
        around.join(telling, ["entity", "term"])
        .groupBy("key", "start", "end")
        .agg(F.max("action").alias("action"))
        .groupBy("key")
        .agg(F.array_sort(F.collect_list(F.struct("start", "end", "action"))).alias("terms"))
    )
    none = F.array().cast("array<struct<start:int,end:int,action:string>>")
    # texts without mentions have no key; they stay out of the join, where they would all meet
    without = found.where(F.col("key").isNull()).select("id", "spans", none.alias("terms"))
    joined = found.where(F.col("key").isNotNull()).join(added, "key", "left").select("id", "spans", F.coalesce("terms", none).alias("terms"))
    return without.unionByName(joined).withColumnRenamed("id", id_col)


def sanitise(docs: DataFrame, scanned: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and the text with base spans as <kind>, removed words as <term>, generalised ones as their shape.

    ``docs`` and ``scanned`` are joined by id, which must be unique and not null here.
    """
    text = whole(text_col)
    base = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.concat(F.lit("<"), s["kind"], F.lit(">")).alias("put")))
    terms = F.transform("terms", lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"), F.when(t["action"] == "remove", f"<{TERM}>").alias("put")))
    rows = docs.select(id_col, text.alias("__text")).join(scanned.select(id_col, F.array_sort(F.concat(base, terms)).alias("__cuts")), id_col, "left")
    state = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(a: Column, c: Column) -> Column:
        piece = F.substring(F.col("__text"), c["start"] + 1, c["end"] - c["start"])
        shape = F.regexp_replace(F.regexp_replace(F.regexp_replace(piece, r"\p{Lu}", "X"), r"[\p{L}&&[^X]]", "x"), r"\p{N}", "0")
        until = F.substring(F.col("__text"), a["at"] + 1, c["start"] - a["at"])
        done = F.struct(c["end"].alias("at"), F.concat(a["out"], until, F.coalesce(c["put"], shape)).alias("out"))
        return F.when(c["start"] >= a["at"], done).otherwise(a)

    finish = lambda a: F.concat(a["out"], F.substring(F.col("__text"), a["at"] + 1, F.length("__text")))
    clean = F.when(F.size("__cuts") > 0, F.aggregate("__cuts", state, step, finish)).otherwise(F.col("__text"))
    return rows.select(id_col, clean.alias(text_col))
