import random
import re
import sys
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from edge_cases import EDGE_TEXTS, frame
from pyspark.sql import functions as F

from keyferry.llm import collocations as co


def words_of(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", lowered)]


def expected(rows, least, top, scale=2_000_000, subsumed=80):
    """Plain counting of (lang, text) rows."""
    counts, total = {}, Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in words_of(text):
            total[lang] += len(piece)
            for size in range(1, 5):
                for i in range(len(piece) - size + 1):
                    counts.setdefault(lang, Counter())[tuple(piece[i : i + size])] += 1
    out = []
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = lambda p, q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
        best = []
        for p, a in found.items():
            if any(len(q) > len(p) and 100 * b >= subsumed * a and inside(p, q) for q, b in found.items()):
                continue
            score, _, l, r = min((scale * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            best.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, total[lang], -score))
    return sorted(out)


def text(rng, vocabulary, n):
    return "".join(rng.choice(vocabulary) + rng.choice([" ", " ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", " ! "]) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    vocabulary = ["New", "york", "city", "of", "the", "Ärger", "ärger", "日本", "x\x1cy", "a-b", "THE", "\xa0z"] + [f"w{i}" for i in range(25)]
    rows = [(i, text(rng, vocabulary, rng.randint(0, 60))) for i in range(240)]
    rows += [(500 + i, "new york city hall of the") for i in range(40)] + [(600, None), (601, ""), (602, " ;; ,. "), (None, "new york city")]
    return rows


def columns(out):
    return sorted(tuple(r) for r in out.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize("least,top,bits", [(5, 2000, 20), (12, 7, 20), (5, 2000, 15)])
def test_phrases_equal_plain_counting(spark, corpus, least, top, bits):
    docs = frame(spark, corpus)
    rows = [(r["lang"], r["text"]) for r in docs.select("lang", "text").collect()]
    assert columns(co.collocations(docs, least=least, top=top, bits=bits)) == expected(rows, least, top)


def test_small_flushes_and_cut_stripes_change_nothing(spark, corpus, monkeypatch):
    docs = frame(spark, corpus)
    want = columns(co.collocations(docs, least=5, bits=20))
    rows = docs.select("lang", "text").collect()
    monkeypatch.setattr(co, "FRESH", 40)
    monkeypatch.setattr(co, "FIRST_PARTS", 3)
    for size, hot in ((1, set()), (2, {("en", "new"), ("en", "the")}), (3, {("en", "new york")})):
        stripes = {}
        bitmap = None if size == 1 else np.full(1 << 17, 255, np.uint8)
        held = co.Stripes("en", size, bitmap, 20)
        for r in rows:
            if r["lang"] == "en":
                held.add([r["text"] or ""])
        parts = {}
        for lang, prefix, part, words, counts in held.rows(hot):
            for w, c in zip(words.split(" "), np.frombuffer(counts, np.int64).tolist()):
                stripes[prefix, w] = stripes.get((prefix, w), 0) + c
                parts.setdefault(prefix, set()).add(part)
        plain = Counter()
        for r in rows:
            if r["lang"] == "en":
                for piece in words_of(r["text"]):
                    for i in range(len(piece) - size + 1):
                        plain[" ".join(piece[i : i + size - 1]), piece[i + size - 1]] += 1
        assert stripes == {k: c for k, c in plain.items()}
        if size == 1:
            assert parts[""] == {0, 1, 2}
        elif size == 2:
            assert len(parts["new"]) > 1 and parts["of"] == {0}
    assert want == columns(co.collocations(docs.repartition(5), least=5, bits=20))


def test_hot_prefixes_are_cut_and_summed(spark, monkeypatch):
    monkeypatch.setattr(co, "HOT", 10)
    rows = [(i, f"hot w{i % 9} tail. hot w{i % 4} end") for i in range(200)]
    docs = frame(spark, rows)
    plain = [(r["lang"], r["text"]) for r in docs.select("lang", "text").collect()]
    levels = co.stripes(docs, least=5, bits=18)
    assert levels[1].where("prefix = 'hot'").count() > 2
    assert levels[1].where("prefix = 'hot'").groupBy("lang").agg(F.sum("total")).count() == 2
    assert columns(co.collocations(docs, least=5, bits=18)) == expected(plain, 5, 2000)


def test_scores_need_more_than_64_bits(spark):
    rows = spark.createDataFrame([(6_000_000_000_000_000_000, 3_000_000_000_000_000_001)], "a bigint, x bigint")
    wide = rows.select((co._wide(F.col("a")) * F.lit(2_000_000).cast("decimal(10,0)")).alias("wide"), "x")
    got = wide.select(F.expr("wide div cast(x + x as decimal(20,0))")).first()[0]
    assert got == 2_000_000 * 6_000_000_000_000_000_000 // 6_000_000_000_000_000_002


def test_edge_rows(edge, none):
    rows = [(r["lang"], r["text"]) for r in edge.select("lang", "text").collect()]
    assert len(rows) == len(EDGE_TEXTS)
    assert columns(co.collocations(edge, least=2, bits=18)) == expected(rows, 2, 2000)
    assert columns(co.collocations(edge, least=10**6, bits=18)) == []
    assert columns(co.collocations(none, bits=18)) == []


RAW_TYPES = [pa.string(), pa.string(), pa.int32(), pa.string(), pa.binary()]


def calls(run):
    """How many functions, of Python or C, are called."""
    seen = Counter()
    sys.setprofile(lambda _, event, __: seen.update([event]))
    try:
        run()
    finally:
        sys.setprofile(None)
    return seen["call"] + seen["c_call"]


def test_work_in_python_grows_with_different_words_only():
    texts = ["Alpha beta gamma. Delta, beta gamma! " * 2000]
    co._split(texts)  # what is imported on the first call
    for size in (1, 2, 4):
        held = co.Stripes("en", size, None if size == 1 else np.full(1 << 17, 255, np.uint8), 20)
        assert calls(lambda: held.add(texts)) < 1000
    assert co.Stripes("en", 1, None, 20).full() == (0, 1)

    raw = [("en", f"w{i:03}", 0, " ".join(f"v{k}" for k in range(40)), np.arange(40).tobytes()) for i in range(300)]
    batches = [pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*raw), RAW_TYPES)], names=co.RAW_NAMES)]
    run = co._merge(30)
    assert calls(lambda: list(run(iter(batches)))) < 3000


@pytest.mark.parametrize("block", [1, 120, 8 << 20])
def test_merging_in_blocks_sums_every_stripe(monkeypatch, block):
    monkeypatch.setattr(co, "STRIPE_BLOCK", block)
    rng = random.Random(3)
    raw, plain = [], {}
    for lang in ("de", "en"):
        for prefix in ("", "a", "b c", "zz"):
            for part in range(3 if prefix == "" else 1):
                for _ in range(rng.randint(1, 9)):
                    entries = {f"{w}{part}": rng.randint(1, 9) for w in rng.sample(["x", "y", "ü", "日本", "x\x1cy", "v"], rng.randint(1, 6))}
                    raw.append((lang, prefix, part, " ".join(entries), np.array([*entries.values()]).tobytes()))
                    plain.setdefault((lang, prefix, part), Counter()).update(entries)
    whole_batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*raw), RAW_TYPES)], names=co.RAW_NAMES)
    batches = [whole_batch[:0], *[whole_batch[k : k + 4] for k in range(0, len(raw), 4)]]
    got = [r for b in co._merge(12)(iter(batches)) for r in zip(*[c.to_pylist() for c in b.columns])]
    assert [r[:3] for r in got] == [(*k[:2], sum(c.values())) for k, c in plain.items()]
    assert [dict(zip(*r[3:])) for r in got] == [{w: n for w, n in c.items() if n >= 12} for c in plain.values()]
    assert list(co._merge(12)(iter([]))) == []


def test_texts_split_at_blanks_and_pieces():
    for texts, words in (([""], []), ([" .;\n"], []), (["One two\tone", "TWO. three"], [b"one", b"two", b"three"]), ([".a\xa0b\x1cc  É!"], ["a\xa0b\x1cc".encode(), "É".encode()])):
        different, at, borders = co._split(texts)
        assert different == words
        numbers = np.insert(np.asarray(at) + 1, borders, 0).tolist()
        runs = [[words[k - 1].decode() for k in map(ord, run)] for run in "".join(map(chr, numbers)).split("\0") if run]
        assert runs == [p for t in texts for p in words_of(t) if p]


def test_small_blocks_of_text_change_nothing(spark, corpus, monkeypatch):
    docs = frame(spark, corpus)
    rows = [(r["lang"], r["text"]) for r in docs.select("lang", "text").collect()]
    batch = pa.RecordBatch.from_arrays([pa.array([x[0] or "und" for x in rows]), pa.array([x[1] or "" for x in rows])], names=["lang", "text"])

    def found():
        out = Counter()
        for b in co._gather(1, None, None, 20)(iter([batch[k : k + 7] for k in range(0, len(rows), 7)])):
            for lang, prefix, part, words, counts in zip(*[c.to_pylist() for c in b.columns]):
                for w, c in zip(words.split(" "), np.frombuffer(counts, np.int64).tolist()):
                    out[lang, prefix, part, w] += c
        return out

    want = found()
    monkeypatch.setattr(co, "TEXT_BLOCK", 10)
    monkeypatch.setattr(co, "HELD", 30)
    monkeypatch.setattr(co, "ROWS", 3)
    assert found() == want
    assert sum(want.values()) == sum(len(p) for _, t in rows for p in words_of(t))
