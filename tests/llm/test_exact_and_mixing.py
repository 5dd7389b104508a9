import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import pytest
from edge_cases import EDGE_TEXTS, frame
from pyspark.sql import functions as F

from keyferry.llm import exact_dedup, mixing


def squeezed(text):
    return re.sub("[\x20\x09-\x0d]", "", text or "")


def brute_classes(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[squeezed(t)].append((-len(t or ""), i is None, i))
    out = Counter()
    for i, t in rows:
        norm = squeezed(t)
        n, _, keep = min(groups[norm], key=lambda x: (x[0], x[1], x[2] or 0))
        out[i, keep, len(groups[norm]), (i, len(t or "")) == (keep, -n), hashlib.sha256(norm.encode()).hexdigest()] += 1
    return out


def got_classes(df):
    return Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["digest"]) for r in df.collect())


def test_classes_of_edge_cases(edge):
    assert got_classes(exact_dedup.exact_classes(edge)) == brute_classes(EDGE_TEXTS)


def test_classes_of_random_texts(spark):
    random.seed(1)
    rows = [(i, "".join(random.choices("ab \n", k=random.randint(0, 5)))) for i in range(400)]
    assert got_classes(exact_dedup.exact_classes(frame(spark, rows, partitions=7), salts=3)) == brute_classes(rows)


def test_colliding_digests_are_told_apart_by_text(spark):
    rows = [(i, t) for i, t in enumerate(["a b", "ab", "abc", "b", "b ", "c", "ca", "ab  "])]
    weak = exact_dedup.exact_classes(frame(spark, rows), digest=lambda c: F.substring(c, 1, 1))
    got = {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in weak.collect()}
    assert got == {0: (7, 3), 1: (7, 3), 7: (7, 3), 2: (2, 1), 3: (4, 2), 4: (4, 2), 5: (5, 1), 6: (6, 1)}


def test_drop_copies_keeps_one_row_and_all_columns(edge):
    out = exact_dedup.drop_copies(edge)
    assert out.columns == edge.columns
    kept = Counter((r["doc_id"], r["text"]) for r in out.collect())
    assert set(kept.values()) == {1}
    assert Counter(squeezed(t) for _, t in kept) == Counter({squeezed(t): 1 for _, t in EDGE_TEXTS})


def test_empty_tables(none):
    assert exact_dedup.exact_classes(none).count() == 0
    assert exact_dedup.drop_copies(none).count() == 0
    assert mixing.mix(none, {"source": 0.5, "lang": 0.5, "topic": 0.5}).count() == 0
    assert mixing.sample(none, {"source": 0.5, "lang": 0.5, "topic": 0.5}).count() == 0


def test_mix_of_edge_cases_and_its_rows(edge):
    targets = {"source": 0.5, "lang": 0.5, "topic": 0.7}
    out = mixing.mix(edge, targets, rounds=4)
    rows = out.collect()
    assert len(rows) == len(EDGE_TEXTS)
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (2, 3, 4)} == {0}
    assert all(r["kept"] and r["probability"] == 1 for r in rows if not r["n_tokens"])
    assert all(0 <= r["probability"] <= 1 for r in rows)
    assert Counter(r["doc_id"] for r in rows if r["kept"]) == Counter(r["doc_id"] for r in mixing.sample(edge, targets, rounds=4).collect())


def test_raking_follows_given_targets_and_budget(spark):
    random.seed(3)
    rows = [(i, " ".join(["w"] * random.randint(1, 30))) for i in range(4000)]
    docs = frame(spark, rows, extra=False).withColumn("source", F.when(F.col("doc_id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("doc_id") % 5)))
    docs = docs.withColumn("lang", F.when(F.col("doc_id") % 7 < 5, "en").otherwise("de"))
    targets = {"source": 1.0, "lang": {"en": 0.5, "de": 0.5}, "topic": 1.0}
    rows = mixing.mix(docs, targets, topic=F.concat(F.lit("t"), F.col("doc_id") % 2), rounds=15, budget=0.4).collect()
    total = sum(r["n_tokens"] for r in rows)
    expected = sum(r["n_tokens"] * r["probability"] for r in rows)
    assert expected == pytest.approx(0.4 * total, rel=1e-6)
    english = sum(r["n_tokens"] * r["probability"] for r in rows if r["lang"] == "en")
    assert english == pytest.approx(expected / 2, rel=1e-3)
    hot = sum(r["n_tokens"] for r in rows if r["source"] == "hot") / total
    assert sum(r["n_tokens"] * r["probability"] for r in rows if r["source"] == "hot") == pytest.approx(hot * expected, rel=1e-3)
    drawn = sum(r["n_tokens"] for r in rows if r["kept"])
    assert abs(drawn - expected) < 5 * math.sqrt(sum(r["n_tokens"] ** 2 * r["probability"] * (1 - r["probability"]) for r in rows))


def test_probabilities_that_reach_one(spark):
    rows = [(i, "w " * (1 if i < 5 else 20)) for i in range(105)]
    docs = frame(spark, rows, extra=False).withColumn("source", F.when(F.col("doc_id") < 5, "rare").otherwise("rich"))
    out = mixing.mix(docs, {"source": {"rare": 0.5, "rich": 0.5}}, rounds=3, budget=0.5).collect()
    assert {round(r["probability"], 9) for r in out if r["source"] == "rare"} == {1.0}
    assert sum(r["n_tokens"] * r["probability"] for r in out) == pytest.approx(0.5 * 2005)
