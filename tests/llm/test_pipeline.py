import base64
import os
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from edge_cases import EDGE_TEXTS
from test_similarity import brute_classes
from tokenizers import Tokenizer

import corpus_pipeline
from keyferry.llm.queries import ORACLES, QUERIES
from keyferry.session import cut_lineage

DIR = "/root/testdata/sf0.001"


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


@pytest.mark.skipif(not os.path.isdir(DIR), reason="driver tables not present")
def test_stages_on_driver_tables(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    columns = docs.columns
    named = cut_lineage(stage("language_id")(spark, docs, DIR))
    rows = [(r["doc_id"], r["text"]) for r in named.collect()]
    assert named.columns == columns
    lettered = {r["doc_id"] for r in docs.collect() if any(c.isalpha() for c in r["text"] or "")}
    assert {i for i, _ in rows} <= lettered and len(rows) >= 0.99 * len(lettered)

    single = cut_lineage(stage("exact_dedup")(spark, named, DIR))
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub("[\x20\x09-\x0d]", "", t)].append((-len(t), i, t))
    left = [(i, t) for _, i, t in map(min, groups.values())]
    assert single.columns == columns and sorted(r["doc_id"] for r in single.collect()) == sorted(i for i, _ in left)

    apart = cut_lineage(stage("ngram_join")(spark, single, DIR))
    first = {c for _, _, c in brute_classes(left, 5, 80, 100)}
    assert apart.columns == columns and {r["doc_id"] for r in apart.collect()} == first

    mixed = cut_lineage(stage("mixing")(spark, apart, DIR))
    assert mixed.columns == columns
    texts = {r["doc_id"]: r["text"] for r in mixed.collect()}
    assert set(texts) < first

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out = stage("bpe")(spark, mixed, DIR).collect()
    assert len(out) == len(texts)
    for r in out:
        assert np.frombuffer(r["ids"], "<u4").tolist() == tokenizer.encode(texts[r["doc_id"]], add_special_tokens=False).ids


def noise(rng, kind):
    words = rng.randint(20, 300)
    if kind == "letters":
        return " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) for _ in range(words))
    if kind == "capitals":
        return " ".join("".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZ", k=6)) for _ in range(words))
    return base64.b64encode(rng.randbytes(4 * words)).decode()


@pytest.mark.skipif(not os.path.isdir(DIR), reason="driver tables not present")
def test_language_stage_rejects_what_is_in_no_language(spark):
    """Letters alone do not make a language: noise goes, prose of every language stays."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rng = random.Random(3)
    planted = [(10**9 + k, noise(rng, kind), None, "src0", 0) for k, kind in enumerate(["letters", "capitals", "packed"] * 20)]
    both = docs.unionByName(spark.createDataFrame(planted, docs.schema))
    kept = {r["doc_id"] for r in stage("language_id")(spark, both, DIR).select("doc_id").collect()}
    assert not {r[0] for r in planted} & kept
    for lang in ("de", "en", "es", "fr"):
        clean = {r["doc_id"] for r in docs.where(f"lang = '{lang}' AND length(text) >= 20").select("doc_id").collect()}
        assert len(clean & kept) >= 0.99 * len(clean), lang


def test_mixing_stage_equals_sql(spark):
    """Who stays, by the query's SQL on the same documents."""
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{DIR}/documents.parquet'")
    cur = con.execute(ORACLES["op2_mixing"])
    at = [c[0] for c in cur.description]
    want = sorted(r[at.index("doc_id")] for r in cur.fetchall() if r[at.index("kept")])
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    assert sorted(r["doc_id"] for r in stage("mixing")(spark, docs, DIR).collect()) == want


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_on_edge_cases(spark, edge, none, name):
    out = stage(name)(spark, edge, DIR)
    rows = out.collect()
    assert (out.columns == edge.columns) == (name != "bpe")
    assert set(Counter(r["doc_id"] for r in rows)) <= {i for i, _ in EDGE_TEXTS}
    if name in ("language_id", "exact_dedup", "ngram_join"):
        assert any(r["doc_id"] == 8 for r in rows)
    assert stage(name)(spark, none, DIR).count() == 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for given in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {given} AS SELECT * FROM '{DIR}/{given}.parquet'")
    cur = con.execute(ORACLES[name])
    names = [c[0] for c in cur.description]
    df = QUERIES[name](spark, DIR)
    assert sorted(df.columns) == sorted(names)
    cols = sorted(names)
    got = Counter(tuple(r[c] for c in cols) for r in df.collect())
    assert got == Counter(tuple(r[names.index(c)] for c in cols) for r in cur.fetchall())


def test_thirteen_operators_and_the_pipeline_are_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert {int(n[2:].split("_")[0]) for n in names if re.match(r"op\d+_", n)} == set(range(1, 14))
    assert names["pipeline"] is corpus_pipeline.run
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "ngram_join", "mixing", "bpe"]
