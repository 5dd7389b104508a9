import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from edge_cases import EDGE_TEXTS, frame
from tokenizers import Tokenizer

from keyferry.llm import bpe, token_counts

WORDS, BYTES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "<|endoftext|>Hi<|startoftext|>x <|endoftext| >", "ΑΣ ΣΣ İstanbul ǅ ﬁ é Å", "x\x1cy\x1dz \x85a\xa0b　c",
    "½ ² Ⅷ ٣ ४५ 中文字 한국어", "!!!!! ... 's ''ll don't", "a" * 3000, "ab" * 700, "\x00\x01 \x7f", "\U0001f600\U0001f468‍\U0001f469",
]


def plain(path):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def cases():
    random.seed(4)
    alphabet = [chr(random.choice([random.randint(32, 126), random.randint(160, 0x24F), random.randint(0x370, 0xD7FF), 32])) for _ in range(5000)]
    return ODD + ["".join(random.choices(alphabet, k=80)) for _ in range(300)] + ["".join(random.choices("theinareron ", k=60)) for _ in range(200)]


def test_encoding_equals_the_library():
    content = open(WORDS, "rb").read()
    v, d, t = bpe.encoder(content), bpe.decoder(content), plain(WORDS)
    for text in cases():
        want = t.encode(text, add_special_tokens=False).ids
        ids = np.frombuffer(v.encode(text), "<u4")
        assert ids.tolist() == want, text
        assert d.text(ids).decode() == t.decode(want, skip_special_tokens=False)


def test_every_character_is_classed_like_the_library():
    v, t = bpe.encoder(open(WORDS, "rb").read()), plain(WORDS)
    for c in [*range(32, 0x3000, 3), *range(0xA000, 0xD800, 11), *range(0x10000, 0x20000, 17)]:
        text = f"a{chr(c)}b{chr(c)}{chr(c)}"
        assert np.frombuffer(v.encode(text), "<u4").tolist() == t.encode(text, add_special_tokens=False).ids, hex(c)


def test_round_trip_of_edge_cases(edge, none):
    t = plain(WORDS)
    out = bpe.decode(bpe.encode(edge, WORDS), WORDS, keep=("ids", "n_tokens")).collect()
    want = []
    for i, text in EDGE_TEXTS:
        ids = t.encode(text or "", add_special_tokens=False).ids
        want.append((i, np.array(ids, "<u4").tobytes(), len(ids), t.decode(ids, skip_special_tokens=False)))
    assert sorted(map(repr, want)) == sorted(repr((r["doc_id"], bytes(r["ids"]), r["n_tokens"], r["decoded"])) for r in out)
    assert bpe.encode(none, WORDS).count() == 0


def test_one_pass_equals_two(edge, none):
    two = bpe.decode(bpe.encode(edge, WORDS), WORDS, keep=("ids", "n_tokens"))
    one = bpe.round_trip(edge, WORDS, cached=3)
    columns = ("doc_id", "ids", "n_tokens", "decoded")
    assert sorted(map(repr, one.select(*columns).collect())) == sorted(map(repr, two.select(*columns).collect()))
    assert bpe.round_trip(none, WORDS).count() == 0


def test_null_ids_decode_to_empty_text(spark):
    df = spark.createDataFrame([(1, None)], "doc_id long, ids binary")
    assert bpe.decode(df, WORDS).collect()[0]["decoded"] == ""


def test_counts_of_edge_cases(edge, none):
    t = plain(BYTES)
    out = token_counts.count_tokens(edge, BYTES, chunk=5000, overlap=64)
    want = [(i, len((x or "").encode()), n := len(t.encode(x or "", add_special_tokens=False).ids), n > 1024) for i, x in EDGE_TEXTS]
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in out.select("doc_id", "n_bytes", "n_tokens", "over_limit").collect())
    assert token_counts.count_tokens(none, BYTES).count() == 0


def test_chunked_counts_equal_whole_ones(spark):
    random.seed(6)
    parts = ["the", " ", "  ", "\n", "\n\n", " a", "<|endoftext|>", "<|", "endoftext", "'s", "'ll", "é", "x1", "22", "!!", "…", " \t", "Ünï", "word" * 30]
    rows = [(i, "".join(random.choices(parts, k=random.randint(5, 200)))) for i in range(150)] + [(900, " " * 3000), (901, "x" * 2000 + " y")]
    t = plain(BYTES)
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.count_tokens(frame(spark, rows), BYTES, chunk=48, overlap=8).collect()}
    assert got == {i: len(t.encode(x, add_special_tokens=False).ids) for i, x in rows}


def test_long_runs_of_blanks_fall_back_to_the_library():
    c, t = token_counts.counter(open(BYTES, "rb").read()), plain(BYTES)
    text = "\n " * 600_000 + "x"
    assert len(c.ids(text)) == len(t.encode(text, add_special_tokens=False).ids)


@pytest.mark.parametrize("name", ["op3_bpe_round_trip", "op4_token_counts"])
def test_queries_on_driver_tables(spark, name):
    from keyferry.llm.queries import QUERIES, table

    docs = {r["doc_id"]: r["text"] for r in table(spark, "/root/testdata/sf0.001", "documents").collect()}
    rows = QUERIES[name](spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == len(docs)
    t = plain(WORDS if name.startswith("op3") else BYTES)
    for r in rows:
        ids = t.encode(docs[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        if name.startswith("op3"):
            assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
            assert r["decoded_sha256"] == hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()
