import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow.orc as orc
import pytest
from edge_cases import EDGE_TEXTS, frame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from keyferry.llm import token_files

WORDS, BYTES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "<|endoftext|>Hi<|startoftext|>x <|endoftext| >", "ΑΣ ΣΣ İstanbul ǅ ﬁ é Å", "x\x1cy\x1dz \x85a\xa0b　c", "½ ² Ⅷ ٣ ४५ 中文字 한국어",
    "!!!!! ... 's ''ll don't", "a" * 3000, "ab" * 700, "\x00\x01 \x7f", "\U0001f600\U0001f468‍\U0001f469", "<|startoftext|", "|> <|start", "é ́x", "a ̂",
]


def plain():
    tokenizer = Tokenizer.from_file(WORDS)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def expected(rows, end=1):
    t, start, out = plain(), 0, []
    for i, text in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids + [end]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_runs_encode_like_whole_texts(monkeypatch):
    monkeypatch.setattr(token_files, "HELD", 50)
    rng = random.Random(8)
    ranges = [(32, 126), (128, 0x24F), (0x300, 0x36F), (0x370, 0xD7FF), (32, 32), (9, 10)]
    alphabet = [chr(rng.randint(*rng.choice(ranges))) for _ in range(4000)]
    latin = [chr(c) for c in [*range(33, 0x250)]]
    texts = ODD + ["".join(rng.choices(alphabet, k=70)) for _ in range(300)] + [" ".join("".join(rng.choices(latin, k=9)) for _ in range(9)) for _ in range(200)]
    texts += ["".join(rng.choices("theinareron's .", k=60)) for _ in range(100)]
    runs, t = token_files.Runs(open(WORDS, "rb").read()), plain()
    assert runs.by_piece and not token_files.Runs(open(BYTES, "rb").read()).by_piece
    for text in texts:
        assert np.frombuffer(runs.encode(text), "<u4").tolist() == t.encode(text, add_special_tokens=False).ids, text


def test_every_latin_character_is_split_like_the_library():
    runs, t = token_files.Runs(open(WORDS, "rb").read()), plain()
    for c in range(33, 0x250):
        text = f"a{chr(c)}B{chr(c)}{chr(c)}1"
        assert np.frombuffer(runs.encode(text), "<u4").tolist() == t.encode(text, add_special_tokens=False).ids, hex(c)


def test_files_of_edge_rows(spark, edge, none, tmp_path):
    token_files.write(edge, f"{tmp_path}/a", WORDS, 1)
    got = token_files.checked(token_files.read(spark, f"{tmp_path}/a")).collect()
    want = expected(sorted(EDGE_TEXTS, key=lambda r: (r[0] is not None, r[0] or 0)))
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in got)
    token_files.write(none, f"{tmp_path}/b", WORDS, 1)
    assert token_files.read(spark, f"{tmp_path}/b").count() == 0


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    rng = random.Random(9)
    rows = [(i * 3, " ".join(rng.choices(["alpha", "beta", "gamma", "delta", str(i)], k=rng.randint(0, 400)))) for i in range(6000)]
    path = str(tmp_path_factory.mktemp("tokens") / "t")
    token_files.write(frame(spark, rows, extra=False, partitions=5), path, WORDS, 1, stripe_bytes=64 << 10, index_rows=1000)
    return path, rows


def test_ids_run_on_through_sorted_files(spark, written):
    path, rows = written
    got = sorted(tuple(r) for r in token_files.checked(token_files.read(spark, path)).collect())
    assert got == expected(rows)
    spans = spark.read.orc(f"{path}/tokens").groupBy("part").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).orderBy("part").collect()
    assert len(spans) > 1 and all(x["b"] < y["a"] for x, y in zip(spans, spans[1:]))


def test_stripes_are_read_by_several_tasks(spark, written):
    path, rows = written
    files = [f for f in spark.read.orc(f"{path}/tokens").inputFiles()]
    assert max(orc.ORCFile(f.removeprefix("file://")).nstripes for f in files) > 2
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(64 << 10))
    try:
        read = spark.read.orc(f"{path}/tokens")
        tasks = [r for r in read.groupBy("part", F.spark_partition_id().alias("task")).count().collect() if r["count"]]
        assert len(tasks) > len({r["part"] for r in tasks}) and sum(r["count"] for r in tasks) == len(rows)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_searches_reach_the_metadata(spark, written):
    path, rows = written
    found = token_files.read(spark, path).where(F.col("doc_id").isin(300, 4500, 7))
    assert "PushedFilters: [In(doc_id" in found._jdf.queryExecution().toString()
    assert sorted(r["doc_id"] for r in found.collect()) == [300, 4500]
    jvm = spark._jvm
    file = next(f for f in spark.read.orc(f"{path}/tokens").inputFiles())
    reader = jvm.org.apache.orc.OrcFile.createReader(jvm.org.apache.hadoop.fs.Path(file), jvm.org.apache.orc.OrcFile.readerOptions(spark._jsc.hadoopConfiguration()))
    assert reader.getRowIndexStride() == 1000
    stripe = reader.rows().readStripeFooter(reader.getStripes()[0])
    kinds = {(str(stripe.getStreams(k).getKind()), stripe.getStreams(k).getColumn()) for k in range(stripe.getStreamsCount())}
    assert ("BLOOM_FILTER_UTF8", 2) in kinds and ("ROW_INDEX", 2) in kinds


def test_repeated_rows_and_ids(spark, tmp_path):
    rows = [(5, "same text")] * 300 + [(5, "other"), (None, "x"), (None, "x"), (4, None)]
    token_files.write(frame(spark, rows), f"{tmp_path}/r", WORDS, 1)
    got = token_files.read(spark, f"{tmp_path}/r").collect()
    assert len(got) == len(rows)
    starts = sorted((r["start"], r["n_tokens"]) for r in got)
    assert [s for s, _ in starts] == [sum(n for _, n in starts[:k]) for k in range(len(starts))]
    assert [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])] == [None, None, 4] + [5] * 301


def test_other_vocabularies_with_ends_apart(spark, tmp_path):
    """A vocabulary whose rules join across white space is not one for this writer; the check refuses it."""
    with pytest.raises(ValueError):
        token_files.write(frame(spark, [(1, "a b")]), f"{tmp_path}/x", BYTES, 1)


def test_query_on_driver_tables(spark):
    from keyferry.llm.queries import QUERIES, table

    rows = sorted((r["doc_id"], r["text"]) for r in table(spark, "/root/testdata/sf0.001", "documents").collect())
    got = sorted(tuple(r) for r in QUERIES["op12_token_files"](spark, "/root/testdata/sf0.001").collect())
    assert got == expected(rows)
