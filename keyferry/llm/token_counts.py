"""Token counts of whole texts; huge documents are counted in overlapping chunks spread over tasks.

A chunk's word boundaries away from its end are those of the whole text, once one of them is: words
are cut left to right, and a cut depends on nothing before it and at most one character after it. So
two neighbouring chunks are spliced at the first place in their overlap that is a word boundary in
both and lies far enough from the left chunk's end to be stable; merging never crosses such a place.
Where an overlap holds no such place (one endless word), the document is counted again with wider
overlaps, up to the whole text. Chunks are keyed by the text's digest, so copies are counted once.

Defined cases: a null text counts as empty, with 0 tokens; texts of any length are counted whole;
repeated rows and null ids come out as they came in; further columns are ignored; an empty table
gives an empty result. Special strings inside texts count as the one special token they name.
"""

from __future__ import annotations

import functools
import hashlib
import json

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ..session import cut_lineage
from .bpe import byte_characters
from .common import bounded_batches, whole

# Fixed value of the vocabulary's file format: how a text is cut into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Counter:
    """Counts tokens with the merge ranks of a vocabulary file; offsets are sums of token sizes."""

    def __init__(self, content: bytes):
        spec = json.loads(content)
        byte_of = {c: b for b, c in enumerate(byte_characters())}
        ranks = {bytes(byte_of[c] for c in t): i for t, i in spec["model"]["vocab"].items()}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {t: i for t, i in ranks.items() if i not in special.values()}
        self.special = set(special)
        self.encoding = tiktoken.Encoding("file", pat_str=WORDS, mergeable_ranks=ranks, special_tokens=special)
        self.sizes = np.zeros(max([*ranks.values(), *special.values()]) + 1, dtype=np.int64)
        for t, i in ranks.items():
            self.sizes[i] = len(t)
        for t, i in special.items():
            self.sizes[i] = len(t.encode())
        self.margin = max([1, *map(len, special)])
        self.cut = regex.compile("|".join([*map(regex.escape, sorted(special, key=len, reverse=True)), "(?!)"]))
        self.words = regex.compile(WORDS)
        self.content = content

    def ids(self, text: str) -> list[int]:
        try:
            return self.encoding.encode(text, allowed_special=self.special, disallowed_special=())
        except ValueError:  # a run of millions of blanks is too long for its pattern search
            return Tokenizer.from_buffer(self.content).encode(text, add_special_tokens=False).ids

    def boundaries(self, text: str, windows: list[tuple[int, int]]) -> list[tuple[list[int], list[int]]]:
        """For each window of places: the word boundaries in it and the tokens before each."""
        ends = np.cumsum(self.sizes[np.array(self.ids(text), dtype=np.int64)])
        places, at = [0], 0
        for special in [*self.cut.finditer(text), None]:
            upto = special.start() if special else len(text)
            places += [m.end() for m in self.words.finditer(text[at:upto])] if at == 0 else [at + m.end() for m in self.words.finditer(text[at:upto])]
            if special:
                places.append(at := special.end())
        lasting = [p for p in places[:-1] if p <= len(text) - self.margin]  # the last word may go on
        out = []
        for low, high in windows:
            inside = [p for p in lasting if low <= p < high]
            sizes = np.cumsum([len(text[a:b].encode()) for a, b in zip([0, *inside], inside)]) if inside else np.zeros(0, np.int64)
            counts = np.searchsorted(ends, sizes, "left") + 1
            counts[sizes == 0] = 0
            exact = [(p, int(n)) for p, n, s in zip(inside, counts, sizes) if s == 0 or n <= len(ends) and ends[n - 1] == s]
            out.append(([p for p, _ in exact], [n for _, n in exact]))
        return [*out, len(ends)]


@functools.lru_cache(maxsize=1)
def _counter(key: str, content: bytes) -> Counter:
    return Counter(content)


def counter(content: bytes) -> Counter:
    """Built once per Python worker."""
    return _counter(hashlib.sha256(content).hexdigest(), content)


def _counted(rows: DataFrame, content) -> DataFrame:
    """Rows of (id, text) counted one by one."""

    def run(batches):
        c = counter(content.value)
        for batch in batches:
            n = [len(c.ids(t)) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(n, pa.int64())], names=["id", "n_bytes", "n_tokens"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, n_bytes bigint, n_tokens bigint")


def _chunks(texts: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """Rows of (key, text) as chunks of the text, each reaching ``overlap`` into the next."""

    def run(batches):
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                n = max(1, -(-(len(text) - overlap) // chunk))
                for k in range(n):
                    piece = text[k * chunk :] if k == n - 1 else text[k * chunk : (k + 1) * chunk + overlap]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([key]), pa.array([k], pa.int64()), pa.array([k == n - 1]), pa.array([piece], pa.string())],
                        names=["key", "k", "last", "piece"],
                    )

    pieces = texts.mapInArrow(run, "key string, k bigint, last boolean, piece string")
    return pieces.dropDuplicates(["key", "k"])  # copies meet here; this also deals the chunks out


def _encoded(pieces: DataFrame, chunk: int, overlap: int, content) -> DataFrame:
    def run(batches):
        c = counter(content.value)
        windows = [(0, overlap), (chunk, chunk + overlap)]
        for batch in batches:
            got = [c.boundaries(t, windows) for t in batch.column(3).to_pylist()]
            places, counts = pa.list_(pa.int64()), pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:3],
                    pa.array([g[2] for g in got], pa.int64()),
                    pa.array([g[0][0] for g in got], places),
                    pa.array([g[0][1] for g in got], counts),
                    pa.array([[p - chunk for p in g[1][0]] for g in got], places),
                    pa.array([g[1][1] for g in got], counts),
                ],
                names=["key", "k", "last", "total", "head", "head_n", "tail", "tail_n"],
            )

    lists = "head array<bigint>, head_n array<bigint>, tail array<bigint>, tail_n array<bigint>"
    return pieces.mapInArrow(run, f"key string, k bigint, last boolean, total bigint, {lists}")


def _spliced(encoded: DataFrame) -> DataFrame:
    """key, n_tokens; n_tokens is null where two neighbours have no common stable boundary."""
    left = encoded.select("key", "k", "last", "total", "tail", "tail_n")
    right = encoded.select("key", (F.col("k") - 1).alias("k"), "head", "head_n")
    at = F.get(F.array_intersect("tail", "head"), 0)
    upto = F.get("tail_n", F.array_position("tail", F.col("at")).cast("int") - 1)
    before = F.get("head_n", F.array_position("head", F.col("at")).cast("int") - 1)
    part = F.when(F.col("last"), F.col("total")).otherwise(upto - before)
    pairs = left.join(right, ["key", "k"], "left").withColumn("at", at).select("key", part.alias("part"))
    return pairs.groupBy("key").agg(F.when(F.count("part") == F.count(F.lit(1)), F.sum("part")).alias("n_tokens"))


def count_tokens(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = 1024,
    chunk: int = 1 << 16,
    overlap: int = 1 << 10,
) -> DataFrame:
    """id, n_bytes, n_tokens, over_limit of every whole text; texts above ``chunk`` characters are cut."""
    spark = bounded_batches(docs.sparkSession)
    with open(path, "rb") as f:
        content = spark.sparkContext.broadcast(f.read())  # a vocabulary file, a few MB
    text = whole(text_col)
    rows = docs.select(F.col(id_col).alias("id"), F.octet_length(text).cast("bigint").alias("n_bytes"), text.alias("text"))
    huge = rows.where(F.length("text") > chunk).withColumn("key", F.sha2(F.col("text").cast("binary"), 256))
    small = _counted(rows.where(F.length("text") <= chunk), content)

    texts, counts, wide, wider = huge.select("key", "text"), [], chunk, overlap
    while True:
        encoded = cut_lineage(_encoded(_chunks(texts, wide, wider), wide, wider, content))
        sums = cut_lineage(_spliced(encoded))
        counts.append(sums.where("n_tokens IS NOT NULL"))
        failed = sums.where("n_tokens IS NULL").select("key")
        if failed.isEmpty():
            break
        texts = texts.join(failed, "key", "left_semi")
        wider *= 8
        wide = max(wide, 4 * wider)
    every = functools.reduce(DataFrame.unionByName, counts)
    spliced = huge.select("id", "n_bytes", "key").join(every, "key").select("id", "n_bytes", "n_tokens")
    out = small.unionByName(spliced)
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
