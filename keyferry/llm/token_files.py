"""Token ids of a corpus as ORC files in document order.

Layout below one folder: ``tokens`` holds a row per document (part, doc_id, place, n_tokens, ids), sorted by
doc_id through all files; ``parts`` a row per file with the ids of all files before it. Ids are an integer
list column, which ORC stores run-length encoded; stripes are small enough to be read by different tasks;
row indexes and a Bloom filter on doc_id let a search by id skip files, stripes and row groups by their
metadata. ``start``, the ids of all documents before, is the file's offset plus the row's ``place`` in it.

Documents are ranged and sorted before they are encoded, so ids are never shuffled. A task encodes with the
tokenizer library, each piece of a word once while it is remembered: the file's rules never join or compare
text across white space, so ids of a text are those of its runs one after the other.

Defined cases: a null text is an empty one; an empty document has only the end id; null ids come first,
documents of one id follow by a hash of the text, then as read; repeated rows are written as often as they
come; texts of any length are whole; further columns are ignored; an empty table gives empty files.
Memory in a task: the tokenizer, up to twice ``HELD`` remembered pieces, one Arrow batch, one ORC
stripe.
"""

from __future__ import annotations

import functools
import hashlib
import json
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .bpe import BEYOND, PYTHON_ONLY_SPACE, WHITE, Recent, byte_characters, piece_patterns
from .common import SPACES, bounded_batches, give_back, whole

HELD = 500_000
# The rules of the vocabulary file under which runs are split here.
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
PIECES = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}

STRIPE_BYTES, INDEX_ROWS, BLOOM_ERROR = 16 << 20, 1000, 0.01
CHECK_ROWS = 256  # a stripe's size is looked at so often, because one row may be a book


class Runs:
    """Packed ids of runs between white space, by the tokenizer library.

    The library's merging is most of the work, so its model is asked for each lower-case piece once while
    that is remembered. In texts with characters ``BEYOND`` or a special token, runs that hold some go
    through the whole library, as do all runs of files with other rules than these.
    """

    def __init__(self, content: bytes):
        spec = json.loads(content)
        self.tokenizer = Tokenizer.from_str(content.decode())
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.by_piece = spec["normalizer"] == NORMALIZER and spec["pre_tokenizer"] == PIECES
        self.specials = [t["content"] for t in spec["added_tokens"]]
        self.split = piece_patterns()[0].findall
        self.shown = dict(enumerate(byte_characters()))
        self.pieces = Recent(self._piece, HELD)
        self.runs = Recent(self._run, HELD // 5)

    def parted_by_white_space(self) -> bool:
        """Whether ids of two runs are those of each, whatever white space is between."""
        both = self._whole("ab") + self._whole("12")
        return all(self._whole(f"ab{c}12") == both for c in SPACES)

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _piece(self, piece: str) -> bytes:
        shown = piece if piece.isascii() and piece.isalpha() else piece.encode().decode("latin-1").translate(self.shown)
        return array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()

    def _by_piece(self, text: str) -> str | None:
        """The text in lower case, if its pieces can be asked for one by one."""
        if not self.by_piece or any(s in text for s in self.specials):
            return None
        lower = text.lower()
        try:
            text.encode("latin-1")  # the usual case, quickly told
        except UnicodeEncodeError:
            return None if BEYOND.search(text) or BEYOND.search(lower) else lower
        return lower

    def encode(self, text: str) -> bytes:
        if (lower := self._by_piece(text)) is not None:
            return b"".join(map(self.pieces.__getitem__, self.split(lower)))
        runs = WHITE.split(text) if PYTHON_ONLY_SPACE.search(text) else text.split()
        return b"".join(map(self.runs.__getitem__, runs))

    def _run(self, run: str) -> bytes:
        if (lower := self._by_piece(run)) is None:
            return self._whole(run)
        return b"".join(map(self.pieces.__getitem__, self.split(lower)))


@functools.lru_cache(maxsize=1)
def _runs(key: str, content: bytes) -> Runs:
    return Runs(content)


def runs_of(content: bytes) -> Runs:
    """Built once per Python worker, which keeps what it remembers for its next task."""
    return _runs(hashlib.sha256(content).hexdigest(), content)


def write(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
          stripe_bytes: int = STRIPE_BYTES, index_rows: int = INDEX_ROWS) -> None:
    """Write the token files of all documents below ``path``, which must not exist."""
    spark = bounded_batches(docs.sparkSession)
    with open(tokenizer_path, "rb") as f:
        content = f.read()
    if not Runs(content).parted_by_white_space():
        raise ValueError(f"{tokenizer_path} joins tokens across white space; its texts can't be encoded run by run")
    content = spark.sparkContext.broadcast(content)  # a vocabulary file, a few MB
    id_type = docs.schema[id_col].dataType.simpleString()
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches):
        runs = runs_of(content.value)
        place = 0
        for batch in batches:
            packed = [runs.encode(t) + end for t in batch.column(1).to_pylist()]
            sizes = np.array([len(p) >> 2 for p in packed], dtype=np.int64)
            offsets = np.concatenate([[0], np.cumsum(sizes)])
            ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.frombuffer(b"".join(packed), "<i4")))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(place + offsets[:-1]), pa.array(sizes), ids], names=["doc_id", "place", "n_tokens", "ids"])
            place += int(offsets[-1])
        give_back()

    text = whole(text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("hash"), F.monotonically_increasing_id().alias("row"))
    keys = ["doc_id", "hash", "row"]
    in_order = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "text")
    encoded = in_order.mapInArrow(run, f"doc_id {id_type}, place bigint, n_tokens bigint, ids array<int>")
    out = encoded.select(F.spark_partition_id().alias("part"), "*").write
    for key, value in {
        "orc.stripe.size": stripe_bytes, "orc.row.index.stride": index_rows, "orc.create.index": "true",
        "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": BLOOM_ERROR,
        "orc.row.batch.size": CHECK_ROWS, "orc.rows.between.memory.checks": CHECK_ROWS,
    }.items():
        out = out.option(key, str(value))
    out.orc(f"{path}/tokens")
    written = _tokens(spark, path, id_type)
    sizes = written.groupBy("part").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("documents"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    sizes.withColumn("offset", F.coalesce(F.sum("tokens").over(before), F.lit(0))).write.orc(f"{path}/parts")


def _tokens(spark: SparkSession, path: str, id_type: str) -> DataFrame:
    schema = f"part int, doc_id {id_type}, place bigint, n_tokens bigint, ids array<int>"
    return spark.read.schema(schema).orc(f"{path}/tokens")


def read(spark: SparkSession, path: str, id_type: str = "bigint") -> DataFrame:
    """doc_id, start, n_tokens, ids of every document; filters on doc_id reach the files' metadata."""
    parts = spark.read.schema("part int, offset bigint").orc(f"{path}/parts")
    rows = _tokens(spark, path, id_type).join(parts, "part")
    return rows.select("doc_id", (F.col("offset") + F.col("place")).alias("start"), "n_tokens", "ids")


def checked(rows: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the checksum of each document's ids as little-endian unsigned 32-bit integers."""
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            lists = batch.column(3)
            values, offsets = lists.values.to_numpy().astype("<i4", copy=False), lists.offsets.to_numpy()
            sums = [zlib.crc32(values[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(sums, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    bounded_batches(rows.sparkSession)
    return rows.select("doc_id", "start", "n_tokens", "ids").mapInArrow(run, f"doc_id {id_type}, start bigint, n_tokens bigint, ids_crc32 bigint")
