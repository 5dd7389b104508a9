"""Toxicity by two class-conditional Kneser-Ney models with a shared backoff.

A text's score compares its length-normalised log-likelihoods under the toxic and the ordinary model. Each
class has discounted counts of its own, of word pairs and of words, by occurrences, each different text once:

    P(w | v, class) = (n(v w) - D)+ / n(v)  +  D kinds(v) / n(v) * A(w | v, class)
    A(w | v, class) = (n(w) - E)+ / N       +  E kinds / N       * S(w | v)

What the discounts take goes to one model that both classes share: S holds the pairs of both, backs off to
continuation counts (the number of different words before a word), and these to the number of documents of
the WHOLE corpus that hold the word. So a rare expression of one class is weighed against how often it is
met at all, and where nothing is known of a word the classes do not differ. All discounts are below 1, from
the counts of counts (n1 / (n1 + 2 n2)) of their level.

Labels are learned from EVERY different labelled text. A quarter of them, by hash, is kept from the counts
for the calibration: which part of every log-ratio is taken for chance (languages and topics are not evenly
spread over the classes, so common words differ a little, many times over), and a logistic fit that allows
for wrong labels, both from counts in narrow bins of the ratio. Nothing is chosen on held-out rows.

Words and pairs are 64-bit hashes. The model grows with the corpus, so it stays in tables, in blocks by ranges of
the hashes. Texts are coded in chunks of bounded size; each chunk asks every range for its own words and pairs, and
is scored with the counts that come back. Keys and counts travel packed, and texts are scored in rounds, so that
the disk holds little more than the corpus. No text is sent whole.

Defined cases: a null text counts as empty; an empty text has the score of no evidence; without labelled
rows, or with one class only (or one without words), every score is the share of toxic labels (0 if there
are none); labelled texts in which no word or pair repeats give scores like any other; a text that bears both
labels counts as toxic; texts of any length are read whole; equal texts get equal scores; repeated rows and
null ids come out as they came in; null labels are not learned; further columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.dedupe import FEW, split_repeated
from ..session import cut_lineage, cuts_released, scratch
from .common import bounded_batches, held_out, tidy, whole

# Parts of a log-ratio that may be taken for chance; the calibration picks one.
MARGINS = (0.0, 0.5, 1.0, 1.5, 2.0, 2.5, 3.0, 3.5, 4.0)
SHORT = 10.0  # added to the length, so that a few words alone are weak evidence
CHUNK, CHUNK_TEXTS = 2_000_000, 50_000  # words and texts after which a chunk ends
WORDS, CHARACTERS = 100_000, 12_000_000  # words of the model, and of learned text, in one range of hashes
ROUNDS = 4  # of the scoring, so that the disk holds what a part of the corpus asks for
BINS = 20_000  # of the ratios, for the calibration
# Of a word: documents that hold it, different words before it, its occurrences, different words after it, occurrences as a context.
COUNTS = ("held", "befores", "of0", "of1", "kinds", "kinds0", "kinds1", "after0", "after1")
# ASCII apart from letters and digits parts words; other characters belong to them.
APART = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256))


def words_of(text: str) -> np.ndarray:
    """Hashes of the lower-case words of a text, in order."""
    words = text.lower().encode().translate(APART).split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _pair_hash(before: np.ndarray, words: np.ndarray) -> np.ndarray:
    return ((before << np.uint64(17)) | (before >> np.uint64(47))) ^ words


@dataclass
class _Shared:
    """What all texts share of a model: how often each count is 1, 2 and above 0 (``_coc``), and the sums."""

    n: dict[str, int]

    def __post_init__(self):
        n = self.n
        self.discounts = tuple(_discount(n, k) for k in ("both", "n0", "n1"))  # of pairs: of both classes together and of each
        self.left = tuple(_discount(n, f"of{k}") * n[f"of{k}"] / n[f"all{k}"] for k in (0, 1))  # the classes' shares for the backoff

    def parts(self, held, befores, of0, of1, kinds, kinds0, kinds1, after0, after1) -> np.ndarray:
        """Of each word its shared backoff, its part in each class, what it leaves as a context, and how often it is one."""
        n, e = self.n, _discount(self.n, "befores")
        floor = (held + 0.5) / (n["held"] + 0.5 * (n["words"] + 1))  # shared: pairs of both classes, continuation counts, documents
        shared = np.maximum(befores - e, 0.0) / n["both"] + floor * (e * n["befores"] / n["both"])
        word = [np.maximum(of - _discount(n, f"of{k}"), 0.0) / n[f"all{k}"] for k, of in enumerate((of0, of1))]
        after = after0 + after1
        context = [np.where(a > 0, x * d / np.maximum(a, 1), 1.0) for x, d, a in zip((kinds, kinds0, kinds1), self.discounts, (after, after0, after1))]
        return np.array([shared, *word, *context, after, after0, after1], float)


@dataclass
class Model:
    """The model's tables and what all texts share.

    ``words`` has the ``COUNTS`` of each word, ``pairs`` those of each pair in each class; both lie in blocks.
    """

    word_blocks: _Blocks
    pair_blocks: _Blocks
    shared: _Shared
    margin: float = 0.0
    slope: float = 1.0
    base: float = 0.0

    @property
    def words(self) -> DataFrame:
        return self.word_blocks.rows()

    @property
    def pairs(self) -> DataFrame:
        return self.pair_blocks.rows()

    def ratios(self, w: np.ndarray) -> np.ndarray:
        """Log-ratio toxic to ordinary of each word after the one before it, for a short text."""
        coded = _Coded(w, np.array([len(w)]))
        known = self.words.where(F.col("word").isin(coded.wanted().view(np.int64).tolist())).toArrow()
        pairs = self.pairs.where(F.col("pair").isin(coded.pairs.view(np.int64).tolist())).toArrow()
        parts = self.shared.parts(*[known[c].to_numpy() for c in COUNTS])
        counts = [pairs[f"n{c}"].to_numpy() for c in (0, 1)]
        return coded.ratios(_unsigned(known, "word"), parts, _unsigned(pairs, "pair"), counts, self.shared.left, self.shared.discounts)


class _Coded:
    """Texts as one row of words: their hashes, where texts end, and each different pair once."""

    def __init__(self, words: np.ndarray, lengths: np.ndarray):
        self.words, self.lengths, self.before = words, lengths, _before(words, lengths)
        self.pairs, self.first, self.place = np.unique(_pair_hash(self.before, words), return_index=True, return_inverse=True)

    def wanted(self) -> np.ndarray:
        """Words whose rows of the model are needed; 0 stands before a text."""
        return _different(self.words, self.lengths, False)

    def ratios(self, words: np.ndarray, parts: np.ndarray, pairs: np.ndarray, counts: Sequence[np.ndarray], left, discounts) -> np.ndarray:
        """Log-ratio of each word after the one before it, from the model's rows for the words and pairs here."""
        order = np.argsort(words)
        words, none = words[order], len(words)  # what is not known has no part, and leaves all to the backoff
        shared, word0, word1, *context, after, after0, after1 = (np.append(p, x) for p, x in zip(parts[:, order], (0, 0, 0, 1, 1, 1, 1, 1, 1)))
        w, known = _find(words, self.words[self.first])
        v, seen = _find(words, self.before[self.first])
        w, v = np.where(known, w, none), np.where(seen, v, none)
        order = np.argsort(pairs)
        at, seen = _find(pairs[order], self.pairs)
        n = [np.zeros(len(self.pairs)) for _ in (0, 1)]
        for out, given in zip(n, counts):
            out[seen] = given[order][at[seen]]

        def top(n, d, after, context, rest):
            return np.maximum(n - d, 0) / np.maximum(after[v], 1) + context[v] * rest

        rest = np.where(known, top(n[0] + n[1], discounts[0], after, context[0], shared[w]), 1.0)  # of an unknown word only this is left
        p = [
            top(n[c], discounts[1 + c], of, context[1 + c], word[w] + left[c] * rest)
            for c, (of, word) in enumerate(((after0, word0), (after1, word1)))
        ]
        return np.log(p[1] / p[0])[self.place]

    def pooled(self, ratios: np.ndarray, margin: float) -> np.ndarray:
        """Length-normalised log-likelihood ratio of each text, without what may be chance; 0 for an empty one."""
        out = np.zeros(len(self.lengths))
        some = self.lengths > 0
        if some.any():
            parts = np.sign(ratios) * np.maximum(np.abs(ratios) - margin, 0)
            out[some] = np.add.reduceat(parts, (np.cumsum(self.lengths) - self.lengths)[some]) / (self.lengths[some] + SHORT)
        return out


def _before(words: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """What stands before each word, 0 before a text."""
    before = np.concatenate([np.zeros(1, np.uint64), words[:-1]]) if len(words) else words.copy()
    before[(np.cumsum(lengths) - lengths)[lengths > 0]] = 0
    return before


def _different(words: np.ndarray, lengths: np.ndarray, pairs: bool) -> np.ndarray:
    """The different pairs, or words and 0, in order."""
    keys = np.sort(_pair_hash(_before(words, lengths), words) if pairs else np.append(words, np.uint64(0)))
    return keys[np.append(np.ones(min(len(keys), 1), bool), keys[1:] != keys[:-1])]


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(wanted), np.intp), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def _unsigned(table: pa.Table, name: str) -> np.ndarray:
    return table[name].to_numpy().view(np.uint64)


def _chunks(batches) -> Iterator[tuple[list[pa.Array], list[np.ndarray]]]:
    """First columns and words of the texts (last column), in chunks of bounded size."""
    columns, words, n = [], [], 0
    for batch in batches:
        for k, text in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
            columns.append(batch.column(0).slice(k, 1))
            words.append(words_of(text))
            n += len(words[-1])
            if n >= CHUNK or len(words) >= CHUNK_TEXTS:
                yield columns, words
                columns, words, n = [], [], 0
    if words:
        yield columns, words


def _packed(array: np.ndarray) -> bytes:
    """The first bytes of all numbers, then the second ones and so on, compressed."""
    planes = np.ascontiguousarray(array).view(np.uint8).reshape(-1, array.itemsize).T
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpacked(data: bytes, kind, n: int) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(data, n * size, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(size, n).T).view(kind).reshape(n)


def _packed_keys(keys: np.ndarray) -> bytes:
    return _packed(np.diff(keys, prepend=np.uint64(0)))


def _unpacked_keys(data: bytes, n: int) -> np.ndarray:
    return np.cumsum(_unpacked(data, np.uint64, n), dtype=np.uint64)


def _slots_of(keys: np.ndarray, slots: int) -> np.ndarray:
    """The range of hashes that a key is in; it grows with the key."""
    return ((keys >> np.uint64(32)) * np.uint64(slots)) >> np.uint64(32)


def _ranges(keys: np.ndarray, slots: int) -> list[tuple[int, int]]:
    """Where the keys of each slot begin and end, in order."""
    ends = np.searchsorted(_slots_of(keys, slots), np.arange(slots + 1, dtype=np.uint64)).tolist()
    return list(zip(ends[:-1], ends[1:]))


SLOT = "CAST(shiftrightunsigned(shiftrightunsigned({key}, 32) * {slots}L, 32) AS INT)"  # the same in Spark


@dataclass
class _Blocks:
    """A table of the model by ranges of its 64-bit key: ``packed`` has a row (slot, n, keys, values) per range."""

    packed: DataFrame
    slots: int
    key: str
    columns: Sequence[str]
    kind: type

    @staticmethod
    def of(table: DataFrame, key: str, columns: Sequence[str], kind: type, slots: int) -> _Blocks:
        def run(rows: pa.Table) -> pa.Table:
            keys = _unsigned(rows, "key")
            order = np.argsort(keys)
            values = np.concatenate([rows[c].to_numpy().astype(kind)[order] for c in columns])
            row = {"slot": rows["slot"][0].as_py(), "n": len(keys), "keys": _packed_keys(keys[order]), "values": _packed(values)}
            return pa.Table.from_pylist([row], _BLOCK)

        rows = table.select(F.expr(SLOT.format(key=key, slots=slots)).alias("slot"), F.col(key).alias("key"), *columns)
        return _Blocks(cut_lineage(rows.groupBy("slot").applyInArrow(run, "slot int, n int, keys binary, values binary"), keep=True), slots, key, columns, kind)

    def rows(self) -> DataFrame:
        kind, columns = self.kind, self.columns

        def run(batches):
            for batch in batches:
                for row in batch.to_pylist():
                    values = _unpacked(row["values"], kind, row["n"] * len(columns)).reshape(len(columns), -1)
                    yield from _batches([_unpacked_keys(row["keys"], row["n"]).view(np.int64), *values], names)

        names = [self.key, *columns]
        of = "double" if kind is np.float64 else "bigint"
        return self.packed.mapInArrow(run, f"{self.key} bigint, " + ", ".join(f"{c} {of}" for c in columns))

    def answers(self, coded: DataFrame, is_pair: bool) -> DataFrame:
        """For each chunk and range: which of the chunk's keys there are known (a bit each), and their values."""
        slots, kind, width = self.slots, self.kind, len(self.columns)

        def wanted(batches):
            for batch in batches:
                for row in batch.to_pylist():
                    keys = _different(*_decoded(row, row["texts"]), is_pair)
                    blocks = [
                        {"slot": s, "chunk": row["chunk"], "n": e - b, "keys": _packed_keys(keys[b:e])}
                        for s, (b, e) in enumerate(_ranges(keys, slots)) if e > b
                    ]
                    yield pa.RecordBatch.from_pylist(blocks, _ASKED)

        def run(asked: pa.Table, known: pa.Table) -> pa.Table:
            block = known.select(["n", "keys", "values"]).to_pylist() or [{"n": 0, "keys": _packed_keys(np.zeros(0, np.uint64)), "values": _packed(np.zeros(0, kind))}]
            n = block[0]["n"]
            keys, values = _unpacked_keys(block[0]["keys"], n), _unpacked(block[0]["values"], kind, n * width).reshape(width, n)
            out = []
            for k in range(asked.num_rows):
                row = asked.slice(k, 1).to_pylist()[0]
                at, seen = _find(keys, _unpacked_keys(row["keys"], row["n"]))
                got = np.concatenate(values[:, at[seen]])
                mask = pa.compress(np.packbits(seen).tobytes(), codec="zstd", asbytes=True)
                out.append({"chunk": row["chunk"], "is_pair": is_pair, "slot": row["slot"], "n": row["n"], "found": int(seen.sum()), "mask": mask, "values": _packed(got)})
            return pa.Table.from_pylist(out, _ANSWER)

        asked = coded.select("chunk", "kinds", "n", "vocabulary", "stream", "lengths", F.size("ids").alias("texts"))
        asked = asked.mapInArrow(wanted, "slot int, chunk bigint, n int, keys binary")
        schema = "chunk bigint, is_pair boolean, slot int, n int, found int, mask binary, values binary"
        return asked.groupBy("slot").cogroup(self.packed.groupBy("slot")).applyInArrow(run, schema)


@dataclass
class _Columns:
    """Reads answers of tables with so many columns of a kind."""

    width: int
    kind: type

    def found(self, answers: pa.Table, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The known ones of a chunk's keys and a row of values for each column, from the chunk's answers."""
        masks, values = [np.zeros(0, bool)], [np.zeros((self.width, 0), self.kind)]
        for row in answers.sort_by("slot").to_pylist():
            bits = np.frombuffer(pa.decompress(row["mask"], (row["n"] + 7) // 8, codec="zstd", asbytes=True), np.uint8)
            masks.append(np.unpackbits(bits, count=row["n"]).astype(bool))
            values.append(_unpacked(row["values"], self.kind, row["found"] * self.width).reshape(self.width, -1))
        return keys[np.concatenate(masks)], np.concatenate(values, axis=1)


_BLOCK = pa.schema([("slot", pa.int32()), ("n", pa.int32()), ("keys", pa.binary()), ("values", pa.binary())])
_COUNTED = pa.schema([*_BLOCK, ("kinds", pa.int32()), ("befores", pa.binary()), ("place", pa.binary())])
_ASKED = pa.schema([("slot", pa.int32()), ("chunk", pa.int64()), ("n", pa.int32()), ("keys", pa.binary())])
_ANSWER = pa.schema([
    ("chunk", pa.int64()), ("is_pair", pa.bool_()), ("slot", pa.int32()), ("n", pa.int32()), ("found", pa.int32()), ("mask", pa.binary()), ("values", pa.binary()),
])


def _coded(rows: DataFrame) -> DataFrame:
    """Chunks of (id, text) rows: ids, the different words, frequent ones first, each text's words by their number, the lengths."""

    def run(batches):
        part = TaskContext.get().partitionId()
        for k, (ids, words) in enumerate(_chunks(batches)):
            vocabulary, stream, n = np.unique(np.concatenate(words), return_inverse=True, return_counts=True)
            order = np.argsort(-n, kind="stable")
            number = np.empty(len(order), np.int32)
            number[order] = np.arange(len(order), dtype=np.int32)
            lengths = np.array([len(w) for w in words], np.int32)
            ids = pa.concat_arrays(ids)
            columns = [
                pa.array([(part << 32) + k], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                pa.array([len(vocabulary)], pa.int32()), pa.array([len(stream)], pa.int32()), pa.array([vocabulary[order].tobytes()], pa.binary()),
                pa.array([_packed(number[stream])], pa.binary()), pa.array([_packed(lengths)], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["chunk", "ids", "kinds", "n", "vocabulary", "stream", "lengths"])

    kind = rows.schema["id"].dataType.simpleString()
    return cut_lineage(rows.mapInArrow(run, f"chunk bigint, ids array<{kind}>, kinds int, n int, vocabulary binary, stream binary, lengths binary"))


def _decoded(row: dict, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Words and lengths of the texts of a chunk."""
    words = np.frombuffer(row["vocabulary"], np.uint64)[_unpacked(row["stream"], np.int32, row["n"])]
    return words, _unpacked(row["lengths"], np.int32, texts)


def _pooled_ratios(rows: DataFrame, model: Model, margins: Sequence[float], rounds: int = 1) -> DataFrame:
    """(id, m0, m1, ...): the pooled ratio of each (id, text) row for each margin.

    Every round takes a part of the rows by the hash of the id, and what it wrote in between goes before the
    next one, so the disk holds the shuffles of one round only.
    """
    spark, path = rows.sparkSession, scratch(rows.sparkSession)
    names = [f"m{k}" for k in range(len(margins))]
    schema = ", ".join([f"id {rows.schema['id'].dataType.simpleString()}", *[f"{m} double" for m in names]])
    shared, word_blocks, pair_blocks = model.shared, model.word_blocks, model.pair_blocks
    word_columns, pair_columns = (_Columns(len(b.columns), b.kind) for b in (word_blocks, pair_blocks))

    def scored(given: pa.Table, answers: pa.Table) -> pa.Table:
        ids = given["ids"].combine_chunks().flatten()
        chunk = _Coded(*_decoded(given.select(["kinds", "n", "vocabulary", "stream", "lengths"]).to_pylist()[0], len(ids)))
        words, of_words = word_columns.found(answers.filter(pc.invert(answers["is_pair"])), chunk.wanted())
        pairs, counts = pair_columns.found(answers.filter(answers["is_pair"]), chunk.pairs)
        ratios = chunk.ratios(words, shared.parts(*of_words), pairs, counts, shared.left, shared.discounts)
        return pa.table([ids, *[pa.array(chunk.pooled(ratios, m)) for m in margins]], names=["id", *names])

    for k in range(rounds):
        with cuts_released(spark):
            coded = _coded(rows.where(F.pmod(F.xxhash64("id", F.lit(3)), F.lit(rounds)) == k) if rounds > 1 else rows)
            answers = cut_lineage(word_blocks.answers(coded, False))
            tidy(spark)
            answers = answers.unionByName(cut_lineage(pair_blocks.answers(coded, True)))
            tidy(spark)
            out = coded.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(scored, schema)
            out.write.option("compression", "zstd").mode("append").parquet(path)
            del coded, answers, out
        tidy(spark)
    return spark.read.schema(schema).parquet(path)


def _sample(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, toxic_col: str, bounds: tuple[int, int] | None = None
) -> tuple[DataFrame, dict[int, int]]:
    """(toxic, text, tuning) of the different labelled texts, and the labelled rows of each class.

    ``bounds`` is for trials: so many texts of each class, drawn by the order of their hashes.
    """
    known = labels.where(F.col(toxic_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col))
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(toxic_col).cast("int")).alias("toxic"))
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = docs.select(F.col(id_col).alias("id"), whole(text_col).alias("text")).withColumn("hash", F.xxhash64("text"))
    different = rows.select("id", "hash").join(known, "id").groupBy("hash").agg(F.max("toxic").alias("toxic"), F.min("id").alias("id"))
    if bounds:
        order = F.xxhash64("hash", F.lit(5))
        different = reduce(DataFrame.unionByName, [different.where(F.col("toxic") == c).orderBy(order, "hash").limit(bounds[c]) for c in (0, 1)])
    different = cut_lineage(different)
    # rows of other ids are left out before the texts are shuffled
    _, rows = split_repeated(rows, ["id"], different.select(F.xxhash64("id").alias("_rh")), FEW + 1)  # as marks, however few: a join would shuffle all
    texts = rows.join(different, ["hash", "id"]).dropDuplicates(["hash", "id"])
    tuning = F.pmod(F.xxhash64("text", F.lit(9)), F.lit(4)) == 0
    return texts.select("toxic", "text", tuning.alias("tuning")), sizes


def _class_counts(sample: DataFrame) -> tuple[DataFrame, int]:
    """Occurrences of each pair in the texts of each class, in blocks by ranges of the pairs' hashes, and the number of these.

    A block has the pairs, what stands before each (0 before a text's first word), and the counts n0 and n1.
    """
    size = sample.agg(F.sum(F.length("text"))).first()[0] or 0
    slots = max(2 * sample.sparkSession.sparkContext.defaultParallelism, size // CHARACTERS)

    def block(slot: int, pairs: np.ndarray, before: np.ndarray, counts: list[np.ndarray]) -> dict:
        kinds, place = np.unique(before, return_inverse=True)
        return {
            "slot": slot, "n": len(pairs), "keys": _packed_keys(pairs), "values": _packed(np.concatenate(counts)),
            "kinds": len(kinds), "befores": _packed_keys(kinds), "place": _packed(place.astype(np.int32)),
        }

    def run(batches):
        for toxic, words in _chunks(batches):
            toxic = pa.concat_arrays(toxic).to_numpy()
            lengths = np.array([len(w) for w in words])
            chunk = _Coded(np.concatenate(words), lengths)
            of = np.repeat(toxic, lengths)
            counts = [np.bincount(chunk.place[of == c], minlength=len(chunk.pairs)) for c in (0, 1)]
            before = chunk.before[chunk.first]
            parts = [(s, slice(b, e)) for s, (b, e) in enumerate(_ranges(chunk.pairs, slots)) if e > b]
            yield pa.RecordBatch.from_pylist([block(s, chunk.pairs[k], before[k], [c[k] for c in counts]) for s, k in parts], _COUNTED)

    def merged(blocks: pa.Table) -> pa.Table:
        got = [_counts_of(row) for row in blocks.to_pylist()]
        pairs, before, *counts = (np.concatenate(x) for x in zip(*got))
        order = np.argsort(pairs, kind="stable")
        pairs = pairs[order]
        starts = np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1]))
        counts = [np.add.reduceat(c[order], starts) for c in counts]
        return pa.Table.from_pylist([block(blocks["slot"][0].as_py(), pairs[starts], before[order][starts], counts)], _COUNTED)

    schema = "slot int, n int, keys binary, values binary, kinds int, befores binary, place binary"
    found = sample.select("toxic", "text").mapInArrow(run, schema)
    return cut_lineage(found.groupBy("slot").applyInArrow(merged, schema)), slots


def _counts_of(row: dict) -> tuple[np.ndarray, ...]:
    """Pairs, what stands before each, and the counts in each class, of a block."""
    before = _unpacked_keys(row["befores"], row["kinds"])[_unpacked(row["place"], np.int32, row["n"])]
    return _unpacked_keys(row["keys"], row["n"]), before, *_unpacked(row["values"], np.int64, 2 * row["n"]).reshape(2, -1)


def _count_rows(blocks: DataFrame) -> DataFrame:
    """(before, word, n0, n1) of the blocks."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                pairs, before, *counts = _counts_of(row)
                word = _pair_hash(before, pairs)  # takes back what it does
                yield from _batches([before.view(np.int64), word.view(np.int64), *counts], ["before", "word", "n0", "n1"])

    return blocks.mapInArrow(run, "before bigint, word bigint, n0 bigint, n1 bigint")


def _batches(columns: Sequence[np.ndarray], names: list[str], n: int = 100_000) -> Iterator[pa.RecordBatch]:
    for k in range(0, len(columns[0]), n):
        yield pa.RecordBatch.from_arrays([pa.array(c[k : k + n]) for c in columns], names=names)


def _document_counts(docs: DataFrame, text_col: str) -> DataFrame:
    """(word, held): the number of documents of the corpus that hold the word."""

    def run(batches):
        for _, words in _chunks(batches):
            different, n = np.unique(np.concatenate([np.unique(w) for w in words]), return_counts=True)
            yield from _batches([different.view(np.int64), n], ["word", "held"])

    found = docs.select(F.lit(0).alias("id"), whole(text_col).alias("text")).mapInArrow(run, "word bigint, held bigint")
    return found.groupBy("word").agg(F.sum("held").alias("held"))


def _coc(name: str, count: Column) -> list[Column]:
    """How many counts of a level are 1, 2 and above 0."""
    return [F.count_if(count == 1).alias(f"{name}_1"), F.count_if(count == 2).alias(f"{name}_2"), F.count_if(count > 0).alias(name)]


def _discount(counts: dict, name: str) -> float:
    """Absolute discount of a level, from how many of its counts are 1 and 2."""
    once, twice = counts[f"{name}_1"], counts[f"{name}_2"]
    return once / (once + 2 * twice) if once else 0.5


def _model(blocks: DataFrame, slots: int, docs: DataFrame, text_col: str) -> Model | None:
    """The two models from pair counts and the corpus counts of words. None if a class has no word."""
    c, both, spark = F.col, F.col("n0") + F.col("n1"), docs.sparkSession
    counted = _count_rows(blocks)
    sums = [F.sum(f"n{k}").alias(f"all{k}") for k in (0, 1)]
    n = counted.agg(*sums, *_coc("both", both), *_coc("n0", c("n0")), *_coc("n1", c("n1"))).first().asDict()
    if not n["all0"] or not n["all1"]:
        return None
    second = counted.groupBy("word").agg(F.count(F.lit(1)).alias("befores"), F.sum("n0").alias("of0"), F.sum("n1").alias("of1"))
    first = counted.groupBy(c("before").alias("word")).agg(
        F.count(F.lit(1)).alias("kinds"), *[F.sum(f"n{k}").alias(f"after{k}") for k in (0, 1)], *[F.count_if(c(f"n{k}") > 0).alias(f"kinds{k}") for k in (0, 1)],
    )
    words = cut_lineage(second.join(first, "word", "full_outer").na.fill(0))
    tidy(spark)
    held = cut_lineage(_document_counts(docs, text_col))
    tidy(spark)
    n["held"] = held.agg(F.sum("held")).first()[0] or 0
    words = words.join(held, "word", "left").na.fill(0)
    n |= words.agg(F.count(F.lit(1)).alias("words"), *_coc("befores", c("befores")), *_coc("of0", c("of0")), *_coc("of1", c("of1"))).first().asDict()
    least = 2 * spark.sparkContext.defaultParallelism
    word_blocks = _Blocks.of(words, "word", COUNTS, np.int64, max(least, n["words"] // WORDS))
    pair_blocks = _Blocks(cut_lineage(blocks.select("slot", "n", "keys", "values"), keep=True), slots, "pair", ("n0", "n1"), np.int64)
    return Model(word_blocks, pair_blocks, _Shared(n))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", toxic_col: str = "toxic") -> Model | float:
    """The model, or the share of toxic labels where there is nothing to compare."""
    spark = bounded_batches(docs.sparkSession)
    tidy(spark)
    with cuts_released(spark):  # the model's blocks stay
        sample, sizes = _sample(docs, labels, id_col, text_col, toxic_col)
        if not sizes.get(0) or not sizes.get(1):
            return float(sizes.get(1, 0) > 0)
        sample = cut_lineage(sample)
        tidy(spark)
        model = _model_of(sample, docs, text_col)
        if model is None:
            return sizes[1] / (sizes[0] + sizes[1])
        _calibrate(model, sample.where("tuning"), sizes)
    tidy(spark)
    return model


def _model_of(sample: DataFrame, docs: DataFrame, text_col: str) -> Model | None:
    """The model before its calibration; the tables it is made of go when it is done."""
    spark = docs.sparkSession
    with cuts_released(spark):
        blocks, slots = _class_counts(sample.where("NOT tuning"))
        tidy(spark)
        model = _model(blocks, slots, docs, text_col)
    tidy(spark)
    return model


def _binned(model: Model, tuning: DataFrame) -> pa.Table:
    """(k, toxic, x, n): how many texts of each class have a ratio in each bin of the k-th margin, x on average.

    Up to as many texts as there are bins go by their own ratios.
    """
    got = _pooled_ratios(tuning.select(F.col("toxic").alias("id"), "text"), model, MARGINS)
    each = got.select(F.col("id").alias("toxic"), F.posexplode(F.array(*[f"m{k}" for k in range(len(MARGINS))])).alias("k", "x"))
    if got.count() <= BINS:
        return each.groupBy("k", "toxic", "x").agg(F.count(F.lit(1)).alias("n")).toArrow()
    ends = each.groupBy("k").agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    place = F.when(F.col("hi") > F.col("lo"), F.floor((F.col("x") - F.col("lo")) / (F.col("hi") - F.col("lo")) * BINS)).otherwise(0)
    bins = each.join(F.broadcast(ends), "k").groupBy("k", "toxic", place.alias("bin")).agg(F.avg("x").alias("x"), F.count(F.lit(1)).alias("n"))
    return bins.select("k", "toxic", "x", "n").toArrow()  # bounded by the bins


def _calibrate(model: Model, tuning: DataFrame, sizes: dict[int, int]) -> None:
    """Margin, then slope and base by logistic regression; texts weigh as many as the rows they stand for."""
    got = _binned(model, tuning)
    k, y, x, n = (got[name].to_numpy().astype(float) for name in ("k", "toxic", "x", "n"))
    share = sizes[1] / (sizes[0] + sizes[1])
    if not 0 < y.sum() < len(y):
        model.slope, model.base = 10.0, float(np.log(share / (1 - share)))
        return
    best = max(range(len(MARGINS)), key=lambda m: (round(_ordered(x[k == m], y[k == m], n[k == m]), 6), -m))
    model.margin, x, y, n = MARGINS[best], x[k == best], y[k == best], n[k == best]
    order = np.lexsort((y, x))
    y, x, n = y[order], x[order], n[order]
    weight = np.where(y == 1, sizes[1] / (n * y).sum(), sizes[0] / (n * (1 - y)).sum())
    model.slope, model.base = _noisy_logistic(x, y, n * weight * (n.sum() / (n * weight).sum()), n)


def _ordered(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> float:
    """How often a toxic text has the higher ratio than an ordinary one, ties by half; a point stands for ``n`` texts."""
    values, place = np.unique(x, return_inverse=True)
    toxic, ordinary = (np.bincount(place, n * (y == c), len(values)) for c in (1, 0))
    return float((toxic * (np.cumsum(ordinary) - ordinary / 2)).sum() / (toxic.sum() * ordinary.sum()))


def _quantile(x: np.ndarray, n: np.ndarray | None, q):
    """``np.quantile`` of points that stand for ``n`` rows each, one by default."""
    order = np.argsort(x)
    x, upto = x[order], np.cumsum(np.ones(len(x)) if n is None else n[order])
    place = np.asarray(q) * (upto[-1] - 1)
    low = np.floor(place)
    below, above = (x[np.minimum(np.searchsorted(upto, at, "right"), len(x) - 1)] for at in (low, np.ceil(place)))
    return below + (above - below) * (place - low)


def _noisy_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, n: np.ndarray | None = None, rounds: int = 60) -> tuple[float, float]:
    """Slope and base of P(toxic | x) where labels of either class may be wrong at a rate of their own.

    Expectation maximisation over what a text truly is; it starts from the best single cut.
    """
    cuts = np.unique(_quantile(x, n, np.linspace(0.02, 0.98, 97)))
    hits = [(weight * y * (x > c)).sum() / (weight * y).sum() - (weight * (1 - y) * (x > c)).sum() / (weight * (1 - y)).sum() for c in cuts]
    spread = max(float(_quantile(x, n, 0.9) - _quantile(x, n, 0.1)), 1e-6)
    beta = np.array([8.0 / spread, -8.0 / spread * cuts[int(np.argmax(hits))]])
    missed, false = 0.1, 0.02
    design = np.stack([x, np.ones_like(x)], axis=1)
    top = 400.0 / spread
    for _ in range(rounds):
        p = _logistic(design @ beta)
        if_toxic = p * np.where(y == 1, 1 - missed, missed)
        q = if_toxic / (if_toxic + (1 - p) * np.where(y == 1, false, 1 - false))
        missed = float(np.clip((weight * q * (1 - y)).sum() / max((weight * q).sum(), 1e-9), 0.005, 0.45))
        false = float(np.clip((weight * (1 - q) * y).sum() / max((weight * (1 - q)).sum(), 1e-9), 0.005, 0.45))
        for _ in range(5):
            p = _logistic(design @ beta)
            slope = design.T @ (weight * (q - p)) - np.array([1e-4 * beta[0] * spread**2, 0])
            curve = (design * (weight * p * (1 - p))[:, None]).T @ design + np.diag([1e-4 * spread**2, 1e-6])
            move = np.linalg.solve(curve, slope)
            beta = beta + move / max(1.0, abs(move[0]) * spread / 20)
            beta[0] = np.clip(beta[0], 0.1 / spread, top)
    return float(beta[0]), float(beta[1])


def _logistic(v: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(v, -30, 30)))


def score(docs: DataFrame, model: Model | float, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, score and predicted of every whole text."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), whole(text_col).alias("text"))
    if isinstance(model, float):
        out = rows.select("id", F.lit(model).alias("score"))
    else:
        at = F.col("m0") * model.slope + model.base
        bounded = F.greatest(F.least(at, F.lit(30.0)), F.lit(-30.0))
        out = _pooled_ratios(rows, model, [model.margin], ROUNDS).select("id", (1 / (1 + F.exp(-bounded))).alias("score"))
    return out.select(F.col("id").alias(id_col), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
