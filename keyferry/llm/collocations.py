"""Phrases of a language whose words stand together, mined with stripes.

A stripe is what a prefix of words is followed by: an associative counter from the next word to its
occurrences. The empty prefix has the words themselves, so four levels of stripes hold every phrase of up to
four words. Tasks gather stripes of their texts, the shuffle brings stripes of one prefix together and they
are merged word by word. From the merged stripes come the extensions (entries), the totals of prefixes
(entries one level up; of the empty one, the sum) and the largest extension of a prefix, by which a phrase
is found to be part of a longer one.

A phrase can only reach ``least`` occurrences if the phrases it holds do. So a level counts a prefix only
if the level before found it often enough, and a next word only if the phrase without the first word was.
That is asked of a bitmap of fixed size (``bits``) of the frequent phrases' hashes: a wrong hit costs a
counter that ends below ``least``, nothing is ever missed, whatever the size of the input.

A prefix with ``1 / HOT`` or more of all words (there are at most ``HOT``) has its stripes cut by the hash
of the next word, the empty prefix always; no key holds more than a small share of the rows.

Defined cases: null texts are empty and give nothing, a null language is ``und``; repeated rows count each
time; ties end with the phrase in byte order; texts of any length are counted whole; ids and further
columns are ignored; an empty table or one without frequent phrases gives an empty result.
Memory in a task: up to ``HELD`` different windows and ``NUMBERED`` words, one merged stripe, the bitmap,
and texts or stripes of ``TEXT_BLOCK`` characters or ``STRIPE_BLOCK`` bytes, which are worked on at once.
"""

from __future__ import annotations

from array import array
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import bounded_batches, give_back, whole

SIZES = 4
HOT, HOT_PARTS, FIRST_PARTS = 2000, 64, 4096
HELD = 3_000_000  # windows a task gathers before it hands stripes on; 24 bytes each
NUMBERED = 500_000  # words a task numbers
FRESH = 1_500_000
TEXT_BLOCK, STRIPE_BLOCK = 4_000_000, 8 << 20
ROWS = 5000  # to an Arrow batch

UPPER = bytes(range(65, 91))
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
BYTES = bytes.maketrans(UPPER + PIECE_ENDS + b"\t", UPPER.lower() + b"\n" * len(PIECE_ENDS) + b" ")
BLANK, END = b" \n"  # what BYTES leaves between words
MIX = np.uint64(0x9E3779B97F4A7C15)  # an odd multiplier with well-spread bits
RAW = "lang string, prefix string, part int, words string, counts binary"
RAW_NAMES = [f.split()[0] for f in RAW.split(", ")]
MERGED = "lang string, prefix string, total bigint, words array<string>, counts array<bigint>"


def _word_hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, 42)


def _places(lang: str, words: list[np.ndarray], bits: int) -> np.ndarray:
    """Bit of each phrase, from the hashes of its words."""
    h = np.full(len(words[0]), _word_hash(lang.encode()), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for w in words:
            h = (h ^ w) * MIX
            h ^= h >> np.uint64(29)
    return (h >> np.uint64(64 - bits)).astype(np.int64)


def _split(texts: list[str]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The different words of texts, the place of each word among them, and before which words a piece ends."""
    data = "\n".join(texts).encode().translate(BYTES)
    raw = np.frombuffer(data, np.uint8)
    edges = np.flatnonzero(np.diff((raw != BLANK) & (raw != END), prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    offsets = np.concatenate([[0], np.cumsum(ends - starts)])
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(data.translate(None, b" \n"))]
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), buffers).dictionary_encode()
    return words.dictionary.to_numpy(zero_copy_only=False).tolist(), words.indices.to_numpy(), np.searchsorted(starts, np.flatnonzero(raw == END))


def _merged(windows: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Windows in order, each once, with the sum of their counts, or how often they came."""
    n, size = windows.shape
    if not n:
        return windows, np.empty(0, np.int64)
    order = None
    if size > 2:
        order = np.lexsort(windows.T[::-1])
        windows = windows[order]
        new = (windows[1:] != windows[:-1]).any(axis=1)
    else:
        key = windows[:, -1].astype(np.int64)
        if size == 2:
            key |= windows[:, 0].astype(np.int64) << 32
        if counts is None:
            key.sort()
        else:
            order = np.argsort(key)
            key = key[order]
        new = key[1:] != key[:-1]
    starts = np.concatenate([[0], np.flatnonzero(new) + 1])
    if size > 2:
        windows = windows[starts]
    else:
        key = key[starts]
        windows = np.stack([key >> 32, key & 0xFFFFFFFF][2 - size :], axis=1).astype(np.int32)
    return windows, np.diff(starts, append=n) if counts is None else np.add.reduceat(counts[order], starts)


class Stripes:
    """Stripes of one language for prefixes of ``size - 1`` words, gathered from texts.

    A window is a row of word numbers, the last one the next word.
    """

    def __init__(self, lang: str, size: int, frequent: np.ndarray | None, bits: int):
        self.lang, self.size, self.frequent, self.bits = lang, size, frequent, bits
        self.hashes = array("Q", [0])
        self.number: defaultdict[bytes, int] = defaultdict(None, {b"": 0})
        self.number.default_factory = self.number.__len__
        self.windows, self.counts = np.empty((0, size), np.int32), np.empty(0, np.int64)
        self.fresh: list[np.ndarray] = []
        self.n_fresh = 0

    def add(self, texts: list[str]) -> None:
        words, at, borders = _split(texts)
        if not words:
            return
        numbers = np.insert(self._numbers(words)[at], borders, 0)
        self.fresh.append(self._windows(numbers))
        self.n_fresh += len(self.fresh[-1])
        if self.n_fresh > FRESH:
            self.settle()

    def _numbers(self, words: list[bytes]) -> np.ndarray:
        """Numbers of different words, as they come; 0 is a border of pieces."""
        known = len(self.number)
        numbers = np.fromiter(map(self.number.__getitem__, words), np.int32, len(words))
        new = [words[k] for k in np.flatnonzero(numbers >= known).tolist()]
        self.hashes.frombytes(np.fromiter(map(_word_hash, new), np.uint64, len(new)).tobytes())
        return numbers

    def _windows(self, numbers: np.ndarray) -> np.ndarray:
        """Windows of a run of pieces, which number 0 parts, that may be frequent."""
        size = self.size
        if size == 1:
            return numbers[numbers > 0][:, None]
        n = len(numbers) - size + 1
        if n < 1:
            return np.empty((0, size), np.int32)
        runs = [numbers[k : k + n + 1] for k in range(size - 1)]
        whole_run = np.logical_and.reduce([r > 0 for r in runs])
        hashes = np.frombuffer(self.hashes, np.uint64)
        at = np.flatnonzero(whole_run)
        places = _places(self.lang, [hashes[r[at]] for r in runs], self.bits)
        alive = np.zeros(n + 1, bool)
        alive[at] = (self.frequent[places >> 3] >> (places & 7).astype(np.uint8)) & 1 == 1
        at = np.flatnonzero(alive[:-1] & alive[1:])
        return np.stack([*[r[at] for r in runs], runs[-1][at + 1]], axis=1)

    def settle(self) -> None:
        if not self.fresh:
            return
        windows, counts = _merged(np.concatenate(self.fresh))
        if len(self.counts):
            windows, counts = _merged(np.concatenate([self.windows, windows]), np.concatenate([self.counts, counts]))
        self.windows, self.counts = windows, counts
        self.fresh, self.n_fresh = [], 0

    def full(self) -> tuple[int, int]:
        return len(self.counts), len(self.number)

    def batches(self, hot: set[tuple[str, str]]):
        """(lang, prefix, part, words, counts): stripes with words joined by blanks and packed counts."""
        self.settle()
        n, size = len(self.counts), self.size
        if not n:
            return
        prefixes, last, spelled = self.windows[:, :-1], self.windows[:, -1], pa.array([*self.number], pa.string())
        new = np.concatenate([[True], (prefixes[1:] != prefixes[:-1]).any(axis=1)])
        lead = prefixes[new]
        if size == 1:
            prefix, parts = pa.array([""]), np.array([FIRST_PARTS])
        else:
            prefix = pc.binary_join_element_wise(*[spelled.take(pa.array(k)) for k in lead.T], " ")
            often = pc.is_in(prefix, pa.array([p for lang, p in hot if lang == self.lang], pa.string()))
            parts = np.where(often.to_numpy(zero_copy_only=False), HOT_PARTS, 1)
        stripe = np.cumsum(new) - 1
        part = (np.frombuffer(self.hashes, np.uint64)[last] % parts.astype(np.uint64)[stripe]).astype(np.int64)
        counts = self.counts
        if (parts > 1).any():
            order = np.lexsort((part, stripe))
            stripe, part, last, counts = stripe[order], part[order], last[order], counts[order]
            new = np.concatenate([[True], (np.diff(stripe) != 0) | (np.diff(part) != 0)])
        starts = np.append(np.flatnonzero(new), n)
        for k in range(0, len(starts) - 1, ROWS):
            some = starts[k : k + ROWS + 1]
            at, a, b = some[:-1], some[0], some[-1]
            cuts = (some - a).astype(np.int32)
            words = pa.ListArray.from_arrays(pa.array(cuts), spelled.take(pa.array(last[a:b])))
            packed = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(cuts * 8), pa.py_buffer(counts[a:b].tobytes())])
            columns = [pa.repeat(self.lang, len(at)), prefix.take(pa.array(stripe[at])), pa.array(part[at], pa.int32()), pc.binary_join(words, " "), packed]
            yield pa.RecordBatch.from_arrays(columns, names=RAW_NAMES)

    def rows(self, hot: set[tuple[str, str]]):
        """The same, row by row."""
        for batch in self.batches(hot):
            yield from zip(*[c.to_pylist() for c in batch.columns])


def _gather(size: int, frequent, hot, bits: int):
    """Texts of a task to stripes."""

    def run(batches):
        bitmap = None if frequent is None else np.frombuffer(frequent.value, np.uint8)
        often = set() if hot is None else hot.value
        held: dict[str, Stripes] = {}

        texts: dict[str, list[str]] = {}
        n_texts = 0

        def count():
            for lang, some in texts.items():
                if lang not in held:
                    held[lang] = Stripes(lang, size, bitmap, bits)
                held[lang].add(some)
            texts.clear()

        def out():
            for s in held.values():
                yield from s.batches(often)
            held.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                texts.setdefault(lang, []).append(text)
                n_texts += len(text)
            if n_texts < TEXT_BLOCK:
                continue
            count()
            n_texts = 0
            windows, words = map(sum, zip(*[s.full() for s in held.values()]))
            if windows > HELD or words > NUMBERED:
                yield from out()
        count()
        yield from out()
        give_back()

    return run


def _packed(counts: pa.Array) -> np.ndarray:
    """The counts of stripes, one after the other."""
    cuts = np.frombuffer(counts.buffers()[1], np.int32)[counts.offset : counts.offset + len(counts) + 1]
    return np.frombuffer(counts.buffers()[2], np.int64, (cuts[-1] - cuts[0]) // 8, cuts[0])


def _summed(rows: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray, pa.Array, np.ndarray]:
    """Stripes in order of their key, merged: keys and their totals, then the number of the key, word and count of entries."""
    key = rows.select(["lang", "prefix", "part"]).combine_chunks()
    changes = [pc.not_equal(c[1:], c[:-1]).to_numpy() for c in key.columns]
    new = np.concatenate([[True], np.logical_or.reduce(changes)])
    lists = pc.split_pattern(rows.column("words").combine_chunks(), " ")
    words, counts = lists.flatten().dictionary_encode(), _packed(rows.column("counts").combine_chunks())
    keys = np.repeat(np.cumsum(new) - 1, lists.value_lengths().to_numpy())
    totals = np.add.reduceat(counts, np.concatenate([[0], np.flatnonzero(np.diff(keys)) + 1]))
    code = (keys << 32) | words.indices.to_numpy()
    order = np.argsort(code)
    code = code[order]
    starts = np.concatenate([[0], np.flatnonzero(np.diff(code)) + 1])
    code, sums = code[starts], np.add.reduceat(counts[order], starts)
    return key.take(pa.array(np.flatnonzero(new))), totals, code >> 32, words.dictionary.take(pa.array(code & 0xFFFFFFFF)), sums


def _merge(least: int):
    """Stripes in order of their key to one stripe for each key, entries below ``least`` summed up only."""

    def merged(rows: pa.Table, last: bool):
        """The batch of merged stripes, and the stripe of the last key, to which more may come, as a row."""
        found, totals, keys, words, sums = _summed(rows)
        n, rest = len(totals), None
        if not last:
            n -= 1
            a = int(np.searchsorted(keys, n))
            joined = pc.binary_join(pa.ListArray.from_arrays([0, len(words) - a], words[a:]), " ")
            rest = found.slice(n).append_column("words", joined).append_column("counts", pa.array([sums[a:].tobytes()]))
            keys, words, sums = keys[:a], words[:a], sums[:a]
        often = sums >= least
        cuts = pa.array(np.searchsorted(keys[often], np.arange(n + 1)).astype(np.int32))
        lists = [pa.ListArray.from_arrays(cuts, c) for c in (words.filter(pa.array(often)), pa.array(sums[often]))]
        columns = [*[found.column(k).combine_chunks()[:n] for k in ("lang", "prefix")], pa.array(totals[:n]), *lists]
        return pa.RecordBatch.from_arrays(columns, names=["lang", "prefix", "total", "words", "counts"]), rest

    def run(batches):
        held, size, block = [], 0, STRIPE_BLOCK
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(pa.Table.from_batches([batch]))
            size += batch.nbytes
            if size >= block:
                out, rest = merged(pa.concat_tables(held), last=False)
                yield out
                held, size, block = [rest], 0, max(STRIPE_BLOCK, 2 * rest.nbytes)
        if held:
            yield merged(pa.concat_tables(held), last=True)[0]
        give_back()

    return run


def _bitmap(level: DataFrame, size: int, bits: int) -> bytes:
    """Bits of the level's frequent phrases; its size depends on ``bits`` alone."""

    def run(batches):
        for batch in batches:
            out = []
            for lang, phrase in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = [np.array([_word_hash(w)], np.uint64) for w in phrase.encode().split(b" ")]
                out.append(int(_places(lang, words, bits)[0]) + 1)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.int64())], names=["bit"])

    rows = level.select("lang", "phrase").mapInArrow(run, "bit bigint")
    found = rows.groupBy(F.bitmap_bucket_number("bit").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("map"))
    out = bytearray(1 << (bits - 3))
    for r in found.collect():
        at, content = (r["bucket"] - 1) * 4096, bytes(r["map"])
        out[at : at + len(content)] = content[: len(out) - at]
    return bytes(out)


def _extensions(stripes: DataFrame) -> DataFrame:
    """lang, prefix, phrase, a: the frequent entries of stripes."""
    entries = stripes.select("lang", "prefix", F.explode(F.arrays_zip("words", "counts")).alias("e"))
    phrase = F.when(F.col("prefix") == "", F.col("e.words")).otherwise(F.concat_ws(" ", "prefix", "e.words"))
    return entries.select("lang", "prefix", phrase.alias("phrase"), F.col("e.counts").alias("a"))


def stripes(docs: DataFrame, least: int, bits: int = 26, text_col: str = "text", lang_col: str = "lang") -> list[DataFrame]:
    """Merged stripes for prefixes of 0 to 3 words: lang, prefix, total, words, counts.

    Entries of fewer than ``least`` occurrences are in the total only; a cut stripe has one row a part.
    The total sums what was counted: all words for the empty prefix, for others windows that may be frequent.
    """
    spark = bounded_batches(docs.sparkSession)
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), whole(text_col).alias("text"))
    out: list[DataFrame] = []
    frequent = hot = None
    for size in range(1, SIZES + 1):
        raw = texts.mapInArrow(_gather(size, frequent, hot, bits), RAW)
        sorted_raw = raw.repartition("lang", "prefix", "part").sortWithinPartitions("lang", "prefix", "part")
        out.append(cut_lineage(sorted_raw.mapInArrow(_merge(least), MERGED)))
        if size < SIZES:
            if size == 1:
                n = out[0].agg(F.coalesce(F.sum("total"), F.lit(0))).first()[0]
            phrases = _extensions(out[-1])
            often = phrases.where((F.col("a") >= max(1, n // HOT)) & (F.col("a") >= least)).select("lang", "phrase")
            hot = spark.sparkContext.broadcast({tuple(r) for r in often.collect()})  # at most HOT of them
            frequent = spark.sparkContext.broadcast(_bitmap(phrases, size, bits))
    return out


def _size(phrase: str) -> Column:
    return F.size(F.split(phrase, " "))


def _wide(col: Column) -> Column:
    return col.cast("decimal(20,0)")


def collocations(docs: DataFrame, least: int = 30, scale: int = 2_000_000, subsumed: int = 80, top: int = 2000, bits: int = 26,
                 text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``top`` phrases of 2 to 4 words.

    a, l and r are occurrences of the phrase and of its two parts at the cut with the lowest score
    ``floor(scale * a / (l + r))``; a phrase goes where a longer one has ``subsumed`` hundredths of it.
    """
    levels = stripes(docs, least, bits, text_col, lang_col)
    words = levels[0].groupBy("lang").agg(F.sum("total").alias("n"))
    parts = _extensions(levels[0].unionByName(levels[1]).unionByName(levels[2])).select("lang", "phrase", F.col("a").alias("f"))
    found = _extensions(levels[1].unionByName(levels[2]).unionByName(levels[3]))

    # the largest extension to the right is in the phrase's own stripe, to the left in that of a longer one
    stripe_maxima = levels[2].unionByName(levels[3]).where(F.size("counts") > 0).select("lang", F.col("prefix").alias("phrase"), F.array_max("counts").alias("a"))
    longer = found.where(_size("phrase") > 2).select("lang", F.expr("substring_index(phrase, ' ', 1 - size(split(phrase, ' ')))").alias("phrase"), "a")
    maxima = stripe_maxima.unionByName(longer).groupBy("lang", "phrase").agg(F.max("a").alias("longest"))
    kept = found.join(maxima, ["lang", "phrase"], "left").where(
        F.col("longest").isNull() | (_wide(F.col("longest")) * 100 < _wide(F.col("a")) * subsumed)
    )
    cuts = kept.select("lang", "phrase", "a", F.explode(F.sequence(F.lit(1), _size("phrase") - 1)).alias("k"))
    cuts = cuts.withColumn("left", F.expr("substring_index(phrase, ' ', k)")).withColumn("right", F.expr("substring_index(phrase, ' ', k - size(split(phrase, ' ')))"))
    lefts = parts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    rights = parts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    scored = cuts.join(lefts, ["lang", "left"]).join(rights, ["lang", "right"]).withColumn("wide", _wide(F.col("a")) * F.lit(scale).cast("decimal(10,0)"))
    scored = scored.withColumn("score", F.expr("wide div cast(l + r as decimal(20,0))"))
    best = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    best = best.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").alias("score"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(words, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
