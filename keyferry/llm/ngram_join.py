"""Documents whose sets of word n-grams have a Jaccard similarity of at least a threshold, as classes.

Rare-first prefix filtering: a set's n-grams are ordered by their document frequency over the whole
corpus, rarest first; two sets that are similar enough share an n-gram of their prefixes. N-grams of
one document only can't be shared, so they take their place in the order but are not joined.

1. Documents are dealt into batches by hash. Each batch sends its n-grams, packed and sorted, to ranges
   of the hash space, which count documents and answer each batch with the n-grams that others have too.
2. Each batch orders its sets and gives the joinable prefix n-grams with their places. Equal sets have
   one signature and count as one from here on, so that copies are never paired.
3. In every prefix n-gram's bucket all sets are compared with one pivot, the set with the fewest n-grams
   of its own. This joins large groups of near copies with as many comparisons as they have members.
4. What is still in different components of one bucket is compared in full: buckets are first reduced to
   cells of equal size and place, so that the length and positional filters drop cells, not pairs; a
   suffix filter comes before each verification. Every pair is verified once, on the sets themselves.

A pair inside one component is not looked at again: classes, not their inner links, are the result.

Words are runs of characters that are not ASCII white space, with A-Z in lower case. N-grams are 64-bit
hashes. Defined cases: a null text counts as empty; a set is empty without words and links with
nothing; fewer than ``words`` words make one n-gram; texts of any length are read whole; repeated rows
belong to their class each time; a null id is never a class's smallest unless all are null; further
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import bounded_batches, give_back, whole
from .components import components

BATCH_BYTES = 4 << 20
RANGE_BYTES = 8 << 20
SHORT_BITS = 46  # of a hash, as far as frequencies go: two n-grams that agree in them share a count


def grams_of(text: bytes, words: int) -> np.ndarray:
    """Sorted distinct n-gram hashes of a text."""
    tokens = text.lower().split()  # of bytes: ASCII only, as the words are defined
    if not tokens:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, len(tokens))
    width = min(words, len(h))
    out = np.full(len(h) - width + 1, np.uint64(width))
    for k in range(width):
        out = (out ^ h[k : len(h) - width + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return np.unique(out)


def needed(total: int | np.ndarray, num: int, den: int):
    """Least overlap of two sets with ``total`` members together that reaches the threshold."""
    return -(-(num * total) // (num + den))


def prefix_length(n: int, num: int, den: int) -> int:
    return n - -(-(num * n) // den) + 1


def _pack(values: np.ndarray) -> bytes:
    """Sorted numbers as 32-bit steps after the first, or plainly where a step is wider."""
    steps = np.diff(values)
    if len(values) > 2 and int(steps.max()) < 1 << 32:
        return b"s" + values[:1].tobytes() + steps.astype(np.uint32).tobytes()
    return b"p" + values.tobytes()


def _unpack(data: bytes) -> np.ndarray:
    if data[:1] == b"p":
        return np.frombuffer(data, np.uint64, offset=1)
    steps = np.frombuffer(data, np.uint32, offset=9).astype(np.uint64)
    return np.frombuffer(data, np.uint64, 1, offset=1) + np.concatenate([np.zeros(1, np.uint64), np.cumsum(steps, dtype=np.uint64)])


def _texts(column: pa.ChunkedArray):
    for chunk in column.chunks:
        for v in chunk:
            yield v.as_buffer().to_pybytes()


def _sent(words: int, ranges: int):
    """A batch's n-grams, each once with its number of documents, cut into ranges."""

    def run(table: pa.Table) -> pa.Table:
        sets = [grams_of(t, words) >> np.uint64(64 - SHORT_BITS) for t in _texts(table["text"])]
        every, counts = np.unique(np.concatenate([np.unique(s) for s in sets]), return_counts=True)
        where = (every >> np.uint64(16)).astype(np.int64) * ranges >> (SHORT_BITS - 16)
        cuts = np.searchsorted(where, np.arange(ranges + 1))
        rows = [(int(p), cuts[p], cuts[p + 1]) for p in np.unique(where)]
        del sets
        give_back()
        return pa.table(
            {
                "part": pa.array([p for p, _, _ in rows], pa.int64()),
                "batch": pa.array([table["batch"][0].as_py()] * len(rows), pa.int64()),
                "grams": pa.array([_pack(every[a:b]) for _, a, b in rows], pa.binary()),
                "counts": pa.array([counts[a:b].astype(np.uint32).tobytes() for _, a, b in rows], pa.binary()),
            }
        )

    return run


def _answered(table: pa.Table) -> pa.Table:
    """To each batch the n-grams of a range that at least two documents hold, with how many do."""
    parts = [_unpack(v.as_buffer().to_pybytes()) for c in table["grams"].chunks for v in c]
    counts = [np.frombuffer(v.as_buffer().to_pybytes(), np.uint32) for c in table["counts"].chunks for v in c]
    every, place = np.unique(np.concatenate(parts), return_inverse=True)
    held = np.bincount(place, weights=np.concatenate(counts)).astype(np.uint32)[place]
    batches, grams, numbers, at = [], [], [], 0
    for batch, part in zip(table["batch"].to_pylist(), parts):
        own = held[at : at + len(part)]
        at += len(part)
        common = own > 1
        if common.any():
            batches.append(batch)
            grams.append(_pack(part[common]))
            numbers.append(own[common].tobytes())
    part = [table["part"][0].as_py()] * len(batches)
    del every, place, held, parts, counts
    give_back()
    return pa.table({"part": pa.array(part, pa.int64()), "batch": pa.array(batches, pa.int64()), "grams": pa.array(grams, pa.binary()), "counts": pa.array(numbers, pa.binary())})


def _ordered(words: int, num: int, den: int, id_type: pa.DataType):
    """Of each document: signature and size; of each different set also prefix n-grams and what it shares."""

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        answers = answers.sort_by("part")
        known = [_unpack(v.as_buffer().to_pybytes()) for c in answers["grams"].chunks for v in c]
        counts = [np.frombuffer(v.as_buffer().to_pybytes(), np.uint32) for c in answers["counts"].chunks for v in c]
        keys = np.concatenate(known) if known else np.zeros(0, np.uint64)
        held = np.concatenate(counts) if counts else np.zeros(0, np.uint32)
        out = {k: [] for k in ("sig", "n", "own", "grams", "places", "shared")}
        seen = set()
        for text in _texts(docs["text"]):
            s = grams_of(text, words)
            n = len(s)
            sig = xxhash.xxh3_128_digest(s.tobytes()) if n else None
            grams = places = shared = None
            own = 0
            if n and sig not in seen:
                seen.add(sig)
                at = np.minimum(np.searchsorted(keys, s >> np.uint64(64 - SHORT_BITS)), max(len(keys) - 1, 0))
                df = np.where(keys[at] == s >> np.uint64(64 - SHORT_BITS), held[at], 1) if len(keys) else np.ones(n, np.uint32)
                own = int((df == 1).sum())
                length = prefix_length(n, num, den)
                if own < length:
                    order = np.lexsort((s, df))[own:length]
                    grams, places = s[order].view(np.int64).tolist(), list(range(own, length))
                    shared = s[df > 1].tobytes()
            for k, v in zip(out, (sig, n, own, grams, places, shared)):
                out[k].append(v)
        del known, counts, keys, held
        give_back()
        kinds = {"sig": pa.binary(), "n": pa.int64(), "own": pa.int64(), "grams": pa.list_(pa.int64()), "places": pa.list_(pa.int64()), "shared": pa.binary()}
        return pa.table({"id": docs["id"].cast(id_type), **{k: pa.array(v, kinds[k]) for k, v in out.items()}})

    return run


def _sets(docs: DataFrame, id_col: str, text_col: str, words: int, num: int, den: int) -> DataFrame:
    rows = docs.select(F.col(id_col).alias("id"), whole(text_col).cast("binary").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    batches, ranges = max(16, -(-size // BATCH_BYTES)), max(16, -(-size // RANGE_BYTES))
    dealt = rows.select(F.pmod(F.xxhash64("id", "text"), F.lit(batches)).alias("batch"), "id", "text").repartition("batch")
    packed = "part bigint, batch bigint, grams binary, counts binary"
    sent = dealt.groupBy("batch").applyInArrow(_sent(words, ranges), packed)
    answers = sent.groupBy("part").applyInArrow(_answered, packed)
    kind = rows.schema["id"].dataType
    schema = f"id {kind.simpleString()}, sig binary, n bigint, own bigint, grams array<bigint>, places array<bigint>, shared binary"
    from pyspark.sql.pandas.types import to_arrow_type

    ordered = _ordered(words, num, den, to_arrow_type(kind))
    return cut_lineage(dealt.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(ordered, schema))


def _possible(n_a: Column, at_a: Column, n_b: Column, at_b: Column, num: int, den: int) -> Column:
    """Length and positional filter: what can still follow the shared n-gram in both sets is enough."""
    length = (n_a * den >= n_b * num) & (n_b * den >= n_a * num)
    most = F.least(n_a - at_a, n_b - at_b)
    return length & (most * (num + den) >= (n_a + n_b) * num)


def _verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) of signatures that reach the threshold."""

    def run(batches):
        for batch in batches:
            keep = []
            cols = [batch.column(k) for k in (2, 3, 4, 5)]
            for n_a, n_b, x, y in zip(cols[0].to_pylist(), cols[1].to_pylist(), cols[2], cols[3]):
                a, b = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                keep.append(overlaps(a, b, int(needed(n_a + n_b, num, den))))
            kept = batch.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays(kept.columns[:2], names=["a", "b"])
        give_back()

    content = sets.where("shared IS NOT NULL").groupBy("sig").agg(F.any_value("n").alias("n"), F.any_value("shared").alias("shared"))
    left = content.select(F.col("sig").alias("a"), F.col("n").alias("n_a"), F.col("shared").alias("s_a"))
    right = content.select(F.col("sig").alias("b"), F.col("n").alias("n_b"), F.col("shared").alias("s_b"))
    rows = pairs.join(left, "a").join(right, "b").select("a", "b", "n_a", "n_b", "s_a", "s_b")
    return rows.mapInArrow(run, "a binary, b binary")


def overlaps(a: np.ndarray, b: np.ndarray, least: int) -> bool:
    """Whether two sorted sets share ``least`` members; a bound from a few cuts comes first (suffix filter)."""
    if min(len(a), len(b)) < least:
        return False
    cuts = a[:: max(1, len(a) // 8)]
    in_a, in_b = (np.diff(np.concatenate([[0], np.searchsorted(s, cuts), [len(s)]])) for s in (a, b))
    if int(np.minimum(in_a, in_b).sum()) < least:
        return False
    return len(np.intersect1d(a, b, assume_unique=True)) >= least


def similar_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 5,
    num: int = 80,
    den: int = 100,
) -> DataFrame:
    """id, n_shingles and component_id (the smallest id of the class) of every row."""
    bounded_batches(docs.sparkSession)
    sets = _sets(docs, id_col, text_col, words, num, den)
    places = F.explode(F.arrays_zip("grams", "places")).alias("e")
    entries = sets.where("grams IS NOT NULL").select("sig", "n", "own", places).select("sig", "n", "own", "e.grams", "e.places")
    entries = entries.select(F.col("grams").alias("gram"), "sig", "n", "own", F.col("places").alias("at")).distinct()
    buckets = entries.groupBy("gram").agg(F.count(F.lit(1)).alias("size"), F.min(F.struct("own", "n", "sig", "at")).alias("pivot"))
    entries = cut_lineage(entries.join(buckets.where("size > 1").drop("size"), "gram"))

    p = F.col("pivot")
    near_pivot = entries.where((F.col("sig") != p["sig"]) & _possible(F.col("n"), F.col("at"), p["n"], p["at"], num, den))
    stars = near_pivot.select(F.least("sig", p["sig"]).alias("a"), F.greatest("sig", p["sig"]).alias("b")).distinct()
    stars = cut_lineage(stars)
    links = cut_lineage(_verified(stars, sets, num, den))
    groups = components(links, "a", "b")

    rest = entries.drop("pivot").join(groups.withColumnRenamed("node", "sig"), "sig", "left").withColumn("root", F.coalesce("root", "sig"))
    spread = rest.groupBy("gram").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("gram")
    rest = cut_lineage(rest.join(spread, "gram", "left_semi"))
    pairs = cut_lineage(_across(rest, num, den).join(stars, ["a", "b"], "left_anti"))
    links = links.unionByName(_verified(pairs, sets, num, den))
    groups = components(cut_lineage(links), "a", "b")

    lowest = sets.where("sig IS NOT NULL").groupBy("sig").agg(F.min("id").alias("low"))
    named = lowest.join(groups.withColumnRenamed("node", "sig"), "sig", "left").withColumn("root", F.coalesce("root", "sig"))
    classes = named.join(named.groupBy("root").agg(F.min("low").alias("component_id")), "root").select("sig", "component_id")
    out = sets.select("id", "sig", "n").join(classes, "sig", "left")
    own = F.when(F.col("sig").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), own.alias("component_id"))


def _across(rest: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b): pairs of one bucket in different components that the filters leave."""
    cells = rest.groupBy("gram", "n", "at").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    one = cells.select("gram", *[F.col(c).alias(f"{c}_1") for c in ("n", "at", "low", "high")])
    two = cells.select("gram", *[F.col(c).alias(f"{c}_2") for c in ("n", "at", "low", "high")])
    ahead = (F.col("n_1") < F.col("n_2")) | ((F.col("n_1") == F.col("n_2")) & (F.col("at_1") <= F.col("at_2")))
    mixed = (F.least("low_1", "low_2") != F.greatest("high_1", "high_2"))
    fits = _possible(F.col("n_1"), F.col("at_1"), F.col("n_2"), F.col("at_2"), num, den)
    cell_pairs = one.join(two, "gram").where(ahead & mixed & fits).select("gram", "n_1", "at_1", "n_2", "at_2")
    left = rest.select("gram", F.col("n").alias("n_1"), F.col("at").alias("at_1"), F.col("sig").alias("x"), F.col("root").alias("r_1"))
    right = rest.select("gram", F.col("n").alias("n_2"), F.col("at").alias("at_2"), F.col("sig").alias("y"), F.col("root").alias("r_2"))
    met = cell_pairs.join(left, ["gram", "n_1", "at_1"]).join(right, ["gram", "n_2", "at_2"]).where("r_1 <> r_2")
    return met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The documents, all their columns, of which each class keeps the one with the smallest id.

    Rows are told apart by id and text, so that null or repeated ids stay with their own text; rows
    that are equal in both count as one and are all kept or all dropped.
    """
    name = F.coalesce(F.lpad((F.col(id_col).cast("decimal(20,0)") + F.lit(str(2**63)).cast("decimal(20,0)")).cast("string"), 20, "0"), F.lit("null"))
    name = F.concat_ws(":", name, F.sha2(whole(text_col).cast("binary"), 256))
    # the row travels as one column: no name of its own can clash
    keyed = docs.select(F.struct(*docs.columns).alias("row"), name.alias("name"), F.col(text_col).alias("text"))
    classes = similar_classes(keyed, "name", "text", words, num, den)
    first = classes.where("name = component_id").select("name").distinct()
    return keyed.join(first, "name", "left_semi").select("row.*")
