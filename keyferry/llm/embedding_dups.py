"""Near duplicates among embeddings of equal labels, found with a flat proximity graph.

1. Equal vectors become one node that stands for all its rows.
2. Labels with many nodes are cut into overlapping shards: centroids are fitted on a bounded sample,
   each node goes to its nearest centroid (its home) and to the second one; shards that are still too
   large are cut again, level by level.
3. In each shard every node gets the nearest nodes that robust pruning leaves: one is dropped if a nearer
   kept one is closer to it, by the factor ``ALPHA``, than the node itself. Nodes that can't be reached
   from the shard's medoid get an edge from their nearest reached node.
4. The adjacency lists of all shards are united per node: a shard searches its own graph, and from each
   node also goes to the neighbours it has in other shards, as far as they are near enough to lie on a
   way to a link; so links across the cut are found.
5. Each node is searched for at home: greedily from the medoid with a beam, then the range is expanded
   through every node found within ``SLACK`` of the threshold, until nothing new comes up.
6. Links are verified by the cosine in double precision. Links between nodes at home in one shard are
   counted there and leave it as a spanning forest, other links as pairs.
7. A bounded number of nodes, drawn by hash and those with the most links found, is audited against brute
   force over all rows; with less than ``LEAST_RECALL`` of the links of either found, the search is repeated
   with a wider beam.
8. Where that does not help, for a beam can't reach what no list of a shard holds, every two shards whose
   balls (centroid and radius) are near enough for a link are compared in full: the links are then exact.

Defined cases: a null label, a null, empty or zero vector, or one with a null or non-finite component
links with nothing and is its own component; vectors of different lengths never link; repeated rows
link with each other; a null id is never a component's smallest unless all are null; further columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import logging

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import bounded_batches
from .components import components

SHARD, SHARD_MAX = 1000, 2000  # nodes aimed at and accepted
OVERLAP = 1  # further shards of each node, those of the next nearest centroids
SHARDS_A_LEVEL, CENTROIDS_A_SHARD, SAMPLE_A_CENTROID = 1024, 16, 100  # bound what a level fits and broadcasts
DEGREE, CANDIDATES, ALPHA = 24, 64, 1.2
SLACK = 0.02
BEAM = 24
AUDITED, LEAST_RECALL = 200, 0.95
log = logging.getLogger(__name__)


def _nodes(rows: DataFrame) -> DataFrame:
    """(key, shard, vec, n): one row for equal vectors of a label; the shard begins as label and length."""
    text = F.concat_ws(",", F.col("vec").cast("array<string>"))
    shard = F.concat_ws(":", F.col("label").cast("string"), F.size("vec").cast("string"))
    keyed = rows.where("valid").select("id", "vec", shard.alias("shard"), F.md5(F.concat_ws("|", shard, text).cast("binary")).alias("key"))
    return keyed


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _centroids(table: pa.Table) -> pa.Table:
    """Spherical k-means on the sample of one shard."""
    x, k = _unit(_matrix(table["vec"])), int(table["k"][0].as_py())
    x = x[np.lexsort(x.T)]
    centers = x[[0]]
    near = x @ centers[0]
    while len(centers) < min(k, len(x)):  # the farthest one next
        at = int(np.argmin(near))
        centers = np.concatenate([centers, x[[at]]])
        near = np.maximum(near, x @ x[at])
    for _ in range(8):
        of = np.argmax(x @ centers.T, axis=1)
        sums = np.stack([x[of == c].sum(axis=0) if (of == c).any() else centers[c] for c in range(len(centers))])
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centers = np.where(norms > 0, sums / np.maximum(norms, 1e-300), centers)
    return pa.table({"shard": pa.array([table["shard"][0].as_py()] * len(centers)), "center": pa.array(centers.tolist(), pa.list_(pa.float64()))})


def _sharded(nodes: DataFrame) -> DataFrame:
    """(shard, key, vec, n, home): every node at home once, and in neighbouring shards."""
    spark = nodes.sparkSession
    out = nodes.withColumn("home", F.lit(True))
    schema = "shard string, key string, vec array<double>, n bigint, home boolean"
    for _ in range(30):
        big = out.groupBy("shard").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > SHARD_MAX)
        big = big.orderBy(F.desc("size"), "shard").limit(SHARDS_A_LEVEL)
        k = F.least(F.lit(CENTROIDS_A_SHARD), F.ceil(F.col("size") * 2 / SHARD).cast("int"))
        big = cut_lineage(big.withColumn("k", k))
        if big.isEmpty():
            break
        draw = F.pmod(F.xxhash64("key"), F.lit(1 << 30)) / F.lit(float(1 << 30))
        rate = F.col("k") * SAMPLE_A_CENTROID / F.col("size")
        sample = out.where("home").join(F.broadcast(big), "shard").where(draw < rate).select("shard", "k", "vec")
        fitted = sample.groupBy("shard").applyInArrow(_centroids, "shard string, center array<double>").toArrow()
        by: dict[str, list] = {}
        for shard, center in zip(fitted["shard"].to_pylist(), fitted["center"].to_pylist()):
            by.setdefault(shard, []).append(center)
        given = spark.sparkContext.broadcast({s: np.array(c) for s, c in by.items()})

        def split(batches, given=given):
            centers = given.value
            for batch in batches:
                shards = np.array(batch.column(0).to_pylist(), dtype=object)
                home = batch.column(4).to_numpy(zero_copy_only=False)
                rows, names, homes = [], [], []
                for s in sorted(set(shards)):
                    at = np.nonzero(shards == s)[0]
                    if s not in centers:
                        rows += at.tolist()
                        names += [s] * len(at)
                        homes += home[at].tolist()
                        continue
                    close = _unit(_matrix(batch.column(2).take(pa.array(at)))) @ centers[s].T
                    order = np.argsort(-close, axis=1, kind="stable")
                    for i, r in enumerate(at.tolist()):
                        rows.append(r)
                        names.append(f"{s}/{order[i, 0]}")
                        homes.append(bool(home[r]))
                        for c in order[i, 1 : 1 + OVERLAP].tolist() if home[r] else ():
                            rows.append(r)
                            names.append(f"{s}/{c}")
                            homes.append(False)
                kept = batch.take(pa.array(rows, pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(names), *kept.columns[1:4], pa.array(homes)], names=batch.schema.names)

        out = cut_lineage(out.select("shard", "key", "vec", "n", "home").mapInArrow(split, schema))
    return out.select("shard", "key", "vec", "n", "home")


def prune(near: np.ndarray, of: np.ndarray, among: np.ndarray) -> list[int]:
    """Robust pruning: candidates in order of distance ``of``; ``among`` has their mutual distances."""
    kept: list[int] = []
    open_ = np.ones(len(near), bool)
    for k in range(len(near)):
        if open_[k]:
            kept.append(int(near[k]))
            if len(kept) == DEGREE:
                break
            open_ &= ALPHA * among[k] > of
    return kept


def build(x: np.ndarray) -> tuple[list[list[int]], int]:
    """Adjacency lists of unit vectors and the medoid; every node can be reached from the medoid."""
    m = len(x)
    medoid = int(np.argmax(x @ x.mean(axis=0)))
    lists: list[set[int]] = [set() for _ in range(m)]
    top = min(CANDIDATES, m - 1)
    for low in range(0, m, 512):
        close = x[low : low + 512] @ x.T
        close[np.arange(len(close)), np.arange(low, low + len(close))] = -np.inf
        near = np.argpartition(-close, top - 1, axis=1)[:, :top] if top else np.zeros((len(close), 0), int)
        for i in range(len(close)):
            order = near[i][np.argsort(-close[i, near[i]], kind="stable")]
            among = 1 - x[order] @ x[order].T
            kept = prune(order, 1 - close[i, order], among)
            lists[low + i].update(kept)
            for k in kept:
                lists[k].add(low + i)
    reached, stack = np.zeros(m, bool), [medoid]
    reached[medoid] = True
    while True:
        while stack:
            for k in lists[stack.pop()]:
                if not reached[k]:
                    reached[k] = True
                    stack.append(k)
        left = np.nonzero(~reached)[0]
        if not len(left):
            return [sorted(s) for s in lists], medoid
        inside = np.nonzero(reached)[0]
        close = x[left[0]] @ x[inside].T
        nearest = int(inside[np.argmax(close)])
        lists[nearest].add(int(left[0]))
        lists[left[0]].add(nearest)
        reached[left[0]] = True
        stack.append(int(left[0]))


def _built(threshold: float):
    """Lists as places among the shard's nodes in order of their keys; near ones also by key."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("key")
        keys, x = table["key"].to_pylist(), _unit(_matrix(table["vec"]))
        lists, medoid = build(x)
        near = [[keys[k] for k in near if x[k] @ x[i] >= threshold - 2 * SLACK] for i, near in enumerate(lists)]
        return pa.table(
            {
                "shard": table["shard"],
                "key": pa.array(keys),
                "next": pa.array(lists, pa.list_(pa.int32())),
                "near": pa.array(near, pa.list_(pa.string())),
                "medoid": pa.array([k == medoid for k in range(len(keys))]),
            }
        )

    return run


def search(q: int, x: np.ndarray, lists: list[np.ndarray], start: int, threshold: float, beam: int) -> np.ndarray:
    """Nodes found within the threshold of node ``q``: greedy with a beam, then expanding the range.

    The search for a node of the graph ends at the node itself; its own list is followed in any case.
    """
    seen = {start: float(x[start] @ x[q]), q: 1.0}
    heap = [(-c, k) for k, c in seen.items()]
    heapq.heapify(heap)
    best = [seen[start]]  # the beam, smallest first
    wide = threshold - SLACK
    while heap:
        close, at = heapq.heappop(heap)
        if len(best) >= beam and -close < best[0] and -close < wide:
            break
        new = [k for k in lists[at].tolist() if k not in seen]
        if not new:
            continue
        for k, c in zip(new, (x[new] @ x[q]).tolist()):
            seen[k] = c
            if c >= wide or len(best) < beam or c > best[0]:  # within the range all are followed
                heapq.heappush(heap, (-c, k))
                heapq.heappush(best, c)
                if len(best) > beam:
                    heapq.heappop(best)
    return np.array([k for k, c in seen.items() if c >= threshold and k != q], dtype=np.int64)


def _searched(threshold: float, beam: int):
    """Of a shard's home nodes: the rows they link with at home, a spanning forest, and links to others."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("member", "descending"), ("key", "ascending")])  # members first: their lists are places
        keys, home = table["key"].to_pylist(), table["home"].to_numpy(zero_copy_only=False)
        x = _unit(_matrix(table["vec"]))
        n = table["n"].to_numpy()
        place = {k: i for i, k in enumerate(keys)}
        lists: list[set[int]] = [set() for _ in keys]
        for i, (inside, near) in enumerate(zip(table["next"].to_pylist(), table["near"].to_pylist())):
            for k in [*(inside or ()), *(place[k] for k in near or () if k in place)]:
                lists[i].add(k)
                lists[k].add(i)
        arrays = [np.array(sorted(s), dtype=np.int64) for s in lists]
        medoids = np.nonzero(table["medoid"].to_numpy(zero_copy_only=False))[0]
        found = set()
        for q in np.nonzero(home)[0].tolist():
            for start in medoids.tolist()[:1]:
                found.update((min(q, k), max(q, k)) for k in search(q, x, arrays, start, threshold, beam).tolist())
        kind, one, two, count = [], [], [], []
        parent = list(range(len(keys)))

        def root(v: int) -> int:
            while parent[v] != v:
                parent[v] = parent[parent[v]]
                v = parent[v]
            return v

        local = np.zeros(len(keys), np.int64)
        for a, b in sorted(found):
            if home[a] and home[b]:
                local[a] += n[b]
                local[b] += n[a]
                r, s = root(a), root(b)
                if r == s:
                    continue
                parent[max(r, s)] = min(r, s)
                kind.append("edge")
            else:
                kind.append("pair")
            one.append(keys[a])
            two.append(keys[b])
            count.append(0)
        for i in np.nonzero(home & (local > 0))[0]:
            kind.append("node")
            one.append(keys[i])
            two.append(None)
            count.append(int(local[i]))
        return pa.table({"kind": pa.array(kind, pa.string()), "a": pa.array(one, pa.string()), "b": pa.array(two, pa.string()), "n": pa.array(count, pa.int64())})

    return run


def _graph(members: DataFrame, threshold: float) -> DataFrame:
    """Rows that each shard searches with: its nodes with their lists, and near neighbours elsewhere."""
    schema = "shard string, key string, next array<int>, near array<string>, medoid boolean"
    built = cut_lineage(members.select("shard", "key", "vec").groupBy("shard").applyInArrow(_built(threshold), schema))
    united = built.select("key", F.explode("near").alias("near")).distinct().groupBy("key").agg(F.collect_list("near").alias("near"))
    own = members.join(built.drop("near"), ["shard", "key"]).join(united, "key", "left")
    own = cut_lineage(own.select("shard", "key", "vec", "n", "home", "medoid", F.lit(True).alias("member"), "next", "near"))
    beyond = own.select("shard", F.explode("near").alias("key")).distinct().join(own.select("shard", "key"), ["shard", "key"], "left_anti")
    other = beyond.join(own.where("home").select("key", "vec", "n", "near"), "key")
    no, none = F.lit(False), F.array().cast("array<int>")
    other = other.select("shard", "key", "vec", "n", no.alias("home"), no.alias("medoid"), no.alias("member"), none.alias("next"), "near")
    return cut_lineage(own.unionByName(other))


def _links(graph: DataFrame, nodes: DataFrame, threshold: float, beam: int) -> tuple[DataFrame, DataFrame]:
    """(key, n_links) of nodes that link with others, and links (a, b) that connect all that link."""
    out = cut_lineage(graph.groupBy("shard").applyInArrow(_searched(threshold, beam), "kind string, a string, b string, n bigint"))
    # two shards that find the same pair may name it in either order
    pairs = out.where("kind = 'pair'").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    ends = pairs.select(F.col("a").alias("key"), F.col("b").alias("other")).unionByName(pairs.select(F.col("b").alias("key"), F.col("a").alias("other")))
    across = ends.join(nodes.select(F.col("key").alias("other"), "n"), "other").select("key", "n")
    counts = out.where("kind = 'node'").select(F.col("a").alias("key"), "n").unionByName(across)
    return counts.groupBy("key").agg(F.sum("n").alias("n_links")), out.where("kind <> 'node'").select("a", "b")


def _ball(table: pa.Table) -> pa.Table:
    """Centre of a shard's home nodes and the greatest angle between it and one of them."""
    x = _unit(_matrix(table["vec"]))
    center = x.sum(axis=0)
    norm = np.linalg.norm(center)
    center = center / norm if norm > 0 else x[0]
    radius = float(np.arccos(np.clip(x @ center, -1, 1)).max())
    return pa.table({"shard": table["shard"].slice(0, 1), "center": pa.array([center.tolist()], pa.list_(pa.float64())), "radius": [radius]})


def _forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Links (row, column) that connect what the matrix connects."""
    out = []
    rows, columns = linked.any(axis=1), np.ones(linked.shape[1], bool)
    while rows.any():
        front = np.array([int(np.argmax(rows))])
        rows[front] = False
        while len(front):
            new = np.nonzero(linked[front].any(axis=0) & columns)[0]
            if not len(new):
                break
            columns[new] = False
            out += zip(front[linked[np.ix_(front, new)].argmax(axis=0)].tolist(), new.tolist())
            front = np.nonzero(linked[:, new].any(axis=1) & rows)[0]
            rows[front] = False
            out += zip(front.tolist(), new[linked[np.ix_(front, new)].argmax(axis=1)].tolist())
    return out


def _compared(threshold: float):
    """Of two shards, or of one with itself: the rows that nodes link with, and a spanning forest."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("side", "ascending"), ("key", "ascending")])
        keys, n, side = table["key"].to_pylist(), table["n"].to_numpy(), table["side"].to_numpy()
        x = _unit(_matrix(table["vec"]))
        first = int((side == 0).sum())
        low = first if first < len(x) else 0  # where the columns begin: a shard with itself has one side
        count, parent, kept = np.zeros(len(x), np.int64), list(range(len(x))), []

        def root(v: int) -> int:
            while parent[v] != v:
                parent[v] = parent[parent[v]]
                v = parent[v]
            return v

        for at in range(0, first, 512):
            rows = np.arange(at, min(at + 512, first))
            linked = x[rows] @ x[low:].T >= threshold
            if not low:
                linked[np.arange(len(rows)), rows] = False
            count[rows] += linked @ n[low:]
            if low:
                count[low:] += linked.T @ n[rows]
            for i, j in _forest(linked):
                a, b = at + i, low + j
                r, s = root(a), root(b)
                if r != s:
                    parent[max(r, s)] = min(r, s)
                    kept.append((keys[a], keys[b]))
        some = np.nonzero(count)[0].tolist()
        return pa.table(
            {
                "kind": pa.array(["node"] * len(some) + ["edge"] * len(kept), pa.string()),
                "a": pa.array([keys[i] for i in some] + [a for a, _ in kept], pa.string()),
                "b": pa.array([None] * len(some) + [b for _, b in kept], pa.string()),
                "n": pa.array([int(count[i]) for i in some] + [0] * len(kept), pa.int64()),
            }
        )

    return run


def _exact_links(members: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """As ``_links``, but exact: all pairs of shards are compared, except those too far apart for any link."""
    home = members.where("home").select("shard", "key", "vec", "n")
    balls = home.groupBy("shard").applyInArrow(_ball, "shard string, center array<double>, radius double")
    # the cut adds /k to a shard's name, which begins as label and length
    balls = cut_lineage(balls.withColumn("of", F.regexp_replace("shard", "(/[0-9]+)+$", "")))
    one, two = (balls.select("of", *[F.col(c).alias(f"{c}{k}") for c in ("shard", "center", "radius")]) for k in (1, 2))
    cosine = F.aggregate(F.zip_with("center1", "center2", lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
    reach = F.col("radius1") + F.col("radius2") + F.lit(float(np.arccos(np.clip(threshold, -1, 1))) + 1e-6)
    pairs = one.join(two, "of").where(F.col("shard1") <= F.col("shard2")).where(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine))) <= reach)
    pairs = cut_lineage(pairs.select("shard1", "shard2"))
    left = home.join(pairs, home["shard"] == pairs["shard1"]).select("shard1", "shard2", "key", "vec", "n", F.lit(0).alias("side"))
    right = home.join(pairs.where("shard1 < shard2"), F.col("shard") == F.col("shard2")).select("shard1", "shard2", "key", "vec", "n", F.lit(1).alias("side"))
    out = left.unionByName(right).groupBy("shard1", "shard2").applyInArrow(_compared(threshold), "kind string, a string, b string, n bigint")
    out = cut_lineage(out)
    counts = out.where("kind = 'node'").groupBy(F.col("a").alias("key")).agg(F.sum("n").alias("n_links"))
    return counts, out.where("kind = 'edge'").select("a", "b")


def audit(nodes: DataFrame, counts: DataFrame, threshold: float) -> float:
    """Share of the links found of nodes drawn by hash, or of those with the most links, whichever is less."""
    by_hash = nodes.orderBy(F.xxhash64("key"), "key").limit(AUDITED)
    densest = nodes.join(counts.orderBy(F.desc("n_links"), "key").limit(AUDITED).select("key"), "key")
    return min(_recall(nodes, drawn, counts, threshold) for drawn in (by_hash, densest))


def _recall(nodes: DataFrame, drawn: DataFrame, counts: DataFrame, threshold: float) -> float:
    """Share of the links of a bounded number of nodes that were found."""
    drawn = drawn.select("key", "shard", "vec").toArrow()
    if not drawn.num_rows:
        return 1.0
    keys, shards, vectors = (drawn[c].to_pylist() for c in ("key", "shard", "vec"))
    given = nodes.sparkSession.sparkContext.broadcast((keys, np.array(shards, dtype=object), vectors))

    def run(batches):
        keys, shards, vectors = given.value
        for batch in batches:
            own, of = np.array(batch.column(0).to_pylist(), dtype=object), np.array(batch.column(1).to_pylist(), dtype=object)
            n = batch.column(3).to_numpy()
            for s in sorted(set(shards)):
                rows, wanted = np.nonzero(of == s)[0], np.nonzero(shards == s)[0]
                if len(rows):
                    x = _unit(_matrix(batch.column(2).take(pa.array(rows))))
                    close = _unit(np.array([vectors[w] for w in wanted])) @ x.T >= threshold
                    same = np.array([keys[w] for w in wanted], dtype=object)[:, None] == own[rows][None, :]
                    total = ((close & ~same) * n[rows]).sum(axis=1)
                    yield pa.RecordBatch.from_arrays([pa.array([keys[w] for w in wanted]), pa.array(total, pa.int64())], names=["key", "n"])

    there = nodes.select("key", "shard", "vec", "n").mapInArrow(run, "key string, n bigint").groupBy("key").agg(F.sum("n").alias("there"))
    sums = there.join(counts, "key", "left").agg(F.sum("there").alias("there"), F.sum(F.coalesce("n_links", F.lit(0))).alias("found")).first()
    return (sums["found"] or 0) / sums["there"] if sums["there"] else 1.0


def near_duplicates(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
    threshold: float = 0.98,
) -> DataFrame:
    """id, n_links, component_id and kept of every row."""
    bounded_batches(vectors.sparkSession)
    vec = F.col(vec_col).cast("array<double>")
    finite = F.forall(vec, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    valid = F.col(label_col).isNotNull() & (F.size(vec) > 0) & finite & F.exists(vec, lambda v: v != 0)
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), vec.alias("vec"), F.coalesce(valid, F.lit(False)).alias("valid"))
    keyed = cut_lineage(_nodes(rows))
    nodes = keyed.groupBy("key").agg(F.any_value("shard").alias("shard"), F.any_value("vec").alias("vec"), F.count(F.lit(1)).alias("n"), F.min("id").alias("low"))
    nodes = cut_lineage(nodes)
    members = _sharded(nodes.select("shard", "key", "vec", "n"))
    graph = _graph(members, threshold)
    beam, before = BEAM, -1.0
    while True:
        counts, links = _links(graph, nodes, threshold, beam)
        recall = audit(nodes, counts, threshold)
        log.info("beam %d: %.4f of the audited links found", beam, recall)
        if recall >= LEAST_RECALL:
            break
        if recall < before + 0.01:  # what is missing is beyond the beam
            counts, links = _exact_links(members, threshold)
            break
        beam, before = beam * 4, recall
    groups = components(links, "a", "b").withColumnRenamed("node", "key")
    named = nodes.select("key", "n", "low").join(groups, "key", "left").withColumn("root", F.coalesce("root", "key"))
    lowest = named.groupBy("root").agg(F.min("low").alias("component_id"))
    done = named.join(lowest, "root").join(counts, "key", "left")
    done = done.select("key", "component_id", (F.coalesce("n_links", F.lit(0)) + F.col("n") - 1).cast("bigint").alias("n_links"))
    linked = keyed.select("id", "key").join(done, "key").select("id", "n_links", "component_id")
    alone = rows.where("NOT valid").select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"))
    out = linked.unionByName(alone)
    return out.select(F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
