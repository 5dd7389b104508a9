import random
import re
from collections import Counter

import numpy as np
import pytest
from edge_cases import EDGE_TEXTS, frame

from keyferry.llm import embedding_dups, ngram_join
from keyferry.llm.components import components


def roots(n, links):
    parent = list(range(n))

    def find(v):
        while parent[v] != v:
            parent[v] = parent[parent[v]]
            v = parent[v]
        return v

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(v) for v in range(n)]


def shingles(text, words):
    w = re.findall("[^\x20\x09-\x0d]+", (text or "").translate({k: k + 32 for k in range(65, 91)}))
    if len(w) < words:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + words]) for i in range(len(w) - words + 1)}


def brute_classes(rows, words, num, den):
    sets = [shingles(t, words) for _, t in rows]
    links = [
        (i, j)
        for i in range(len(rows))
        for j in range(i)
        if sets[i] and sets[j] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j])
    ]
    root = roots(len(rows), links)
    low = {}
    for (i, _), r in zip(rows, root):
        low[r] = min((x for x in (low.get(r), i) if x is not None), default=None)
    return Counter((i, len(s), low[r] if s else i) for (i, _), s, r in zip(rows, sets, root))


def near_copies(seed, bases, copies, length, vocabulary):
    random.seed(seed)
    out = []
    for _ in range(bases):
        base = [f"w{random.randint(0, vocabulary)}" for _ in range(random.randint(length // 2, length))]
        for _ in range(random.randint(1, copies)):
            new = list(base)
            for _ in range(random.choice([0, 0, 1, 1, 2, 3, 5])):
                new[random.randrange(len(new))] = f"x{random.randint(0, 10**9)}"
            if random.random() < 0.2:
                new = new[random.randint(0, 12) :]
            out.append(" ".join(new))
    return list(enumerate(out))


@pytest.mark.parametrize("words, num, den", [(4, 85, 100), (5, 80, 100), (2, 1, 2)])
def test_classes_equal_brute_force(spark, words, num, den):
    rows = near_copies(words, 25, 12, 90, 400)
    out = ngram_join.similar_classes(frame(spark, rows), words=words, num=num, den=den)
    assert Counter(map(tuple, out.select("doc_id", "n_shingles", "component_id").collect())) == brute_classes(rows, words, num, den)


def test_classes_of_short_texts_and_common_words(spark):
    random.seed(9)
    rows = [(i, " ".join(random.choices("a b c A\tB \n".split(" "), k=random.randint(0, 9)))) for i in range(250)]
    out = ngram_join.similar_classes(frame(spark, rows), words=3, num=3, den=5)
    assert Counter(map(tuple, out.select("doc_id", "n_shingles", "component_id").collect())) == brute_classes(rows, 3, 3, 5)


def test_classes_of_edge_cases(edge, none):
    out = ngram_join.similar_classes(edge, words=4, num=85, den=100)
    assert Counter(map(tuple, out.select("doc_id", "n_shingles", "component_id").collect())) == brute_classes(EDGE_TEXTS, 4, 85, 100)
    assert ngram_join.similar_classes(none).count() == 0
    assert ngram_join.one_of_each(none).count() == 0


def test_one_of_each_class_stays(spark, edge):
    rows = near_copies(3, 10, 8, 80, 400)
    classes = brute_classes(rows, 5, 80, 100)
    out = ngram_join.one_of_each(frame(spark, rows))
    assert sorted(r["doc_id"] for r in out.collect()) == sorted({c for _, _, c in classes})
    assert ngram_join.one_of_each(edge).columns == edge.columns


def test_prefix_length_and_overlap_bounds():
    for n in range(1, 200):
        for m in range(n, 200):
            least = next(k for k in range(n + 1) if 100 * k >= 85 * (n + m - k) or k == n)
            if 100 * least >= 85 * (n + m - least):
                assert ngram_join.needed(n + m, 85, 100) == least
                assert ngram_join.prefix_length(n, 85, 100) >= n - least + 1


def test_overlap_check_equals_intersection():
    rng = np.random.default_rng(0)
    for _ in range(300):
        a, b = (np.unique(rng.integers(0, 60, rng.integers(0, 50)).astype(np.uint64)) for _ in range(2))
        both = len(np.intersect1d(a, b))
        for least in range(0, 40, 3):
            assert ngram_join.overlaps(a, b, least) == (both >= least)


def test_packing_round_trip():
    rng = np.random.default_rng(1)
    for values in (np.zeros(0, np.uint64), np.array([5], np.uint64), np.unique(rng.integers(0, 2**48, 5000).astype(np.uint64)), np.array([0, 2**47], np.uint64), np.arange(9, dtype=np.uint64)):
        assert np.array_equal(ngram_join._unpack(ngram_join._pack(values)), values)


def test_components_of_paths_and_cliques(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(200 + i, 200 + j) for i in range(6) for j in range(i)] + [(300, 300), (90, 80)]
    out = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()))
    assert out == {**{i: 0 for i in range(61)}, **{200 + i: 200 for i in range(6)}, 90: 80, 80: 80}


VECTORS = "vec_id long, embedding array<float>, label int, key string, n long, shard string"


def brute_vectors(rows, threshold=0.98):
    def valid(v, label):
        return label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)

    ok = [i for i, (_, v, label) in enumerate(rows) if valid(v, label)]
    links = []
    for k, i in enumerate(ok):
        for j in ok[:k]:
            a, b = (np.array(rows[x][1], np.float32).astype(float) for x in (i, j))
            if rows[i][2] == rows[j][2] and len(a) == len(b) and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= threshold:
                links.append((i, j))
    root, count = roots(len(rows), links), Counter(x for pair in links for x in pair)
    low = {}
    for (i, _, _), r in zip(rows, root):
        low[r] = min((x for x in (low.get(r), i) if x is not None), default=None)
    return [(i, count[k], low[root[k]]) for k, (i, _, _) in enumerate(rows)]


def test_links_of_vectors(spark, monkeypatch):
    monkeypatch.setattr(embedding_dups, "SHARD", 60)
    monkeypatch.setattr(embedding_dups, "SHARD_MAX", 120)
    rng = np.random.default_rng(4)
    rows = []
    for label in (1, 2):
        for _ in range(40):
            center = rng.normal(size=16)
            for _ in range(rng.integers(1, 14)):
                rows.append((len(rows), (center + rng.normal(scale=0.06, size=16)).astype(np.float32).tolist(), label))
    rows += [(len(rows) + k, rows[0][1], 1) for k in range(30)]  # copies
    df = spark.createDataFrame([(*r, "k", 1, "s") for r in rows], VECTORS).repartition(5)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embedding_dups.near_duplicates(df).collect()}
    want = {i: (n, c, i == c) for i, n, c in brute_vectors(rows)}
    assert all(got[i][0] <= want[i][0] for i in want)
    assert sum(g[0] for g in got.values()) >= 0.95 * sum(w[0] for w in want.values())
    assert np.mean([got[i][1:] == want[i][1:] for i in want]) >= 0.97


def test_links_of_a_dense_group_of_several_shards(spark, monkeypatch):
    monkeypatch.setattr(embedding_dups, "SHARD", 60)
    monkeypatch.setattr(embedding_dups, "SHARD_MAX", 120)
    rng = np.random.default_rng(6)
    center = rng.normal(size=16)
    rows = [(i, (center + rng.normal(scale=0.02, size=16)).astype(np.float32).tolist(), "a/1") for i in range(600)]
    rows += [(600 + i, rng.normal(size=16).astype(np.float32).tolist(), "a/1") for i in range(100)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label string").repartition(5)
    want = {i: (n, c) for i, n, c in brute_vectors(rows)}
    assert min(want[i][0] for i in range(600)) > 4 * embedding_dups.SHARD_MAX
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embedding_dups.near_duplicates(df).collect()}
    assert got == want


def test_vectors_of_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], None), (4, None, 1), (5, [], 1), (6, [0.0, 0.0], 1), (7, [nan, 1.0], 1)]
    rows += [(8, [inf, 1.0], 1), (9, [None, 1.0], 1), (10, [1.0, 0.0], 2), (11, [1.0, 0.0, 0.0], 1), (None, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (13, [-1.0, 0.0], 1)]
    df = spark.createDataFrame([(*r, "k", 1, "s") for r in rows], VECTORS)
    got = Counter((r["vec_id"], r["n_links"], r["component_id"]) for r in embedding_dups.near_duplicates(df).collect())
    assert got == Counter(brute_vectors(rows))
    assert embedding_dups.near_duplicates(spark.createDataFrame([], VECTORS)).count() == 0


def test_every_node_of_a_graph_is_reached():
    rng = np.random.default_rng(8)
    x = embedding_dups._unit(np.concatenate([rng.normal(c, 0.01, (40, 8)) for c in rng.normal(size=(5, 8))]))
    lists, start = embedding_dups.build(x)
    seen, stack = {start}, [start]
    while stack:
        for k in lists[stack.pop()]:
            if k not in seen:
                seen.add(k)
                stack.append(k)
    assert len(seen) == len(x)
