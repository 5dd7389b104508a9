import random
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from edge_cases import EDGE_TEXTS, frame
from pyspark.sql import functions as F

from keyferry.llm import language, toxicity
from keyferry.llm.common import held_out
from keyferry.session import checkpoint_dir

SYLLABLES = {"en": "the and ing er tion wh".split(), "de": "der und ung sch ei ü".split(), "es": "el ción os ñ rr que".split()}


def texts(n, seed=1):
    random.seed(seed)
    rows = []
    for i in range(n):
        lang = random.choice(list(SYLLABLES))
        words = ["".join(random.choices(SYLLABLES[lang], k=random.randint(1, 3))) for _ in range(random.randint(5, 60))]
        rows.append((i, " ".join(words), lang))
    return rows


def test_fold_is_crc32_of_the_id(spark):
    got = {r[0]: r[1] for r in spark.range(300).select("id", held_out("id")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in range(300)}


def test_gradients_equal_differences():
    net = language.Network(3, hidden=4)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    rng = np.random.default_rng(0)
    codes, lengths, target = rng.integers(0, 6, (7, 5)), np.array([7, 7, 5, 3, 1]), rng.integers(0, 3, 5)
    inside = (np.arange(7)[:, None] < lengths).astype(np.float32)

    def loss():
        passes = [net._pass(side, codes, inside, False)[0] for side in (0, 1)]
        return -sum((np.log(net.probabilities(t, *passes)[target, np.arange(5)]) * inside[t]).sum() for t in range(7)) / inside.sum()

    grad = net.gradients(codes, lengths, target)
    for name, values in net.p.items():
        for _ in range(6):
            at = tuple(rng.integers(0, s) for s in values.shape)
            at = (*at[:2], at[2] % 6) if name == "table" else at
            old = values[at]
            values[at] = old + 1e-2
            up = loss()
            values[at] = old - 1e-2
            down = loss()
            values[at] = old
            assert grad[name][at] == pytest.approx((up - down) / 2e-2, abs=2e-5)


def test_pooled_is_the_mean_over_bytes_one_window_at_a_time():
    net = language.Network(3)
    data = np.frombuffer(random.Random(1).randbytes(1500), np.uint8)
    offsets = np.array([0, 0, 1, 300, 428, 1500])
    got = language.pooled(net, data, offsets)
    for k in range(len(offsets) - 1):
        total, n = np.zeros(3), 0
        for at in range(offsets[k], offsets[k + 1], language.WINDOW):
            piece = data[at : min(at + language.WINDOW, offsets[k + 1])]
            total += net.label(piece[:, None].astype(np.intp), np.array([len(piece)]))[:, 0]
            n += len(piece)
        assert got[k] == pytest.approx(total / max(n, 1), abs=1e-5)


def test_languages_are_told_on_held_out_texts(spark):
    rows = texts(600)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    out = {r["doc_id"]: r for r in language.identify_held_out(docs).collect()}
    tested = [(i, lang) for i, _, lang in rows if out[i]["held_out"]]
    assert len(out) == 600 and len(tested) > 80
    assert np.mean([out[i]["lang_pred"] == lang for i, lang in tested]) >= 0.95
    assert all(0 <= r["score"] <= 1 for r in out.values())
    kept = language.keep_identified(docs, language.fit(docs))
    assert kept.columns == docs.columns and kept.count() == 600


def test_copies_do_not_shrink_what_is_learned_from(spark):
    one = F.when(F.col("id") < 29980, F.lit("one and the same")).otherwise(F.concat(F.lit("other "), F.col("id").cast("string")))
    rows = spark.range(30000).select(one.alias("text"), F.lit("en").alias("lang"))
    rows = rows.unionByName(spark.range(20000).select(F.concat(F.lit("text "), (F.col("id") % 200).cast("string")).alias("text"), F.lit("de").alias("lang")))
    rows = rows.unionByName(spark.range(9000).select(F.concat(F.lit("viel "), F.col("id").cast("string")).alias("text"), F.lit("xx").alias("lang")))
    windows, labels = language._sample(rows, F.col("text"), F.col("lang"), 400, 1)
    assert len(windows) == len(set(zip(windows, labels)))
    assert Counter(labels) == {"en": 21, "de": 200, "xx": 400}


def test_language_of_edge_cases(edge, none):
    model = language.fit(edge)
    out = language.identify(edge, model).collect()
    assert sorted(repr(r["doc_id"]) for r in out) == sorted(repr(i) for i, _ in EDGE_TEXTS)
    assert {r["doc_id"]: (r["lang_pred"], r["score"]) for r in out if r["doc_id"] in (2, 3, 4, 9)} == {k: ("und", 0.0) for k in (2, 3, 4, 9)}
    assert {r["lang_pred"] for r in out if r["doc_id"] not in (2, 3, 4, 9)} == {"en"}
    kept = language.keep_identified(edge, model)
    assert kept.columns == edge.columns and kept.count() == len(EDGE_TEXTS) - 4
    assert language.fit(none) is None
    assert language.identify_held_out(none).count() == 0
    assert {(r["lang_pred"], r["score"]) for r in language.identify(edge, None).collect()} == {("und", 0.0)}
    assert language.keep_identified(edge, None).count() == len(EDGE_TEXTS) - 4


def test_toxic_texts_are_told_on_held_out_rows(spark):
    random.seed(2)
    ordinary = [f"w{random.randint(0, 400)}" for _ in range(4000)] + ["the", "and"] * 400
    bad = ["idiot", "scum", "trash"]
    rows, labels = [], []
    for i in range(1500):
        toxic = i % 4 == 0
        words = random.choices(ordinary, k=random.randint(40, 120))
        for _ in range(len(words) // 25 + 1 if toxic else 0):
            words.insert(random.randrange(len(words)), random.choice(bad))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic), None))
    docs = frame(spark, rows)
    known = spark.createDataFrame(labels, "doc_id long, toxic int, quality int")
    out = {r["doc_id"]: r for r in toxicity.score(docs, toxicity.fit(docs, known)).withColumn("held", held_out("doc_id")).collect()}
    tested = [(out[i]["score"], out[i]["predicted"], t) for i, t, _ in labels if out[i]["held"]]
    hits = [p for _, p, t in tested if t]
    false = [p for _, p, t in tested if not t]
    assert np.mean(hits) >= 0.95 and np.mean(false) <= 0.03
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in out.values())


def test_kneser_ney_ratios_equal_their_definition(spark):
    """Every position of a small fit, computed again with plain loops."""
    random.seed(7)
    rows = [(i, " ".join(random.choices("a b c d e f".split() + (["g"] * 3 if i % 2 else []), k=random.randint(1, 9)))) for i in range(120)]
    docs = frame(spark, rows, extra=False)
    known = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, toxic int")
    model = toxicity.fit(docs, known)
    sample, _ = toxicity._sample(docs, known, "doc_id", "text", "toxic", (4000, 1000))
    train = [(r["toxic"], r["text"].split()) for r in sample.where("NOT tuning").collect()]
    pairs = [Counter(), Counter()]
    for y, t in train:
        pairs[y].update(zip([None, *t], t))
    both = pairs[0] + pairs[1]
    held = Counter(w for _, t in rows for w in set(t.split()))
    vocabulary = {x for p in both for x in p}

    def discount(counts):
        n = Counter(counts)
        return n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5

    def top(counts, v, w, rest):
        after = {y: n for (x, y), n in counts.items() if x == v}
        d, total = discount(counts.values()), sum(after.values())
        return max(after.get(w, 0) - d, 0) / total + d * len(after) / total * rest if after else rest

    def shared(v, w):
        before = Counter(y for _, y in both)
        d = discount(before.values())
        floor = (held[w] + 0.5) / (sum(held.values()) + 0.5 * (len(vocabulary) + 1))
        return top(both, v, w, max(before[w] - d, 0) / len(both) + d * len(before) / len(both) * floor)

    def probability(c, v, w):
        words = Counter()
        for (_, y), n in pairs[c].items():
            words[y] += n
        d, total = discount(words.values()), sum(words.values())
        return top(pairs[c], v, w, max(words[w] - d, 0) / total + d * len(words) / total * shared(v, w))

    for text in ["a b c", "g g a f", "e", "c d g b a a"]:
        t = text.split()
        want = [np.log(probability(1, v, w) / probability(0, v, w)) for v, w in zip([None, *t], t)]
        assert model.ratios(toxicity.words_of(text)) == pytest.approx(want, abs=1e-5)


def _area(out, labels):
    scored = sorted((out[i]["score"], t) for i, t in labels if out[i]["held"])
    toxic, ordinary = [s for s, t in scored if t], [s for s, t in scored if not t]
    return np.mean([(a > b) + 0.5 * (a == b) for a in toxic for b in ordinary])


def test_rare_insults_are_learned(spark):
    """Each of many insults stands in a few toxic texts and in no ordinary one."""
    rng = random.Random(4)
    ordinary = [f"w{rng.randint(0, 600)}" for _ in range(4000)] + ["the", "and"] * 400
    rows, labels = [], []
    for i in range(3000):
        toxic = i % 3 == 0
        words = rng.choices(ordinary, k=rng.randint(20, 60))
        for _ in range(2 if toxic else 0):
            words.insert(rng.randrange(len(words)), f"insult{rng.randrange(150)}")
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    docs, known = frame(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit(docs, known)
    out = {r["doc_id"]: r for r in toxicity.score(docs, model).withColumn("held", held_out("doc_id")).collect()}
    assert _area(out, labels) >= 0.9


def test_a_fixed_phrase_is_learned_from_its_pairs(spark):
    """The words of the phrase are common in both classes; only their order is not."""
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(1500):
        toxic = i % 4 == 0
        words = rng.choices([f"w{k}" for k in range(40)], k=60)
        at = rng.randrange(50)
        words[at:at] = ["w1", "w2", "w3", "w4"] if toxic else rng.sample(["w1", "w2", "w3", "w4"], 4)[::-1]
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    docs, known = frame(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")
    out = {r["doc_id"]: r for r in toxicity.score(docs, toxicity.fit(docs, known)).withColumn("held", held_out("doc_id")).collect()}
    assert _area(out, labels) >= 0.7


@pytest.mark.parametrize("words", [60, 1])
def test_texts_without_a_repeated_word(spark, words):
    rng = random.Random(6)
    rows = [(i, " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=12)) for _ in range(words))) for i in range(200)]
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, toxic int")
    docs = frame(spark, rows)
    out = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
    assert len(out) == 200 and all(0 <= r["score"] <= 1 for r in out)


def test_copies_and_both_labels(spark):
    rows = [(i, "same copy of one text") for i in range(300)] + [(1000 + i, f"idiot x{i} y{i % 7}") for i in range(60)] + [(2000 + i, f"fine x{i} y{i % 7}") for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)] + [(1000 + i, 1) for i in range(60)] + [(2000 + i, 0) for i in range(60)], "doc_id long, toxic int")
    docs = frame(spark, rows)
    sample, _ = toxicity._sample(docs, labels, "doc_id", "text", "toxic", (40, 40))
    drawn = Counter((r["toxic"], r["text"]) for r in sample.collect())
    assert max(drawn.values()) == 1 and drawn.get((0, "same copy of one text"), 0) == 0
    assert sum(y for y, _ in drawn) == 40 == sum(1 - y for y, _ in drawn)


def test_toxicity_of_edge_cases(spark, edge, none):
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 1), (8, 0), (11, 0), (11, 0), (6, 1)], "doc_id long, toxic int")
    out = toxicity.score(edge, toxicity.fit(edge, labels)).collect()
    assert sorted(repr(r["doc_id"]) for r in out) == sorted(repr(i) for i, _ in EDGE_TEXTS)
    assert all(0 <= r["score"] <= 1 for r in out)
    assert len({r["score"] for r in out if r["doc_id"] in (2, 3, 4)}) == 1
    empty = labels.where(F.lit(False))
    assert toxicity.fit(edge, empty) == 0.0
    assert toxicity.fit(edge, labels.where("toxic = 1")) == 1.0
    assert toxicity.score(none, toxicity.fit(none, empty)).count() == 0
    assert toxicity.score(none, toxicity.fit(none, labels)).count() == 0


def test_wrong_labels_do_not_move_the_cut():
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(0, 0.01, 900), rng.normal(0.1, 0.02, 100)])
    y = np.concatenate([rng.random(900) < 0.03, rng.random(100) > 0.1]).astype(float)
    slope, base = toxicity._noisy_logistic(x, y, np.ones(1000))
    assert 0.02 < -base / slope < 0.08 and slope > 50


def test_every_labelled_text_is_learned_from(spark):
    """More texts of both classes than any bound there was, each with a word of its own."""
    docs = spark.range(16000).select(F.col("id").alias("doc_id"), F.concat(F.lit("both say own"), F.col("id").cast("string")).alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 4 == 0).cast("int").alias("toxic"))
    sample, sizes = toxicity._sample(docs, labels, "doc_id", "text", "toxic")
    drawn = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert drawn == sizes and drawn[1] > 3000 and drawn[0] > 9000
    model = toxicity.fit(docs, labels)
    learned = sample.where("NOT tuning").count()
    assert model.words.count() == learned + 3  # both, say, and what stands before a text
    assert model.pairs.where("n0 + n1 = 1").count() == learned
    assert toxicity.score(docs, model).count() == 16000


def test_quantiles_of_points_that_stand_for_several_rows():
    rng = np.random.default_rng(8)
    x, n = rng.normal(size=40), rng.integers(1, 9, 40)
    q = np.linspace(0, 1, 33)
    assert toxicity._quantile(x, n, q) == pytest.approx(np.quantile(np.repeat(x, n), q))
    assert toxicity._quantile(x, None, q) == pytest.approx(np.quantile(x, q))


def test_ratios_are_pooled_text_by_text_whatever_shares_their_chunk():
    texts = ["a b c a b", "", "c", "", "b b a"]
    words = [toxicity.words_of(t) for t in texts]
    chunk = toxicity._Coded(np.concatenate(words), np.array([len(w) for w in words]))
    each = [toxicity._Coded(w, np.array([len(w)])) for w in words]
    place = {p: k / 7 - 1 for k, p in enumerate(chunk.pairs.tolist())}
    want = [c.pooled(np.array([place[p] for p in c.pairs[c.place].tolist()]), 0.1)[0] for c in each]
    assert chunk.pooled(np.array([place[p] for p in chunk.pairs[chunk.place].tolist()]), 0.1) == pytest.approx(want)
    assert want[1] == want[3] == 0.0


def _many_words(spark, texts, words, seed=9):
    """Texts of random words, few of which come again, and their labels."""
    rng = random.Random(seed)
    rows = [(i, " ".join(f"w{rng.randrange(200_000)}" for _ in range(words))) for i in range(texts)]
    return frame(spark, rows, extra=False), spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, toxic int")


def _bytes_in(folder):
    return sum(f.stat().st_size for f in Path(folder).rglob("*") if f.is_file())


def test_toxicity_leaves_only_its_model_and_scores_on_disk(spark, tmp_path):
    """Every table in between stayed, the coded texts among them."""
    docs, labels = _many_words(spark, 1500, 120)
    docs.write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    start = _bytes_in(checkpoint_dir(spark))
    model = toxicity.fit(docs, labels)
    fitted = _bytes_in(checkpoint_dir(spark))
    assert toxicity.score(docs, model).count() == 1500
    assert fitted - start < 3 * _bytes_in(tmp_path / "docs")  # hardly a pair comes twice here
    assert _bytes_in(checkpoint_dir(spark)) - fitted < 100_000


def test_scores_do_not_depend_on_rounds_and_chunks(spark):
    docs, labels = _many_words(spark, 300, 50)
    rows = docs.select(F.col("doc_id").alias("id"), "text").unionByName(spark.createDataFrame([(None, "w1 w2"), (None, ""), (7, "")], "id long, text string"))
    model = toxicity.fit(docs, labels)
    once = toxicity._pooled_ratios(rows, model, [0.0, 0.5]).collect()
    thrice = toxicity._pooled_ratios(rows.repartition(7), model, [0.0, 0.5], 3).collect()
    assert len(once) == 303 and sorted(map(repr, once)) == sorted(map(repr, thrice))


def test_blocks_give_back_their_rows_and_answer_in_few_bytes(spark):
    """An asked key took a row of chunk, kind and key, an answer another one with an array."""
    rng = np.random.default_rng(4)
    keys = np.unique(rng.integers(-(2**63), 2**63, 60_000))
    table = spark.createDataFrame([(int(k), i % 3, int(i == 5) << 40) for i, k in enumerate(keys)], "pair long, n0 long, n1 long")
    blocks = toxicity._Blocks.of(table, "pair", ("n0", "n1"), np.int64, 5)
    assert blocks.packed.count() == 5
    assert blocks.rows().exceptAll(table).count() == 0 == table.exceptAll(blocks.rows()).count()
    asked = np.sort(np.concatenate([keys[::2], rng.integers(-(2**63), 2**63, 30_000)]).view(np.uint64))
    assert len(toxicity._packed_keys(asked)) < 7 * len(asked)
    assert (toxicity._unpacked_keys(toxicity._packed_keys(asked), len(asked)) == asked).all()
    ranges = toxicity._ranges(asked, 5)
    assert ranges[0][0] == 0 and ranges[-1][1] == len(asked) and all(a[1] == b[0] for a, b in zip(ranges, ranges[1:]))
    in_spark = table.where(F.expr(toxicity.SLOT.format(key="pair", slots=5)) == 3).select("pair").toArrow()["pair"].to_numpy().view(np.uint64)
    every = np.sort(keys.view(np.uint64))
    b, e = toxicity._ranges(every, 5)[3]
    assert sorted(in_spark.tolist()) == every[b:e].tolist()


def test_what_comes_from_the_model_is_what_a_join_gives(spark):
    docs, labels = _many_words(spark, 200, 40)
    model = toxicity.fit(docs, labels)
    rows = docs.select(F.col("doc_id").alias("id"), "text")
    coded = toxicity._coded(rows)
    answers = model.pair_blocks.answers(coded, True).toArrow()
    known = {r["pair"] & (2**64 - 1): (r["n0"], r["n1"]) for r in model.pairs.collect()}
    for row in coded.collect():
        keys = toxicity._different(*toxicity._decoded(row.asDict(), len(row["ids"])), True)
        own = answers.filter([c == row["chunk"] for c in answers["chunk"].to_pylist()])
        found, (n0, n1) = toxicity._Columns(2, np.int64).found(own, keys)
        got = dict(zip(found.tolist(), zip(n0.tolist(), n1.tolist())))
        assert got == {k: known[k] for k in keys.tolist() if k in known} and got
