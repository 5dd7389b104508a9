"""Language of whole texts by a bidirectional gated recurrent network over bytes, in numpy.

Texts are cut into windows of ``WINDOW`` bytes that cover them whole. One recurrent pass runs forward
and one backward over each window; at every byte both states give probabilities of the languages, and
a document's probabilities are the mean over all its bytes. Training is backpropagation through time
with Adam over a bounded sample of labelled windows (``per_language`` of each language, drawn by hash
from all different labelled texts, so that copies take no other text's place); it runs on the driver, for its input and its parameters are of fixed size.

Defined cases: a null text, or one without a letter, is ``und`` with score 0, and so is every text if
no row could be learned from; texts of any length are read whole; equal texts get equal results;
repeated rows and null ids come out as they came in; further columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import base64
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, give_back, held_out

UNDETERMINED = "und"
WINDOW = 128
BLOCK = 2048  # windows that run side by side
MAX_LANGUAGES = 1000


class Network:
    """Update gate z, reset gate r and candidate n per direction; feature rows, windows in columns.

    ``table`` holds the input part of the three gates for each byte, so a byte is looked up, not
    multiplied; gates z and r are computed as (1 + tanh) / 2, with the half folded into the weights.
    """

    def __init__(self, n_out: int, hidden: int = 12, seed: int = 7):
        rng = np.random.default_rng(seed)
        h = self.hidden = hidden
        self.p = {
            "table": rng.normal(0, 0.3, (2, 3 * h, 256)),
            "inner": rng.normal(0, 0.4 / np.sqrt(h), (2, 3 * h, h)),
            "head": rng.normal(0, 0.3, (2, n_out, h)),
            "bias": np.zeros((n_out, 1)),
        }
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def _pass(self, side: int, codes: np.ndarray, inside: np.ndarray | None, keep: bool):
        """States at every place; ``keep`` also gives what backpropagation needs."""
        steps, width = codes.shape
        h = self.hidden
        table, inner = self.p["table"][side], self.p["inner"][side]
        states = np.empty((steps, h, width), np.float32)
        x, g = np.empty((3 * h, width), np.float32), np.empty((3 * h, width), np.float32)
        state = np.zeros((h, width), np.float32)
        trace = []
        for t in range(steps) if side == 0 else range(steps - 1, -1, -1):
            np.take(table, codes[t], axis=1, out=x, mode="clip")
            np.matmul(inner, state, out=g)
            gates = g[: 2 * h]
            gates += x[: 2 * h]
            np.tanh(gates, out=gates)
            gates *= 0.5
            gates += 0.5
            z, r, n = g[:h], g[h : 2 * h], g[2 * h :]
            if keep:
                raw = n.copy()
            n *= r
            n += x[2 * h :]
            np.tanh(n, out=n)
            if keep:
                trace.append((t, state.copy(), z.copy(), r.copy(), n.copy(), raw))
            state -= n
            state *= z
            state += n
            if inside is not None:
                state *= inside[t]
            states[t] = state
        return states, trace

    def probabilities(self, t: int, forward: np.ndarray, backward: np.ndarray) -> np.ndarray:
        out = self.p["head"][0] @ forward[t]
        out += self.p["head"][1] @ backward[t]
        out += self.p["bias"]
        out -= out.max(axis=0)
        np.exp(out, out=out)
        out /= out.sum(axis=0)
        return out

    def label(self, codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Sums over each window's bytes of the label probabilities at every byte."""
        full = int(lengths.min()) == len(codes)
        inside = None if full else (np.arange(len(codes))[:, None] < lengths).astype(np.float32)
        forward, _ = self._pass(0, codes, inside, False)
        backward, _ = self._pass(1, codes, inside, False)
        total = 0.0
        for t in range(len(codes)):
            p = self.probabilities(t, forward, backward)
            total = total + (p if inside is None else p * inside[t])
        return total

    def gradients(self, codes: np.ndarray, lengths: np.ndarray, target: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross entropy over all bytes, by backpropagation through time."""
        steps, width = codes.shape
        h = self.hidden
        inside = (np.arange(steps)[:, None] < lengths).astype(np.float32)
        passes = [self._pass(side, codes, inside, True) for side in (0, 1)]
        scale = 1.0 / inside.sum()
        grad = {k: np.zeros_like(v) for k, v in self.p.items()}
        errors = []
        for t in range(steps):
            e = self.probabilities(t, passes[0][0], passes[1][0])
            e[target, np.arange(width)] -= 1
            e *= inside[t] * scale
            errors.append(e)
            grad["bias"] += e.sum(axis=1, keepdims=True)
        for side, (states, trace) in enumerate(passes):
            head, inner = self.p["head"][side], self.p["inner"][side]
            flow = np.zeros((h, width), np.float32)
            to_input = np.zeros((steps, 3 * h, width), np.float32)
            for t, before, z, r, n, raw in reversed(trace):
                grad["head"][side] += errors[t] @ states[t].T
                flow += head.T @ errors[t]
                flow *= inside[t]
                dn = flow * (1 - z) * (1 - n * n)
                dz = flow * (before - n) * z * (1 - z) * 2  # the half is in the weights
                dr = dn * raw * r * (1 - r) * 2
                to_inner = np.concatenate([dz, dr, dn * r])
                to_input[t] = np.concatenate([dz, dr, dn])
                grad["inner"][side] += to_inner @ before.T
                flow = flow * z + inner.T @ to_inner
            where = codes.ravel()
            for k in range(3 * h):
                grad["table"][side][k] = np.bincount(where, weights=to_input[:, k].ravel(), minlength=256)
        return grad


def train(windows: list[bytes], labels: np.ndarray, n_out: int, steps: int = 160, batch: int = 256, rate: float = 0.02) -> Network:
    net = Network(n_out)
    rng = np.random.default_rng(11)
    mean = {k: np.zeros_like(v) for k, v in net.p.items()}
    square = {k: np.zeros_like(v) for k, v in net.p.items()}
    lengths = np.array([len(w) for w in windows])
    codes = np.zeros((WINDOW, len(windows)), np.intp)
    for k, w in enumerate(windows):
        codes[: len(w), k] = np.frombuffer(w, np.uint8)
    order = np.zeros(0, np.intp)
    for step in range(1, steps + 1):
        while len(order) < batch:  # every window comes up before any comes again
            order = np.concatenate([order, rng.permutation(len(windows))])
        pick, order = order[:batch], order[batch:]
        grad = net.gradients(codes[:, pick], lengths[pick], labels[pick])
        now = rate * (1 - 0.9 * step / steps)
        for k, g in grad.items():
            mean[k] += 0.1 * (g - mean[k])
            square[k] += 0.01 * (g * g - square[k])
            net.p[k] -= (now * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return net


def _sample(labelled: DataFrame, text: Column, label: Column, per_language: int, pieces: int) -> tuple[list[bytes], list[str]]:
    """Up to ``per_language`` windows of each language, ``pieces`` from places spread over each drawn text."""
    rows = labelled.select(label.alias("label"), text.alias("text"))
    different = rows.select("label", F.xxhash64("text").alias("text")).distinct()
    counts = {r["label"]: r["n"] for r in different.groupBy("label").agg(F.count(F.lit(1)).alias("n")).limit(MAX_LANGUAGES + 1).collect()}
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not counts:
        return [], []
    rates = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, 2.0 * per_language / (pieces * n))])
    draw = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    drawn = rows.where(draw < rates[F.col("label")])
    cuts = [
        F.substring("text", F.pmod(F.xxhash64("text", F.lit(k)), F.greatest(F.length("text") - WINDOW, F.lit(1))).cast("int") + 1, F.lit(WINDOW))
        for k in range(pieces)
    ]
    # the bound holds whatever was drawn, and for each language by itself
    windows = drawn.select("label", F.explode(F.array(*cuts)).alias("window")).distinct().withColumn("order", F.xxhash64("window", "label"))
    nth = F.row_number().over(Window.partitionBy("label").orderBy("order", "window"))
    got = windows.withColumn("nth", nth).where(F.col("nth") <= per_language).orderBy("order", "window").select("label", "window").collect()
    out, labels = [r["window"].encode()[:WINDOW] for r in got], [r["label"] for r in got]
    return out, labels


def _noise(windows: list[bytes]) -> list[bytes]:
    """What the windows would be in no language: their characters in any order, their letters drawn anew, or packed bytes."""
    rng = random.Random(13)
    out = []
    for k, w in enumerate(windows):
        text = list(w.decode(errors="ignore"))
        if k % 3 == 0:
            rng.shuffle(text)
        elif k % 3 == 1:
            letters = sorted({c for c in text if c.isalpha()}) or ["a"]
            text = [rng.choice(letters) if c.isalpha() else c for c in text]
        else:
            text = base64.b64encode(rng.randbytes(len(w))).decode()
        out.append("".join(text).encode()[: len(w)])
    return out


def fit(
    labelled: DataFrame, text_col: str = "text", label_col: str = "lang", per_language: int = 1500, pieces: int = 4, noise: bool = False
) -> tuple[Network, list[str]] | None:
    """A trained network and its labels, from rows whose text has a letter and whose label is not null.

    With ``noise`` the network has one more output, for text in no language, learned from as many windows
    as a language has: windows of the sample whose characters were shuffled, redrawn or packed.
    """
    usable = labelled.where(F.col(label_col).isNotNull() & F.coalesce(_has_letter(F.col(text_col)), F.lit(False)))
    windows, names = _sample(usable, F.col(text_col), F.col(label_col), per_language, pieces)
    if not windows:
        return None
    labels = sorted(set(names))
    targets = [labels.index(x) for x in names]
    if noise:
        spoiled = _noise(windows[: per_language])  # in hash order, so of all languages
        net = train(windows + spoiled, np.array(targets + [len(labels)] * len(spoiled)), len(labels) + 1, steps=240)
    else:
        net = train(windows, np.array(targets), len(labels))
    give_back()
    return net, labels


def _has_letter(text: Column) -> Column:
    return F.regexp_like(text, F.lit(r"\p{L}"))


def _windows(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and document of the windows that cover the byte ranges between the offsets."""
    sizes = np.diff(offsets)
    per = -(-sizes // WINDOW)
    docs = np.repeat(np.arange(len(sizes)), per)
    nth = np.arange(len(docs)) - np.repeat(np.cumsum(per) - per, per)
    starts = offsets[docs] + nth * WINDOW
    return starts, np.minimum(WINDOW, offsets[docs + 1] - starts), docs


def pooled(net: Network, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Mean label probabilities of each byte range; zeros for an empty one."""
    out = np.zeros((len(offsets) - 1, net.p["bias"].shape[0]))
    starts, lengths, docs = _windows(offsets)
    order = np.argsort(-lengths, kind="stable")
    for at in range(0, len(order), BLOCK):
        pick = order[at : at + BLOCK]
        size, first = lengths[pick], starts[pick]
        places = np.minimum(np.arange(int(size.max()))[:, None], size - 1) + first
        np.add.at(out, docs[pick], net.label(data[places].astype(np.intp), size).T)
    return out / np.maximum(np.diff(offsets), 1)[:, None]


def _labelled(net: Network, labels: list[str], texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Language and score of each text; None where there is no letter."""
    data = np.frombuffer(b"".join(t or b"" for t in texts), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t or b"") for t in texts])]).astype(np.int64)
    p = pooled(net, data, offsets)
    best = np.where(np.diff(offsets) > 0, p.argmax(axis=1), len(labels))
    return np.array([*labels, UNDETERMINED], dtype=object)[best], np.clip(p.max(axis=1), 0, 1)


def identify(docs: DataFrame, model: tuple[Network, list[str]] | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, lang_pred and score, the pooled probability of that language, for every row."""
    spark = bounded_batches(docs.sparkSession)
    text = F.col(text_col)
    rows = docs.select(F.col(id_col).alias("id"), F.when(_has_letter(text), text).cast("binary").alias("text"))
    if model is None:
        out = rows.select("id", F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))
        return out.withColumnRenamed("id", id_col)
    given = spark.sparkContext.broadcast(model)  # a few thousand weights

    def run(batches):
        for batch in batches:
            found, score = _labelled(*given.value, batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string()), pa.array(score, pa.float64())], names=["id", "lang_pred", "score"])
        give_back()

    out = rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, lang_pred string, score double")
    return out.withColumnRenamed("id", id_col)


def keep_identified(docs: DataFrame, model: tuple[Network, list[str]] | None, text_col: str = "text", most_noise: float = 0.8) -> DataFrame:
    """The documents, all their columns, that are in a language.

    Those go that have no letter, or of which a model fitted with ``noise`` takes more than ``most_noise``
    of the bytes' probability for text in no language. Without a model nothing can be judged but letters.
    """
    spark = bounded_batches(docs.sparkSession)
    rows = docs.where(F.coalesce(_has_letter(F.col(text_col)), F.lit(False)))
    if model is None:
        return rows
    given = spark.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            net, labels = given.value
            texts = [t.encode() for t in batch.column(at).to_pylist()]
            offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
            p = pooled(net, np.frombuffer(b"".join(texts), np.uint8), offsets)
            yield batch.filter(pa.array(p[:, len(labels) :].sum(axis=1) <= most_noise))
        give_back()

    return rows.mapInArrow(run, docs.schema)


def identify_held_out(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang") -> DataFrame:
    """Learn from four folds of the documents and label all of them; ``held_out`` marks the fifth fold."""
    model = fit(docs.where(~held_out(id_col)), text_col, label_col)
    out = identify(docs, model, id_col, text_col)
    return out.withColumn("held_out", held_out(id_col))
