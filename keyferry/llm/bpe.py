"""Byte-pair encoding and decoding with a public vocabulary file whose words carry an end mark.

Encoding: one Aho-Corasick pass finds the longest token at every place of a word; a backtracking walk
takes the longest one, falls back to its next shorter prefix token, and steps back where none fits.
Two neighbours fit if byte-pair merging would keep them apart (``PairTable``); the one chain of
fitting tokens that covers the word is what merging in rank order gives, in time linear in its length.
Decoding: token strings lie in one byte table with offsets; ids become byte ranges of it.

Ids travel as one binary per document, little-endian unsigned 32-bit integers.

Defined cases: a null text encodes as an empty one, empty texts and empty id lists give no tokens and
empty text, null ids decode to empty text; texts of any length are encoded whole; repeated rows and
null ids come out as they came in; further columns are ignored; an empty table gives an empty result.
Memory in a task: the vocabulary, bounded word caches, one Arrow batch and the words of one document.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
import sys
import unicodedata

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex
from tokenizers.normalizers import NFC, Lowercase, Sequence
from tokenizers.pre_tokenizers import Split

from .common import bounded_batches, give_back, whole

# Fixed values of the vocabulary's file format: contractions, the end mark and Unicode white space.
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
END_MARK = "</w>"
WHITE_CLASS = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WHITE = re.compile(f"[{WHITE_CLASS}]+")
PYTHON_ONLY_SPACE = re.compile("[\x1c-\x1f]")

END = ""  # stands for the end mark: one character that no byte maps to
CACHED_WORDS = 150_000
DECODED_AT_ONCE = 1 << 17


def byte_characters() -> list[str]:
    """The visible character of each byte: printable ones stay, the others follow from code point 256."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shown, extra = {b: chr(b) for b in printable}, 256
    for b in range(256):
        if b not in shown:
            shown[b] = chr(extra)
            extra += 1
    return [shown[b] for b in range(256)]


def _runs(kind: str, top: int) -> str:
    """A character class of the Unicode kind, in the version of Unicode that the library has."""
    every = "".join(chr(c) for c in range(top + 1) if not 0xD800 <= c < 0xE000)
    shift = lambda k: k if k < 0xD800 else k + 0x800  # noqa: E731  surrogates are no characters of a text
    found = Split(Regex(rf"\p{{{kind}}}+"), "removed", invert=True).pre_tokenize_str(every)
    return "".join(f"\\U{shift(a):08x}-\\U{shift(b - 1):08x}" for _, (a, b) in found)


# Texts of scripts above this code point go through wider, slower classes.
BEYOND = re.compile("[\u0250-\U0010ffff]")


@functools.cache
def piece_patterns() -> tuple[re.Pattern, re.Pattern]:
    """Contractions, runs of letters, single digits, runs of anything else but white space.

    One pattern for texts without characters ``BEYOND``, one for all.
    """
    out = []
    for top in (0x24F, sys.maxunicode):
        letters, numbers = _runs("L", top), _runs("N", top)
        out.append(re.compile(f"{CONTRACTIONS}|[{letters}]+|[{numbers}]|[^{WHITE_CLASS}{letters}{numbers}]+"))
    return out[0], out[1]


@functools.cache
def unknown_to_python() -> re.Pattern:
    """Characters that Python's Unicode tables don't have; Python can't compose or lower them."""
    new = (c for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c)) == "Cn")
    merged: list[list[int]] = []
    for c in new:
        if merged and merged[-1][1] == c - 1:
            merged[-1][1] = c
        else:
            merged.append([c, c])
    return re.compile("[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in merged) + "]")


class PairTable:
    """Whether merging in rank order keeps two neighbouring tokens apart, answered once per pair."""

    LIMIT = 250_000

    def __init__(self, rank: dict[tuple[int, int], int], made: dict[int, tuple[int, int, int]]):
        self.rank, self.made, self.known = rank, made, {}

    def apart(self, left: int, right: int) -> bool:
        key = (left, right)
        if (got := self.known.get(key)) is None:
            if len(self.known) >= self.LIMIT:
                self.known.clear()
            got = self.known[key] = self._apart(left, right)
        return got

    def _apart(self, left: int, right: int) -> bool:
        """Undo merges from the latest on; the border must never hold a pair that merges sooner.

        At equal rank the leftmost merge comes first: the border's, if the right token is undone.
        """
        none = (-1, 0, 0)
        before = float("inf")
        while True:
            if self.rank.get((left, right), before) < before:
                return False
            made_left, made_right = self.made.get(left, none), self.made.get(right, none)
            if made_left[0] > made_right[0]:
                before, left = made_left[0], made_left[2]
            elif made_right[0] >= 0:
                before, right = made_right[0] + 0.5, made_right[1]
            else:
                return True


class Decoder:
    """Token strings, each with the blank that parts it from the next, in one table with offsets."""

    def __init__(self, content: bytes):
        spec = json.loads(content)
        ids = {**spec["model"]["vocab"], **{t["content"]: t["id"] for t in spec["added_tokens"]}}
        texts = [b""] * (max(ids.values()) + 1)
        for t, i in ids.items():
            texts[i] = t.encode() + b" "
        self.sizes = np.array([len(t) for t in texts], dtype=np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(self.sizes)[:-1]])
        self.bytes = np.frombuffer(b"".join(texts), dtype=np.uint8)

    def _part(self, ids: np.ndarray) -> bytes:
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        places = np.repeat(self.offsets[ids] - (ends - sizes), sizes)
        places += np.arange(len(places))
        return self.bytes[places].tobytes()

    def text(self, ids: np.ndarray) -> bytes:
        parts = [self._part(ids[k : k + DECODED_AT_ONCE]) for k in range(0, len(ids), DECODED_AT_ONCE)]
        return b"".join(parts)[:-1]


class Encoder:
    """Tables of one vocabulary file."""

    def __init__(self, content: bytes):
        spec = json.loads(content)
        model = spec["model"]
        vocab = model["vocab"]
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_split = re.compile("(" + "|".join(map(re.escape, sorted(self.specials, key=len, reverse=True))) + ")") if self.specials else None
        marked = {t: (t.removesuffix(END_MARK) + END if t.endswith(END_MARK) else t) for t in vocab}
        rank, made = {}, {}
        for n, (a, b) in enumerate(model["merges"]):
            pair = (vocab[a], vocab[b])
            rank.setdefault(pair, n)
            made.setdefault(vocab[a + b], (n, *pair))
        self.pairs = PairTable(rank, made)
        by_text = {marked[t]: i for t, i in vocab.items()}
        base = {s: i for s, i in by_text.items() if i not in made}
        usable = {s: i for s, i in by_text.items() if i not in made or self._merged(s, base) == [i]}
        self.length = {i: len(s) for s, i in usable.items()}
        self.shorter = {i: next((usable[s[:k]] for k in range(len(s) - 1, 0, -1) if s[:k] in usable), -1) for s, i in usable.items()}
        self.longest = ahocorasick.Automaton()
        for s, i in usable.items():
            self.longest.add_word(s, (len(s), i))
        self.longest.make_automaton()
        self.near, self.far = (p.findall for p in piece_patterns())
        self.unknown, self.normal = unknown_to_python(), Sequence([NFC(), Lowercase()])
        self.shown = dict(enumerate(byte_characters()))
        self.pieces = Recent(self._piece_ids)
        self.words = Recent(self._word_ids)

    def _merged(self, text: str, base: dict[str, int]) -> list[int]:
        """Plain merging in rank order; only used to see which tokens merging can reach at all."""
        marked = text.endswith(END)
        parts = [base[c] for c in (text[:-2] if marked else text)] + ([base[text[-2:]]] if marked else [])
        while len(parts) > 1:
            n, at = min((self.pairs.rank.get(p, 1 << 60), k) for k, p in enumerate(zip(parts, parts[1:])))
            if n == 1 << 60:
                break
            a, b = parts[at], parts[at + 1]
            out, k = [], 0
            while k < len(parts):
                if k + 1 < len(parts) and parts[k] == a and parts[k + 1] == b:
                    out.append(self._product(n))
                    k += 2
                else:
                    out.append(parts[k])
                    k += 1
            parts = out
        return parts

    def _product(self, n: int) -> int:
        if not hasattr(self, "_products"):
            self._products = {m[0]: i for i, m in self.pairs.made.items()}
        return self._products[n]

    def encode_piece(self, piece: str) -> list[int]:
        """Token ids of one word piece, by backtracking."""
        text = piece.encode().decode("latin-1").translate(self.shown) + END
        n = len(text)
        best = [-1] * n
        for end, (size, token) in self.longest.iter(text):
            best[end - size + 1] = token  # later ends are longer
        length, shorter, known, apart = self.length, self.shorter, self.pairs.known.get, self.pairs.apart
        dead = set()  # places from which no chain goes on
        out = [-1]
        at, token = 0, best[0]
        while at < n:
            last = out[-1]
            while token >= 0:
                to = at + length[token]
                if to not in dead:
                    if (fits := last < 0 or known((last, token))) is None:
                        fits = apart(last, token)
                    if fits:
                        break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                at = to
                token = best[at] if at < n else -1
            else:
                dead.add(at)
                token = out.pop()
                at -= length[token]
                token = shorter[token]
        return out[1:]

    def forget(self) -> None:
        """Drop what a task has gathered; the tables of the vocabulary stay for the next one."""
        for known in (self.words, self.pieces):
            known.clear()
            known.older = {}
        self.pairs.known.clear()

    def _piece_ids(self, piece: str) -> bytes:
        return np.array(self.encode_piece(piece), dtype="<u4").tobytes()

    def _word_ids(self, word: str) -> bytes:
        """A run between white space is one or more pieces."""
        pieces = (self.far if BEYOND.search(word) else self.near)(word)
        return self.pieces[word] if len(pieces) == 1 else b"".join(map(self.pieces.__getitem__, pieces))

    def encode(self, text: str) -> bytes:
        """Ids of a whole text, packed."""
        words = self.words
        if self.special_split is None or not self.special_split.search(text):
            return b"".join(map(words.__getitem__, self._units(text)))
        out = []
        for part in self.special_split.split(text):
            if part in self.specials:
                out.append(np.array([self.specials[part]], dtype="<u4").tobytes())
            else:
                out += map(words.__getitem__, self._units(part))
        return b"".join(out)

    def _units(self, text: str) -> list[str]:
        """Runs between white space, composed and in lower case, each letter by itself."""
        if BEYOND.search(text) and self.unknown.search(text):
            text = self.normal.normalize_str(text)
        else:
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        if PYTHON_ONLY_SPACE.search(text):
            return [u for u in WHITE.split(text) if u]
        return text.split()


class Recent(dict):
    """Computes what it doesn't hold; keeps the last one to two ``limit`` entries."""

    def __init__(self, compute, limit: int = CACHED_WORDS):
        super().__init__()
        self.compute, self.limit, self.older = compute, limit, {}

    def __missing__(self, key: str) -> bytes:
        got = self.older.get(key)
        if got is None:
            got = self.compute(key)
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        self[key] = got
        return got


@functools.lru_cache(maxsize=1)
def _encoder(key: str, content: bytes) -> Encoder:
    return Encoder(content)


@functools.lru_cache(maxsize=1)
def _decoder(key: str, content: bytes) -> Decoder:
    return Decoder(content)


def encoder(content: bytes) -> Encoder:
    """Built once per Python worker."""
    return _encoder(hashlib.sha256(content).hexdigest(), content)


def decoder(content: bytes) -> Decoder:
    """Built once per Python worker."""
    return _decoder(hashlib.sha256(content).hexdigest(), content)


def _content(spark, path: str):
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())  # a vocabulary file, a few MB


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ids (packed) and n_tokens of every whole text."""
    spark = bounded_batches(docs.sparkSession)
    content = _content(spark, path)

    def run(batches):
        v = encoder(content.value)
        for batch in batches:
            packed = [v.encode(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], names=["id", "ids"])
        v.forget()
        give_back()

    rows = docs.select(F.col(id_col).alias("id"), whole(text_col).alias("text"))
    out = rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, ids binary")
    return out.select(F.col("id").alias(id_col), "ids", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"))


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids", keep: tuple[str, ...] = ()) -> DataFrame:
    """id, the columns ``keep`` and the decoded text of every list of packed ids."""
    spark = bounded_batches(encoded.sparkSession)
    content = _content(spark, path)

    def run(batches):
        v = decoder(content.value)
        for batch in batches:
            texts = [v.text(np.frombuffer(b or b"", dtype="<u4")) for b in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(texts, pa.string())], names=[*batch.schema.names[1:], "decoded"])

    rows = encoded.select(F.col(ids_col).alias("__ids"), F.col(id_col).alias("__id"), *[F.col(c).alias(f"__{n}") for n, c in enumerate(keep)])
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[1:])
    out = rows.mapInArrow(run, f"{schema}, decoded string")
    return out.select(F.col("__id").alias(id_col), *[F.col(f"__{n}").alias(c) for n, c in enumerate(keep)], "decoded")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", cached: int = 50_000) -> DataFrame:
    """id, ids (packed), n_tokens and the decoded text, encoded and decoded by one Python worker per task.

    ``cached`` bounds the words a worker remembers, for jobs whose earlier stages have filled the executor.
    """
    spark = bounded_batches(docs.sparkSession)
    content = _content(spark, path)

    def run(batches):
        v, d = encoder(content.value), decoder(content.value)
        v.words.limit = v.pieces.limit = cached
        for batch in batches:
            packed = [v.encode(t) for t in batch.column(1).to_pylist()]
            texts = [d.text(np.frombuffer(b, dtype="<u4")) for b in packed]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary()), pa.array(texts, pa.string())], names=["id", "ids", "decoded"])
        v.forget()
        give_back()

    rows = docs.select(F.col(id_col).alias("id"), whole(text_col).alias("text"))
    out = rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, ids binary, decoded string")
    return out.select(F.col("id").alias(id_col), "ids", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), "decoded")
