"""Secrets in whole texts, confirmed by their structure.

Base spans are pattern matches with a least length. The method then decodes what looks encoded and
reports a span of its own kind only where the decoded bytes have the structure of a secret:

* ``jwt``: three base64url parts; the first decodes to a JSON object with ``alg``, the second to a JSON object;
* ``pem``: a block between BEGIN and END lines of a private key whose body parses as nested DER lengths;
  line ends may be written as escapes; with headers that name a cipher, the body is whole blocks of it;
* ``der``: a bare base64 run that parses as such a key: a sequence that fills its bytes, begins with a
  small version number and holds at least one more element of consistent length, or that names a
  password-based cipher and holds what it encrypted;
* ``sshkey``: a base64 run of length-prefixed strings that begins with a key type and ends exactly;
* ``hexkey``: a hex run, of either case, that decodes to a DER key.

All spans are code points, end exclusive. Base spans are found leftmost and non-overlapping per kind
and are never changed by the confirmation.

Defined cases: a null text counts as empty and has no spans; texts of any length are read whole;
repeated rows and null ids come out as they came in; further columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import base64
import binascii
import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, whole

ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# what only has to be long enough is searched by its length: a shorter run can't be a part of a longer one
HEX_LONG = re.compile(r"[0-9a-f]{16,}")
LEAST = {"assign": 12, "access": 18, "hex": 16}
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "jwt", "pem", "der", "sshkey", "hexkey")

SIGNED = re.compile(r"(?<![A-Za-z0-9_-])(eyJ[A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+)\.([A-Za-z0-9_-]*)")
# no character fits two parts side by side and nothing is given back, so a block is read once
PEM = re.compile(
    r"-----BEGIN ((?:[A-Z0-9]+ )*PRIVATE KEY)-----(?:\s|\\+[nrt])*+"
    r"((?:[A-Za-z][A-Za-z0-9-]*: [^\r\n\\]*(?:\r?\n|(?:\\+r)?\\+n)[\x20\t]*)*+)"
    r"((?:[A-Za-z0-9+/=\s]|\\+[nrt/])++)-----END \1-----"
)
ESCAPED = re.compile(r"\\+[nrt]|[\\\s]")
CIPHER = re.compile(r"DEK-Info: [A-Z0-9-]+,([0-9A-Fa-f]{16,32})\b")
# an escaped line end before a run is none of its characters
BASE64_RUN = re.compile(r"(?<![A-Za-z0-9+/])(?:(?<=\\)[nrt])?([A-Za-z0-9+/]{40,}={0,2})(?![A-Za-z0-9+/=])")
HEX_RUN = re.compile(r"(?<![0-9A-Fa-f])30[0-9A-Fa-f]{14,}")
# PKCS#5 and PKCS#12 password-based encryption
PASSWORD_BASED = (bytes.fromhex("2a864886f70d0105"), bytes.fromhex("2a864886f70d010c01"))
SSH_TYPES = (b"ssh-rsa", b"ssh-dss", b"ssh-ed25519", b"ecdsa-sha2-nistp256", b"ecdsa-sha2-nistp384", b"ecdsa-sha2-nistp521")
SSH_MAGIC = b"openssh-key-v1\0"


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the three base patterns."""
    out = []
    if any(c in text for c in ":="):
        out += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= LEAST["assign"]]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    out += [(m.start(), m.end(), "hex") for m in HEX_LONG.finditer(text)]
    return out


def decoded(run: str, url: bool = False) -> bytes | None:
    """Bytes of a base64 run, with or without padding; None if it isn't one."""
    run = run.rstrip("=")
    if len(run) % 4 == 1:
        return None
    try:
        return base64.b64decode(run + "=" * (-len(run) % 4), altchars=b"-_" if url else None, validate=True)
    except (binascii.Error, ValueError):
        return None


def _element(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """Tag, start and end of the content of the DER element at a place; None if its length doesn't fit."""
    if at + 2 > end:
        return None
    tag, size, at = data[at], data[at + 1], at + 2
    if size & 0x80:
        width = size & 0x7F
        if not 1 <= width <= 4 or at + width > end:
            return None
        size = int.from_bytes(data[at : at + width], "big")
        at += width
        if size < 128:
            return None
    return (tag, at, at + size) if at + size <= end else None


def is_key_der(data: bytes) -> bool:
    """A sequence over all bytes that begins with a version of 0 to 3 and holds only whole elements."""
    outer = _element(data, 0, len(data))
    if outer is None or outer[0] != 0x30 or outer[2] != len(data):
        return False
    at, tags = outer[1], []
    while at < outer[2]:
        inner = _element(data, at, outer[2])
        if inner is None:
            return False
        if not tags and not (inner[0] == 0x02 and inner[2] - inner[1] == 1 and data[inner[1]] <= 3):
            return False
        if inner[0] in (0x30, 0xA0, 0xA1) and not _nested(data, inner[1], inner[2]):
            return False
        tags.append(inner[0])
        at = inner[2]
    return len(tags) >= 2 and any(t in (0x02, 0x04, 0x30) for t in tags[1:])


def _nested(data: bytes, at: int, end: int) -> bool:
    while at < end:
        inner = _element(data, at, end)
        if inner is None:
            return False
        at = inner[2]
    return True


def is_encrypted_der(data: bytes) -> bool:
    """A sequence over all bytes of a password-based cipher with its parameters, and the octets it encrypted."""
    outer = _element(data, 0, len(data))
    if outer is None or outer[0] != 0x30 or outer[2] != len(data):
        return False
    cipher = _element(data, outer[1], outer[2])
    if cipher is None or cipher[0] != 0x30 or not _nested(data, cipher[1], cipher[2]):
        return False
    name = _element(data, cipher[1], cipher[2])
    octets = _element(data, cipher[2], outer[2])
    if name is None or name[0] != 0x06 or not data[name[1] : name[2]].startswith(PASSWORD_BASED):
        return False
    return octets is not None and octets[0] == 0x04 and octets[2] == outer[2] and octets[2] > octets[1]


def is_key(data: bytes) -> bool:
    return is_key_der(data) or is_encrypted_der(data)


def _is_encrypted_body(headers: str, body: bytes) -> bool:
    """Headers that name a cipher and its start value, and whole blocks of that size."""
    cipher = CIPHER.search(headers)
    return "Proc-Type: 4,ENCRYPTED" in headers and cipher is not None and len(body) > 0 and len(body) % (len(cipher[1]) // 2) == 0


def is_ssh_key(data: bytes) -> bool:
    """Length-prefixed strings to the very end, the first one a key type; or the private container."""
    if data.startswith(SSH_MAGIC):
        data = data[len(SSH_MAGIC) :]
        at, parts = 0, 0
        while parts < 3:  # cipher, derivation, its options
            if at + 4 > len(data):
                return False
            at += 4 + int.from_bytes(data[at : at + 4], "big")
            parts += 1
        return at + 4 <= len(data) and 1 <= int.from_bytes(data[at : at + 4], "big") <= 64
    at, parts = 0, []
    while at < len(data):
        if at + 4 > len(data):
            return False
        size = int.from_bytes(data[at : at + 4], "big")
        if at + 4 + size > len(data):
            return False
        parts.append(data[at + 4 : at + 4 + size])
        at += 4 + size
    return len(parts) >= 2 and parts[0] in SSH_TYPES


def _json_object(data: bytes | None) -> dict | None:
    try:
        got = json.loads(data) if data else None
    except (ValueError, RecursionError):
        return None
    return got if isinstance(got, dict) else None


def confirmed_spans(text: str, hex_runs: list[tuple[int, int]]) -> list[tuple[int, int, str]]:
    """Spans whose decoded content has the structure of a signed token or a key."""
    out = []
    if "eyJ" in text:
        for m in SIGNED.finditer(text):
            head = _json_object(decoded(m[1], url=True))
            if head is not None and isinstance(head.get("alg"), str) and _json_object(decoded(m[2], url=True)) is not None:
                out.append((m.start(), m.end(), "jwt"))
    if "PRIVATE KEY-----" in text:
        for m in PEM.finditer(text):
            body = decoded(ESCAPED.sub("", m[3]))
            if body is not None and (is_key(body) or is_ssh_key(body) or _is_encrypted_body(m[2], body)):
                out.append((m.start(), m.end(), "pem"))
    for m in BASE64_RUN.finditer(text):
        # a DER sequence or a key type's length come first: 0x30, or three zero bytes, or the container's name
        if m[1].startswith(("M", "AAAA", "b3BlbnNzaC1rZXktdjE")):
            body = decoded(m[1])
            if body is not None:
                kind = "der" if is_key(body) else "sshkey" if is_ssh_key(body) else None
                if kind:
                    out.append((m.start(1), m.end(1), kind))
    for start, end in sorted({*hex_runs, *(m.span() for m in HEX_RUN.finditer(text))}):
        if (end - start) % 2 == 0 and text.startswith("30", start) and is_key(bytes.fromhex(text[start:end])):
            out.append((start, end, "hexkey"))
    return out


def find(text: str) -> list[tuple[int, int, str]]:
    """All spans of a text in order of start, then kind, then end."""
    base = base_spans(text)
    spans = base + confirmed_spans(text, [s[:2] for s in base if s[2] == "hex"])
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


SPANS = "array<struct<start:int,end:int,kind:string>>"


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and the spans of every whole text."""
    spark = bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), whole(text_col).alias("text"))
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))

    def run(batches):
        for batch in batches:
            spans = [[{"start": a, "end": b, "kind": k} for a, b, k in find(t)] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], names=["id", "spans"])

    out = rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, spans {SPANS}")
    return out.select(F.col("id").alias(id_col), "spans")
