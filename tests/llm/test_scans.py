import base64
import json
import random
import re
from collections import Counter

from edge_cases import EDGE_TEXTS, frame

from keyferry.llm import pii, secrets

SECRET = {
    "assign": r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]+",
}
PERSONAL = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute_secrets(text):
    out = []
    for n, (kind, pattern) in enumerate(SECRET.items()):
        for m in re.finditer(pattern, text, re.A | (re.I if kind == "assign" else 0)):
            if {"assign": lambda: len(m[2]) >= 12, "access": lambda: len(m[0]) >= 18, "hex": lambda: len(m[0]) >= 16}[kind]():
                out.append((m.start(), n, m.end(), kind))
    return [(a, b, k) for a, _, b, k in sorted(out)]


def luhn(digits):
    return sum(int(c) if i % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for i, c in enumerate(reversed(digits))) % 10 == 0


def brute_personal(text):
    def holds(kind, match):
        digits = re.sub("[^0-9]", "", match)
        if kind == "ip":
            return all(int(p) <= 255 for p in match.split("."))
        if kind == "card":
            return 16 <= len(digits) <= 19 and luhn(digits)
        return kind == "email" or 8 <= len(digits) <= 15

    return [(k, m.start(), m.end()) for k, p in PERSONAL.items() for m in re.finditer(p, text, re.A) if holds(k, m[0])]


def element(tag, body):
    size = bytes([len(body)]) if len(body) < 128 else b"\x82" + len(body).to_bytes(2, "big")
    return bytes([tag]) + size + body


def b64url(data):
    return base64.urlsafe_b64encode(data).decode().rstrip("=")


KEY = element(0x30, element(2, b"\0") + element(0x30, element(6, b"\x2a\x86\x48")) + element(4, bytes(range(200))))
SSH = b"".join(len(p).to_bytes(4, "big") + p for p in (b"ssh-ed25519", bytes(32)))
JWT = ".".join([b64url(json.dumps({"alg": "HS256", "typ": "JWT"}).encode()), b64url(json.dumps({"sub": "1"}).encode()), "c2ln"])


def kinds(text):
    return [k for _, _, k in secrets.find(text) if k not in secrets.BASE_KINDS]


def test_structures_are_confirmed():
    run = base64.b64encode(KEY).decode()
    assert kinds(f"x {JWT} y") == ["jwt"]
    assert kinds(f"x {run} y") == ["der"]
    assert kinds(f"k {base64.b64encode(SSH).decode()} me") == ["sshkey"]
    assert kinds(f"h {KEY.hex()} y") == ["hexkey"]
    block = "\n".join(run[i : i + 64] for i in range(0, len(run), 64))
    assert "pem" in kinds(f"-----BEGIN RSA PRIVATE KEY-----\n{block}\n-----END RSA PRIVATE KEY-----")
    text = f"é𝒳 {JWT}!"
    (a, b, _), *_ = [s for s in secrets.find(text) if s[2] == "jwt"]
    assert text[a:b] == JWT


ENCRYPTED = element(0x30, element(0x30, element(6, bytes.fromhex("2a864886f70d01050d")) + element(0x30, b"")) + element(4, bytes(range(64))))


def test_keys_are_confirmed_wherever_they_are_written():
    run, ssh = base64.b64encode(KEY).decode(), base64.b64encode(SSH).decode()
    for text, kind, secret in ((f"private_key={run} y", "der", run), (f"k={ssh}", "sshkey", ssh), (f'"a\\n{run}\\n"', "der", run), (f"x={KEY.hex()}", "hexkey", KEY.hex())):
        found = [(text[a:b], k) for a, b, k in secrets.find(text) if k not in secrets.BASE_KINDS]
        assert found == [(secret, kind)]
    assert kinds(f"h {KEY.hex().upper()} y") == ["hexkey"] and kinds(f"h {KEY.hex().title()} y") == ["hexkey"]
    assert kinds("=" + "M" + "AbCd" * 30) == [] and kinds("30" * 40 + "AB" * 8) == []


def test_written_forms_of_pem_blocks():
    def block(data, name="RSA PRIVATE KEY", headers="", end="\n"):
        run = base64.b64encode(data).decode()
        return end.join([f"-----BEGIN {name}-----", *([headers.replace("\n", end), ""] if headers else []), *(run[i : i + 64] for i in range(0, len(run), 64)), f"-----END {name}-----"])

    sealed = "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,000102030405060708090A0B0C0D0E0F"
    for end in ("\n", "\r\n", "\\n", "\\r\\n"):
        forms = block(KEY, end=end), block(bytes(range(160)), headers=sealed, end=end), block(ENCRYPTED, "ENCRYPTED PRIVATE KEY", end=end)
        for text in forms:
            assert [text[a:b] for a, b, k in secrets.find(text) if k == "pem"] == [text]
    assert "pem" not in kinds(block(bytes(range(150)), headers=sealed))  # not whole blocks
    assert "pem" not in kinds(block(bytes(range(160)))) and "pem" not in kinds(block(ENCRYPTED[:-1]))
    digest = element(0x30, element(0x30, element(6, bytes.fromhex("608648016503040201")) + element(5, b"")) + element(4, bytes(32)))
    assert kinds(base64.b64encode(digest).decode()) == []


def test_what_only_looks_encoded_is_left_alone():
    run = base64.b64encode(KEY).decode()
    assert kinds(f"x {run[:-8]} y") == []  # cut short: lengths no longer fit
    assert kinds("M" + "AbCd" * 30) == []
    assert kinds("eyJhbGciOiJub25l.eyJhIjoxfQ.x") == []  # head is no JSON object
    assert kinds("ab" * 40) == [] and kinds("30" * 40) == []


def test_base_secrets_equal_the_patterns(spark):
    random.seed(5)
    parts = ["password", "PASSWD", "token", "api_key", "apikey", "ſecret", "=", ":", " ", '"', "'", "AKIA", "ABCDEF0123456789XY", "deadbeef01", "0f" * 8, "abcDEF123+/=", "é", "\n", ".", "-"]
    rows = [(i, "".join(random.choices(parts, k=random.randint(0, 14)))) for i in range(2000)]
    got = {r["doc_id"]: [(s["start"], s["end"], s["kind"]) for s in r["spans"] if s["kind"] in SECRET] for r in secrets.scan(frame(spark, rows)).collect()}
    assert got == {i: brute_secrets(t) for i, t in rows}
    assert sum(map(len, got.values())) > 300


def test_scans_of_edge_cases(edge, none):
    for scan in (secrets.scan, pii.scan):
        rows = scan(edge).collect()
        assert Counter(r["doc_id"] for r in rows) == Counter(i for i, _ in EDGE_TEXTS)
        assert all(r["spans"] == [] or r["doc_id"] == 10 for r in rows)
        assert scan(none).count() == 0


def test_base_personal_data_equals_the_patterns(spark):
    random.seed(2)
    parts = ["a@b.c", "x_y%z@q-r.s.t", "@", ".", "..", "1.2.3.4", "256.1.1.1", "0001.02.3.4", "1.2.3.4.5.6.7.8", "+1 (555) 123-4567", "+", "4785380592391139"]
    parts += ["4111 1111 1111 1111", "4111-1111-1111-1111", " ", "-", "é", "𝒳", "9", "12", "+49", "()", "a", "_", "%", "\n", "word", "ünï"]
    rows = [(i, "".join(random.choices(parts, k=random.randint(0, 14)))) for i in range(1500)] + [(9002, "9" * 20000), (9003, "a" * 100000), (9004, "1." * 3000), (9005, "+1" + "(" * 20000)]
    got = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["spans"]] for r in pii.find(frame(spark, rows)).withColumnRenamed("id", "doc_id").collect()}
    assert got == {i: brute_personal(t) for i, t in rows}


def test_telling_words_are_added_and_common_ones_are_not(spark):
    rows = [(i, f"call Zorblatt now: zed{i}@mail.org or jo@corp.com via the desk {i}") for i in range(6)]
    rows += [(100 + i, f"we now go via the park {i} or call") for i in range(60)]
    docs = frame(spark, rows)
    found = pii.scan(docs, support=3, generalise=0.8, remove=0.95).collect()
    text = dict(rows)
    words = {r["doc_id"]: {(text[r["doc_id"]][t["start"] : t["end"]].lower(), t["action"]) for t in r["terms"]} for r in found}
    assert all(words[i] == {("desk", "remove")} for i in range(6))
    assert all(not words[100 + i] for i in range(60))


def test_disclosure_equals_its_definition(spark):
    import math

    rows = [(i, "ask Quibb me@x.org Fnord soon") for i in range(4)] + [(10 + i, "Fnord sits soon") for i in range(3)] + [(20 + i, "nothing here") for i in range(13)]
    docs = frame(spark, rows)
    got = {r["term"]: r["disclosure"] for r in pii.disclosures(pii.find(docs), docs, support=3).collect()}
    information = -math.log(4 / 20)
    assert abs(got["quibb"] - 1) < 1e-12
    assert abs(got["fnord"] - math.log(4 * 20 / (4 * 7)) / information) < 1e-12


def test_sanitised_texts(spark):
    rows = [(i, "ask Quibb me@x.org é 10.0.0.1 end") for i in range(4)] + [(20 + i, "nothing é here end") for i in range(13)] + [(40, None)]
    docs = frame(spark, rows, extra=False)
    out = {r["doc_id"]: r["text"] for r in pii.sanitise(docs, pii.scan(docs, near=1, generalise=0.9, remove=2.0)).collect()}
    assert out[0].startswith("ask Xxxxx <email> ") and "<ip>" in out[0]
    assert out[20] == "nothing é here end" and out[40] == ""
