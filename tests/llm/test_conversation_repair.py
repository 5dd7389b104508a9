import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import types as T

from keyferry.llm import conversation_repair as cr

SCHEMA = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
RIGHT = re.compile("(s?(ua)+)?")
BLANK = " \t\n\x0b\x0c\r"


def damaged(rows):
    out = {}
    for conv, turn, role, text in rows:
        mine = out.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        case = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if case == 0:
            continue
        if case == 1:
            text = ""
        elif case == 2:
            text = re.sub("[.!?]", "", text)
        elif case == 4:
            role = "user"
        mine += [(turn, role, text)] * (2 if case == 3 else 1)
    for mine in out.values():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    return out


def faults(rows):
    out, seen = [], set()
    for _, role, text in rows:
        bare = text.rstrip(BLANK)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(initials, fault):
    """(cost, audit, roles out) by going through rows and states one by one."""
    states = {"": (0, "", ())}  # keyed by the role initials so far, cut to what matters: none, s, u, a

    def more(states, key, way):
        if key not in states or way < states[key]:
            states[key] = way

    def insert(states):
        for _ in range(3):
            for at, (cost, audit, roles) in list(states.items()):
                to = "a" if at == "u" else "u"
                more(states, to, (cost + 5, audit + "I", (*roles, to)))
        return states

    for initial, f in zip(initials, fault):
        after = {}
        for at, (cost, audit, roles) in insert(states).items():
            more(after, at, (cost + 2, audit + "D", roles))
            if f in ("blank", "duplicate"):
                continue
            extra = 5 if f == "truncated" else 0
            to = "a" if at == "u" else "u"
            more(after, to, (cost + 1 + extra, audit + "R", (*roles, to)))
            if initial == to or (initial == "s" and at == ""):
                more(after, initial, (cost + extra, audit + "K", (*roles, initial)))
        states = after
    done = [w for at, w in insert(states).items() if at in ("", "a")]
    return min(done)


def expected(rows):
    out = []
    for conv, mine in damaged(rows).items():
        fault, initials = faults(mine), [r[1][:1] for r in mine]
        cost, audit, roles = cheapest(initials, fault)
        assert RIGHT.fullmatch("".join(roles))
        turns = [t for t, _, _ in mine if t is not None]
        lines, left, given = [], iter(mine), iter(roles)
        for edit in audit:
            row = None if edit == "I" else next(left)
            if edit == "D":
                continue
            initial = next(given)
            role = row[1] if edit == "K" else {"u": "user", "a": "assistant"}[initial]
            lines.append(f"{role}:{row[2] if row else ''}")
        out.append((
            conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *[fault.count(f) for f in ("blank", "duplicate", "truncated")],
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def got(df, **options):
    return sorted((tuple(r) for r in cr.Repair(cr.damage(df), **options).summary().collect()), key=repr)


def conversations(seed, n):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "Why?", "cut", " ", "", None, "Long words here. \n", "a.b", "Größe."]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", None, "sudo", ""]
    rows = []
    for conv in range(n):
        clean = rng.random() < 0.4
        for turn in range(rng.randint(1, 12)):
            if clean:
                rows.append((conv, turn, ["user", "assistant"][turn % 2], f"Text {turn}."))
            else:
                rows.append((conv, rng.choice([turn, turn, turn + 2, None]), rng.choice(roles), rng.choice([*texts, f"T{turn}."])))
    return rows


def test_search_equals_trying_every_edit():
    """All edits of short conversations, at most two rows put in at a place."""
    for n in range(4):
        for rows in itertools.product([("s", cr.SOUND), ("u", cr.SOUND), ("a", cr.SOUND), ("u", cr.CUT_SHORT), ("a", cr.MUST_GO), ("x", cr.SOUND)], repeat=n):
            ways = cr.block_ways(list(rows), opens=True, closes=True)
            names = {cr.SOUND: "", cr.CUT_SHORT: "truncated", cr.MUST_GO: "blank"}
            cost, audit, _ = cheapest([r[0] for r in rows], [names[r[1]] for r in rows])
            assert ways == [(0, cr.END, cost, audit)], rows


def test_blocks_in_a_row_equal_one_block():
    rng = random.Random(3)
    kinds = [("s", cr.SOUND), ("u", cr.SOUND), ("a", cr.SOUND), ("u", cr.CUT_SHORT), ("a", cr.CUT_SHORT), ("a", cr.MUST_GO), ("x", cr.SOUND)]
    for _ in range(300):
        rows = [rng.choice(kinds) for _ in range(rng.randint(0, 14))]
        [(_, _, cost, audit)] = cr.block_ways(rows, True, True)
        cuts = sorted(rng.randint(0, len(rows)) for _ in range(rng.randint(1, 4)))
        pieces = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)])]
        ways = [cr.block_ways(p, k == 0, False) for k, p in enumerate(pieces)]
        ranked = [[(a, b, c, sorted(t for s, _, _, t in w if s == a).index(t)) for a, b, c, t in w] for w in ways]
        found, taken, closing = cr.chain_ways(ranked)
        whole = "".join(next(t for a, b, _, t in w if (a, b) == pair) for w, pair in zip(ways, taken)) + "I" * closing
        assert (found, whole) == (cost, audit)


@pytest.mark.parametrize("bits", [10, 2, 0])
def test_conversations_equal_the_plain_way(spark, bits):
    rows = conversations(7, 120) + [(None, 1, "user", "Q?"), (None, 2, "assistant", "A."), (1000, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert got(df, bits=bits) == expected(rows)


def test_a_long_conversation_is_spread(spark):
    rng = random.Random(2)
    rows = [(1, t, rng.choice(["user", "assistant"]), rng.choice(["Yes.", "cut", f"T{t}.", f"U{t}!"])) for t in range(3000)]
    rows += [(2, t, ["user", "assistant"][t % 2], f"T{t}.") for t in range(6)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    repair = cr.Repair(cr.damage(df), bits=6)
    assert repair.blocks.count() > 40
    assert sorted((tuple(r) for r in repair.summary().collect()), key=repr) == expected(rows)


def test_rows_give_the_mended_conversations(spark):
    rows = conversations(11, 30)
    repair = cr.Repair(cr.damage(spark.createDataFrame(rows, SCHEMA)), bits=3)
    edits = {}
    for r in sorted(repair.rows().collect(), key=lambda r: (r["conv_id"], r["at"], r["step"])):
        edits.setdefault(r["conv_id"], []).append(r)
    for conv, *_, audit, digest in expected(rows):
        mine = edits.get(conv, [])
        assert "".join(r["edit"] for r in mine) == audit
        kept = [r for r in mine if r["role"] is not None]
        assert RIGHT.fullmatch("".join(r["role"][:1] for r in kept))
        assert hashlib.sha256("\n".join(f"{r['role']}:{r['text']}" for r in kept).encode()).hexdigest() == digest


def test_edge_tables(spark):
    assert got(spark.createDataFrame([], SCHEMA)) == []
    dropped = next(c for c in range(500) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows = [(dropped, 0, "user", "Gone.")] + [(7, 3, "user", "Same.")] * 40 + [(8, 1, "user", "x" * 300_000)]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("at", "first", "home", "digest", "present", "audit", "window", "kind"):
        df = df.selectExpr("*", f"'z' AS {name}")
    out = got(df)
    assert out == expected(rows)
    assert (dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) in out


def test_query_equals_its_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    from keyferry.llm.queries import ORACLES, QUERIES

    con = duckdb.connect()
    for name in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '/root/testdata/sf0.001/{name}.parquet'")
    for name in ("op13_conversation_repair", "op11_phrase_collocations"):
        out = QUERIES[name](spark, "/root/testdata/sf0.001")
        cur = con.execute(ORACLES[name])
        names = [c[0] for c in cur.description]
        assert sorted(names) == sorted(out.columns)
        want = sorted(([r[names.index(c)] for c in out.columns] for r in cur.fetchall()), key=repr)
        assert sorted((list(r) for r in out.collect()), key=repr) == want
