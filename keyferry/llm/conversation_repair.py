"""Conversations mended at the least cost: rows kept, given another role, deleted, or put in.

A conversation is right if the initials of its roles read ``(s?(ua)+)?``. The edit lattice has a node for
every number of rows read and every state: nothing out yet, after system, after user, after assistant.
Keeping a row costs 0, another role 1, deleting 2, an empty row put in 5, and a truncated row that stays 5
more; blank rows and repetitions must go. The cheapest way through the lattice is found by Dijkstra's
algorithm from both ends: heaps of the start and of the end meet, all crossings of the same cost are
finished, and of the cheapest ways the one with the least audit (the initials of its edits) is taken.

A conversation of any length is spread over tasks. Rows are ranged by conversation and turn, written, and
cut into blocks of up to 1,024 rows by their place. A block finds the cheapest way from each
state to each state; the blocks of a conversation then are a short lattice of their own, searched the same
way, where ties are broken by the order of the blocks' audits. No audit of a block begins another one of it
with the same first state, because a block's way ends with an edit of its last row, so that order holds for
whole audits too.

Defined cases: conversations whose rows are all dropped stay, with nothing in them; a null id is a
conversation of its own; null turns come first; rows of one turn follow by role, then text (by its first
64 characters, then by digest), a repeated row after its first; a null role or text is one blank; roles
other than system, user and assistant go by their first letter; texts of any length; further columns are
ignored; an empty table gives empty results.
Memory in a task: one block's rows, or the block costs of one conversation.
"""

from __future__ import annotations

import hashlib
import heapq

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import cut_lineage
from .common import SPACES, bounded_batches, give_back

BLOCK_BITS = 10  # a block has up to 2 to this power of rows
STATES = "-sua"  # nothing out yet, after system, after user, after assistant
END = 4  # as a block's last state: the conversation is complete
NEXT = {0: 2, 1: 2, 2: 3, 3: 2}  # the state after a row put in or given another role
FROM = {2: (0, 1, 3), 3: (2,)}
CLOSING = {0: 0, 1: 2, 2: 1, 3: 0}  # rows to put in at the end
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
ROLE_OF = {2: "user", 3: "assistant"}
GONE, MUST_GO, CUT_SHORT, SOUND = 0, 1, 2, 3


def damage(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, turn, role, text, present: rows damaged by a hash of conversation and turn.

    Of twenty cases the first drops the row (it stays as one that is not present), the second empties the
    text, the third removes its sentence ends, the fourth repeats the row, the fifth makes it the user's.
    """
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    case = F.crc32(F.concat_ws(":", text_of(conv_col), text_of(turn_col))) % 20
    role, text = text_of(role_col), text_of(text_col)
    out = rows.select(
        F.col(conv_col).alias("conv_id"),
        F.col(turn_col).cast("bigint").alias("turn"),
        F.when(case == 4, "user").otherwise(role).alias("role"),
        F.when(case == 1, "").when(case == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (case != 0).alias("present"),
        F.explode(F.when(case == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )
    return out.drop("copy")


def ordered(rows: DataFrame) -> DataFrame:
    """The rows in order, written, each with its place ``at`` and what can be seen of it alone.

    Rows are spread by all the order goes by and by where they stood, so that no conversation, turn or
    repeated row has to fit one task.
    """
    text = F.coalesce("text", F.lit(" "))
    role = F.coalesce("role", F.lit(" "))
    conv = F.col("conv_id").cast("string")
    named = F.concat_ws(":", F.coalesce(F.length(conv), F.lit(-1)).cast("string"), conv, F.length(role).cast("string"), role, text)
    seen = rows.select(
        "conv_id",
        "turn",
        role.alias("role"),
        F.when(F.col("present"), text).alias("text"),
        "present",
        F.unhex(F.sha2(named.cast("binary"), 256)).alias("digest"),
    ).withColumn("stood", F.monotonically_increasing_id())
    keys = ["conv_id", "turn", "role", F.substring("text", 1, 64), "digest", "stood"]
    trimmed = F.rtrim("text", F.lit(SPACES))
    placed = (
        seen.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .select(
            "conv_id", "turn", "role", "text", "present", "digest",
            F.left("role", F.lit(1)).alias("initial"),
            (trimmed == "").alias("blank"),
            (~F.right(trimmed, F.lit(1)).isin(".", "!", "?")).alias("truncated"),
            F.monotonically_increasing_id().alias("at"),
        )
    )
    return cut_lineage(placed)


def _judged(placed: DataFrame) -> DataFrame:
    """conv_id, at, turn, initial, fault: the first fault of each row; repetitions are found by digest and first place."""
    rows = placed.select("conv_id", "at", "turn", "initial", "present", "blank", "truncated", "digest")
    firsts = rows.where("present").groupBy("digest").agg(F.min("at").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    fault = (
        F.when(~F.col("present"), "-").when(F.col("blank"), "blank").when(F.col("at") > F.col("first"), "duplicate").when(F.col("truncated"), "truncated").otherwise("")
    )
    return rows.join(firsts, "digest", "left").select("conv_id", "at", "turn", "initial", fault.alias("fault"))


# --- the search ---------------------------------------------------------------------------------


def least_path(start, end, ahead, back):
    """(cost, labels) of the cheapest way from start to end, of equally cheap ones with the least labels.

    ``ahead(node)`` gives (label, cost, next node), ``back(node)`` (cost, node before); labels of one node
    differ. None if there is no way.
    """
    dist = ({start: 0}, {end: 0})
    heaps = ([(0, start)], [(0, end)])
    settled: tuple[set, set] = (set(), set())
    best = 0 if start == end else None
    while heaps[0] and heaps[1]:
        if best is not None and heaps[0][0][0] + heaps[1][0][0] > best:
            break
        side = 0 if heaps[0][0][0] <= heaps[1][0][0] else 1
        d, node = heapq.heappop(heaps[side])
        if node in settled[side]:
            continue
        settled[side].add(node)
        mine, other = dist[side], dist[1 - side]
        for step in ahead(node) if side == 0 else back(node):
            cost, to = step[-2], step[-1]
            to_d = d + cost
            if to not in mine or to_d < mine[to]:
                mine[to] = to_d
                heapq.heappush(heaps[side], (to_d, to))
            if to in other and (best is None or to_d + other[to] < best):
                best = to_d + other[to]
    if best is None:
        return None
    from_start, to_end = dist
    settled[1].add(end)
    # nodes of the forward half from which a cheapest way goes on
    good = {n for n in settled[0] if any(t in settled[1] and from_start[n] + c + to_end[t] == best for _, c, t in ahead(n))}
    todo = list(good)
    while todo:
        node = todo.pop()
        for cost, before in back(node):
            if before in settled[0] and before not in good and from_start[before] + cost == from_start[node]:
                good.add(before)
                todo.append(before)
    labels, node, gone = [], start, 0
    while node != end:
        label, cost, node = min(
            (label, c, t)
            for label, c, t in ahead(node)
            if (t in settled[1] and gone + c + to_end[t] == best) or (t in good and gone + c == from_start[t])
        )
        gone += cost
        labels.append(label)
    return best, labels


def _row_edges(rows: list[tuple[str, int]], closes: bool):
    """Edges of a block's lattice; a node is 5 times the number of rows read, plus the state."""
    n = len(rows)
    over = 5 * n + END
    allowed = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}

    def ahead(node):
        i, state = divmod(node, 5)
        if state == END:
            return []
        if i == n:
            if not closes:
                return []
            return [("", 0, over)] if CLOSING[state] == 0 else [("I", INSERT, 5 * i + NEXT[state])]
        initial, kind = rows[i]
        after = NEXT[state]
        out = [("D", DELETE, node + 5), ("I", INSERT, 5 * i + after)]
        if kind != MUST_GO:
            more = TRUNCATED if kind == CUT_SHORT else 0
            out.append(("R", REROLE + more, 5 * (i + 1) + after))
            if (kept := allowed.get((state, initial))) is not None:
                out.append(("K", KEEP + more, 5 * (i + 1) + kept))
        return out

    def back(node):
        i, state = divmod(node, 5)
        if state == END:
            return [(0, 5 * n + s) for s in CLOSING if CLOSING[s] == 0]
        out = []
        if i < n or closes:
            out += [(INSERT, 5 * i + p) for p in FROM.get(state, ()) if i < n or CLOSING[p]]
        if i:
            initial, kind = rows[i - 1]
            out.append((DELETE, node - 5))
            if kind != MUST_GO:
                more = TRUNCATED if kind == CUT_SHORT else 0
                for p in FROM.get(state, ()):
                    out.append((REROLE + more, 5 * (i - 1) + p))
                out += [(KEEP + more, 5 * (i - 1) + p) for (p, c), to in allowed.items() if c == initial and to == state]
        return out

    return ahead, back


def block_ways(rows: list[tuple[str, int]], opens: bool, closes: bool) -> list[tuple[int, int, int, str]]:
    """(from, to, cost, audit) of the cheapest ways through a block's rows: (initial, kind).

    ``opens``: the block is known to begin its conversation; ``closes``: known to end it.
    """
    ahead, back = _row_edges(rows, closes)
    out = []
    for start in (0,) if opens else (0, 1, 2, 3):
        for to in (END,) if closes else (0, 1, 2, 3):
            if to < min(start, 2):
                continue
            if (found := least_path(start, 5 * len(rows) + to, ahead, back)) is not None:
                out.append((start, to, found[0], "".join(found[1])))
    return out


def chain_ways(blocks: list[list[tuple[int, int, int, int]]]) -> tuple[int, list[tuple[int, int]], int]:
    """(cost, (from, to) of each block, rows put in at the end) of the cheapest way through (from, to, cost, rank) of blocks."""
    n = len(blocks)
    over = 5 * n + END
    out_of: dict[int, list] = {}
    into: dict[int, list] = {}
    for i, ways in enumerate(blocks):
        for start, to, cost, rank in ways:
            a, b = 5 * i + start, 5 * (i + 1) + to
            out_of.setdefault(a, []).append((rank, cost, b))
            into.setdefault(b, []).append((cost, a))
    for state, rows in CLOSING.items():
        out_of.setdefault(5 * n + state, []).append((0, INSERT * rows, over))
        into.setdefault(over, []).append((INSERT * rows, 5 * n + state))
    cost, ranks = least_path(0, over, lambda k: out_of.get(k, []), lambda k: into.get(k, []))
    node, taken = 0, []
    for i in range(n):
        _, _, to = next(e for e in out_of[node] if e[0] == ranks[i])
        taken.append((node - 5 * i, to - 5 * (i + 1)))
        node = to
    last = taken[-1][1] if taken else 0
    return cost, taken, 0 if last == END else CLOSING[last]


# --- the tasks -----------------------------------------------------------------------------------

TALLIES = "blank bigint, duplicate bigint, truncated bigint, illegal bigint, turns bigint, least bigint, most bigint, first_initial string, last_initial string"
WAYS = "starts array<int>, ends array<int>, costs array<int>, ranks array<int>, audits array<string>"


def _runs(batches, key):
    """Consecutive rows of one key, as tuples, over the borders of batches."""
    held, now = [], None
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns]):
            k = key(row)
            if held and k != now:
                yield held
                held = []
            now = k
            held.append(row)
    if held:
        yield held


def _batches(rows, schema: pa.Schema, at_once: int = 2000):
    held = []
    for row in rows:
        held.append(row)
        if len(held) == at_once:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
    give_back()


def _block_row(rows: list[tuple], opens: bool, closes: bool) -> tuple:
    live = [r for r in rows if r[4] != "-"]
    kinds = {"blank": MUST_GO, "duplicate": MUST_GO, "truncated": CUT_SHORT, "": SOUND}
    ways = block_ways([(r[3], kinds[r[4]]) for r in live], opens, closes)
    order: dict[int, list[str]] = {}
    for start, _, _, audit in ways:
        order.setdefault(start, []).append(audit)
    ranks = [sorted(order[start]).index(audit) for start, _, _, audit in ways]
    turns = [r[2] for r in live if r[2] is not None]
    illegal = sum(a[3] + b[3] not in ("su", "ua", "au") for a, b in zip(live, live[1:]))
    faults = [sum(r[4] == f for r in live) for f in ("blank", "duplicate", "truncated")]
    seen = (*faults, illegal, len(set(turns)), min(turns, default=None), max(turns, default=None), live[0][3] if live else None, live[-1][3] if live else None)
    columns = zip(*[(a, b, c, r, t) for (a, b, c, t), r in zip(ways, ranks)]) if ways else [()] * 5
    return (rows[0][0], rows[0][1], *seen, *map(list, columns))


def _blocks(judged: DataFrame, bits: int) -> DataFrame:
    """conv_id, first, tallies, ways: one row per block."""
    id_type = judged.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {id_type}, first bigint, {TALLIES}, {WAYS}"
    arrow = _arrow(schema)

    def run(batches):
        def rows():
            for window in _runs(batches, lambda r: r[1] >> bits):
                blocks = [[window[0]]]
                for row in window[1:]:
                    if row[0] == blocks[-1][-1][0]:
                        blocks[-1].append(row)
                    else:
                        blocks.append([row])
                for k, block in enumerate(blocks):
                    yield _block_row(block, opens=k > 0, closes=k < len(blocks) - 1)

        yield from _batches(rows(), arrow)

    spread = judged.withColumn("window", F.shiftright("at", bits)).repartition("window").sortWithinPartitions("at")
    return cut_lineage(spread.select("conv_id", "at", "turn", "initial", "fault").mapInArrow(run, schema))


def _arrow(schema: str) -> pa.Schema:
    return to_arrow_schema(T.StructType.fromDDL(schema))


SUMMARY = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint"


def _chains(blocks: DataFrame) -> DataFrame:
    """home (a conversation's first place), first, start, to, closing, alone for every block; the summary with the last one."""
    id_type = blocks.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {id_type}, home bigint, first bigint, start int, to int, closing int, alone boolean, last boolean, {SUMMARY}"
    arrow = _arrow(schema)
    columns = ["conv_id", "first", "blank", "duplicate", "truncated", "illegal", "turns", "least", "most", "first_initial", "last_initial", "starts", "ends", "costs", "ranks"]

    def run(batches):
        def rows():
            for chain in _runs(batches, lambda r: (r[0] is None, r[0])):
                conv, home = chain[0][:2]
                cost, taken, closing = chain_ways([list(zip(*r[11:15])) for r in chain])
                blank, duplicate, truncated, illegal, turns = (sum(r[k] for r in chain) for k in range(2, 7))
                initial = top = None
                for r in chain:
                    if r[9] is not None:
                        illegal += initial is not None and initial + r[9] not in ("su", "ua", "au")
                        initial = r[10]
                    if r[7] is not None:
                        turns -= r[7] == top  # a turn on both sides of a border
                        top = r[8]
                low = min((r[7] for r in chain if r[7] is not None), default=None)
                gaps = 0 if low is None else top - low + 1 - turns
                for k, (r, (start, to)) in enumerate(zip(chain, taken)):
                    last = k == len(chain) - 1
                    summary = (gaps, blank, duplicate, truncated, illegal, cost) if last else (None,) * 6
                    yield (conv, home, r[1], start, to, closing if last else 0, len(chain) == 1, last, *summary)

        yield from _batches(rows(), arrow)

    sorted_blocks = blocks.select(columns).repartition("conv_id").sortWithinPartitions("conv_id", "first")
    return cut_lineage(sorted_blocks.mapInArrow(run, schema))


def _applied(repair: Repair, run, schema: str) -> DataFrame:
    """Rows of a window in one task, each block's way before its rows."""
    placed = repair.placed
    ways = repair.blocks.select("first", F.explode(F.arrays_zip("starts", "ends", "audits")).alias("w")).select("first", F.col("w.starts").alias("start"), F.col("w.ends").alias("to"), F.col("w.audits").alias("audit"))
    taken = repair.chains.join(ways, ["first", "start", "to"])
    id_type = placed.schema["conv_id"].dataType.simpleString()
    null = lambda t: F.lit(None).cast(t)
    heads = taken.select(
        F.col("first").alias("at"), F.lit(0).alias("kind"), null(id_type).alias("conv_id"), null("string").alias("role"), null("string").alias("text"), null("boolean").alias("present"),
        "home", "start", F.concat("audit", F.repeat(F.lit("I"), F.col("closing"))).alias("audit"), "alone",
    )
    rows = placed.select(
        "at", F.lit(1).alias("kind"), "conv_id", "role", "text", "present", null("bigint").alias("home"), null("int").alias("start"), null("string").alias("audit"), null("boolean").alias("alone"),
    )
    both = heads.unionByName(rows).withColumn("window", F.shiftright("at", repair.bits)).repartition("window").sortWithinPartitions("at", "kind")
    return both.drop("window").mapInArrow(run, schema)


def _mended(batches):
    """Per block (home, first, alone, conv_id, audit, out); out: (at, edit, role, text) after the edits, deleted rows without a role."""
    for block in _runs_of_blocks(batches):
        head, rows = block[0], [r for r in block[1:] if r[5]]
        state, left, out = head[7], iter(rows), []
        at = block[1][0]
        for edit in head[8]:
            if edit == "I":
                state = NEXT[state]
                out.append((at, edit, ROLE_OF[state], ""))
                continue
            row = next(left)
            at = row[0]
            if edit == "D":
                out.append((at, edit, None, row[4]))
                continue
            if edit == "R":
                state = NEXT[state]
                out.append((at, edit, ROLE_OF[state], row[4]))
            else:
                state = STATES.index(row[3][:1])
                out.append((at, edit, row[3], row[4]))
        yield head[6], head[0], head[9], block[1][2], head[8], out


def _runs_of_blocks(batches):
    held = []
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns]):
            if row[1] == 0 and held:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


class Repair:
    """Rows of conversations (conv_id, turn, role, text, present), mended.

    ``rows()`` gives the mended conversations row by row, ``summary()`` one row per conversation.
    """

    def __init__(self, rows: DataFrame, bits: int = BLOCK_BITS):
        bounded_batches(rows.sparkSession)
        self.bits = bits
        self.placed = ordered(rows)
        self.blocks = _blocks(_judged(self.placed), bits)
        self.chains = _chains(self.blocks)

    def rows(self) -> DataFrame:
        """conv_id, at, step, edit, role, text: every edit in order; deleted rows have a null role."""
        id_type = self.placed.schema["conv_id"].dataType.simpleString()
        schema = f"conv_id {id_type}, at bigint, step int, edit string, role string, text string"
        arrow = _arrow(schema)

        def run(batches):
            yield from _batches(((conv, at, k, edit, role, text) for _, _, _, conv, _, out in _mended(batches) for k, (at, edit, role, text) in enumerate(out)), arrow, 500)

        return _applied(self, run, schema)

    def summary(self) -> DataFrame:
        """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of the mended ``role:text`` lines.

        A conversation in one block is hashed there; pieces of others are hashed in order, one at a time:
        a digest of one text can't be made in parts.
        """
        schema = "home bigint, first bigint, audit string, digest string, lines bigint, piece binary"
        arrow = _arrow(schema)

        def run(batches):
            def pieces():
                for home, first, alone, _, audit, out in _mended(batches):
                    lines = [f"{role}:{text}" for _, _, role, text in out if role is not None]
                    piece = "\n".join(lines).encode()
                    if alone:
                        yield home, first, audit, hashlib.sha256(piece).hexdigest(), len(lines), None
                    else:
                        yield home, first, audit, None, len(lines), piece

            yield from _batches(pieces(), arrow, 100)

        parts = cut_lineage(_applied(self, run, schema))
        joined_schema = "home bigint, audit string, repaired_sha256 string"
        joined_arrow = _arrow(joined_schema)

        def join(batches):
            def conversations():
                home, audit, digest, any_line = None, [], None, False
                for batch in batches:
                    for h, a, lines, piece in zip(*[c.to_pylist() for c in batch.columns]):
                        if h != home:
                            if home is not None:
                                yield home, "".join(audit), digest.hexdigest()
                            home, audit, digest, any_line = h, [], hashlib.sha256(), False
                        audit.append(a)
                        if lines:
                            digest.update((b"\n" if any_line else b"") + piece)
                            any_line = True
                if home is not None:
                    yield home, "".join(audit), digest.hexdigest()

            yield from _batches(conversations(), joined_arrow, 100)

        long = parts.where(F.col("digest").isNull()).repartition("home").sortWithinPartitions("home", "first")
        whole = parts.where(F.col("digest").isNotNull()).select("home", "audit", F.col("digest").alias("repaired_sha256"))
        digests = whole.unionByName(long.select("home", "audit", "lines", "piece").mapInArrow(join, joined_schema))
        return self.chains.where("last").join(digests, "home").select(
            "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"
        )
