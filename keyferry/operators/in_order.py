"""Guarded upsert on two keys, record by record in the order given, in rounds of joins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, release
from ..specs import MergeSpec
from .dedupe import collapse, quoted
from .lookup import spread
from .merge import merge


def _claimed(target: DataFrame, source: DataFrame, keys: tuple[str, str], id: str) -> DataFrame:
    """row, k1, k2 of the target rows that hold a key some record names."""
    rows = target.select(F.col(id).alias("row"), *[F.col(k).alias(f"k{n}") for n, k in enumerate(keys, 1)])
    found = [
        rows.join(source.select(F.col(f"k{n}").alias("_named")).filter("_named IS NOT NULL"), F.col(f"k{n}") == F.col("_named"), "left_semi")
        for n in (1, 2)
    ]
    return found[0].unionByName(found[1].filter("row IS NOT NULL")).dropDuplicates(["row"])


def _looked_up(records: DataFrame, key: str, maps: dict[str, DataFrame]) -> DataFrame:
    """Values of several maps (key, value) for one key of the records, which are shuffled once for all."""
    records = records.select("*", spread(records, key).alias("_ls"))
    for out, pairs in maps.items():
        k, v = pairs.columns
        right = pairs.select(F.col(k).alias("_lk"), F.col(v).alias(out))
        records = records.join(right, F.expr(f"_ls = _lk AND `{key}` IS NOT NULL"), "left").drop("_lk")
    return records.drop("_ls")


def _resolved(records: DataFrame, held: DataFrame) -> DataFrame:
    """What each record would do now, and the things it depends on; written.

    A record depends on the rows that hold its keys, and on keys that nobody holds. A second key that is
    only named along with one first key is no thing of its own: whoever names it depends on the same.
    Things go by a hash: if two meet in one, their records wait for each other as well, which costs a round.
    """
    rows = held.filter("k1 IS NOT NULL").select("k1", F.struct("row", "k2").alias("h"))
    by_first = cut_lineage(_looked_up(records, "k1", {"h1": rows}))
    rows = held.filter("k2 IS NOT NULL").select("k2", F.struct("row", "k1").alias("h"))
    owners = records.filter("k2 IS NOT NULL").groupBy("k2").agg(F.expr("count(k1) = count(1) AND min(k1) = max(k1)").alias("one"))
    found = _looked_up(by_first, "k2", {"h2": rows, "_one": owners}).selectExpr(
        "turn", "k1", "k2", "id",
        "CASE WHEN h1 IS NOT NULL THEN struct(h1.row AS row, k1, h1.k2 AS k2) WHEN h2 IS NOT NULL THEN struct(h2.row AS row, h2.k1 AS k1, k2) END AS hit",
        "coalesce(h1.row <> h2.row, false) AS refused",
        "CASE WHEN h1.row <> h2.row THEN false WHEN h1 IS NULL AND h2 IS NULL THEN true WHEN h2 IS NULL THEN k2 IS NOT NULL "
        "WHEN h1 IS NULL THEN k1 IS NOT NULL AND h2.k1 IS NULL ELSE false END AS changes",
        "h1 IS NOT NULL AND (k2 IS NULL OR coalesce(h2.row = h1.row, false) OR (h2 IS NULL AND coalesce(_one, false))) AS own",
        "CASE WHEN h1 IS NOT NULL THEN 'row:' || h1.row WHEN k1 IS NOT NULL THEN '1:' || k1 END AS on1",
        "CASE WHEN coalesce(h1.row = h2.row, false) THEN NULL WHEN h2 IS NOT NULL THEN 'row:' || h2.row "
        "WHEN k2 IS NOT NULL AND NOT coalesce(_one, false) THEN '2:' || k2 END AS on2",
        "monotonically_increasing_id() AS at",
    )
    # a hash of null would be a thing
    hashed = {f"on{n}": F.expr(f"CASE WHEN on{n} IS NOT NULL THEN xxhash64(on{n}) END") for n in (1, 2)}
    resolved = cut_lineage(found.withColumns(hashed))
    release(by_first)
    return resolved


def _with(records: DataFrame, per_thing: DataFrame, columns: list[str]) -> DataFrame:
    """Values of both things of each record, as ``<column>1`` and ``<column>2``."""
    for n in (1, 2):
        right = per_thing.select(F.col("thing").alias("_thing"), *[F.col(c).alias(f"{c}{n}") for c in columns])
        # a record without the thing meets nobody; its own number spreads such records
        left = F.coalesce(F.col(f"on{n}"), F.xxhash64("turn"))
        records = records.join(right, (left == F.col("_thing")) & F.col(f"on{n}").isNotNull(), "left").drop("_thing")
    return records


def _settled(records: DataFrame) -> DataFrame:
    """``certain`` for each record (``at``): no record still open before it can change its effect.

    Things have queues of records, in order. A record at the head of all its queues is certain. One that
    waits in a single queue is certain as long as all before it there are, and none of them changes who
    holds a key; after the first change still if it and all since that change come by their row's own
    first key and name no other row's or other record's second key.

    Only numbers and marks of the records take part; the step in between is written, so the shuffles of half the joins lie
    on disk at a time.
    """
    records = records.select("at", "turn", "changes", "own", "on1", "on2")
    queues = records.select("turn", "changes", F.explode(F.array_compact(F.array("on1", "on2"))).alias("thing"))
    heads = queues.groupBy("thing").agg(F.min("turn").alias("head"), F.min(F.when(F.col("changes"), F.col("turn"))).alias("change"))
    placed = cut_lineage(_with(records, heads, ["head", "change"]).selectExpr(
        "at", "turn", "own", "on1", "on2", "change1", "change2", "on1 IS NULL OR turn = head1 AS first1", "on2 IS NULL OR turn = head2 AS first2"
    ))
    sides = F.array(
        F.struct(F.col("on1").alias("thing"), F.col("first2").alias("loose"), F.col("change1").alias("change")),
        F.struct(F.col("on2").alias("thing"), F.col("first1").alias("loose"), F.col("change2").alias("change")),
    )
    waits = placed.select("turn", "own", F.explode(F.filter(sides, lambda s: s["thing"].isNotNull())).alias("s"))
    stops = waits.groupBy(F.col("s.thing").alias("thing")).agg(
        F.min(F.expr("CASE WHEN NOT s.loose OR (turn > s.change AND NOT own) THEN turn END")).alias("stop")
    )
    before = lambda n: f"(stop{n} IS NULL OR turn < stop{n})"
    judged = cut_lineage(_with(placed.select("at", "turn", "on1", "on2", "first1", "first2"), stops, ["stop"]).selectExpr(
        "at AS _at",
        f"CASE WHEN first1 AND first2 THEN true WHEN first2 THEN {before(1)} WHEN first1 THEN {before(2)} ELSE false END AS certain",
    ))
    release(placed)
    return judged


def merge_in_order(
    target: DataFrame,
    source: DataFrame,
    keys: tuple[str, str],
    spec: MergeSpec,
    id: str = "id",
    stage: Callable[[DataFrame], DataFrame] = cut_lineage,
) -> tuple[DataFrame, DataFrame]:
    """Upsert on either of two keys as if the records were applied one after the other by ``spec.order``.

    A record that finds no row by its keys becomes one, one that finds a single row updates it (the row
    keeps its first key and takes the record's second key), one that finds two is refused. Returns the new
    target and one action row per record: updated, inserted or duplicate_conflict. ``keys`` are each
    unique in the target; the source brings the id a new row would get. Records of equal order follow by
    the hash of their content.

    Each round applies all records whose effect is certain (see ``_settled``) and looks the others up
    again among the keys as they are then. The first open record always is certain, so the rounds end.
    Their number is at most the length of the longest chain of records of which each waits for a change of
    keys by the one before, plus one; any number of records of one key among them takes two or three
    rounds, also if a third of all records share it. Only the keys of named rows take part in rounds,
    never the target; each step is an equi join on unique values or an aggregate that combines before its
    shuffle. What a step of a round leaves is written, and goes with its shuffles when the next one has read it.
    """
    ready, final, actions = writes_in_order(target, source, keys, spec, id, stage)
    return merge(target, ready, final), actions


def writes_in_order(
    target: DataFrame, source: DataFrame, keys: tuple[str, str], spec: MergeSpec, id: str = "id", stage: Callable[[DataFrame], DataFrame] = cut_lineage
) -> tuple[DataFrame, MergeSpec, DataFrame]:
    """One row for each target row to write, how to merge it by id, and the actions."""
    k1, k2 = keys
    cols = source.columns
    # a place in the order for each record; what they stood at spreads equal ones
    order = [*spec.order, "_hash", "_stood"]
    placed = source.selectExpr("*", f"xxhash64({quoted(cols)}) AS _hash", "monotonically_increasing_id() AS _stood")
    placed = placed.repartitionByRange(*order).sortWithinPartitions(*order).drop("_hash", "_stood")
    numbered = stage(placed.withColumn("_turn", F.monotonically_increasing_id()))
    records = numbered.select(F.col("_turn").alias("turn"), F.col(k1).alias("k1"), F.col(k2).alias("k2"), F.col(id).alias("id"))
    held = stage(_claimed(target, records, keys, id))
    done: list[DataFrame] = []
    rounds: list[DataFrame] = []
    while True:
        resolved = _resolved(records, held)
        marks = _settled(resolved)
        judged = stage(resolved.join(marks, F.col("at") == F.col("_at")).select("turn", "k1", "k2", "id", "hit", "refused", "certain"))
        release(resolved, marks)
        certain = judged.filter("certain").selectExpr(
            "turn", "k1", "k2", "CASE WHEN refused THEN NULL WHEN hit IS NULL THEN id ELSE hit.row END AS to",
            "CASE WHEN refused THEN 'duplicate_conflict' WHEN hit IS NULL THEN 'inserted' ELSE 'updated' END AS action",
            "hit.k1 AS was1", "hit.k2 AS was2",
        )
        done.append(certain.select("turn", "to", "action"))
        rounds.append(judged)
        records = judged.filter("NOT certain").select("turn", "k1", "k2", "id")
        if records.isEmpty():
            break
        # a row's first key is the first it was given, its second key the last; a later record of the same
        # row may move it back, so all that touch a row count, not the marked changes alone
        moved = certain.filter("action <> 'duplicate_conflict'").groupBy(F.col("to").alias("row")).agg(
            F.coalesce(F.max("was1"), F.min_by("k1", F.when(F.col("k1").isNotNull(), F.col("turn")))).alias("k1"),
            F.coalesce(F.max_by("k2", F.when(F.col("k2").isNotNull(), F.col("turn"))), F.max("was2")).alias("k2"),
        )
        before, held = held, stage(held.join(moved.select("row"), "row", "left_anti").unionByName(moved))
        release(before)
    effects = done[0]
    for more in done[1:]:
        effects = effects.unionByName(more)
    joined = stage(numbered.join(effects.withColumnRenamed("turn", "_turn").withColumnRenamed("to", "_to"), "_turn"))
    release(numbered, held, *rounds)
    actions = joined.selectExpr(f"`{id}` AS source_id", f"`{k1}`", f"`{k2}`", "_to AS target_id", "action")
    rules = {id: "target", k1: "coalesce_target", k2: "coalesce_source"} | dict(spec.rules)
    keep = [c for c in cols if c in target.columns and c != id]
    folded = collapse(joined.filter("action <> 'duplicate_conflict'").select("_to", "_turn", *cols), ["_to"], ["_turn"], rules, keep)
    return folded.withColumnRenamed("_to", id), MergeSpec((id,), rules=rules, unique=True, delta=spec.delta), actions
