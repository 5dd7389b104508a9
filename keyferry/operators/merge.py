"""Set-based merges: upsert, conditional update, insert-only and match-count-guarded upsert.

A merge returns the new content of the target; ``TableStore.commit`` publishes it. Key columns are
the only shuffle keys: the source is collapsed on them with map-side combine, and the join reuses
that partitioning.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..specs import MergeSpec
from ..session import cut_lineage
from .dedupe import collapse, collapse_repeated, hashable, quoted, repeated_hashes, split_repeated
from .lookup import lookup_key

ACTION = "_action"


def key_expr(key: Sequence[str]) -> str:
    """SQL for what identifies a row: the key, or the first key that is not null with its place."""
    if len(key) == 1:
        return f"`{key[0]}`"
    return "coalesce(" + ", ".join(f"'{i}:' || `{c}`" for i, c in enumerate(key)) + ")"


def _held_keys(target: DataFrame, key: Sequence[str]) -> DataFrame:
    """Merge keys the target holds; reads no other column."""
    return target.selectExpr(f"{key_expr(key)} AS _k", "1 AS _n").filter("_k IS NOT NULL")


def _with_merge_key(df: DataFrame, key: Sequence[str], null_mark: int) -> DataFrame:
    """Add ``_k`` (first non-null key) and ``_n`` (1, or ``null_mark`` when there is none).

    Rows without a key get their own hash as ``_k``, so they spread out, and sides use different
    null marks, so they never match.
    """
    k = key_expr(key)
    kind = df.schema[key[0]].dataType if len(key) == 1 else T.StringType()
    filler = f"xxhash64({quoted(hashable(df))})"
    if isinstance(kind, T.IntegerType):
        filler = f"pmod({filler}, 2147483647)"
    elif not isinstance(kind, (T.LongType, T.StringType)):
        raise TypeError(f"merge keys are texts or whole numbers, not {kind.simpleString()}")
    return df.selectExpr(
        "*",
        f"coalesce({k}, CAST({filler} AS {kind.simpleString()})) AS _k",
        f"CASE WHEN {k} IS NULL THEN {null_mark} ELSE 1 END AS _n",
    )


def _split_keyless(source: DataFrame, key: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with a merge key, and rows that have none: a null never conflicts, so each of those is new."""
    none = " AND ".join(f"`{c}` IS NULL" for c in key)
    return source.filter(f"NOT ({none})"), source.filter(none)


def match_source(
    source: DataFrame,
    spec: MergeSpec,
    keep: Sequence[str] | None = None,
    stage: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Source, unless it is unique, collapsed to one row per key; rows without a key all stay.

    The source is read several times, so it should be a written frame; ``stage`` may write what is collapsed.
    """
    if spec.unique:
        return source
    keyed, loose = _split_keyless(source, spec.key)
    keyed = keyed.selectExpr("*", f"{key_expr(spec.key)} AS _k")
    folded = collapse_repeated(keyed, ["_k"], spec.order, spec.rules, keep, stage).drop("_k")
    return folded.unionByName(loose.select(*folded.columns))


RULES = {
    "source": "s__{c}",
    "target": "t__{c}",
    "least": "least(t__{c}, s__{c})",
    "greatest": "greatest(t__{c}, s__{c})",
    "coalesce_source": "coalesce(s__{c}, t__{c})",
    "coalesce_target": "coalesce(t__{c}, s__{c})",
}


def _merged(joined: DataFrame, target: DataFrame, source: DataFrame, spec: MergeSpec) -> DataFrame:
    update = "_in_s AND _in_t"
    if spec.changed:
        update += f" AND NOT (t__{spec.changed} <=> s__{spec.changed})"
    action = (
        f"CASE WHEN _in_t IS NULL THEN 'inserted' WHEN _in_s IS NULL THEN 'kept' "
        f"WHEN {update} THEN 'updated' ELSE 'unchanged' END"
    )
    out, given = [], set(source.columns)
    for c in target.columns:
        if c not in given:
            out.append(f"t__{c} AS `{c}`")
            continue
        rule = RULES[spec.rules.get(c, "source")].format(c=c)
        out.append(
            f"CASE {ACTION} WHEN 'updated' THEN {rule} WHEN 'inserted' THEN s__{c} ELSE t__{c} END AS `{c}`"
        )
    return joined.selectExpr("*", f"{action} AS {ACTION}").selectExpr(*out, ACTION)


def merge_with_actions(target: DataFrame, source: DataFrame, spec: MergeSpec) -> DataFrame:
    """Merged table plus ``_action``: inserted, updated, unchanged (condition not met), kept."""
    shared = [c for c in target.columns if c in source.columns]
    keyed, loose = _split_keyless(source, spec.key)
    src = _with_merge_key(keyed, spec.key, 0)
    if not spec.unique:
        src = collapse(src, ["_k", "_n"], spec.order, spec.rules, shared)
    tgt = _with_merge_key(target, spec.key, 2)
    s = src.selectExpr("_k AS _sk", "_n AS _sn", "true AS _in_s", *[f"`{c}` AS `s__{c}`" for c in shared])
    t = tgt.selectExpr("_k", "_n", "true AS _in_t", *[f"`{c}` AS `t__{c}`" for c in target.columns])
    on = F.expr("_k = _sk AND _n = _sn")
    none = [f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in t.schema.fields]
    # rows without a key take part in no join
    key_type = s.schema["_sk"].dataType.simpleString()
    new = loose.selectExpr(f"CAST(NULL AS {key_type}) AS _sk", "0 AS _sn", "true AS _in_s", *[f"`{c}` AS `s__{c}`" for c in shared])
    new = new.selectExpr(*none, "*")
    if not spec.delta:
        return _merged(t.join(s, on, "full_outer").union(new), target, source, spec)
    # Small source: the left and semi joins can broadcast it, so the target is rewritten by a
    # map-only pass and only its keys are scanned a second time.
    updated = t.join(s, on, "left")
    held = _held_keys(target, spec.key).join(s.select("_sk", "_sn"), on, "left_semi")
    added = s.join(held, on, "left_anti")
    return _merged(updated.union(added.selectExpr(*none, "*")).union(new), target, source, spec)


def merge(target: DataFrame, source: DataFrame, spec: MergeSpec) -> DataFrame:
    return merge_with_actions(target, source, spec).drop(ACTION)


def insert_only(
    target: DataFrame, source: DataFrame, key: Sequence[str], order: Sequence[str] = ()
) -> DataFrame:
    """Add source rows whose key the target lacks, and all without a key; stored rows never change."""
    spec = MergeSpec(tuple(key), rules={c: "target" for c in source.columns if c not in key})
    keyed, loose = _split_keyless(source, spec.key)
    src = _with_merge_key(keyed, spec.key, 0)
    firsts = collapse(src, ["_k", "_n"], order, spec.rules)
    held = _held_keys(target, spec.key).selectExpr("_k AS _tk", "_n AS _tn")
    added = firsts.join(held, F.expr("_k = _tk AND _n = _tn"), "left_anti")
    fill = [
        (F.col(c) if c in source.columns else F.lit(None)).cast(target.schema[c].dataType).alias(c)
        for c in target.columns
    ]
    return target.unionByName(added.select(*fill)).unionByName(loose.select(*fill))


def guarded_merge(
    target: DataFrame,
    source: DataFrame,
    keys: tuple[str, str],
    spec: MergeSpec,
    id: str = "id",
    stage: Callable[[DataFrame], DataFrame] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Upsert on either of two keys, refused when a row hits more than one target row.

    Returns the new target and one action row per source record: updated, inserted or
    duplicate_conflict. ``keys`` are the record key and the alternative key, each unique in the
    target; the source brings the id a new row would get.

    The result is that of applying the records one after the other in this order: refused ones,
    those that leave the alternative key of their row as it is, those that move their row to
    another alternative key, new ones; within each class by ``spec.order``. So
      * a record that moves a target row to an alternative key owns that key from then on, further
        records claiming it for another row are refused, and new records with it update that row;
      * new records that share an alternative key become one row with the first one's id.
    Each step is an equi join on unique keys or an aggregate that combines before its shuffle.
    The matched records are used several times; ``stage`` may write them once in between.
    """
    ready, final, actions = guarded_writes(target, source, keys, spec, id, stage)
    return merge(target, ready, final), actions


def guarded_writes(
    target: DataFrame,
    source: DataFrame,
    keys: tuple[str, str],
    spec: MergeSpec,
    id: str = "id",
    stage: Callable[[DataFrame], DataFrame] | None = None,
) -> tuple[DataFrame, MergeSpec, DataFrame]:
    """One row for each target row that a guarded merge writes, how to merge it by id, and the actions."""
    k1, k2 = keys
    rules = {id: "target", k1: "coalesce_target", k2: "coalesce_source"} | dict(spec.rules)

    src = match_source(source, MergeSpec((k1,), spec.order, {**rules, k1: "source"}, unique=spec.unique), stage=stage)
    cols = src.columns

    src = lookup_key(src, target.filter(f"`{k1}` IS NOT NULL").select(k1, id), k1, "_id1")
    src = lookup_key(src, target.filter(f"`{k2}` IS NOT NULL").select(k2, id), k2, "_id2")
    total = ", ".join(["_step", *[f"`{c}`" for c in spec.order], f"xxhash64({quoted(cols)})"])
    src = src.selectExpr(
        "*",
        "CASE WHEN _id1 <> _id2 THEN 0 WHEN _id1 IS NULL AND _id2 IS NULL THEN 3 "
        f"WHEN _id2 IS NULL AND `{k2}` IS NOT NULL THEN 2 ELSE 1 END AS _step",
        "coalesce(_id1, _id2) AS _hit",
    ).selectExpr("*", f"struct({total}) AS _turn")

    # of an empty target nothing was looked up, so there is nothing to keep
    if stage and not target.isEmpty():
        src = stage(src)

    # Who owns an alternative key the target does not hold yet: the first row moved to it, else
    # the first new record with it. What one record alone claims is its own, so only keys that
    # several claim are looked up.
    claims = src.filter(f"_step >= 2 AND _id2 IS NULL AND `{k2}` IS NOT NULL")
    shared = repeated_hashes(claims, [k2])
    _, contested = split_repeated(claims, [k2], shared)
    owners = contested.groupBy(k2).agg(F.expr(f"min_by(coalesce(_hit, `{id}`), _turn)").alias("_owner"))
    src = lookup_key(src, cut_lineage(owners), k2, "_owner").selectExpr(
        "*",
        "_step = 0 OR (_step = 2 AND coalesce(_owner <> _hit, false)) AS _refused",
        f"CASE WHEN _step = 3 THEN coalesce(_owner, `{id}`) ELSE _hit END AS _to",
    )
    actions = src.selectExpr(
        f"`{id}` AS source_id", f"`{k1}`", f"`{k2}`",
        "CASE WHEN NOT _refused THEN _to END AS target_id",
        f"CASE WHEN _refused THEN 'duplicate_conflict' WHEN _step = 3 AND _to = `{id}` THEN 'inserted' "
        "ELSE 'updated' END AS action",
    )

    writes = src.filter("NOT _refused").select("_to", "_step", *cols)
    keep = [c for c in cols if c in target.columns and c != id]
    folded = collapse_repeated(writes, ["_to"], ["_step", *spec.order], rules, keep)
    ready = folded.withColumnRenamed("_to", id)
    return ready, MergeSpec((id,), rules=rules, unique=True, delta=spec.delta), actions
