"""Rejects, casts to the declared types, constraint checks and load counts.

Rejecting marks rows in one column instead of splitting the frame: kept and rejected rows come out
of one pass, and every row keeps the first reason that applied.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from ..specs import TableSpec
from .dedupe import hashable, quoted

REJECT = "_reject"


def reject_if(df: DataFrame, condition: Column, reason: str) -> DataFrame:
    return reject_first(df, [(condition, reason)])


def reject_first(df: DataFrame, checks: Sequence[tuple[Column, str | Column]]) -> DataFrame:
    """Mark rows with the reason of the first condition that holds; earlier marks stay."""
    marks = [
        F.when(condition, F.lit(reason) if isinstance(reason, str) else reason) for condition, reason in checks
    ]
    if REJECT in df.columns:
        marks.insert(0, F.col(REJECT))
    return df.withColumn(REJECT, F.coalesce(*marks) if len(marks) > 1 else marks[0])


def split_rejects(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    if REJECT not in df.columns:
        df = df.withColumn(REJECT, F.lit(None).cast("string"))
    kept = df.filter(F.col(REJECT).isNull()).drop(REJECT)
    return kept, df.filter(F.col(REJECT).isNotNull())


def unlimited(kind: T.DataType) -> bool:
    return isinstance(kind, T.DecimalType) and kind.precision == 38


def cast_to_spec(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Cast to the declared types; a value that does not fit rejects its row as ``cast:<column>``.

    Columns that have their type already are passed through. Decimals with a declared number of places
    round to it; one of 38 digits stands for a number without limits, so a value that would lose digits
    does not fit.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    want = {f.name: f.dataType for f in spec.schema.fields}
    marks, out = [], []
    for name in df.columns:
        if name == REJECT:
            marks.insert(0, name)
        elif name not in want or have[name] == want[name]:
            out.append(f"`{name}`")
        else:
            cast = f"try_cast(`{name}` AS {want[name].simpleString()})"
            out.append(f"{cast} AS `{name}`")
            bad = f"{cast} IS NULL"
            if unlimited(want[name]):
                # compared as doubles for digits far behind the point, as wide decimals for many digits
                bad += f" OR CAST(`{name}` AS DOUBLE) <> CAST({cast} AS DOUBLE) OR try_cast(CAST(`{name}` AS STRING) AS DECIMAL(38,18)) <> try_cast({cast} AS DECIMAL(38,18))"
            marks.append(f"CASE WHEN `{name}` IS NOT NULL AND ({bad}) THEN 'cast:{name}' END")
    mark = f"coalesce({', '.join([*marks, 'CAST(NULL AS STRING)'])})"
    return df.selectExpr(*out, f"{mark} AS {REJECT}")


def violations(spec: TableSpec, columns: Sequence[str]) -> Column:
    """Comma-separated list of every not-null and domain violation of a row; null when clean."""
    checks = [f"CASE WHEN `{c}` IS NULL THEN 'required:{c}' END" for c in spec.required if c in columns]
    for c, allowed in spec.domains.items():
        if c in columns:
            values = ", ".join("'" + v.replace("'", "\\'") + "'" for v in allowed)
            checks.append(f"CASE WHEN `{c}` NOT IN ({values}) THEN 'domain:{c}' END")
    return F.expr(f"nullif(concat_ws(',', {', '.join(checks)}), '')" if checks else "CAST(NULL AS STRING)")


def validate(
    df: DataFrame,
    spec: TableSpec,
    refs: Mapping[str, DataFrame] | None = None,
    order: Sequence[str] = (),
    unique: bool = True,
) -> DataFrame:
    """Mark every row that the declared constraints would refuse.

    Required columns and domains are checked in the scan's own stage. Foreign keys are looked up
    in ``refs`` (table name to frame). Of rows that share a unique key the first by ``order`` stays.
    """
    mark = violations(spec, df.columns)
    df = df.withColumn(REJECT, F.coalesce(F.col(REJECT), mark) if REJECT in df.columns else mark)
    for fk in spec.foreign:
        if refs and fk.table in refs and fk.column in df.columns:
            df = fk_violations(df, refs[fk.table], fk.column, fk.ref)
    keys = [key for key in spec.unique if unique and set(key) <= set(df.columns)]
    return unique_violations(df, keys, order) if keys else df


def fk_violations(df: DataFrame, ref: DataFrame, column: str, ref_column: str = "id") -> DataFrame:
    from .lookup import lookup_key

    keys = ref.select(F.col(ref_column).alias("_fk")).filter(F.col("_fk").isNotNull()).distinct()
    hit = lookup_key(df, keys.select("_fk", F.col("_fk").alias("_hit")), column, "_found")
    return reject_if(hit, F.col(column).isNotNull() & F.col("_found").isNull(), f"fk:{column}").drop("_found")


def unique_violations(
    df: DataFrame, keys: Sequence[Sequence[str]], order: Sequence[str] = (), repeated: DataFrame | None = None
) -> DataFrame:
    """Mark all but the first row of each value of each key.

    Null keys never clash. Rows rejected before do not count; the keys are judged side by side. Of rows
    that are equal in every column one stands for all; the others come back as rejects.

    First the values that occur more than once are found, from the key columns alone, and written: usually
    none or few. Only rows with such a value are compared; all others pass by a join with that small
    table. ``df`` is read twice, so it should be a written frame. ``repeated`` gives those values where they
    are known.
    """
    clashes = cut_lineage(repeated_values(df, keys)) if repeated is None else repeated
    if REJECT not in df.columns:
        df = df.withColumn(REJECT, F.lit(None).cast("string"))
    if clashes.isEmpty():
        return df
    # written, so that a row's number tells copies apart and stays the same
    flagged = cut_lineage(with_listed(df, keys, clashes, "_clash").withColumn("_no", F.monotonically_increasing_id()))
    live = F.col("_clash") & F.col(REJECT).isNull()
    passed = flagged.filter(~live).drop("_clash", "_no")
    judged = _first_of_each(flagged.filter(live).drop("_clash"), keys, order)
    return passed.unionByName(judged.select(*passed.columns))


def repeated_values(df: DataFrame, keys: Sequence[Sequence[str]]) -> DataFrame:
    """Values that more than one row has, for all keys in one pass; ``_key`` tells whose they are."""
    live = df.filter(F.col(REJECT).isNull()) if REJECT in df.columns else df
    names = list(dict.fromkeys(c for key in keys for c in key))
    counted = live.select(*[F.col(c).alias(f"_v{names.index(c)}") for c in names])
    places = [f"_v{k}" for k in range(len(names))]
    if len(keys) == 1:
        found = counted.dropna(subset=places).groupBy(*places).agg(F.count(F.lit(1)).alias("_n"))
        return found.filter("_n > 1").select(F.lit(0).alias("_key"), *places)
    sets = [[f"_v{names.index(c)}" for c in key] for key in keys]
    found = counted.groupingSets(sets, *places).agg(F.count(F.lit(1)).alias("_n"), F.grouping_id().alias("_set"))
    number, whole = F.lit(None).cast("int"), F.lit(False)
    for n, key in enumerate(sets):
        mine = F.col("_set") == sum(1 << (len(places) - 1 - k) for k, p in enumerate(places) if p not in key)
        number = F.when(mine, F.lit(n)).otherwise(number)
        whole = whole | (mine & F.expr(" AND ".join(f"{p} IS NOT NULL" for p in key)))
    return found.filter((F.col("_n") > 1) & whole).select(number.alias("_key"), *places)


def with_listed(df: DataFrame, keys: Sequence[Sequence[str]], listed: DataFrame, out: str) -> DataFrame:
    """Add ``out``: whether one of the row's key values is listed, each once, as ``repeated_values`` gives them."""
    from .lookup import spread

    given = df
    names = list(dict.fromkeys(c for key in keys for c in key))
    hit = F.lit(False)
    for n, key in enumerate(keys):
        values = [f"_l{n}_{i}" for i in range(len(key))]
        mine = listed.filter(F.col("_key") == n).select(*[F.col(f"_v{names.index(c)}").alias(v) for c, v in zip(key, values)])
        on = F.expr(" AND ".join(f"`{c}` IS NOT NULL" for c in key))
        for c, v in zip(key, values):
            on = on & (spread(given, c) == F.col(v))
        df = df.join(mine, on, "left")
        hit = hit | F.col(values[0]).isNotNull()
    return df.select(*given.columns, hit.alias(out))


def _first_of_each(df: DataFrame, keys: Sequence[Sequence[str]], order: Sequence[str]) -> DataFrame:
    """Mark all but the first row of each key value; ``_no`` decides between equal rows.

    The first row is found with an aggregate that combines before its shuffle, then joined back,
    so a value shared by many rows is never gathered in one task.
    """
    from .lookup import spread

    given = df.drop("_no")
    parts = [f"`{c}`" for c in order] + [f"xxhash64({quoted([c for c in hashable(given) if c != REJECT])})", "_no"]
    out = df.select("*", F.expr(f"struct({', '.join(parts)}) AS _seq"))
    checks = []
    for n, key in enumerate(keys):
        names = [f"_u{n}_{i}" for i in range(len(key))]
        firsts = (
            out.filter(" AND ".join(f"`{c}` IS NOT NULL" for c in key))
            .groupBy(*[F.col(c).alias(u) for c, u in zip(key, names)])
            .agg(F.min("_seq").alias(f"_first{n}"))
        )
        on = F.expr(" AND ".join(f"`{c}` IS NOT NULL" for c in key))
        for c, u in zip(key, names):
            on = on & (spread(df, c) == F.col(u))
        out = out.join(firsts, on, "left")
        checks.append((F.expr(f"_first{n} IS NOT NULL AND _seq <> _first{n}"), "unique:" + "+".join(key)))
    return reject_first(out, checks).select(*given.columns)


def load_summary(df: DataFrame) -> DataFrame:
    """rows_in / rows_loaded / rows_skipped of a marked frame in one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(F.col(REJECT).isNull()).alias("rows_loaded"),
        F.count_if(F.col(REJECT).isNotNull()).alias("rows_skipped"),
    )


def report_sample(df: DataFrame, order: Sequence[str], n: int = 20) -> DataFrame:
    """First ``n`` rows of a report in the given order; each task keeps its own first ``n``."""
    return df.orderBy(*order).limit(n)


def reject_report(df: DataFrame, name: str, key: str, raw: Sequence[str]) -> DataFrame:
    """One report row per rejected row: object, key, kind, message and the raw row as JSON."""
    bad = df.filter(F.col(REJECT).isNotNull())
    return bad.select(
        F.lit(name).alias("object_name"),
        F.col(key).cast("string").alias("row_key"),
        F.split_part(F.col(REJECT), F.lit(":"), F.lit(1)).alias("error_type"),
        F.col(REJECT).alias("error_message"),
        F.to_json(F.struct(*raw)).alias("raw_row"),
    )
