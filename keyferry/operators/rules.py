"""Decision tables: ordered rules, the first match decides."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quality import reject_if


@dataclass(frozen=True)
class Rule:
    """One row of a decision table.

    ``when`` gives the accepted texts per column (columns not named match anything). ``out`` gives
    the result columns as expressions over the row.
    """

    name: str
    when: dict[str, Sequence[str]]
    out: Callable[[], dict[str, Column]]


def route_rules(df: DataFrame, rules: Sequence[Rule], outputs: dict[str, str]) -> DataFrame:
    """Add the outputs (``{name: type}``) and ``rule`` of the first matching rule.

    The table becomes one conditional expression, so routing costs no join and no shuffle. Rows no
    rule takes are marked as unrouted.
    """
    branches = []
    for rule in rules:
        hit = F.lit(True)
        for col, accepted in rule.when.items():
            hit = hit & F.col(col).isin(*accepted)
        made = rule.out()
        fields = [F.lit(rule.name).alias("rule")] + [
            made.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in outputs.items()
        ]
        branches.append(F.when(hit, F.struct(*fields)))
    routed = df.withColumn("_r", F.coalesce(*branches))
    names = ["rule", *outputs]
    routed = routed.select(
        *[c for c in routed.columns if c not in names and c != "_r"],
        *[F.col(f"_r.{n}").alias(n) for n in names],
    )
    return reject_if(routed, F.col("rule").isNull(), "unrouted")
