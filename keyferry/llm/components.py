"""Connected components of a link table, by rounds of joins; nothing passes through the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root): for every node that a link names, the smallest node it reaches.

    Each round takes the smallest label among the neighbours and then that label's own label, so labels
    travel by growing steps; rounds end when no label changes. A round is written before the next.
    """
    both = links.select(F.col(a).alias("node"), F.col(b).alias("other"))
    both = cut_lineage(both.unionByName(both.select(F.col("other").alias("node"), F.col("node").alias("other"))).where("node <> other").distinct())
    labels = cut_lineage(both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("root")))
    while True:
        seen = both.join(labels.select(F.col("node").alias("other"), "root"), "other").groupBy("node").agg(F.min("root").alias("near"))
        met = labels.join(seen, "node").select("node", "root", F.least("root", "near").alias("now"))
        jump = labels.select(F.col("node").alias("now"), F.col("root").alias("further"))
        moved = cut_lineage(met.join(jump, "now").select("node", F.least("now", "further").alias("root"), F.col("root").alias("was")))
        if moved.where("root <> was").isEmpty():
            return moved.select("node", "root")
        labels = moved.select("node", "root")
