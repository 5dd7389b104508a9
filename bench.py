"""Headline loads and operators at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "merge_on_key", "merge_small_source", "merge_created_least", "merge_if_changed", "insert_only", "merge_last_in_batch",
    "guarded_merge", "fk_lookup", "fk_required_rejects", "role_playing_lookup", "resolve_entity", "or_key_match",
    "three_hop_filter", "remap_cascade", "dedupe_latest", "dedupe_first", "dedupe_hot_key", "group_headers", "unpivot_answers",
    "multi_emit", "route_rules", "typed_answer", "lenient_int", "constraint_report", "unique_violations", "assign_unique",
    "in_run_visibility", "merge_touched_buckets", "guarded_in_order", "csv_quoted_breaks", "run_programs_twice", "load_farmers", "load_attendances", "load_observation_results", "load_best_practice_answers",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("keyferry-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from keyferry.queries import QUERIES

    loads = [n for n in QUERIES if n.startswith("load_") and n not in HEADLINE]
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE + loads)).split(",")
    QUERIES["fk_lookup"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
