"""What lies on disk while a job runs goes as soon as nothing reads it."""

import os
import time

from pyspark.sql import functions as F

from keyferry import operators as O
from keyferry import session
from keyferry.specs import MergeSpec


def shuffled(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for k in range(files.size()) if (name := files.apply(k).getName()).startswith("shuffle_")}


def test_a_written_frame_leaves_no_shuffle_files(quick):
    before = shuffled(quick)
    summed = quick.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.sum("id").alias("s"))
    cut = session.cut_lineage(summed.join(summed.withColumnRenamed("s", "again"), "k"))
    until = time.time() + 20
    while (left := shuffled(quick) - before) and time.time() < until:  # they go in the background
        time.sleep(0.1)
    assert not left
    assert cut.agg(F.sum("s"), F.sum("again")).first() == (499500, 499500)
    assert quick.conf.get(session.CLEANUP) == "false"


def test_rounds_of_records_in_order_leave_one_table(quick, tmp_path, monkeypatch):
    made = []
    monkeypatch.setattr(session, "scratch", lambda spark: made.append(f"{tmp_path}/{len(made)}") or made[-1])
    schema = "id string, sf string, sub string, name string"
    target = quick.createDataFrame([(f"t{i}", f"S{i}", f"C{i}", "old") for i in range(4)], schema)
    chain = [(f"r{i}", f"S{i}", f"C{i + 1}", f"v{i}", 9 - i) for i in range(4)]  # each takes what the one before released
    source = quick.createDataFrame(chain, schema + ", seq long")
    merged, actions = O.merge_in_order(target, source, ("sf", "sub"), MergeSpec(("sf",), ("seq",)))
    assert len(made) > 10 and sum(map(os.path.exists, made)) == 1
    assert sorted(map(tuple, merged.collect())) == [(f"t{i}", f"S{i}", f"C{i + 1}", f"v{i}") for i in range(4)]
    assert actions.groupBy("action").count().collect() == [("updated", 4)]
