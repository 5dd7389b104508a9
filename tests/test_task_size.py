"""What one task of a load holds does not grow with its extracts."""

from pyspark.sql import functions as F

from keyferry import session
from keyferry.plans import FrameRun, LoadConfig


def test_a_load_of_larger_extracts_starts_with_more_and_no_larger_tasks(quick, monkeypatch):
    given, app = quick.conf.get(session.INITIAL), quick.sparkContext.applicationId
    monkeypatch.setitem(session._initial, app, int(given))
    try:
        FrameRun(quick, LoadConfig("sys"), {"small": quick.range(10)})
        assert quick.conf.get(session.INITIAL) == given
        FrameRun(quick, LoadConfig("sys"), {"large": quick.range(10**10)})
        assert int(quick.conf.get(session.INITIAL)) == 8 * 10**10 // (session.SHARE_MB << 20)
        assert quick.conf.get(session.SPLIT) == "32m"
        quick.conf.set(session.INITIAL, "7")  # set by the user
        FrameRun(quick, LoadConfig("sys"), {"large": quick.range(10**12)})
        assert quick.conf.get(session.INITIAL) == "7"
    finally:
        quick.conf.set(session.INITIAL, given)


def test_staged_files_can_be_read_in_parts(quick):
    rows_ = quick.range(3_000_000, numPartitions=1).select(F.xxhash64("id").alias("h"))
    given = quick.conf.get(session.SPLIT, None)
    quick.conf.set(session.SPLIT, "4m")
    try:
        assert session.cut_lineage(rows_, group_mb=4).filter("h IS NOT NULL").groupBy(F.spark_partition_id()).count().count() > 3
    finally:
        quick.conf.set(session.SPLIT, given) if given else quick.conf.unset(session.SPLIT)
