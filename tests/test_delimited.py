"""CSV files with quoted line breaks, split anywhere, against Spark's reader of whole files."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from keyferry.sources.delimited import records, scan_csv


def whole_file(spark, path):
    return spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').csv(path)


@pytest.fixture
def split(quick):
    def at(size):
        quick.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        quick.conf.set("spark.sql.files.minPartitionNum", "1")
        quick.conf.set("spark.sql.files.openCostInBytes", "0")

    yield at
    for name in ("maxPartitionBytes", "minPartitionNum", "openCostInBytes"):
        quick.conf.unset(f"spark.sql.files.{name}")


def text(rows, end="\n", quoting=csv.QUOTE_MINIMAL):
    out = io.StringIO()
    csv.writer(out, lineterminator=end, quoting=quoting).writerows(rows)
    return out.getvalue()


FIELDS = ["x", "", "a,b", 'say "hi"', "two\nlines", "\n", '"\n"', ",\n,", "three\n\nlines\n", '""', "5 in", '",', '"a","b"', "crlf\r\nin", " pad "]


@pytest.mark.parametrize("seed,size,end", [(1, 37, "\n"), (2, 64, "\r\n"), (3, 150, "\n"), (4, 11, "\n"), (5, 10**6, "\n")])
def test_any_split_gives_the_same_rows(quick, split, tmp_path, seed, size, end):
    rnd = random.Random(seed)
    rows = [["id", "b", "c"]] + [[str(i), rnd.choice(FIELDS), rnd.choice(FIELDS)] for i in range(60)]
    (tmp_path / "f.csv").write_bytes(text(rows, end).encode())
    want = sorted(map(tuple, whole_file(quick, str(tmp_path / "f.csv")).collect()), key=repr)
    assert len(want) == 60
    split(size)
    kept, bad = scan_csv(quick, str(tmp_path / "f.csv"))
    assert sorted(map(tuple, kept.collect()), key=repr) == want and bad.count() == 0


def test_one_record_over_many_splits(quick, split, tmp_path):
    long = "line, \"quoted\"\n" * 200
    (tmp_path / "f.csv").write_text(text([["a", "b"], ["1", "x"], ["2", long], ["3", "y"], ["4", long], ["5", "z"]]))
    split(100)
    kept, _ = scan_csv(quick, str(tmp_path / "f.csv"))
    assert dict(map(tuple, kept.collect())) == {"1": "x", "2": long, "3": "y", "4": long, "5": "z"}


def test_quotes_inside_plain_fields_open_nothing(quick, split, tmp_path):
    body = 'a,b\n5" pipe,6" pipe\nx,y"\n"q\n""w""",5" more\nlast,1\n'
    (tmp_path / "f.csv").write_text(body)
    want = sorted(map(tuple, whole_file(quick, str(tmp_path / "f.csv")).collect()))
    for size in (7, 16, 1000):
        split(size)
        kept, bad = scan_csv(quick, str(tmp_path / "f.csv"))
        assert sorted(map(tuple, kept.collect())) == want and bad.count() == 0


def test_records_of_another_shape_are_rejects(quick, split, tmp_path):
    (tmp_path / "f.csv").write_text('a,b,c\n1,2,3\n4,5\n6,7,8,9\n\n"10\n11",12,13\n"14\n15",16\n')
    split(9)
    kept, bad = scan_csv(quick, str(tmp_path / "f.csv"))
    assert sorted(map(tuple, kept.collect())) == [("1", "2", "3"), ("10\n11", "12", "13")]
    assert sorted((r["raw"], r["reason"]) for r in bad.collect()) == [('"14\n15",16', "malformed"), ("4,5", "malformed"), ("6,7,8,9", "malformed")]
    for columns in (["a"], ["b", "c"], ["c"]):  # the verdict does not depend on what is read later
        assert kept.select(*columns).count() + bad.select("reason").count() == 5


def test_several_tasks_read_one_file(quick, split, tmp_path):
    rows = [["a", "b"]] + [[str(i), "two\nlines" if i % 3 == 0 else "x"] for i in range(30_000)]
    (tmp_path / "f.csv").write_text(text(rows))
    split(64 << 10)
    lines = quick.read.option("lineSep", "\n").text(str(tmp_path / "f.csv"))
    assert lines.select(F.spark_partition_id()).distinct().count() > 5
    kept, bad = scan_csv(quick, str(tmp_path / "f.csv"))
    got = kept.agg(F.count("*"), F.countDistinct("a"), F.count_if(F.col("b") == "two\nlines")).first()
    assert tuple(got) == (30_000, 30_000, 10_000) and bad.count() == 0


def test_folders_empty_files_and_headers(quick, split, tmp_path):
    folder = tmp_path / "d"
    folder.mkdir()
    (folder / "1.csv").write_text('"a\nb",c\n1,2\n')
    (folder / "2.csv").write_text('"a\nb",c\n3,"4\n4"\n')
    (folder / "3.csv").write_text('"a\nb",c\n')
    (folder / "4.csv").write_text("")
    split(5)
    kept, bad = scan_csv(quick, str(folder))
    assert kept.columns == ["a\nb", "c"] and sorted(map(tuple, kept.collect())) == [("1", "2"), ("3", "4\n4")] and bad.count() == 0
    assert records(quick, str(folder)).filter("header").count() == 3
    (tmp_path / "one.csv").write_text("only\nx\n\n\"y\nz\"\n")
    kept, bad = scan_csv(quick, str(tmp_path / "one.csv"))
    assert sorted(r[0] for r in kept.collect()) == ["x", "y\nz"] and bad.count() == 0
