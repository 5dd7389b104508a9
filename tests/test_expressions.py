import hashlib
import math
from datetime import date, datetime

from pyspark.sql import functions as F

from keyferry import functions as X


def values(spark, expr, inputs, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


def test_clean_str(spark):
    got = values(spark, X.clean_str, [None, "", " \t", "NaN", " nil ", "None", "NULL", " a b ", " x　", "nullx"])
    assert got == [None, None, None, None, None, None, None, "a b", "x", "nullx"]


def test_whole_numbers(spark):
    got = values(spark, X.to_int, ["", "12", "12.9", "-3.7", "abc", "0", None, "nan", "inf", "1d", " 7 ", "1e3", "1e30", "9007199254740993"])
    assert got == [None, 12, 12, -3, None, 0, None, None, None, None, 7, 1000, None, 9007199254740993]


def test_numbers(spark):
    got = values(spark, X.to_double, ["", "1.5", "-.5", "5.", "1f", "x", None, "NaN", "-Infinity"])
    assert got[:7] == [None, 1.5, -0.5, 5.0, None, None, None]
    assert math.isnan(got[7]) and got[8] == -math.inf


def test_booleans(spark):
    texts = ["Yes", " n ", "1", "0", "TRUE", "t", "maybe", "", None]
    assert values(spark, X.to_bool3, texts) == [True, False, True, False, True, None, None, None, None]
    assert values(spark, X.to_bool2, texts) == [True, False, True, False, True, True, False, False, False]
    assert values(spark, lambda c: X.to_bool2(c, keep_null=True), ["", "null", "x", "y"]) == [None, None, False, True]
    assert values(spark, lambda c: X.to_bool3(c, True), ["no", "?"]) == [False, True]


def test_times(spark):
    texts = ["2023-11-28 15:08:22.577582+02", "2024-01-01T10:00:00.000+0000", "2024-01-01", "NULL", "later"]
    assert values(spark, X.to_ts_ntz, texts) == [
        datetime(2023, 11, 28, 13, 8, 22, 577582), datetime(2024, 1, 1, 10), datetime(2024, 1, 1), None, None,
    ]
    assert values(spark, X.to_date_safe, ["2024-02-03", "2024-02-03 10:00:00", "x"]) == [date(2024, 2, 3), date(2024, 2, 3), None]


def test_typed_value(spark):
    got = values(spark, X.typed_value, ["1", "17", " https://a/b ", "text ", "no", "0.5"])
    assert [tuple(r) for r in got] == [
        (None, None, True, None), (None, 17.0, None, None), (None, None, None, "https://a/b"), ("text", None, None, None),
        (None, None, False, None), (None, 0.5, None, None),
    ]


def test_names(spark):
    got = values(spark, X.split_name, ["Ada", "Ada Fen", " Ada  B  C Fen ", "", None])
    assert [tuple(r) for r in got] == [
        ("Ada", None, "Ada"), ("Ada", None, "Fen"), ("Ada", "B C", "Fen"), ("Unknown", None, "User"), ("Unknown", None, "User"),
    ]
    pairs = [("Ada van Fen", "Fen"), ("Ada Fen Roe", "Fen"), ("Ada Fen", "Oak"), ("Ada", "Fen"), (None, "Fen"), ("Fen Ada Fen", "Fen")]
    df = spark.createDataFrame(pairs, "f string, l string")
    got = [tuple(r[0]) for r in df.select(X.split_name_last(F.col("f"), F.col("l"))).collect()]
    assert got == [("Ada van", "Fen"), ("Ada", "Fen Roe"), ("Ada", "Fen"), ("Ada", "Fen"), (None, "Fen"), ("Fen Ada", "Fen")]


def test_keys(spark):
    assert values(spark, lambda c: X.hash_key("P-", c, 5), ["x"]) == ["P-" + hashlib.sha1(b"x").hexdigest()[:5]]
    assert values(spark, X.title_key, ["clear voice", "o'neil 3rd time", "ALL caps"]) == [s.title().replace(" ", "_") for s in ("clear voice", "o'neil 3rd time", "ALL caps")]
    one, two, none = values(spark, lambda c: X.stable_id(c), ["a", "b", None])
    assert one != two and none is None and len(one) == 36
    assert values(spark, X.is_external_id, ["a" * 15, "A1" * 9, "a" * 16, "a-b" * 5, None]) == [True, True, False, False, False]
    assert values(spark, lambda c: X.composite_key(":", c, F.lit("g")), ["a", None]) == ["a:g", None]


def test_labels_and_joins(spark):
    assert values(spark, lambda c: X.gender(c, "Male"), [" female", "M", "x", None]) == ["Female", "Male", "Male", "Male"]
    assert values(spark, X.status_label, ["Disabled", "0", "on", None]) == ["Inactive", "Inactive", "Active", "Active"]
    assert values(spark, lambda c: X.attendance(c, F.lit(1.0)), ["yes", "no", "?", None]) == ["Present", "Absent", "Present", "Present"]
    assert values(spark, lambda c: X.join_nonempty("\n", F.lit(" a "), c, F.lit("")), ["b", " ", "", None]) == ["a\nb", "a\n", "a", "a"]
    assert values(spark, lambda c: X.first_truthy(c, F.lit("d")), ["x", "", None]) == ["x", "d", "d"]


def test_points(spark):
    coords = "000000000000F03F0000000000000040"
    got = values(spark, X.ewkb_to_wkb, ["0101000020E6100000" + coords, "0020000001000010E6" + coords, "0101000000" + coords.lower(), "zz", "0101", None])
    assert [g and (g["srid"], bytes(g["wkb"]).hex().upper()) for g in got] == [
        (4326, "0101000000" + coords), (4326, "0000000001" + coords), (None, "0101000000" + coords), None, None, None,
    ]
