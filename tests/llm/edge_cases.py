from pyspark.sql import types as T

# Names that operators use inside or give out; as further columns they must not matter.
CLASHING = "id key sig n kept keep_id digest norm rank salt batch text_sha256 score lang_pred terms spans weight probability shard home gram __row __own __id".split()
LONG = "lorem ipsum dolor sit amet " * 4000

EDGE_TEXTS = [
    (1, "One two three four five six seven."),
    (2, None),
    (3, ""),
    (4, " \t\n\x0b\x0c\r "),
    (5, "One  two three\nfour five six seven."),
    (6, LONG),
    (6, LONG),
    (None, "One two three four five six seven."),
    (8, "Größe été ñandú ÀÉÎ 🙂 日本語 ΣΑΣ"),
    (9, "12 34"),
    (10, "a" * 30_000),
    (11, "one two"),
]


def frame(spark, rows, extra=True, partitions=3):
    names = [c for c in CLASHING if extra]
    schema = T.StructType(
        [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType())]
        + [T.StructField(c, T.StringType()) for c in names]
    )
    data = [(i, t, None if i is None or i % 3 == 0 else "en", None if i == 4 else f"s{(i or 0) % 2}", *["x"] * len(names)) for i, t in rows]
    return spark.createDataFrame(data, schema).repartition(partitions)
