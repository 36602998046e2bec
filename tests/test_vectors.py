"""Vector text parsing, JSON round trip and linear scoring."""

from pyspark.sql import functions as F

from lumisort.functions import vectors as V


def test_parse_vector_text(spark):
    df = spark.createDataFrame([("[1.5, -2, 3e-1]",), ("null",), ("[]",), ("[1, x]",), (None,)], "t string")
    got = [r[0] for r in df.select(V.parse_vector_text("t")).collect()]
    assert got == [[1.5, -2.0, 0.3], None, None, None, None]


def test_json_roundtrip(spark):
    df = spark.createDataFrame([([0.1, 0.2],), (None,)], "v array<double>")
    txt = df.select(V.vector_to_text("v").alias("t"))
    assert [r[0] for r in txt.collect()] == ["[0.1,0.2]", "null"]
    assert [r[0] for r in txt.select(V.text_to_vector("t")).collect()] == [[0.1, 0.2], None]


def test_linear_margin_and_prediction(spark):
    df = spark.createDataFrame([([1.0, 2.0],), ([-3.0, 1.0],), (None,)], "v array<double>")
    m = V.linear_margin(F.col("v"), [0.5, 0.25], 0.1)
    got = [(r[0], r[1]) for r in df.select(m, V.svm_prediction(m)).collect()]
    assert got == [(1.1, 1.0), (-1.15, 0.0), (None, None)]
