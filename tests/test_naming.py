"""Naming rules on the edge-case names (P1-P6)."""

import pytest
from pyspark.sql import functions as F

from lumisort.functions import naming as N

# name, label (to first digit), first token, stem (dots removed), jpg stem
CASES = [
    ("yorkshire_terrier_98.jpg", "yorkshire_terrier", "yorkshire", "yorkshire_terrier_98", "yorkshire_terrier_98.json"),
    ("Egyptian_Mau_1.jpg", "Egyptian_Mau", "Egyptian", "Egyptian_Mau_1", "Egyptian_Mau_1.json"),
    ("a__3", "a", "a", "", "a__3"),
    ("Ragdoll.jpg", "Ragdoll.jpg", "Ragdoll.jpg", "Ragdoll", "Ragdoll.json"),
    ("a.b.jpg", "a.b.jpg", "a.b.jpg", "ab", "a.b.json"),
    ("x.jpg.jpg", "x.jpg.jpg", "x.jpg.jpg", "xjpg", "x.json"),
    ("foojpg", "foojpg", "foojpg", "", "fo.json"),
    ("1_cat.jpg", "", "1", "1_cat", "1_cat.json"),
]


@pytest.fixture(scope="module")
def names(spark):
    return spark.createDataFrame([(c[0],) for c in CASES], "name string")


def test_edge_names(names):
    got = {r["name"]: r for r in names.select(
        "name", N.label_from_name("name").alias("label"), N.label_first_token("name").alias("token"),
        N.stem("name").alias("stem"), N.jpg_stem("name").alias("jpg")).collect()}
    for name, label, token, stem, jpg in CASES:
        r = got[name]
        assert (r["label"], r["token"], r["stem"], r["jpg"]) == (label, token, stem, jpg), name


def test_unicode_digit_is_a_digit(spark):
    # Python's \d is Unicode: an Arabic-Indic digit ends the label too
    r = spark.createDataFrame([("cat_٣.jpg",)], "n string").select(N.label_from_name("n")).first()[0]
    assert r == "cat"


def test_paths(spark):
    df = spark.createDataFrame([("root/a/b.jpg",), ("noslash",), ("dir/",)], "p string")
    r = df.select(N.strip_root("p").alias("s"), N.basename("p").alias("b"),
                  N.is_placeholder("p").alias("ph")).collect()
    assert [(x.s, x.b, x.ph) for x in r] == [("a/b.jpg", "b.jpg", False), ("", "noslash", False), ("", "", True)]


def test_ratio_and_percent(spark):
    df = spark.createDataFrame([(0.3,), (0.6,), (0.9,), (1.0,)], "c double")
    assert [r[0] for r in df.select(N.ratio_label("c")).collect()] == ["0.3/0.7", "0.6/0.4", "0.9/0.1", "1.0/0.0"]
    assert df.select(N.format_percent(F.lit(87.5))).first()[0] == "87.50"


def test_prediction_to_class(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (None,)], "p double")
    got = [r[0] for r in df.select(N.prediction_to_class("p", "wheaten_terrier", "yorkshire_terrier")).collect()]
    assert got == ["wheaten_terrier", "yorkshire_terrier", None]
