import pytest
"""Group ranks: the range path equals the window path, hot groups included."""

from pyspark.sql import functions as F

from lumisort.operators.ranking import boundary_keys, flag_first_k, row_positions


def skewed(spark, hot=3000, cold=40):
    rows = [("hot", f"n{i:06d}") for i in range(hot)] + [(f"g{i % 7}", f"m{i:05d}") for i in range(cold)]
    rows.append((None, "nullgroup"))
    return spark.createDataFrame(rows, "g string, k string")


def test_positions_agree(spark):
    df = skewed(spark).repartition(6)
    w = row_positions(df, ["g"], ["k"], "pos", strategy="window")
    r = row_positions(df, ["g"], ["k"], "pos", strategy="range")
    a = sorted(map(tuple, w.collect()), key=str)
    b = sorted(map(tuple, r.collect()), key=str)
    assert a == b
    hot = {x.k: x.pos for x in r.where(F.col("g") == "hot").collect()}
    assert hot["n000000"] == 1 and hot["n002999"] == 3000


def test_flags_agree_with_ties(spark):
    rows = [("a", 1), ("a", 2), ("a", 2), ("a", 3), ("b", 5)]
    df = spark.createDataFrame(rows, "g string, o int")
    for strat in ("window", "range"):
        out = flag_first_k(df, ["g"], ["o"], F.lit(2), "f", strategy=strat)
        # rank() <= 2: both tied rows at the boundary are in
        assert sorted((r.g, r.o, r.f) for r in out.collect()) == [
            ("a", 1, True), ("a", 2, True), ("a", 2, True), ("a", 3, False), ("b", 5, True)]


def test_boundary_k_beyond_group(spark):
    df = skewed(spark, hot=50, cold=0)
    for strat in ("window", "range"):
        b, _ = boundary_keys(df, ["g"], ["k"], F.lit(10_000), strategy=strat)
        got = {r.g: r._b0 for r in b.collect()}
        assert got["hot"] == "n000049"


@pytest.mark.parametrize("reuse", ["true", "false"])
def test_range_equals_window_whatever_is_reused(spark, reuse):
    """Positions read one stored table, so no optimisation of the session matters."""
    from lumisort.operators.split import split_positional
    df = spark.range(300_000).select(F.concat(F.lit("f"), (F.col("id") * 7919 % 300_007).cast("string")).alias("file_name"),
                                     F.when(F.col("id") % 3 == 0, F.lit("a")).otherwise(F.lit("b")).alias("label_name"))
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        out = {}
        for strategy in ("window", "range"):
            d = split_positional(df, 0.5, strategy=strategy).where("split = 'train'")
            out[strategy] = [tuple(r) for r in d.groupBy("label_name").agg(
                F.count(F.lit(1)), F.sum(F.xxhash64("file_name") % 1000003)).orderBy("label_name").collect()]
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
    assert out["window"] == out["range"] and sum(r[1] for r in out["window"]) == 150_000


NASTY = ["${spark.app.name}", "${env:HOME}", "it's \"q\"", "back\\slash \\'", "a;b--c", "%s {0} é"]


def test_names_are_data_not_sql(spark):
    from lumisort.operators import split as S
    rows = [(f"{c}_{i}.json", c) for c in NASTY for i in range(10)]
    df = spark.createDataFrame(rows, "file_name string, label_name string").repartition(3)
    for strategy in ("window", "range"):
        out = S.split_positional(df, 0.6, strategy=strategy)
        assert {r.label_name: (r.tr, r.n) for r in out.groupBy("label_name").agg(
            F.count_if(F.col("split") == "train").alias("tr"), F.count(F.lit(1)).alias("n")).collect()} == {
                c: (6, 10) for c in NASTY}
        moved = S.rebalance(out, 0.3, strategy=strategy)
        assert moved.where("split = 'train'").count() == 3 * len(NASTY)
        assert S.sample_per_class(df, 4, strategy=strategy).count() == 4 * len(NASTY)
        assert S.systematic_sample(out, 2, strategy=strategy).count() == 5 * len(NASTY)


def test_no_ordered_limit_anywhere(spark):
    from lumisort.operators import joins as J
    from lumisort.operators import split as S
    from lumisort.sinks.writers import dedupe_names
    rows = [(f"c{i % 3}_{i}.json", f"c{i % 3}", "train" if i % 2 else "test", [1.0]) for i in range(60)]
    df = spark.createDataFrame(rows, "file_name string, label_name string, split string, features array<double>")
    for out in (S.systematic_sample(df, 2), J.resolve_split(df.where("split = 'train'"), df), dedupe_names(df)):
        assert "TakeOrderedAndProject" not in out._jdf.queryExecution().toString()
