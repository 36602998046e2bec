"""Plan properties the scale design relies on (checked on executed plans)."""

from conftest import ROOT, SF_CHECK


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def _queries():
    import sys
    sys.path.insert(0, ROOT)
    import __spark_entry__ as E
    return E.queries()


def test_counts_never_read_vectors(spark):
    p = _plan(_queries()["split_counts"](spark, SF_CHECK))
    schemas = [line.split("ReadSchema:")[1] for line in p.splitlines() if "FileScan parquet" in line]
    assert schemas and all("embedding" not in s for s in schemas)


def test_rebalance_output_shuffles_nothing(spark):
    # the class counts and boundary keys are small literal tables: the rows
    # are only scanned and joined with broadcasts
    p = _plan(_queries()["rebalance"](spark, SF_CHECK))
    assert "Exchange hashpartitioning" not in p and "rangepartitioning" not in p
    assert "BroadcastHashJoin" in p


def test_train_wins_filters_wide_rows_in_place(spark):
    p = _plan(_queries()["train_wins"](spark, SF_CHECK))
    assert "SortMergeJoin" not in p and "Exchange hashpartitioning(file_name" not in p
    assert "LeftAnti" in p


def test_no_registered_query_pairs_rows(spark):
    import sys
    sys.path.insert(0, ROOT)
    import __spark_entry__ as E
    qs = E.queries()
    for name in sorted(E.oracle_sql()):
        p = _plan(qs[name](spark, SF_CHECK))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name
