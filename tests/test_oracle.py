"""Every registered query with a SQL twin matches DuckDB (rows, columns, values)."""

import pytest

from conftest import ROOT, SF_CHECK


def _names():
    import sys
    sys.path.insert(0, ROOT)
    import __spark_entry__ as E
    return sorted(E.oracle_sql())


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, name):
    import sys
    sys.path.insert(0, ROOT)
    from tools.oracle_check import compare
    res = compare(spark, SF_CHECK, [name], verbose=False)[name]
    assert res.get("match") is True, res


def test_every_query_has_a_callable_and_entry_runs(spark):
    import sys
    sys.path.insert(0, ROOT)
    import __spark_entry__ as E
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and rows[0].n_test > 0
