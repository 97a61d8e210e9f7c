"""Every registered query equals its DuckDB oracle on the smallest tables
(row count, column names and an order-insensitive hash of the values)."""

import pytest

from pressroom.plans.registry import load_all
from tools.check import digest

REG = load_all()


@pytest.mark.parametrize("name", sorted(REG))
def test_query_matches_oracle(spark, sf_dir, duck, name):
    q = REG[name]
    df = q.build(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    if q.oracle is None:
        assert rows is not None
        return
    res = duck.execute(q.oracle)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(rows) == len(drows)
    assert digest(df.columns, rows)[0] == digest(dcols, drows)[0]


def test_entry_runs(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.count() >= 0
    assert "score" in df.columns
    assert set(e.oracle_sql()) <= set(e.queries())
