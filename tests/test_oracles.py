"""Every registered query against its SQL oracle (DuckDB) on the smallest dataset."""

import pytest

import __spark_entry__ as E
from tools.oracle_compare import rows_of
from tests.conftest import SMALL

SQL = E.oracle_sql()
QUERIES = E.queries()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    scols = df.columns
    srows = [tuple(r) for r in df.collect()]
    res = duck.execute(SQL[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(scols) == sorted(dcols)
    assert len(srows) == len(drows)
    assert rows_of(scols, srows) == rows_of(dcols, drows)


def test_every_query_has_oracle_or_is_model():
    from featmart import plans
    missing = [n for n in plans.queries() if n not in SQL]
    assert all(n.startswith(("mdl", "clu", "dec")) for n in missing), missing


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "acctbal_to_spend" in df.columns
