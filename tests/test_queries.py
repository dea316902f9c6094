"""Every registered query against its SQL statement in DuckDB (the correctness gate)."""

import pytest

from strata.catalog import load_all
from tests.compare import compare, duck

SF = "/root/testdata/sf0.001"
REG = load_all()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(REG))
def test_query_matches_sql(spark, con, name):
    res = compare(spark, con, name, REG[name], SF, verbose=False)
    if REG[name].sql is None:
        assert res["rows"] >= 0
    else:
        assert res["ok"], res
        assert "types" not in res, res


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())
