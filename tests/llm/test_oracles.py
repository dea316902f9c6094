"""Queries with an SQL statement against it in DuckDB."""

import pytest

from strata.catalog import Query
from strata.llm.queries import ORACLES, QUERIES
from tests.compare import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_operator_matches_sql(spark, name):
    res = compare(spark, duck(SF), name, Query(name, QUERIES[name], ORACLES[name]), SF, verbose=False)
    assert res["ok"] and res["rows"] > 0 and "types" not in res, res
