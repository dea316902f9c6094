"""A scan lands the feed it reads, once."""

import os

import pytest

from strata.catalog import load_all
from strata.plans import queries_io as Q
from strata.schemas import FEED_FILES

COLUMNS = {"customer": "c_custkey bigint, c_name string, c_mktsegment string, c_nationkey int",
         "part": "p_partkey bigint, p_name string, p_type string, p_size int"}
ROWS = {"customer": [(1, "Ann", "AUTO", 0), (45, "Bo", "BUILDING", 1)], "part": [(2, "bolt", "STANDARD TIN", 3), (5, "nut", "PROMO TIN", 4)]}


@pytest.fixture
def tables(spark, tmp_path):
    """Two tables alone: a feed that needs another one cannot be landed."""
    for name, schema in COLUMNS.items():
        spark.createDataFrame(ROWS[name], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_a_scan_lands_its_own_feed_only(spark, tables):
    got = load_all()["scan_erp_cust_a1z12"].build(spark, tables).collect()
    assert sorted(r.cid for r in got) == ["AW00000001", "AW00000045", "AX00000045"]
    assert load_all()["scan_crm_prod_info"].build(spark, tables).count() == 6  # 2 % 3 + 1 and 5 % 3 + 1 versions
    root = Q.landing(spark, tables, []).removeprefix("file:")
    assert sorted(os.listdir(root)) == ["source_crm", "source_erp"]
    assert os.listdir(f"{root}/source_crm") == [FEED_FILES["crm_prod_info"][1]]
    pieces = [f for _, _, names in os.walk(root) for f in names if f.startswith("part-")]
    assert pieces and all(f.endswith(".csv.gz") for f in pieces)


def test_a_feed_is_landed_once(spark, tables, monkeypatch):
    calls = []
    land = Q.P.land_feeds
    monkeypatch.setattr(Q.P, "land_feeds", lambda s, d, r, names: (calls.extend(names), land(s, d, r, names)))
    for _ in range(2):
        Q.landing(spark, tables, ["erp_cust_a1z12"])
    assert calls == ["erp_cust_a1z12"]
