"""Invariants of the published layers and idempotency of a refresh."""

import tempfile

from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.plans import pipeline as P
from strata.plans.publish import read_layer
from strata.schemas import FEEDS

SF = "/root/testdata/sf0.001"


def _gold(spark, root):
    return {n: df.drop("dwh_create_date") for n, df in read_layer(spark, root, "gold", P.GOLD_TABLES).items()}


def test_layer_invariants_and_idempotency(spark):
    base = tempfile.mkdtemp(prefix="strata-inv-")
    P.land_feeds(spark, SF, base + "/landing")
    P.run(spark, base + "/landing", base + "/wh", as_of="2025-06-30")
    g = _gold(spark, base + "/wh")
    s = {n: df for n, df in read_layer(spark, base + "/wh", "silver", FEEDS).items()}

    for dim, key in (("dim_customer", "customer_key"), ("dim_products", "product_key")):
        keys = sorted(r[0] for r in g[dim].select(key).collect())
        assert keys == list(range(1, len(keys) + 1)), dim            # dense 1..n
    ids = s["crm_cust_info"].groupBy("cst_id").count()
    assert ids.filter("count > 1 OR cst_id IS NULL").count() == 0      # silver ids unique
    assert g["fact_sales"].count() == s["crm_sales_details"].count()   # no fan-out
    w = Window.partitionBy("cat_id", "prd_key").orderBy("prd_start_dt")
    overlaps = (s["crm_prod_info"].withColumn("next_start", F.lead("prd_start_dt").over(w))
                .filter("prd_end_dt >= next_start").count())
    assert overlaps == 0                                               # intervals do not overlap

    mon = {(r.table_name, r.metric): r for r in P.layer_monitor(spark, base + "/wh").collect()}
    assert len(mon) == 5 * len(FEEDS)
    assert all(mon["crm_cust_info", m].status == "OK" for m in ("row_count", "duplicate_keys", "null_keys", "load_seconds"))
    assert all(r.value > 0 for (_, m), r in mon.items() if m in ("row_count", "load_seconds"))
    late = P.layer_monitor(spark, base + "/wh", today="2999-01-01", max_seconds=0.0)
    assert {r.status for r in late.where("metric in ('load_seconds', 'load_age_days')").collect()} == {"ALERT"}
    assert P.layer_monitor(spark, base + "/wh", "bronze").where("table_name = 'crm_cust_info' and status = 'ALERT'").count() == 2

    sql = "SELECT count(*) AS n FROM gold.fact_sales f JOIN gold.dim_customer c ON f.customer_key = c.customer_key"
    joined = g["fact_sales"].join(g["dim_customer"], "customer_key").count()
    assert spark.sql(sql).first().n == joined                          # the pipeline's own views
    dated = P.read_fact(spark, base + "/wh", "2024-01-01", "2025-01-01")
    assert dated.columns == [*g["fact_sales"].columns, "dwh_create_date"] and dated.count() == g["fact_sales"].where("year(order_date) = 2024").count()

    P.run(spark, base + "/landing", base + "/wh", as_of="2025-06-30")  # second refresh
    assert spark.sql(sql).first().n == joined
    for db in ("silver", "gold"):
        spark.sql(f"DROP DATABASE {db} CASCADE")
    again = _gold(spark, base + "/wh")
    for n in P.GOLD_TABLES:
        assert again[n].exceptAll(g[n]).count() == 0 and g[n].exceptAll(again[n]).count() == 0, n
