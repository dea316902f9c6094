"""Plan guards for the properties the design relies on at scale."""

import datetime as dt
import re
import tempfile

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.catalog import load_all
from strata.operators import dedup, joins
from strata.plans import analytics as A
from strata.plans.layers import star

SF = "/root/testdata/sf0.001"


def _plan(df):
    """The plan that ran: of this DataFrame's own execution, after adaptive changes."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=false" not in plan
    return re.sub(r"#\d+L?", "", plan.split("+- == Initial Plan ==")[0])


def test_fact_is_not_shuffled_for_small_dimensions(spark):
    plan = _plan(star(spark, SF)["fact_sales"])
    assert "BroadcastHashJoin [sls_prd_key], [product_number], LeftOuter" in plan
    assert "BroadcastHashJoin [sls_cust_id], [customer_id], LeftOuter" in plan
    assert "hashpartitioning(sls_prd_key" not in plan and "hashpartitioning(sls_cust_id" not in plan


def test_dedup_limits_before_the_exchange(spark):
    rows = [(i % 5, dt.date(2020, 1, 1) + dt.timedelta(days=i), str(i)) for i in range(100)]
    df = spark.createDataFrame(rows, "id int, d date, x string")
    plan = _plan(dedup.dedup_latest(df, ["id"], [F.col("d").desc_nulls_first()]))
    lines = plan.splitlines()
    partial = [i for i, l in enumerate(lines) if "WindowGroupLimit" in l and "Partial" in l]
    exchange = [i for i, l in enumerate(lines) if "Exchange hashpartitioning(id" in l]
    assert partial and exchange and min(partial) > min(exchange)  # printed below = runs before


def test_no_nested_loop_or_cartesian_in_reports(spark):
    g = star(spark, SF)
    for report in (A.sales_by_customer, A.sales_by_country, A.customer_category, A.headline_shares,
                   A.headline_totals, A.order_metrics):
        plan = _plan(report(g))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.fixture
def no_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, old)


def _few_pairs(spark):
    """A stored star whose lines share few (customer, product) pairs."""
    g = star(spark, SF)
    one = g["fact_sales"].select("customer_key", "product_key").dropna().limit(40)
    fact = g["fact_sales"].drop("customer_key", "product_key").limit(400).withColumn("at", F.pmod(F.xxhash64("order_number"), F.lit(40)))
    keys = one.withColumn("at", F.row_number().over(Window.orderBy("customer_key", "product_key")) - 1)
    path = tempfile.mkdtemp(prefix="strata-few-") + "/fact_sales"
    fact.join(keys, "at").drop("at").write.parquet(path)
    return {"dim_customer": g["dim_customer"], "dim_products": g["dim_products"], "fact_sales": spark.read.parquet(path)}


PAIR = r"Exchange hashpartitioning\(customer_key, product_key"


def test_small_dimensions_are_joined_before_aggregating(spark):
    plan = _plan(A.customer_category(star(spark, SF)))
    assert not re.search(PAIR, plan) and plan.count("BroadcastHashJoin [customer_key]") == 1


def test_large_dimensions_and_few_pairs_aggregate_first(spark, no_broadcast):
    g = _few_pairs(spark)
    assert A.pairs_first(g) and not A.pairs_first(star(spark, SF))
    report = A.customer_category(g)
    assert re.search(PAIR, _plan(report))
    assert not re.search(PAIR, _plan(A.customer_category(star(spark, SF))))
    # the same figures whichever way
    few = {tuple(r) for r in report.collect()}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "32m")
    assert {tuple(r) for r in A.customer_category(g).collect()} == few and few


def test_headline_aggregates_below_the_joins(spark):
    plan = _plan(A.headline_shares(star(spark, SF)))
    for key in ("customer_key", "product_key"):
        assert re.search(rf"Exchange hashpartitioning\({key}", plan)


@pytest.mark.parametrize("name,scans", [("int_to_date", 1), ("dq_int_date", 1), ("dq_date_order", 2), ("dq_profile", 2)])
def test_checks_scan_the_lines_once_a_layer(spark, name, scans):
    plan = _plan(load_all()[name].build(spark, SF))
    assert len(re.findall(r"Scan parquet .*l_orderkey", plan)) <= scans


def test_a_bound_of_the_whole_dimension_is_measured_once(spark, monkeypatch):
    g = star(spark, SF)
    A.template_filtered(g, "Germany", "1998-01-01")
    A.star_filter(g, "STANDARD")
    calls = []
    known = joins.measured

    def counted(df, columns):
        seen = joins._SIZES.get(df, {})
        calls.append(joins._ROWS not in seen or any(c not in seen for c in columns))
        return known(df, columns)

    monkeypatch.setattr(joins, "measured", counted)
    for country in ("Germany", "United States"):
        A.template_filtered(g, country, "1998-01-01")
    A.star_filter(g, "PROMO")
    assert calls and not any(calls)


def test_distinct_counts_copy_no_rows(spark):
    for plan in (_plan(load_all()["agg_distinct"].build(spark, SF)), _plan(A.yearly(star(spark, SF)))):
        assert "Expand" not in plan
