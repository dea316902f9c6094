"""Report edge fixtures: NULL order dates, every weekday, NULL name parts (N11, N12)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from strata.operators.distinct import distinct_counts
from strata.plans import analytics as A

FACT = "order_number string, product_key bigint, customer_key bigint, order_date date, shipping_date date, " \
       "due_date date, sales_amount decimal(18,2), quantity bigint, price decimal(18,6)"
CUST = "customer_key bigint, customer_id bigint, customer_number string, first_name string, last_name string, " \
       "country string, marital_status string, gender string, birthdate date, create_date date"
PROD = "product_key bigint, product_id bigint, product_number string, product_name string, category_id string, " \
       "category string, subcategory string, maintenance string, cost decimal(18,2), product_line string, " \
       "start_date date"


def _star(spark):
    monday = dt.date(2024, 1, 1)
    fact = [(f"SO{i}", 1 + i % 2, 1 + i % 3, monday + dt.timedelta(days=i), None, None,
             Decimal("10.00") * (i + 1), i + 1, Decimal("10.000000")) for i in range(7)]
    fact.append(("SO9", 1, 1, None, None, None, Decimal("5.00"), 1, Decimal("5.000000")))
    cust = [(1, 11, "AW1", "Ann", None, "Germany", "Single", "Female", dt.date(1980, 1, 1), None),
            (2, 12, "AW2", None, "Bo", "Germany", "Married", "Male", None, None),
            (3, 13, "AW3", "Cy", "Do", "n/a", "n/a", "n/a", dt.date(1990, 1, 1), None)]
    prod = [(1, 101, "P1", "Alpha", "AB_CD", "Bikes", "Road", "Yes", Decimal("4.00"), "Road", dt.date(2020, 1, 1)),
            (2, 102, "P2", "Beta", "AB_CD", "Bikes", "Road", "Yes", Decimal("6.00"), "Touring", dt.date(2020, 1, 1))]
    return {"fact_sales": spark.createDataFrame(fact, FACT), "dim_customer": spark.createDataFrame(cust, CUST),
            "dim_products": spark.createDataFrame(prod, PROD)}


def test_weekday_every_day_and_null_group(spark):
    rows = A.weekday(_star(spark)).collect()
    assert [r.day_of_week for r in rows] == ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday",
                                             "Saturday", None]
    assert sum(r.order_count for r in rows) == 8


def test_monthly_null_month_is_one_group(spark):
    rows = {r.year_month: r for r in A.monthly_trend(_star(spark)).collect()}
    assert set(rows) == {"2024-01", None}
    assert rows[None].order_count == 1 and rows[None].total_sales == 5.0
    assert rows["2024-01"].avg_order_value == 40.0


def test_customer_name_with_null_parts(spark):
    names = {r.customer_id: r.customer_name for r in A.customer_category(_star(spark)).collect()}
    assert names == {11: "Ann ", 12: " Bo", 13: "Cy Do"}


def test_demographics_counts_customers_without_sales(spark):
    g = _star(spark)
    g["dim_customer"] = g["dim_customer"].union(spark.createDataFrame(
        [(4, 14, "AW4", "Ed", "Fu", "Germany", "Single", "Female", dt.date(2000, 1, 1), None)], CUST))
    rows = {(r.gender, r.marital_status): r for r in A.demographics(g, "2025-06-30").collect()}
    single_f = rows[("Female", "Single")]
    assert single_f.customer_count == 2
    # customer 1 has 4 sales lines (age 45), customer 4 none (age 25, counted once)
    assert single_f.avg_age == round((45 * 4 + 25) / 5, 1)


def _unsold(spark):
    """The star with a NULL amount for customer 3, product 3, a weekday and a country of their own."""
    g = _star(spark)
    extra = spark.createDataFrame([("SO99", 3, 4, dt.date(2023, 3, 5), None, None, None, None, None)], FACT)
    cust = spark.createDataFrame([(4, 14, "AW4", "Ed", "Fu", "Peru", "Single", "Male", dt.date(2000, 1, 1), None)], CUST)
    prod = spark.createDataFrame([(3, 103, "P3", "Gamma", "CD_EF", "Caps", "Soft", "No", Decimal("1.00"), "Other", dt.date(2020, 1, 1))], PROD)
    return {"fact_sales": g["fact_sales"].union(extra), "dim_customer": g["dim_customer"].union(cust), "dim_products": g["dim_products"].union(prod)}


# report, its total, largest first within
ORDERED = [(A.sales_by_customer, "total_sales", ()), (A.sales_by_country, "total_sales", ()), (lambda g: A.demographics(g, "2025-06-30"), "total_sales", ()),
           (A.top_products, "total_revenue", ()), (A.sales_by_category, "total_sales", ()), (A.by_product_line, "total_sales", ()),
           (A.customer_category, "total_spent", ()), (A.geo_product, "total_sales", ("country",)), (A.headline_shares, "total_sales", ("dimension",))]


@pytest.mark.parametrize("report,total,within", ORDERED, ids=[t[0].__name__ for t in ORDERED])
def test_a_null_total_comes_first_and_totals_fall(spark, report, total, within):
    rows = report(_unsold(spark)).collect()
    groups = {}
    for r in rows:
        groups.setdefault(tuple(r[c] for c in within), []).append(r[total])
    assert list(groups) == sorted(groups, key=lambda k: tuple((v is None, v) for v in k))
    assert any(v[0] is None for v in groups.values())
    for v in groups.values():
        assert v == sorted(v, key=lambda x: (x is not None, -(x or 0))), v


@pytest.mark.parametrize("report,column", [(A.monthly_trend, "year_month"), (A.yearly, "year")])
def test_periods_rise_and_the_undated_come_last(spark, report, column):
    got = [r[column] for r in report(_unsold(spark)).collect()]
    assert got[-1] is None and got[:-1] == sorted(got[:-1])


def test_distinct_counts_against_sets(spark):
    rows = [(1, "a", 5, 2), (1, "a", None, 3), (1, None, 5, None), (2, None, None, 1), (None, "b", 7, 1), (None, "c", 7, 1)]
    df = spark.createDataFrame(rows, "g int, x string, y int, v int")
    got = {r.g: (r.xs, r.ys, r.total) for r in distinct_counts(df, {"g": F.col("g")}, {"xs": "x", "ys": "y"}, [F.sum("v").alias("total")]).collect()}
    assert got == {1: (1, 1, 5), 2: (0, 0, 1), None: (2, 1, 2)}
    assert distinct_counts(df, {"g": F.col("g")}, {"xs": "x"}).columns == ["g", "xs"]
    assert distinct_counts(df.limit(0), {"g": F.col("g")}, {"xs": "x"}).count() == 0
