"""Business questions over the gold star schema.

Reports on one dimension aggregate the fact by its surrogate key first (partial sums on
the map side), so the join sees one row per customer or product and not every sales line.
Reports on customers and products choose by measurement: dimensions that fit a broadcast are
joined to the lines where they lie, as pairs of keys are nearly as many as lines; else the
fact is aggregated by key pairs first if that at least halves it.  Sums
stay exact decimals and only the finished figures become doubles.  The closing
sort runs on aggregated rows, NULL totals first in descending order as in the
source, with every group column as tie break.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import calendar as K
from ..functions import cleanse as C
from ..functions import metrics as M
from ..operators.distinct import distinct_counts
from ..operators.joins import broadcast_if_small, broadcast_threshold, fits_broadcast

Gold = dict[str, DataFrame]


def _dim(g: Gold, name: str, *cols: str) -> DataFrame:
    """The dimension columns a report needs, broadcast when provably small."""
    d = g[name].select(*cols) if cols else g[name]
    return broadcast_if_small(d, rows_of=g[name])


def _known(g: Gold, *keys: str) -> DataFrame:
    """Sales lines with known keys (an inner join on them drops NULL keys anyway)."""
    return g["fact_sales"].dropna(subset=list(keys))


def _lines(g: Gold, *keys: str) -> DataFrame:
    """Sales lines summed by surrogate keys: order lines, lines, amount, priced lines, price, quantity."""
    return _known(g, *keys).groupBy(*keys).agg(
        F.count("order_number").alias("_orders"), F.sum("sales_amount").alias("_sales"), F.count("sales_amount").alias("_paid"),
        F.sum("price").alias("_price"), F.count("price").alias("_priced"), F.sum("quantity").alias("_units"))


def _single_lines(g: Gold, *keys: str) -> DataFrame:
    """The columns of :func:`_lines` with a row per line."""
    one = lambda c: F.col(c).isNotNull().cast("bigint")
    return _known(g, *keys).select(*keys, one("order_number").alias("_orders"), F.col("sales_amount").alias("_sales"), one("sales_amount").alias("_paid"),
                                   F.col("price").alias("_price"), one("price").alias("_priced"), F.col("quantity").alias("_units"))


PAIRS_WORTH_IT = 0.5  # key pairs per line up to which the fact is aggregated by pair before a shuffled join


def pairs_first(g: Gold) -> bool:
    """Are there so few (customer, product) pairs that aggregating by them first pays?  One pass over
    the two key columns, a sketch per task."""
    keys = _known(g, "customer_key", "product_key").select("customer_key", "product_key")
    n = keys.agg(F.count(F.lit(1)).alias("lines"), F.approx_count_distinct(F.xxhash64("customer_key", "product_key")).alias("pairs")).first()
    return n["pairs"] <= PAIRS_WORTH_IT * n["lines"]


def _by_customer(g: Gold, *cols: str) -> DataFrame:
    return _lines(g, "customer_key").join(_dim(g, "dim_customer", "customer_key", *cols), "customer_key", "inner")


def _by_product(g: Gold, *cols: str) -> DataFrame:
    return _lines(g, "product_key").join(_dim(g, "dim_products", "product_key", *cols), "product_key", "inner")


def _by_both(g: Gold, cust_cols=(), prod_cols=()) -> DataFrame:
    small = all(fits_broadcast(g[d].select(k, *cols), rows_of=g[d])
                for d, k, cols in (("dim_customer", "customer_key", cust_cols), ("dim_products", "product_key", prod_cols)))
    lines = _lines if not small and pairs_first(g) else _single_lines
    return (lines(g, "customer_key", "product_key")
            .join(_dim(g, "dim_customer", "customer_key", *cust_cols), "customer_key", "inner")
            .join(_dim(g, "dim_products", "product_key", *prod_cols), "product_key", "inner"))


def _largest_first(total: str, *ties: str):
    return [F.col(total).desc_nulls_first(), *[F.col(t).asc_nulls_last() for t in ties]]


def _sum_of(part: str):
    return F.sum(part).cast("double")


def sales_by_customer(g: Gold) -> DataFrame:
    """One row per customer: the surrogate key already is the group."""
    return (_by_customer(g, "first_name", "last_name", "country")
            .select("customer_key", "first_name", "last_name", "country", F.col("_orders").alias("total_orders"),
                    F.col("_sales").cast("double").alias("total_sales"),
                    (F.col("_sales").cast("double") / F.nullif("_paid", F.lit(0))).alias("avg_order_value"))
            .orderBy(*_largest_first("total_sales", "customer_key")))


def sales_by_country(g: Gold) -> DataFrame:
    return (_by_customer(g, "country")
            .groupBy("country")
            .agg(F.count(F.lit(1)).alias("customer_count"), F.sum("_orders").alias("order_count"), _sum_of("_sales").alias("total_sales"))
            .orderBy(*_largest_first("total_sales", "country")))


def demographics(g: Gold, as_of=None) -> DataFrame:
    """Customers with or without sales; the age average runs over sales lines
    (a customer without sales counts once), as the outer join defines it.

    The fact is aggregated per customer before the join, so the join sees one
    row per customer on each side and a customer with a huge share of the
    sales never lands in one task; the line-weighted average is rebuilt from
    integer sums, so it equals the average over the joined lines exactly.
    """
    per_customer = (g["fact_sales"].groupBy("customer_key")
                    .agg(F.sum("sales_amount").alias("_sales"), F.count(F.lit(1)).alias("_lines")))
    age = F.year(C.as_of_date(as_of)) - F.year("birthdate")
    weight = F.coalesce(F.col("_lines"), F.lit(1))
    joined = g["dim_customer"].join(per_customer, "customer_key", "left")
    return (joined.groupBy("gender", "marital_status")
            .agg(F.countDistinct("customer_key").alias("customer_count"),
                 F.round(F.sum(age * weight) / F.sum(F.when(age.isNotNull(), weight)), 1).alias("avg_age"),
                 F.sum("_sales").cast("double").alias("total_sales"))
            .orderBy(F.col("total_sales").desc_nulls_first(), "gender", "marital_status"))


def top_products(g: Gold) -> DataFrame:
    units, revenue = F.col("_units"), F.col("_sales")
    return (_by_product(g, "product_name", "category", "subcategory", "cost")
            .select("product_key", "product_name", "category", "subcategory", units.alias("units_sold"),
                    revenue.cast("double").alias("total_revenue"), M.ratio(revenue, units).alias("avg_selling_price"),
                    F.col("cost").cast("double").alias("cost"), M.rounded(revenue - F.col("cost") * units).alias("gross_profit"))
            .orderBy(*_largest_first("total_revenue", "product_key")))


def sales_by_category(g: Gold) -> DataFrame:
    return (_by_product(g, "category", "subcategory")
            .groupBy("category", "subcategory")
            .agg(F.count(F.lit(1)).alias("product_count"), F.sum("_units").alias("total_quantity"),
                 _sum_of("_sales").alias("total_sales"), M.rounded(F.sum("_price") / F.nullif(F.sum("_priced"), F.lit(0))).alias("avg_price"))
            .orderBy(*_largest_first("total_sales", "category", "subcategory")))


def by_product_line(g: Gold) -> DataFrame:
    units, revenue = F.sum("_units"), F.sum("_sales")
    return (_by_product(g, "product_line")
            .groupBy("product_line")
            .agg(F.count(F.lit(1)).alias("product_count"), revenue.cast("double").alias("total_sales"),
                 units.alias("units_sold"), M.ratio(revenue, units).alias("avg_price"))
            .orderBy(*_largest_first("total_sales", "product_line")))


def monthly_trend(g: Gold) -> DataFrame:
    return (g["fact_sales"]
            .groupBy(K.year_month("order_date").alias("year_month"))
            .agg(F.count("order_number").alias("order_count"),
                 F.sum("quantity").alias("total_quantity"),
                 M.total("sales_amount").alias("total_sales"),
                 M.rounded(F.avg("sales_amount")).alias("avg_order_value"))
            .orderBy(F.col("year_month").asc_nulls_last()))


def yearly(g: Gold) -> DataFrame:
    """Buyers and orders are counted over distinct (year, key) pairs, each from its own two columns."""
    counted = distinct_counts(g["fact_sales"], {"year": K.year_of("order_date")}, {"unique_customers": "customer_key", "total_orders": "order_number"},
                              [F.sum("sales_amount").alias("_sales")])
    return (counted.select("year", F.col("_sales").cast("double").alias("total_sales"), "unique_customers", "total_orders",
                           M.ratio(F.col("_sales"), F.col("unique_customers")).alias("sales_per_customer"))
            .orderBy(F.col("year").asc_nulls_last()))


def weekday(g: Gold) -> DataFrame:
    return (g["fact_sales"]
            .groupBy(K.weekday_name("order_date").alias("day_of_week"),
                     K.weekday_number("order_date").alias("_dow"))
            .agg(F.count("order_number").alias("order_count"),
                 M.total("sales_amount").alias("total_sales"),
                 M.rounded(F.avg("sales_amount")).alias("avg_order_value"))
            .orderBy(F.col("_dow").asc_nulls_last())
            .drop("_dow"))


def customer_category(g: Gold) -> DataFrame:
    return (_by_both(g, ("customer_id", "first_name", "last_name"), ("category",))
            .groupBy("customer_id", "first_name", "last_name", "category")
            .agg(F.sum("_orders").alias("order_count"), _sum_of("_sales").alias("total_spent"), F.sum("_units").alias("total_quantity"))
            .select("customer_id", C.full_name("first_name", "last_name").alias("customer_name"),
                    "category", "order_count", "total_spent", "total_quantity")
            .orderBy(*_largest_first("total_spent", "customer_id", "category", "customer_name")))


def geo_product(g: Gold) -> DataFrame:
    return (_by_both(g, ("country",), ("category", "product_line"))
            .groupBy("country", "category", "product_line")
            .agg(_sum_of("_sales").alias("total_sales"), F.sum("_units").alias("units_sold"))
            .orderBy(F.col("country").asc_nulls_last(), *_largest_first("total_sales", "category", "product_line")))


def template_filtered(g: Gold, country: str, since: str, by_customer: str = "gender",
                      by_product: str = "category") -> DataFrame:
    """The analyst template: dimension filters applied before the join."""
    whole = g["dim_customer"]
    c = whole.filter(F.col("country") == country).select("customer_key", by_customer)
    # the whole dimension's size, measured once, is a bound; only beyond it is the filtered part measured
    c = F.broadcast(c) if fits_broadcast(c, rows_of=whole) else broadcast_if_small(c)
    f = g["fact_sales"].filter(F.col("order_date") >= F.lit(since).cast("date"))
    return (f.join(c, "customer_key", "inner").join(_dim(g, "dim_products", "product_key", by_product),
                                                    "product_key", "inner")
            .groupBy(by_customer, by_product)
            .agg(F.countDistinct("order_number").alias("order_count"),
                 M.total("sales_amount").alias("total_sales"),
                 M.mean("sales_amount").alias("avg_sales"))
            .orderBy(*_largest_first("total_sales", by_customer, by_product)))


def star_filter(g: Gold, category: str, hint_broadcast: bool = False) -> DataFrame:
    """Revenue of one category.  Written dimension-first or fact-first, Catalyst
    pushes the category filter below the join either way; ``hint_broadcast``
    asks for the filtered dimension to be broadcast up to four times the session's
    threshold (the nested-loop hint of a row store has no better Spark analogue)."""
    whole = g["dim_products"]
    p = whole.filter(F.col("category") == category).select("product_key", "category")
    limit = 4 * broadcast_threshold(p) if hint_broadcast else broadcast_threshold(p)
    p = F.broadcast(p) if fits_broadcast(p, limit, rows_of=whole) else broadcast_if_small(p, limit)
    return (p.join(_lines(g, "product_key"), "product_key", "inner")
            .groupBy("category").agg(_sum_of("_sales").alias("total_sales")))


def preaggregated_by_customer(g: Gold) -> DataFrame:
    """Aggregate the fact at the lowest grain first, then join: one row per customer."""
    agg = g["fact_sales"].groupBy("customer_key").agg(F.sum("sales_amount").alias("_sales"))
    return (agg.join(g["dim_customer"].select("customer_key", "country"), "customer_key", "inner")
            .select("country", F.col("_sales").cast("double").alias("total_sales")))


def order_metrics(g: Gold) -> DataFrame:
    """Average order value and units per order (orders = distinct order numbers)."""
    orders = F.countDistinct("order_number")
    revenue = F.sum("sales_amount")
    return g["fact_sales"].agg(
        revenue.cast("double").alias("total_sales"),
        orders.alias("order_count"),
        M.ratio(revenue, orders).alias("avg_order_value"),
        M.rounded(F.sum("quantity") / F.nullif(orders, F.lit(0))).alias("units_per_order"))


def headline_shares(g: Gold) -> DataFrame:
    """Revenue and share of revenue per country and per category."""
    by_country = (_by_customer(g, "country").groupBy(F.lit("country").alias("dimension"), F.col("country").alias("member"))
                  .agg(F.sum("_sales").alias("_sales")))
    by_category = (_by_product(g, "category").groupBy(F.lit("category").alias("dimension"), F.col("category").alias("member"))
                   .agg(F.sum("_sales").alias("_sales")))
    # the window runs over aggregated rows: one per country or category
    whole = F.sum("_sales").over(Window.partitionBy("dimension"))
    both = by_country.unionByName(by_category)
    return (both.select("dimension", "member", F.col("_sales").cast("double").alias("total_sales"),
                        F.round(F.lit(100.0) * F.col("_sales").cast("double") / whole.cast("double"), 1)
                        .alias("share_pct"))
            .orderBy("dimension", *_largest_first("total_sales", "member")))


def headline_totals(g: Gold) -> DataFrame:
    """Customers, products, order lines, revenue and revenue per line, in one
    global aggregate over the three tables stacked (no join needed)."""
    amount = g["fact_sales"].schema["sales_amount"].dataType
    none = F.lit(None).cast(amount)
    stacked = (g["dim_customer"].select(F.lit("c").alias("_t"), none.alias("_s"))
               .unionByName(g["dim_products"].select(F.lit("p").alias("_t"), none.alias("_s")))
               .unionByName(g["fact_sales"].select(F.lit("f").alias("_t"), F.col("sales_amount").alias("_s"))))
    lines = M.count_if(F.col("_t") == "f")
    return stacked.agg(M.count_if(F.col("_t") == "c").alias("customers"),
                       M.count_if(F.col("_t") == "p").alias("products"),
                       lines.alias("order_lines"),
                       F.sum("_s").cast("double").alias("total_sales"),
                       M.ratio(F.sum("_s"), lines).alias("sales_per_line"))
