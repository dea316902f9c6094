"""The six raw source feeds, derived from the driver tables.

The source systems of the warehouse (a CRM with customers, product versions and
sales lines; an ERP with customer birth data, customer locations and product
categories) are not shipped, so every feed is derived from the driver tables by
fixed, deterministic rules that plant the defects the cleansing layer exists
for: duplicate customers with older dates, NULL ids and dates, padded and
mixed-case codes, product keys with 1-3 versions, impossible integer dates,
NULL/zero/wrong amounts, negative prices, unknown customers, prefixed and
hyphenated ERP ids, future birth dates and one category missing.

All derivations are narrow maps over one scan except the sales feed (one
equi-join of lineitem and orders on the order key) and the category feed (a
distinct over part, pre-aggregated map-side).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import AMOUNT
from .tables import read_table


def _padded(c: Column, width: int) -> Column:
    return F.lpad(c.cast("string"), width, "0")


def _case(value: Column, mapping: dict, default=None) -> Column:
    out = None
    for k, v in mapping.items():
        cond = value == F.lit(k)
        lit = F.lit(v) if v is not None else F.lit(None).cast("string")
        out = F.when(cond, lit) if out is None else out.when(cond, lit)
    dflt = default if isinstance(default, Column) else (F.lit(default) if default is not None
                                                         else F.lit(None).cast("string"))
    return out.otherwise(dflt)


def _ymd(ts: Column) -> Column:
    return F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)


def crm_cust_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_mktsegment")
    k = F.col("c_custkey")
    key = F.concat(F.lit("AW"), _padded(k, 8))
    current = c.select(
        k.alias("cst_id"),
        key.alias("cst_key"),
        F.when(k % 7 == 0, F.concat(F.lit("  "), "c_name")).otherwise(F.col("c_name")).alias("cst_firstname"),
        F.when(k % 5 == 0, F.concat("c_mktsegment", F.lit(" "))).otherwise(F.col("c_mktsegment")).alias("cst_lastname"),
        _case(k % 4, {0: "S", 1: "M", 2: " s "}).alias("cst_material_status"),
        _case(k % 5, {0: "F", 1: "M", 2: " f", 3: None}, "x").alias("cst_gndr"),
        F.when(k % 11 == 0, F.lit(None).cast("date"))
         .otherwise(F.date_add(F.lit("2015-01-01").cast("date"), (k % 900).cast("int"))).alias("cst_create_date"),
    )
    older = c.filter(k % 10 == 0).select(
        k.alias("cst_id"), key.alias("cst_key"),
        F.concat(F.lit("OLD "), "c_name").alias("cst_firstname"),
        F.col("c_mktsegment").alias("cst_lastname"),
        F.lit("M").alias("cst_material_status"), F.lit("M").alias("cst_gndr"),
        F.date_add(F.lit("2014-01-01").cast("date"), (k % 300).cast("int")).alias("cst_create_date"),
    )
    no_id = c.filter(k % 50 == 0).select(
        F.lit(None).cast("bigint").alias("cst_id"),
        F.concat(F.lit("PO"), k.cast("string")).alias("cst_key"),
        F.col("c_name").alias("cst_firstname"), F.col("c_mktsegment").alias("cst_lastname"),
        F.lit(None).cast("string").alias("cst_material_status"),
        F.lit(None).cast("string").alias("cst_gndr"),
        F.lit(None).cast("date").alias("cst_create_date"),
    )
    return current.unionByName(older).unionByName(no_id)


def crm_prod_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part", "p_partkey", "p_name", "p_type", "p_size")
    k = F.col("p_partkey")
    # 1-3 versions per part: a generator, not a join
    versions = p.withColumn("v", F.explode(F.sequence(F.lit(0), (k % 3).cast("int"))))
    v = F.col("v")
    family = F.when(k % 2 == 0, F.lit("A1")).otherwise(F.lit("B2"))
    return versions.select(
        (k * 10 + v).alias("prd_id"),
        # the first of three versions of every 25th part is a product of its own, which nobody orders
        F.concat(F.substring("p_type", 1, 2), F.lit("-"), family, F.when((k % 25 == 0) & (k % 3 == 2) & (v == 0), F.lit("-X")).otherwise(F.lit("-P")),
                 _padded(k, 7)).alias("prd_key"),
        F.col("p_name").alias("prd_nm"),
        F.when(k % 40 == 0, F.lit(None).cast(AMOUNT))
         .otherwise((F.col("p_size") * 10 + v).cast(AMOUNT)).alias("prd_cost"),
        _case(k % 6, {0: "M", 1: "R ", 2: " s", 3: "T", 4: None}, "x").alias("prd_line"),
        # every seventh part has its versions on one day, the later ids at earlier hours
        F.when(k % 7 == 2, F.lit("1994-01-01 18:00:00").cast("timestamp_ntz") - F.make_dt_interval(hours=9 * v))
         .otherwise(F.date_add(F.lit("1994-01-01").cast("date"), v * 400).cast("timestamp_ntz")
                    + F.make_dt_interval(hours=(k % 5).cast("int"))).alias("prd_start_dt"),
        F.when(v == k % 3, F.lit(None).cast("timestamp_ntz"))
         .otherwise(F.date_add(F.lit("1990-01-01").cast("date"), v * 10).cast("timestamp_ntz")).alias("prd_end_dt"),
    )


def crm_sales_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_linenumber",
                    "l_quantity", "l_shipdate")
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    ok = F.col("l_orderkey")
    unit = (F.lit(100) + F.col("l_partkey") % 900)
    qty = F.col("l_quantity").cast("bigint")
    return j.select(
        F.concat(F.lit("SO"), ok.cast("string")).alias("sls_ord_num"),
        F.concat(F.lit("P"), _padded(F.col("l_partkey"), 7)).alias("sls_prd_key"),
        F.when(ok % 97 == 0, F.col("o_custkey") + 1000000).otherwise(F.col("o_custkey")).alias("sls_cust_id"),
        F.when(ok % 31 == 0, F.lit(0)).when(ok % 37 == 0, F.lit(32154))
         .otherwise(_ymd(F.col("o_orderdate"))).cast("bigint").alias("sls_order_dt"),
        _ymd(F.col("l_shipdate")).cast("bigint").alias("sls_ship_dt"),
        F.when((F.col("l_linenumber") == 7) & (ok % 5 == 0), F.lit(20101332))
         .otherwise(_ymd(F.col("l_shipdate"))).cast("bigint").alias("sls_due_dt"),
        F.when(ok % 19 == 0, F.lit(None).cast(AMOUNT))
         .when(ok % 23 == 0, F.lit(0).cast(AMOUNT))
         .when(ok % 41 == 0, F.lit(1).cast(AMOUNT))
         .otherwise((qty * unit).cast(AMOUNT)).alias("sls_sales"),
        qty.alias("sls_quantity"),
        F.when(ok % 13 == 0, F.lit(None).cast(AMOUNT))
         .when(ok % 17 == 0, (-unit).cast(AMOUNT))
         .otherwise(unit.cast(AMOUNT)).alias("sls_price"),
    )


def erp_cust_a1z12(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer", "c_custkey").filter(F.col("c_custkey") % 9 != 8)
    k = F.col("c_custkey")
    # every 45th customer has a second record under an id that the CRM does not know
    c = c.withColumn("twin", F.explode(F.when(k % 45 == 0, F.array(F.lit("AW"), F.lit("AX"))).otherwise(F.array(F.lit("AW")))))
    return c.select(
        F.concat(F.when(k % 2 == 0, F.lit("NAS")).otherwise(F.lit("")), F.col("twin"), _padded(k, 8)).alias("cid"),
        F.when(k % 60 == 0, F.lit("2099-01-01").cast("date"))
         .otherwise(F.date_add(F.lit("1920-01-01").cast("date"), ((k * 37) % 30000).cast("int"))).alias("bdate"),
        _case(k % 8, {0: "F", 1: "Female", 2: "M ", 3: "male", 4: "", 5: None, 6: " "}, "M").alias("gen"),
    )


def erp_loc_a101(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    n = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    # every 40th customer has a second location under an unknown id
    c = c.withColumn("twin", F.explode(F.when(F.col("c_custkey") % 40 == 0, F.array(F.lit("AW-"), F.lit("AX-"))).otherwise(F.array(F.lit("AW-")))))
    j = c.join(n, c.c_nationkey == n.n_nationkey, "inner")
    return j.select(
        F.concat(F.col("twin"), _padded(F.col("c_custkey"), 8)).alias("cid"),
        _case(F.col("n_nationkey") % 6, {0: "DE", 1: "US", 2: " USA ", 3: "  ", 4: None},
              F.col("n_name")).alias("cntry"),
    )


def erp_px_cat_g1v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part", "p_partkey", "p_type")
    even = F.col("p_partkey") % 2 == 0
    raw_id = F.concat(F.substring("p_type", 1, 2), F.lit("-"), F.when(even, F.lit("A1")).otherwise(F.lit("B2")))
    return (p.filter(raw_id != F.lit("PR-B2"))
             .select(F.replace(raw_id, F.lit("-"), F.lit("_")).alias("id"),
                     F.col("p_type").alias("cat"),
                     F.concat("p_type", F.when(even, F.lit(" A")).otherwise(F.lit(" B"))).alias("subcat"),
                     F.when(even, F.lit("Yes")).otherwise(F.lit("No")).alias("maintenance"))
             .distinct())


BUILDERS = {
    "crm_cust_info": crm_cust_info,
    "crm_prod_info": crm_prod_info,
    "crm_sales_details": crm_sales_details,
    "erp_cust_a1z12": erp_cust_a1z12,
    "erp_loc_a101": erp_loc_a101,
    "erp_px_cat_g1v2": erp_px_cat_g1v2,
}


def all_feeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: build(spark, sf_dir) for name, build in BUILDERS.items()}
