"""Registered queries for the individual operators: cleansing rules, windows,
joins, predicates, scalar functions and aggregates, each run over whole feeds."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from .. import sqlcheck as Q
from ..catalog import register
from ..functions import calendar as K
from ..functions import cleanse as C
from ..functions import metrics as M
from ..operators import dedup, joins
from ..operators import quality as D
from ..operators.distinct import distinct_counts
from ..session import shared_dir
from . import gold as G
from . import silver as S
from .layers import AS_OF, bronze, silver_of, star


def _feed(spark, sf, name):
    return bronze(spark, sf)[name]


def _silver(spark, sf, name):
    return silver_of(star(spark, sf))[name]


def _mapping(df, raw: str, decoded):
    """How a rule maps each raw value: ``(raw_value, decoded, row_count)``."""
    return (df.groupBy(F.col(raw).alias("raw_value"), decoded.alias("decoded"))
              .agg(F.count(F.lit(1)).alias("row_count")))


def _mapping_sql(table: str, raw: str, expr: str) -> str:
    return Q.chain(f"SELECT {raw} AS raw_value, {expr} AS decoded, count(*) AS row_count "
                   f"FROM {table} GROUP BY {raw}, {expr}")


# ---------------------------------------------------------------- cleansing rules

@register("trim_names", Q.chain("SELECT cst_firstname AS raw_firstname, trim(cst_firstname) AS first_name,"
                                " cst_lastname AS raw_lastname, trim(cst_lastname) AS last_name FROM b_cust"))
def trim_names(spark, sf):
    b = _feed(spark, sf, "crm_cust_info")
    return b.select(F.col("cst_firstname").alias("raw_firstname"), C.trim_text("cst_firstname").alias("first_name"),
                    F.col("cst_lastname").alias("raw_lastname"), C.trim_text("cst_lastname").alias("last_name"))


@register("decode_marital", _mapping_sql("b_cust", "cst_material_status", Q.decode_marital()))
def decode_marital(spark, sf):
    return _mapping(_feed(spark, sf, "crm_cust_info"), "cst_material_status",
                    C.decode("cst_material_status", C.MARITAL_CODES))


@register("decode_gender", _mapping_sql("b_cust", "cst_gndr", Q.decode_gender()))
def decode_gender(spark, sf):
    return _mapping(_feed(spark, sf, "crm_cust_info"), "cst_gndr", C.decode("cst_gndr", C.GENDER_CODES))


@register("decode_gender_multi", _mapping_sql("b_ecust", "gen", Q.decode_gender_multi()))
def decode_gender_multi(spark, sf):
    return _mapping(_feed(spark, sf, "erp_cust_a1z12"), "gen", C.decode("gen", C.GENDER_SPELLINGS))


@register("decode_line", _mapping_sql("b_prod", "prd_line", Q.decode_line()))
def decode_line(spark, sf):
    return _mapping(_feed(spark, sf, "crm_prod_info"), "prd_line", C.decode("prd_line", C.PRODUCT_LINE_CODES))


@register("decode_country", _mapping_sql("b_loc", "cntry", Q.decode_country()))
def decode_country(spark, sf):
    return _mapping(_feed(spark, sf, "erp_loc_a101"), "cntry",
                    C.decode("cntry", C.COUNTRY_CODES, normalize=False, passthrough=True, blank_to=C.UNKNOWN))


@register("split_product_key", Q.chain("SELECT prd_key AS raw_key, replace(substr(prd_key,1,5),'-','_') AS cat_id,"
                                       " substr(prd_key, 7) AS prd_key FROM b_prod"))
def split_product_key(spark, sf):
    b = _feed(spark, sf, "crm_prod_info")
    return b.select(F.col("prd_key").alias("raw_key"), C.key_category("prd_key").alias("cat_id"),
                    C.key_number("prd_key").alias("prd_key"))


@register("strip_prefix", Q.chain(f"SELECT cid AS raw_cid, {Q.strip_nas()} AS cid FROM b_ecust"))
def strip_prefix(spark, sf):
    b = _feed(spark, sf, "erp_cust_a1z12")
    return b.select(F.col("cid").alias("raw_cid"), C.strip_prefix("cid").alias("cid"))


@register("remove_chars", Q.chain("SELECT cid AS raw_cid, replace(cid, '-', '') AS cid FROM b_loc"))
def remove_chars(spark, sf):
    b = _feed(spark, sf, "erp_loc_a101")
    return b.select(F.col("cid").alias("raw_cid"), C.remove_chars("cid", "-").alias("cid"))


@register("null_default", Q.chain("SELECT prd_id, CAST(prd_cost AS DOUBLE) AS raw_cost,"
                                  " CAST(coalesce(prd_cost, 0) AS DOUBLE) AS cost FROM b_prod"))
def null_default(spark, sf):
    b = _feed(spark, sf, "crm_prod_info")
    return b.select("prd_id", F.col("prd_cost").cast("double").alias("raw_cost"),
                    C.null_to("prd_cost", 0).cast("double").alias("cost"))


_DATE_COLS = ("sls_order_dt", "sls_ship_dt", "sls_due_dt")


@register("int_to_date", Q.chain(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {c} AS raw_value, {Q.int_date(c)} AS parsed, count(*) AS row_count "
    f"FROM b_sales GROUP BY {c}" for c in _DATE_COLS)))
def int_to_date(spark, sf):
    """All three columns in one pass over the feed."""
    long = _feed(spark, sf, "crm_sales_details").unpivot([], list(_DATE_COLS), "column_name", "raw_value")
    return (long.groupBy("column_name", "raw_value").agg(F.count(F.lit(1)).alias("row_count"))
            .withColumn("parsed", C.int_to_date("raw_value")))


@register("future_to_null", Q.chain(f"SELECT cid, bdate AS raw_bdate, CASE WHEN bdate > DATE '{AS_OF}' THEN NULL"
                                    f" ELSE bdate END AS bdate FROM b_ecust"))
def future_to_null(spark, sf):
    b = _feed(spark, sf, "erp_cust_a1z12")
    return b.select("cid", F.col("bdate").alias("raw_bdate"), C.future_to_null("bdate", AS_OF).alias("bdate"))


@register("repair_amount", Q.chain(f"""
SELECT CAST(sls_sales AS DOUBLE) AS raw_sales, sls_quantity, CAST(sls_price AS DOUBLE) AS raw_price,
 CAST({Q.repaired_sales()} AS DOUBLE) AS sales, count(*) AS row_count
FROM b_sales GROUP BY sls_sales, sls_quantity, sls_price"""))
def repair_amount(spark, sf):
    b = _feed(spark, sf, "crm_sales_details")
    g = b.groupBy("sls_sales", "sls_quantity", "sls_price").agg(F.count(F.lit(1)).alias("row_count"))
    return g.select(F.col("sls_sales").cast("double").alias("raw_sales"), "sls_quantity",
                    F.col("sls_price").cast("double").alias("raw_price"),
                    C.repair_amount("sls_sales", "sls_quantity", "sls_price").cast("double").alias("sales"),
                    "row_count")


@register("repair_price", Q.chain(f"""
SELECT CAST(sls_sales AS DOUBLE) AS raw_sales, sls_quantity, CAST(sls_price AS DOUBLE) AS raw_price,
 CAST({Q.repaired_price()} AS DOUBLE) AS price, count(*) AS row_count
FROM b_sales GROUP BY sls_sales, sls_quantity, sls_price"""))
def repair_price(spark, sf):
    b = _feed(spark, sf, "crm_sales_details")
    g = b.groupBy("sls_sales", "sls_quantity", "sls_price").agg(F.count(F.lit(1)).alias("row_count"))
    return g.select(F.col("sls_sales").cast("double").alias("raw_sales"), "sls_quantity",
                    F.col("sls_price").cast("double").alias("raw_price"),
                    C.repair_price("sls_sales", "sls_quantity", "sls_price").cast("double").alias("price"),
                    "row_count")


_GENDER_JOIN = ("FROM s_cust ci LEFT JOIN s_ecust ca ON ci.cst_key = ca.cid")
_RESOLVED = "CASE WHEN ci.cst_gndr <> 'n/a' THEN ci.cst_gndr ELSE coalesce(ca.gen, 'n/a') END"


def _gender_sources(spark, sf):
    s = silver_of(star(spark, sf))
    ci, ca = s["crm_cust_info"].select("cst_key", "cst_gndr"), s["erp_cust_a1z12"].select("cid", "gen")
    return joins.left_join_spread(ci, ca, "cst_key", "cid").select(
        F.col("cst_gndr").alias("crm_gender"), F.col("gen").alias("erp_gender"), C.coalesce_sources("cst_gndr", "gen").alias("gender"))


@register("master_source_gender", Q.chain(
    f"SELECT ci.cst_gndr AS crm_gender, ca.gen AS erp_gender, {_RESOLVED} AS gender, count(*) AS row_count "
    f"{_GENDER_JOIN} GROUP BY ci.cst_gndr, ca.gen, {_RESOLVED}"))
def master_source_gender(spark, sf):
    return _gender_sources(spark, sf).groupBy("crm_gender", "erp_gender", "gender").agg(
        F.count(F.lit(1)).alias("row_count"))


@register("gender_matrix", Q.chain(
    f"SELECT DISTINCT ci.cst_gndr AS crm_gender, ca.gen AS erp_gender, {_RESOLVED} AS gender {_GENDER_JOIN}"))
def gender_matrix(spark, sf):
    return _gender_sources(spark, sf).distinct()


# ---------------------------------------------------------------- windows

_BCUST = "cst_id, cst_key, cst_firstname, cst_lastname, cst_material_status, cst_gndr, cst_create_date"


@register("dedup_latest", Q.chain(f"""
SELECT {_BCUST} FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY cst_id ORDER BY {Q.CUST_ORDER}) AS rn
 FROM b_cust WHERE cst_id IS NOT NULL) ranked WHERE rn = 1"""))
def dedup_latest(spark, sf):
    return S.latest_customers(_feed(spark, sf, "crm_cust_info"))


@register("dedup_superseded", Q.chain(f"""
SELECT {_BCUST} FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY cst_id ORDER BY {Q.CUST_ORDER}) AS rn
 FROM b_cust) ranked WHERE rn <> 1"""))
def dedup_superseded(spark, sf):
    return dedup.superseded(_feed(spark, sf, "crm_cust_info"), ["cst_id"],
                            [F.col("cst_create_date").desc_nulls_first()], tie_break=S.CUSTOMER_TIE_BREAK)


@register("surrogate_key_customer", Q.chain("SELECT customer_key, customer_id FROM dim_customer"))
def surrogate_key_customer(spark, sf):
    return star(spark, sf)["dim_customer"].select("customer_key", "customer_id")


@register("surrogate_key_product", Q.chain("SELECT product_key, product_number, start_date FROM dim_products"))
def surrogate_key_product(spark, sf):
    return star(spark, sf)["dim_products"].select("product_key", "product_number", "start_date")


@register("validity_interval", Q.chain(f"""
SELECT prd_id, prd_key AS raw_key, prd_start_dt,
 CAST(LEAD(prd_start_dt) OVER (PARTITION BY prd_key ORDER BY {Q.PROD_ORDER}) AS DATE) - 1 AS prd_end_dt FROM b_prod"""))
def validity_interval(spark, sf):
    v = S.with_validity_end(_feed(spark, sf, "crm_prod_info"))
    return v.select("prd_id", F.col("prd_key").alias("raw_key"), "prd_start_dt", F.col("_valid_to").alias("prd_end_dt"))


@register("validity_interval_ts", Q.chain(f"""
SELECT prd_id, prd_key AS raw_key, CAST(prd_start_dt AS TIMESTAMP) AS prd_start_ts,
 LEAD(CAST(prd_start_dt AS TIMESTAMP)) OVER (PARTITION BY prd_key ORDER BY {Q.PROD_ORDER})
   - INTERVAL 1 SECOND AS prd_end_ts FROM b_prod"""))
def validity_interval_ts(spark, sf):
    v = S.with_validity_end(_feed(spark, sf, "crm_prod_info"), precision="second")
    return v.select("prd_id", F.col("prd_key").alias("raw_key"),
                    F.col("prd_start_dt").cast("timestamp_ntz").alias("prd_start_ts"),
                    F.col("_valid_to").alias("prd_end_ts"))


# ---------------------------------------------------------------- joins

@register("left_join_2", Q.chain("SELECT pn.prd_id, pn.prd_key, pn.cat_id, pc.cat, pc.subcat"
                                 " FROM s_prod pn LEFT JOIN s_cat pc ON pn.cat_id = pc.id"))
def left_join_2(spark, sf):
    pn = _silver(spark, sf, "crm_prod_info").select("prd_id", "prd_key", "cat_id")
    pc = _silver(spark, sf, "erp_px_cat_g1v2").select("id", "cat", "subcat")
    return joins.left_join_spread(pn, pc, "cat_id", "id").drop("id")


@register("anti_not_in", Q.chain("SELECT sls_ord_num, sls_prd_key, sls_cust_id FROM s_sales"
                                 " WHERE sls_cust_id NOT IN (SELECT cst_id FROM s_cust)"))
def anti_not_in(spark, sf):
    sales = _silver(spark, sf, "crm_sales_details").select("sls_ord_num", "sls_prd_key", "sls_cust_id")
    return joins.not_in(sales, "sls_cust_id", _silver(spark, sf, "crm_cust_info"), "cst_id")


@register("anti_not_in_nullable", Q.chain("SELECT sls_ord_num, sls_prd_key, sls_cust_id FROM s_sales"
                                          " WHERE sls_cust_id NOT IN (SELECT cst_id FROM b_cust)"))
def anti_not_in_nullable(spark, sf):
    """The subquery holds NULL ids, so NOT IN keeps nothing (three-valued logic)."""
    sales = _silver(spark, sf, "crm_sales_details").select("sls_ord_num", "sls_prd_key", "sls_cust_id")
    return joins.not_in(sales, "sls_cust_id", _feed(spark, sf, "crm_cust_info"), "cst_id")


@register("anti_not_in_category", Q.chain("SELECT prd_id, prd_key, cat_id FROM s_prod"
                                          " WHERE cat_id NOT IN (SELECT id FROM s_cat)"))
def anti_not_in_category(spark, sf):
    prod = _silver(spark, sf, "crm_prod_info").select("prd_id", "prd_key", "cat_id")
    return joins.not_in(prod, "cat_id", _silver(spark, sf, "erp_px_cat_g1v2"), "id")


@register("anti_not_exists", Q.chain("SELECT count(*) AS orphan_sales FROM s_sales s WHERE NOT EXISTS"
                                     " (SELECT 1 FROM s_cust c WHERE c.cst_id = s.sls_cust_id)"))
def anti_not_exists(spark, sf):
    orphans = joins.not_exists(_silver(spark, sf, "crm_sales_details"), "sls_cust_id",
                               _silver(spark, sf, "crm_cust_info"), "cst_id")
    return orphans.agg(F.count(F.lit(1)).alias("orphan_sales"))


@register("anti_product_sales", Q.chain("SELECT prd_id, prd_key, cat_id FROM s_prod"
                                        " WHERE prd_key NOT IN (SELECT sls_prd_key FROM s_sales)"))
def anti_product_sales(spark, sf):
    """Products that were never sold."""
    prod = _silver(spark, sf, "crm_prod_info").select("prd_id", "prd_key", "cat_id")
    return joins.not_in(prod, "prd_key", _silver(spark, sf, "crm_sales_details"), "sls_prd_key")


@register("anti_erp_customer", Q.chain("""
SELECT cid, bdate FROM b_ecust WHERE CASE WHEN starts_with(cid, 'NAS') THEN substring(cid, 4) ELSE cid END NOT IN (SELECT cst_key FROM b_cust)"""))
def anti_erp_customer(spark, sf):
    """ERP customers whose id, prefix taken off inside the predicate, is no key of a CRM customer."""
    erp = _feed(spark, sf, "erp_cust_a1z12").select("cid", "bdate", C.strip_prefix("cid").alias("_key"))
    return joins.not_in(erp, "_key", _feed(spark, sf, "crm_cust_info"), "cst_key").drop("_key")


@register("anti_location_customer", Q.chain("""
SELECT cid, cntry FROM b_loc WHERE replace(cid, '-', '') NOT IN (SELECT cst_key FROM s_cust)"""))
def anti_location_customer(spark, sf):
    """Locations without a customer."""
    loc = _feed(spark, sf, "erp_loc_a101").select("cid", "cntry", C.remove_chars("cid").alias("_key"))
    return joins.not_in(loc, "_key", _silver(spark, sf, "crm_cust_info"), "cst_key").drop("_key")


_RELATIONS_SQL = {
    "sales_customer": ("SELECT sls_cust_id AS k FROM s_sales", "SELECT cst_id FROM s_cust"),
    "sales_product": ("SELECT sls_prd_key FROM s_sales", "SELECT prd_key FROM s_prod"),
    "product_category": ("SELECT cat_id FROM s_prod", "SELECT id FROM s_cat"),
    "product_sales": ("SELECT prd_key FROM s_prod", "SELECT sls_prd_key FROM s_sales"),
    "erp_customer": ("SELECT cid FROM s_ecust", "SELECT cst_key FROM s_cust"),
    "location_customer": ("SELECT cid FROM s_loc", "SELECT cst_key FROM s_cust"),
    "customer_location": ("SELECT cst_key FROM s_cust", "SELECT cid FROM s_loc"),
}


@register("orphan_summary", Q.chain(" UNION ALL ".join(
    f"SELECT '{name}' AS relation, (SELECT count(*) FROM ({left}) l(k) WHERE NOT EXISTS (SELECT 1 FROM ({right}) r(k) WHERE r.k = l.k)) AS orphan_rows,"
    f" (SELECT count(DISTINCT k) FROM ({left}) l(k) WHERE NOT EXISTS (SELECT 1 FROM ({right}) r(k) WHERE r.k = l.k)) AS orphan_keys"
    for name, (left, right) in _RELATIONS_SQL.items())))
def orphan_summary(spark, sf):
    """Orphans of every relation of the silver layer, whole tables on both sides, by one grouping of all keys."""
    s = silver_of(star(spark, sf))
    key = lambda t, c: s[t].select(F.col(c).cast("string").alias("k"))
    sales, prod, cust = "crm_sales_details", "crm_prod_info", "crm_cust_info"
    return D.orphan_summary({
        "sales_customer": (key(sales, "sls_cust_id"), key(cust, "cst_id")),
        "sales_product": (key(sales, "sls_prd_key"), key(prod, "prd_key")),
        "product_category": (key(prod, "cat_id"), key("erp_px_cat_g1v2", "id")),
        "product_sales": (key(prod, "prd_key"), key(sales, "sls_prd_key")),
        "erp_customer": (key("erp_cust_a1z12", "cid"), key(cust, "cst_key")),
        "location_customer": (key("erp_loc_a101", "cid"), key(cust, "cst_key")),
        "customer_location": (key(cust, "cst_key"), key("erp_loc_a101", "cid")),
    })


@register("anti_left_null", Q.chain("""
SELECT f.order_number, f.product_key, f.customer_key, f.order_date, CAST(f.sales_amount AS DOUBLE) AS sales_amount
FROM fact_sales f LEFT JOIN dim_customer c ON c.customer_key = f.customer_key
LEFT JOIN dim_products p ON p.product_key = f.product_key WHERE c.customer_key IS NULL"""))
def anti_left_null(spark, sf):
    g = star(spark, sf)
    f = g["fact_sales"].select("order_number", "product_key", "customer_key", "order_date",
                               F.col("sales_amount").cast("double").alias("sales_amount"))
    return joins.not_exists(f, "customer_key", g["dim_customer"], "customer_key")


# ---------------------------------------------------------------- predicates

@register("filter_cmp", Q.chain("""
SELECT sls_ord_num, sls_prd_key, sls_quantity, CAST(sls_price AS DOUBLE) AS sls_price FROM s_sales
WHERE sls_quantity >= 40 AND sls_quantity <= 45 AND sls_price < 150 AND sls_sales <> 0
 AND sls_cust_id > 10 AND sls_prd_key != 'P0000001' AND sls_order_dt = sls_order_dt"""))
def filter_cmp(spark, sf):
    s = _silver(spark, sf, "crm_sales_details")
    q = F.col("sls_quantity")
    return (s.filter((q >= 40) & (q <= 45) & (F.col("sls_price") < 150) & (F.col("sls_sales") != 0)
                     & (F.col("sls_cust_id") > 10) & (F.col("sls_prd_key") != "P0000001")
                     & (F.col("sls_order_dt") == F.col("sls_order_dt")))
             .select("sls_ord_num", "sls_prd_key", "sls_quantity", F.col("sls_price").cast("double")))


@register("current_rows", Q.chain("SELECT prd_id, prd_key, prd_start_dt FROM s_prod WHERE prd_end_dt IS NULL"))
def current_rows(spark, sf):
    return (_silver(spark, sf, "crm_prod_info").filter(F.col("prd_end_dt").isNull())
            .select("prd_id", "prd_key", "prd_start_dt"))


@register("historic_rows", Q.chain("SELECT * EXCLUDE (cost), CAST(cost AS DOUBLE) AS cost FROM ("
                                   + Q.product_rows(False) + ") h"))
def historic_rows(spark, sf):
    rows = G.product_rows(silver_of(star(spark, sf)), current=False)
    return rows.withColumn("cost", F.col("cost").cast("double"))


@register("like_prefix", Q.chain("SELECT cid, bdate FROM b_ecust WHERE cid LIKE 'NAS%'"))
def like_prefix(spark, sf):
    return _feed(spark, sf, "erp_cust_a1z12").filter(F.col("cid").startswith("NAS")).select("cid", "bdate")


@register("like_contains", Q.chain("SELECT cid, bdate, gen FROM b_ecust WHERE cid LIKE '%AW000001%'"))
def like_contains(spark, sf):
    return _feed(spark, sf, "erp_cust_a1z12").filter(F.col("cid").like("%AW000001%"))


_TOP_COLS = ["sls_ord_num", "sls_prd_key", "sls_cust_id", "sls_order_dt", "sls_ship_dt", "sls_due_dt",
             "sls_quantity"]


@register("top_n", Q.chain(f"""
SELECT sls_ord_num, sls_prd_key, CAST(sls_sales AS DOUBLE) AS sls_sales, sls_quantity FROM s_sales
ORDER BY sls_sales DESC NULLS LAST, {', '.join(c + ' ASC NULLS LAST' for c in _TOP_COLS)},
 sls_price ASC NULLS LAST LIMIT 10"""))
def top_n(spark, sf):
    """The ten largest sales lines: a top-k (TakeOrderedAndProject, no full sort)."""
    s = _silver(spark, sf, "crm_sales_details")
    return (s.orderBy(F.col("sls_sales").desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in _TOP_COLS],
                      F.col("sls_price").asc_nulls_last())
             .limit(10)
             .select("sls_ord_num", "sls_prd_key", F.col("sls_sales").cast("double"), "sls_quantity"))


# ---------------------------------------------------------------- scalar functions

@register("fn_string", Q.chain("""
SELECT cst_key, trim(cst_firstname) AS trimmed, upper(cst_lastname) AS upper_last, substr(cst_key, 1, 2) AS key_prefix,
 substr(cst_key, 3, 20) AS key_rest, length(cst_key) AS key_length, replace(cst_key, 'AW', '') AS key_digits,
 coalesce(cst_firstname, '')||' '||coalesce(cst_lastname, '') AS full_name, lpad(CAST(cst_id AS VARCHAR), 12, '0') AS padded_id
FROM b_cust"""))
def fn_string(spark, sf):
    b = _feed(spark, sf, "crm_cust_info")
    return b.select("cst_key", F.trim("cst_firstname").alias("trimmed"), F.upper("cst_lastname").alias("upper_last"),
                    F.substring("cst_key", 1, 2).alias("key_prefix"), F.substring("cst_key", 3, 20).alias("key_rest"),
                    F.length("cst_key").cast("bigint").alias("key_length"),
                    F.replace(F.col("cst_key"), F.lit("AW"), F.lit("")).alias("key_digits"),
                    C.full_name("cst_firstname", "cst_lastname").alias("full_name"),
                    F.lpad(F.col("cst_id").cast("string"), 12, "0").alias("padded_id"))


@register("fn_date", Q.chain("""
SELECT sls_ord_num, sls_order_dt, CAST(EXTRACT(YEAR FROM sls_order_dt) AS BIGINT) AS order_year,
 strftime(sls_order_dt, '%Y-%m') AS year_month, dayname(sls_order_dt) AS day_name,
 dayofweek(sls_order_dt) + 1 AS day_number, sls_order_dt - 1 AS day_before,
 CAST(sls_ship_dt AS TIMESTAMP) - INTERVAL 1 SECOND AS ship_minus_second,
 CAST(try_strptime(CAST(sls_due_dt AS VARCHAR), '%Y-%m-%d') AS DATE) AS due_roundtrip
FROM s_sales"""))
def fn_date(spark, sf):
    s = _silver(spark, sf, "crm_sales_details")
    d = F.col("sls_order_dt")
    return s.select("sls_ord_num", "sls_order_dt", K.year_of(d).alias("order_year"),
                    K.year_month(d).alias("year_month"), K.weekday_name(d).alias("day_name"),
                    K.weekday_number(d).alias("day_number"), F.date_sub(d, 1).alias("day_before"),
                    (F.col("sls_ship_dt").cast("timestamp_ntz") - F.expr("INTERVAL 1 SECOND")).alias("ship_minus_second"),
                    F.try_to_date(F.col("sls_due_dt").cast("string"), "yyyy-MM-dd").alias("due_roundtrip"))


@register("fn_math", Q.chain(f"""
SELECT sls_ord_num, sls_prd_key, CAST(abs(sls_price) AS DOUBLE) AS abs_price,
 {Q.rnd('CAST(sls_sales AS DOUBLE)/NULLIF(sls_quantity, 0)', 2, 22)} AS unit_price,
 NULLIF(sls_quantity, 0) AS qty_or_null,
 CAST(sls_sales - sls_quantity*sls_price AS DOUBLE) AS difference,
 CAST(sls_sales + 1 AS DOUBLE) AS plus_one, CAST(sls_quantity * 2 AS BIGINT) AS double_qty
FROM b_sales"""))
def fn_math(spark, sf):
    b = _feed(spark, sf, "crm_sales_details")
    return b.select("sls_ord_num", "sls_prd_key", F.abs("sls_price").cast("double").alias("abs_price"),
                    M.ratio(F.col("sls_sales"), F.col("sls_quantity")).alias("unit_price"),
                    F.nullif(F.col("sls_quantity"), F.lit(0)).alias("qty_or_null"),
                    (F.col("sls_sales") - F.col("sls_quantity") * F.col("sls_price")).cast("double").alias("difference"),
                    (F.col("sls_sales") + 1).cast("double").alias("plus_one"),
                    (F.col("sls_quantity") * 2).alias("double_qty"))


@register("fn_conditional", Q.chain(f"""
SELECT {Q.decode_line()} AS product_line,
 CAST(sum(CASE WHEN prd_cost IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing_cost,
 CAST(sum(CASE WHEN prd_end_dt IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS open_versions,
 CAST(sum(CASE WHEN prd_cost IS NULL THEN 0 WHEN prd_cost > 100 THEN CASE WHEN prd_cost > 300 THEN 2 ELSE 1 END ELSE 0 END) AS BIGINT) AS cost_band_score,
 CAST(sum(coalesce(prd_cost, 0)) AS DOUBLE) AS total_cost, count(*) AS versions
FROM b_prod GROUP BY {Q.decode_line()}"""))
def fn_conditional(spark, sf):
    b = _feed(spark, sf, "crm_prod_info")
    cost = F.col("prd_cost")
    band = F.when(cost.isNull(), 0).when(cost > 100, F.when(cost > 300, 2).otherwise(1)).otherwise(0)
    return (b.groupBy(C.decode("prd_line", C.PRODUCT_LINE_CODES).alias("product_line"))
             .agg(M.count_if(cost.isNull()).alias("missing_cost"),
                  M.count_if(F.col("prd_end_dt").isNull()).alias("open_versions"),
                  F.sum(band).cast("bigint").alias("cost_band_score"),
                  F.sum(C.null_to(cost, 0)).cast("double").alias("total_cost"),
                  F.count(F.lit(1)).alias("versions")))


# ---------------------------------------------------------------- aggregates

@register("agg_basic", Q.chain(f"""
SELECT count(*) AS row_count, count(order_date) AS dated_rows, CAST(sum(quantity) AS BIGINT) AS total_quantity,
 {Q.dbl('sum(sales_amount)')} AS total_sales, {Q.mean('sales_amount')} AS avg_sales,
 min(order_date) AS first_order, max(order_date) AS last_order FROM fact_sales"""))
def agg_basic(spark, sf):
    f = star(spark, sf)["fact_sales"]
    return f.agg(F.count(F.lit(1)).alias("row_count"), F.count("order_date").alias("dated_rows"),
                 F.sum("quantity").alias("total_quantity"), M.total("sales_amount").alias("total_sales"),
                 M.mean("sales_amount").alias("avg_sales"), F.min("order_date").alias("first_order"),
                 F.max("order_date").alias("last_order"))


@register("agg_distinct", Q.chain("""
SELECT CAST(EXTRACT(YEAR FROM order_date) AS BIGINT) AS order_year, count(DISTINCT customer_key) AS customers,
 count(DISTINCT product_key) AS products, count(DISTINCT order_number) AS orders
FROM fact_sales GROUP BY EXTRACT(YEAR FROM order_date)"""))
def agg_distinct(spark, sf):
    """Over the materialised fact, like every report on a published layer."""
    path = shared_dir(spark, f"strata-distinct-{uuid.uuid4().hex[:10]}") + "/fact_sales"
    star(spark, sf)["fact_sales"].select("order_date", "customer_key", "product_key", "order_number").write.parquet(path)
    return distinct_counts(spark.read.parquet(path), {"order_year": K.year_of("order_date")},
                           {"customers": "customer_key", "products": "product_key", "orders": "order_number"})
