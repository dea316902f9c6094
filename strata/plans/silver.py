"""Silver layer: cleansed copies of the six bronze tables.

The six transforms are independent: each reads exactly one bronze table.
Customers shuffle once (dedup by id, pre-limited map-side), products are
range-sorted once for their validity intervals; the other four are narrow
maps without any exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import cleanse as C
from ..operators.dedup import dedup_latest
from ..operators.ordering import lead_within
from ..schemas import SILVER_COLUMNS

CUSTOMER_TIE_BREAK = ["cst_key", "cst_firstname", "cst_lastname", "cst_material_status", "cst_gndr"]
PRODUCT_TIE_BREAK = ["prd_id", "prd_nm", "prd_cost", "prd_line", "prd_end_dt"]


def latest_customers(bronze_cust: DataFrame) -> DataFrame:
    """Newest record per customer id; a NULL create date counts as newest."""
    return dedup_latest(bronze_cust, ["cst_id"], [F.col("cst_create_date").desc_nulls_first()],
                        tie_break=CUSTOMER_TIE_BREAK, drop_null_keys=True)


def crm_cust_info(bronze_cust: DataFrame) -> DataFrame:
    latest = latest_customers(bronze_cust)
    return latest.select(
        "cst_id", "cst_key",
        C.trim_text("cst_firstname").alias("cst_firstname"),
        C.trim_text("cst_lastname").alias("cst_lastname"),
        C.decode("cst_material_status", C.MARITAL_CODES).alias("cst_material_status"),
        C.decode("cst_gndr", C.GENDER_CODES).alias("cst_gndr"),
        "cst_create_date",
    )


def with_validity_end(bronze_prod: DataFrame, *, precision: str = "day") -> DataFrame:
    """Adds ``_valid_to`` = next version's start of the same *raw* key, minus one
    day (``precision='day'``) or one second (``'second'``, timestamp result).
    The raw end date of the feed is ignored."""
    if precision == "day":
        start = F.col("prd_start_dt").cast("date")
    else:
        start = F.col("prd_start_dt").cast("timestamp_ntz")
    nxt = lead_within(bronze_prod, ["prd_key"],
                      [F.col("prd_start_dt").asc_nulls_last(),
                       *[F.col(c).asc_nulls_last() for c in PRODUCT_TIE_BREAK]],
                      start, "_next_start")
    if precision == "day":
        end = F.date_sub(F.col("_next_start"), 1)
    else:
        end = F.col("_next_start") - F.expr("INTERVAL 1 SECOND")
    return nxt.withColumn("_valid_to", end).drop("_next_start")


def crm_prod_info(bronze_prod: DataFrame) -> DataFrame:
    # the interval is computed on the raw key before the key is overwritten
    versions = with_validity_end(bronze_prod)
    return versions.select(
        "prd_id",
        C.key_number("prd_key").alias("prd_key"),
        C.key_category("prd_key").alias("cat_id"),
        "prd_nm",
        C.null_to("prd_cost", 0).cast(bronze_prod.schema["prd_cost"].dataType).alias("prd_cost"),
        C.decode("prd_line", C.PRODUCT_LINE_CODES).alias("prd_line"),
        F.col("prd_start_dt").cast("date").alias("prd_start_dt"),
        F.col("_valid_to").alias("prd_end_dt"),
    )


def crm_sales_details(bronze_sales: DataFrame, *, strict_dates: bool = False) -> DataFrame:
    return bronze_sales.select(
        "sls_ord_num", "sls_prd_key", "sls_cust_id",
        C.int_to_date("sls_order_dt", strict_dates).alias("sls_order_dt"),
        C.int_to_date("sls_ship_dt", strict_dates).alias("sls_ship_dt"),
        C.int_to_date("sls_due_dt", strict_dates).alias("sls_due_dt"),
        C.repair_amount("sls_sales", "sls_quantity", "sls_price").alias("sls_sales"),
        "sls_quantity",
        C.repair_price("sls_sales", "sls_quantity", "sls_price").alias("sls_price"),
    )


def erp_cust_a1z12(bronze_erp_cust: DataFrame, as_of=None) -> DataFrame:
    return bronze_erp_cust.select(
        C.strip_prefix("cid").alias("cid"),
        C.future_to_null("bdate", as_of).alias("bdate"),
        C.decode("gen", C.GENDER_SPELLINGS).alias("gen"),
    )


def erp_loc_a101(bronze_loc: DataFrame, *, distinct: bool = False) -> DataFrame:
    out = bronze_loc.select(
        C.remove_chars("cid", "-").alias("cid"),
        C.decode("cntry", C.COUNTRY_CODES, normalize=False, passthrough=True,
                 blank_to=C.UNKNOWN).alias("cntry"),
    )
    return out.distinct() if distinct else out


def erp_px_cat_g1v2(bronze_cat: DataFrame) -> DataFrame:
    return bronze_cat.select(*SILVER_COLUMNS["erp_px_cat_g1v2"])


_BUILDERS = {
    "crm_cust_info": lambda feed, as_of: crm_cust_info(feed),
    "crm_prod_info": lambda feed, as_of: crm_prod_info(feed),
    "crm_sales_details": lambda feed, as_of: crm_sales_details(feed),
    "erp_cust_a1z12": lambda feed, as_of: erp_cust_a1z12(feed, as_of),
    "erp_loc_a101": lambda feed, as_of: erp_loc_a101(feed),
    "erp_px_cat_g1v2": lambda feed, as_of: erp_px_cat_g1v2(feed),
}


NAMES = tuple(_BUILDERS)


def build_one(name: str, bronze: dict[str, DataFrame], as_of=None) -> DataFrame:
    """One silver table from its one bronze table (lazy except the product interval's sort)."""
    return _BUILDERS[name](bronze[name], as_of)


def build_silver(bronze: dict[str, DataFrame], as_of=None) -> dict[str, DataFrame]:
    """All six silver tables."""
    return {name: build_one(name, bronze, as_of) for name in _BUILDERS}
