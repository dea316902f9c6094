"""Gold layer: the star schema.

``dim_customer`` and ``dim_products`` get dense surrogate keys from the
distributed numbering (no single-partition window); ``fact_sales`` looks the
keys up with two left joins on natural keys.  A numbered dimension is read
back from the table its numbering wrote; the lookup is broadcast only after a
bounded count proves it fits the broadcast threshold (so the fact is never
shuffled just to find that out), and a larger dimension is sort-merge joined
with AQE splitting skewed fact keys.  The
ERP enrichment joins of the customer dimension spread hot ERP keys over salt
buckets, because AQE cannot split the non-preserved side of an outer join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import cleanse as C
from ..operators.joins import HOT_KEY_ROWS, broadcast_if_small, left_join_spread
from ..operators.ordering import surrogate_key
from ..schemas import DIM_CUSTOMER_COLUMNS, DIM_PRODUCTS_COLUMNS, FACT_SALES_COLUMNS


def customer_rows(silver: dict[str, DataFrame], hot_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """CRM customers enriched from the two ERP tables, both on the CRM key.  The
    ERP sides are the non-preserved sides, where AQE cannot split a hot key, so
    both joins spread hot ERP keys (see ``left_join_spread``)."""
    ci = silver["crm_cust_info"]
    ca = silver["erp_cust_a1z12"].select(F.col("cid").alias("_ca_cid"), F.col("bdate").alias("_ca_bdate"),
                                         F.col("gen").alias("_ca_gen"))
    la = silver["erp_loc_a101"].select(F.col("cid").alias("_la_cid"), F.col("cntry").alias("_la_cntry"))
    joined = left_join_spread(left_join_spread(ci, ca, "cst_key", "_ca_cid", hot_rows),
                              la, "cst_key", "_la_cid", hot_rows)
    return joined.select(
        F.col("cst_id").alias("customer_id"),
        F.col("cst_key").alias("customer_number"),
        F.col("cst_firstname").alias("first_name"),
        F.col("cst_lastname").alias("last_name"),
        F.col("_la_cntry").alias("country"),
        F.col("cst_material_status").alias("marital_status"),
        C.coalesce_sources(F.col("cst_gndr"), F.col("_ca_gen")).alias("gender"),
        F.col("_ca_bdate").alias("birthdate"),
        F.col("cst_create_date").alias("create_date"),
    )


def dim_customer(silver: dict[str, DataFrame]) -> DataFrame:
    rows = customer_rows(silver)
    keyed = surrogate_key(rows, [F.col("customer_id").asc_nulls_last()], "customer_key")
    return keyed.select(*DIM_CUSTOMER_COLUMNS)


def product_rows(silver: dict[str, DataFrame], current: bool = True) -> DataFrame:
    """Current (open-ended) product versions with their category attributes."""
    pn = silver["crm_prod_info"]
    pn = pn.filter(F.col("prd_end_dt").isNull() if current else F.col("prd_end_dt").isNotNull())
    pc = silver["erp_px_cat_g1v2"]
    return left_join_spread(pn, pc, "cat_id", "id").select(
        F.col("prd_id").alias("product_id"),
        F.col("prd_key").alias("product_number"),
        F.col("prd_nm").alias("product_name"),
        F.col("cat_id").alias("category_id"),
        F.col("cat").alias("category"),
        F.col("subcat").alias("subcategory"),
        F.col("maintenance"),
        F.col("prd_cost").alias("cost"),
        F.col("prd_line").alias("product_line"),
        F.col("prd_start_dt").alias("start_date"),
    )


def dim_products(silver: dict[str, DataFrame]) -> DataFrame:
    rows = product_rows(silver, current=True)
    keyed = surrogate_key(rows, [F.col("start_date").asc_nulls_last(),
                                 F.col("product_number").asc_nulls_last()], "product_key")
    return keyed.select(*DIM_PRODUCTS_COLUMNS)


def fact_sales(silver: dict[str, DataFrame], dim_prod: DataFrame, dim_cust: DataFrame) -> DataFrame:
    sd = silver["crm_sales_details"].alias("sd")
    # the lookups are two-column projections of counted dimensions: broadcast
    # when their exact size fits, else sort-merge (the fact is never shuffled
    # just to find out that a dimension was small)
    pr = broadcast_if_small(dim_prod.select("product_key", "product_number"), rows_of=dim_prod).alias("pr")
    cu = broadcast_if_small(dim_cust.select("customer_key", "customer_id"), rows_of=dim_cust).alias("cu")
    joined = (sd.join(pr, F.col("sd.sls_prd_key") == F.col("pr.product_number"), "left")
                .join(cu, F.col("sd.sls_cust_id") == F.col("cu.customer_id"), "left"))
    return joined.select(
        F.col("sd.sls_ord_num").alias("order_number"),
        F.col("pr.product_key"),
        F.col("cu.customer_key"),
        F.col("sd.sls_order_dt").alias("order_date"),
        F.col("sd.sls_ship_dt").alias("shipping_date"),
        F.col("sd.sls_due_dt").alias("due_date"),
        F.col("sd.sls_sales").alias("sales_amount"),
        F.col("sd.sls_quantity").alias("quantity"),
        F.col("sd.sls_price").alias("price"),
    ).select(*FACT_SALES_COLUMNS)


def build_gold(silver: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The three gold tables; the dimensions are numbered once and reused by the
    fact, so fact and dimensions always agree on the keys."""
    dc = dim_customer(silver)
    dp = dim_products(silver)
    return {"dim_customer": dc, "dim_products": dp, "fact_sales": fact_sales(silver, dp, dc)}
