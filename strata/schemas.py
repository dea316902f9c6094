"""Declared schemas of the three layers.  Nothing is ever inferred."""

from __future__ import annotations

from pyspark.sql import types as T

AMOUNT = T.DecimalType(18, 2)
PRICE = T.DecimalType(18, 6)  # a repaired price is a quotient

FEEDS = ("crm_cust_info", "crm_prod_info", "crm_sales_details",
         "erp_cust_a1z12", "erp_loc_a101", "erp_px_cat_g1v2")


def _s(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Bronze: the source systems' record layouts, one per feed.
BRONZE = {
    "crm_cust_info": _s(("cst_id", T.LongType()), ("cst_key", T.StringType()),
                        ("cst_firstname", T.StringType()), ("cst_lastname", T.StringType()),
                        ("cst_material_status", T.StringType()), ("cst_gndr", T.StringType()),
                        ("cst_create_date", T.DateType())),
    "crm_prod_info": _s(("prd_id", T.LongType()), ("prd_key", T.StringType()),
                        ("prd_nm", T.StringType()), ("prd_cost", AMOUNT),
                        ("prd_line", T.StringType()), ("prd_start_dt", T.TimestampNTZType()),
                        ("prd_end_dt", T.TimestampNTZType())),
    "crm_sales_details": _s(("sls_ord_num", T.StringType()), ("sls_prd_key", T.StringType()),
                            ("sls_cust_id", T.LongType()), ("sls_order_dt", T.LongType()),
                            ("sls_ship_dt", T.LongType()), ("sls_due_dt", T.LongType()),
                            ("sls_sales", AMOUNT), ("sls_quantity", T.LongType()),
                            ("sls_price", AMOUNT)),
    "erp_cust_a1z12": _s(("cid", T.StringType()), ("bdate", T.DateType()), ("gen", T.StringType())),
    "erp_loc_a101": _s(("cid", T.StringType()), ("cntry", T.StringType())),
    "erp_px_cat_g1v2": _s(("id", T.StringType()), ("cat", T.StringType()),
                          ("subcat", T.StringType()), ("maintenance", T.StringType())),
}

# File name of each feed in its source-system folder (matched case-insensitively).
FEED_FILES = {
    "crm_cust_info": ("source_crm", "cust_info.csv"),
    "crm_prod_info": ("source_crm", "prd_info.csv"),
    "crm_sales_details": ("source_crm", "sales_details.csv"),
    "erp_cust_a1z12": ("source_erp", "cust_a1z12.csv"),
    "erp_loc_a101": ("source_erp", "loc_a101.csv"),
    "erp_px_cat_g1v2": ("source_erp", "px_cat_g1v2.csv"),
}

# Per-field text patterns used when a feed arrives as delimited text.
DATE_PATTERNS = {
    "cst_create_date": ("yyyy-MM-dd",),
    "bdate": ("yyyy-MM-dd",),
    # product dates are declared with a time part but shipped date-only
    "prd_start_dt": ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd"),
    "prd_end_dt": ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd"),
}

# Silver and gold: the declared tables (the audit column is added by the publisher).
SILVER = {
    "crm_cust_info": BRONZE["crm_cust_info"],
    "crm_prod_info": _s(("prd_id", T.LongType()), ("prd_key", T.StringType()), ("cat_id", T.StringType()),
                        ("prd_nm", T.StringType()), ("prd_cost", AMOUNT), ("prd_line", T.StringType()),
                        ("prd_start_dt", T.DateType()), ("prd_end_dt", T.DateType())),
    "crm_sales_details": _s(("sls_ord_num", T.StringType()), ("sls_prd_key", T.StringType()),
                            ("sls_cust_id", T.LongType()), ("sls_order_dt", T.DateType()),
                            ("sls_ship_dt", T.DateType()), ("sls_due_dt", T.DateType()),
                            ("sls_sales", AMOUNT), ("sls_quantity", T.LongType()), ("sls_price", PRICE)),
    "erp_cust_a1z12": BRONZE["erp_cust_a1z12"],
    "erp_loc_a101": BRONZE["erp_loc_a101"],
    "erp_px_cat_g1v2": BRONZE["erp_px_cat_g1v2"],
}
GOLD = {
    "dim_customer": _s(("customer_key", T.LongType()), ("customer_id", T.LongType()), ("customer_number", T.StringType()),
                       ("first_name", T.StringType()), ("last_name", T.StringType()), ("country", T.StringType()),
                       ("marital_status", T.StringType()), ("gender", T.StringType()), ("birthdate", T.DateType()),
                       ("create_date", T.DateType())),
    "dim_products": _s(("product_key", T.LongType()), ("product_id", T.LongType()), ("product_number", T.StringType()),
                       ("product_name", T.StringType()), ("category_id", T.StringType()), ("category", T.StringType()),
                       ("subcategory", T.StringType()), ("maintenance", T.StringType()), ("cost", AMOUNT),
                       ("product_line", T.StringType()), ("start_date", T.DateType())),
    "fact_sales": _s(("order_number", T.StringType()), ("product_key", T.LongType()), ("customer_key", T.LongType()),
                     ("order_date", T.DateType()), ("shipping_date", T.DateType()), ("due_date", T.DateType()),
                     ("sales_amount", AMOUNT), ("quantity", T.LongType()), ("price", PRICE)),
}


def declared(layer: str) -> dict[str, T.StructType]:
    """Declared tables of a layer that is published with a schema."""
    return {"silver": SILVER, "gold": GOLD}[layer]


SILVER_COLUMNS = {name: schema.names for name, schema in SILVER.items()}
DIM_CUSTOMER_COLUMNS = GOLD["dim_customer"].names
DIM_PRODUCTS_COLUMNS = GOLD["dim_products"].names
FACT_SALES_COLUMNS = GOLD["fact_sales"].names
