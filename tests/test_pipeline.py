"""Bronze load: one write per feed, good rows and quarantine split by status."""

import os
import tempfile

from strata.plans import pipeline as P
from strata.schemas import FEED_FILES, FEEDS

HEADERS = {
    "crm_cust_info": "cst_id,cst_key,cst_firstname,cst_lastname,cst_material_status,cst_gndr,cst_create_date",
    "crm_prod_info": "prd_id,prd_key,prd_nm,prd_cost,prd_line,prd_start_dt,prd_end_dt",
    "crm_sales_details": "sls_ord_num,sls_prd_key,sls_cust_id,sls_order_dt,sls_ship_dt,sls_due_dt,sls_sales,"
                         "sls_quantity,sls_price",
    "erp_cust_a1z12": "cid,bdate,gen",
    "erp_loc_a101": "cid,cntry",
    "erp_px_cat_g1v2": "id,cat,subcat,maintenance",
}
ROWS = {
    "crm_cust_info": ["1,AW1,Ann,Lee,S,F,2020-01-01", "x2,AW2,Bo,Ma,M,M,2020-01-02"],
    "crm_prod_info": ["10,AB-CD-P1,Alpha,5,R,2020-01-01,"],
    "crm_sales_details": ["SO1,P1,1,20200101,20200102,20200103,10,2,5", "SO2,P1,1,20200101,20200102,20200103,10,2,5,9"],
    "erp_cust_a1z12": ["AW1,1980-01-01,F"],
    "erp_loc_a101": ["AW-1,DE"],
    "erp_px_cat_g1v2": ["AB_CD,Bikes,Road,Yes"],
}


def test_bronze_split_by_status(spark):
    base = tempfile.mkdtemp(prefix="strata-pipe-")
    for feed in FEEDS:
        folder, name = FEED_FILES[feed]
        os.makedirs(os.path.join(base, "landing", folder), exist_ok=True)
        with open(os.path.join(base, "landing", folder, name.upper()), "w") as fh:
            fh.write(HEADERS[feed] + "\n" + "\n".join(ROWS[feed]) + "\n")
    audit, rejected = P.load_bronze(spark, base + "/landing", base + "/wh")
    written = {r.table_name: r.rows_written for r in audit.collect()}
    assert written["crm_cust_info"] == 1 and written["crm_sales_details"] == 1 and written["erp_loc_a101"] == 1
    assert rejected["crm_cust_info"] == 1 and rejected["crm_sales_details"] == 1 and rejected["erp_loc_a101"] == 0
    good = P.read_bronze(spark, base + "/wh")
    assert [r.cst_id for r in good["crm_cust_info"].collect()] == [1]
    bad = P.read_quarantine(spark, base + "/wh")
    row = bad["crm_cust_info"].first()
    assert row.cst_id == "x2" and row.reject_reason == "bad_cst_id" and row.source_file
    assert bad["crm_sales_details"].first().reject_reason == "too_many_fields"
    assert bad["erp_loc_a101"].count() == 0
