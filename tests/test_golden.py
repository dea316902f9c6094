"""Product feed in the delivered shape: CRLF, padded codes, blank cost, up to
three versions per key, raw end dates that precede the start (rule CL-16)."""

import datetime as dt
import os
import tempfile
from decimal import Decimal

from strata.plans import silver
from strata.schemas import BRONZE
from strata.sources import delimited

ROWS = [
    "prd_id,prd_key,prd_nm,prd_cost,prd_line,prd_start_dt,prd_end_dt",
    "11,AB-CD-WX-1000-S,Widget Alpha S,,S ,2011-07-01,2007-12-28",
    "12,AB-CD-WX-1000-S,Widget Alpha S,12,S ,2012-07-01,2008-12-27",
    "13,AB-CD-WX-1000-S,Widget Alpha S,13,S ,2013-07-01,",
    "21,EF-GH-YZ-2000-M,Widget Beta M,40,M ,2013-07-01,",
    "31,EF-GH-YZ-3000,Widget Gamma,7,,2003-07-01 00:00:00,2011-06-30",
    "32,EF-GH-YZ-3000,Widget Gamma,8,t,2011-07-01,",
    "41,IJ-KL-WX-1000-S,Widget Alpha S (other category),9,S,2012-07-01,",
]


def test_product_versions_from_delivered_file(spark):
    folder = tempfile.mkdtemp(prefix="strata-golden-")
    with open(os.path.join(folder, "prd_info.csv"), "w", newline="") as fh:
        fh.write("\r\n".join(ROWS) + "\r\n")
    good, rejects = delimited.ingest(spark, folder, BRONZE["crm_prod_info"])
    assert rejects.count() == 0 and good.count() == 7
    out = {r.prd_id: r for r in silver.crm_prod_info(good).collect()}
    assert out[11].cat_id == "AB_CD" and out[11].prd_key == "WX-1000-S"
    assert out[11].prd_cost == Decimal("0.00") and out[11].prd_line == "Other Sales"
    assert out[11].prd_end_dt == dt.date(2012, 6, 30)
    assert out[12].prd_end_dt == dt.date(2013, 6, 30)
    assert out[13].prd_end_dt is None and out[21].prd_end_dt is None
    assert out[21].prd_line == "Mountain"
    assert out[31].prd_line == "n/a" and out[31].prd_start_dt == dt.date(2003, 7, 1)
    assert out[31].prd_end_dt == dt.date(2011, 6, 30) and out[32].prd_line == "Touring"
    current = [r.prd_id for r in out.values() if r.prd_end_dt is None]
    # same suffix under another category: its own interval chain (raw key), still current
    assert out[41].prd_key == "WX-1000-S" and out[41].cat_id == "IJ_KL" and out[41].prd_end_dt is None
    assert sorted(current) == [13, 21, 32, 41]
