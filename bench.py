"""Benchmark: the layer pipeline and the gold reports at one scale factor.

Prints one JSON line.  ``value`` is the bronze + silver + gold pipeline time
(the published reference figure is 40 s for 116,497 source rows); ``queries``
holds per-layer and per-report seconds (reports run over the published gold
tables, as the reference's reports run over its gold views).  Each report is
executed in full, final sort included, into Spark's ``noop`` sink, so the
figure is engine time rather than the transfer of result rows to Python.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from strata.plans import analytics as A  # noqa: E402
from strata.plans import pipeline as P  # noqa: E402
from strata.plans.layers import AS_OF  # noqa: E402
from strata.plans.publish import read_layer  # noqa: E402
from strata.session import build_session, shared_dir  # noqa: E402

REPORTS = {
    "a1_sales_by_customer": A.sales_by_customer,
    "a2_sales_by_country": A.sales_by_country,
    "a3_demographics": lambda g: A.demographics(g, AS_OF),
    "a4_top_products": A.top_products,
    "a5_sales_by_category": A.sales_by_category,
    "a6_by_product_line": A.by_product_line,
    "a7_monthly": A.monthly_trend,
    "a8_yearly": A.yearly,
    "a9_weekday": A.weekday,
    "a10_customer_category": A.customer_category,
    "a11_geo_product": A.geo_product,
    "tmpl_filtered": lambda g: A.template_filtered(g, "United States", "1998-01-01"),
    "star_filter": lambda g: A.star_filter(g, "STANDARD"),
    "preagg_join": A.preaggregated_by_customer,
    "metric_aov": A.order_metrics,
    "kpi_headline": A.headline_shares,
    "kpi_totals": A.headline_totals,
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("strata-bench", cpus=cpus, shuffle_partitions=max(8, int(cpus) * 2),
                          extra={"spark.eventLog.enabled": "false"})
    timings: dict[str, float] = {}

    run_root = shared_dir(spark, f"strata-bench-{uuid.uuid4().hex[:12]}")
    landing, root = f"{run_root}/landing", f"{run_root}/warehouse"

    t = time.time()
    P.land_feeds(spark, sf_dir, landing)
    timings["landing_feeds"] = time.time() - t

    layer_times = P.run(spark, landing, root, as_of=AS_OF)
    for k, v in layer_times.items():
        timings[f"load_{k}"] = v

    gold = {n: df.drop("dwh_create_date") for n, df in read_layer(spark, root, "gold", P.GOLD_TABLES).items()}
    for name, report in REPORTS.items():
        t = time.time()
        report(gold).write.format("noop").mode("overwrite").save()
        timings[name] = time.time() - t

    pipeline = sum(layer_times.values())
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    print(json.dumps({
        "metric": "pipeline_bronze_silver_gold",
        "value": round(pipeline, 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in timings.items()},
        "reports_total_sec": round(sum(timings[k] for k in REPORTS), 3),
        "fact_rows": rows,
        "sf": os.path.basename(sf_dir).replace("sf", ""),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
