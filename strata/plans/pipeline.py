"""The layer pipeline: bronze load, silver load, gold build.

``run`` is the job a scheduler calls.  The fact is written in date-range directories, and the
silver and gold views follow the committed batches.  Each layer is read from the previous
layer's committed batch and published all-or-nothing; the gold dimensions are
numbered once and the fact looks up exactly the numbered dimensions that are
published with it, so fact and dimensions of one batch agree on the keys.
"""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import quality
from ..schemas import BRONZE, FEED_FILES, FEEDS, GOLD, SILVER
from ..session import bound_partitions
from ..sources import delimited, feeds
from . import gold, silver
from .commitlog import Written, commit, commits, current_batch, last_version, utc_now
from .publish import new_batch_id, publish_layer, read_layer, table_path
from .ranged import LABEL, RangedTable, Ranges
from .views import create_views

GOLD_TABLES = ("dim_customer", "dim_products", "fact_sales")


# the category file arrives upper-case although declared lower-case
DELIVERED_AS = {"erp_px_cat_g1v2": "PX_CAT_G1V2.csv"}


def land_feeds(spark: SparkSession, sf_dir: str, landing_root: str, names=FEEDS) -> None:
    """Deliver the derived feeds (default: all six) as delimited files (stand-in for the source systems)."""
    bound_partitions(spark)
    for name in names:
        folder, file_name = FEED_FILES[name]
        delimited.write_feed(feeds.BUILDERS[name](spark, sf_dir),
                             f"{landing_root.rstrip('/')}/{folder}/{DELIVERED_AS.get(name, file_name)}")


def load_bronze(spark: SparkSession, landing_root: str, root: str, batch_id: str | None = None,
                header: bool = True) -> tuple[DataFrame, dict[str, int]]:
    """Scan the six feeds and write each one once, split by status:
    ``<root>/bronze/<feed>/batch=<batch>/_status=good`` holds the typed rows,
    ``…/_status=rejected`` the quarantine (raw text, reason, source file).

    One parse and one write per file, no cache: the raw text columns are NULL
    for good rows, which costs nothing in parquet, and readers prune to the
    partition and columns they need.  The six writes run as concurrent jobs;
    the batch is committed only after all of them succeeded.
    """
    batch = batch_id or new_batch_id()
    stamp = utc_now()

    def write_one(name):
        started, began = utc_now(), time.monotonic()
        checked = delimited.with_rejects(
            delimited.read_text_fields(spark, delimited.feed_path(landing_root, name), BRONZE[name], header),
            BRONZE[name])
        good = F.col(delimited.REASON).isNull()
        out = (checked.withColumn(delimited.STATUS, F.when(good, F.lit("good")).otherwise(F.lit("rejected")))
               .withColumn("dwh_create_date", F.lit(stamp).cast("timestamp_ntz")))
        obs = Observation()
        (out.observe(obs, F.sum(F.when(good, 1).otherwise(0)).alias("good"),
                     F.sum(F.when(good, 0).otherwise(1)).alias("rejected"))
            .write.mode("overwrite").partitionBy(delimited.STATUS)
            .parquet(table_path(root, "bronze", name, batch)))
        m = obs.get
        seconds = round(time.monotonic() - began, 3)
        return Written(batch, name, int(m["good"] or 0), started, stamp, seconds), int(m["rejected"] or 0)

    with ThreadPoolExecutor(max_workers=len(FEEDS)) as pool:
        results = dict(zip(FEEDS, pool.map(write_one, FEEDS)))
    audit = commit(spark, root, "bronze", [r[0] for r in results.values()])
    return audit, {n: r[1] for n, r in results.items()}


def _bronze_part(spark: SparkSession, root: str, name: str, status: str, batch: str | None) -> DataFrame:
    b = batch or current_batch(spark, root, "bronze")
    layout = T.StructType([*delimited.checked_schema(BRONZE[name]).fields,
                           T.StructField("dwh_create_date", T.TimestampNTZType(), True),
                           T.StructField(delimited.STATUS, T.StringType(), True)])
    table = spark.read.schema(layout).parquet(table_path(root, "bronze", name, b))
    return table.filter(F.col(delimited.STATUS) == status)


def read_bronze(spark: SparkSession, root: str, names=FEEDS, batch: str | None = None) -> dict[str, DataFrame]:
    """The typed good rows of the current bronze batch."""
    return {n: _bronze_part(spark, root, n, "good", batch).select(*BRONZE[n].names, "dwh_create_date")
            for n in names}


def read_quarantine(spark: SparkSession, root: str, names=FEEDS, batch: str | None = None) -> dict[str, DataFrame]:
    """The rejected rows of the current bronze batch, as delivered, with reason and file."""
    return {n: delimited.rejected_rows(_bronze_part(spark, root, n, "rejected", batch), BRONZE[n])
            for n in names}


def load_silver(spark: SparkSession, root: str, as_of=None, batch_id: str | None = None) -> DataFrame:
    """Six silver tables from the current bronze batch.  Each table is a
    callable, so the product table's numbering (its own jobs) runs in the
    publisher's pool alongside the other tables' writes."""
    b = {n: df.drop("dwh_create_date") for n, df in read_bronze(spark, root).items()}
    builders = {
        "crm_cust_info": lambda: silver.crm_cust_info(b["crm_cust_info"]),
        "crm_prod_info": lambda: silver.crm_prod_info(b["crm_prod_info"]),
        "crm_sales_details": lambda: silver.crm_sales_details(b["crm_sales_details"]),
        "erp_cust_a1z12": lambda: silver.erp_cust_a1z12(b["erp_cust_a1z12"], as_of),
        "erp_loc_a101": lambda: silver.erp_loc_a101(b["erp_loc_a101"]),
        "erp_px_cat_g1v2": lambda: silver.erp_px_cat_g1v2(b["erp_px_cat_g1v2"]),
    }
    return publish_layer(spark, root, "silver", builders, batch_id, schemas=SILVER)


def build_gold(spark: SparkSession, root: str, batch_id: str | None = None, ranges: Ranges = Ranges()) -> DataFrame:
    """Both dimensions are numbered concurrently (each numbering writes its
    sorted rows once), then the three tables are written concurrently, the fact
    in date ranges; the fact looks up the same numbered dimensions it is published
    with.  If another gold batch is committed meanwhile, this one is refused."""
    after = last_version(spark, root, "gold")
    s = read_layer(spark, root, "silver", FEEDS)
    s = {n: df.drop("dwh_create_date") for n, df in s.items()}
    with ThreadPoolExecutor(max_workers=2) as pool:
        dc = pool.submit(gold.dim_customer, s)
        dp = pool.submit(gold.dim_products, s)
        dims = {"dim_customer": dc.result(), "dim_products": dp.result()}
    fact = gold.fact_sales(s, dims["dim_products"], dims["dim_customer"])
    return publish_layer(spark, root, "gold", {**dims, "fact_sales": fact}, batch_id, schemas=GOLD,
                         ranged={"fact_sales": ranges}, after=after)


def read_fact(spark: SparkSession, root: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Fact rows of the committed batch with an order date in [start, end); only the date
    ranges that can hold such dates are read.  Without bounds every row, the undated included."""
    table = RangedTable(spark, table_path(root, "gold", "fact_sales", current_batch(spark, root, "gold")))
    rows = table.rows if start is None and end is None else table.between(start, end)
    return rows.drop(LABEL)


def register_views(spark: SparkSession, root: str, silver_database: str = "silver", gold_database: str = "gold") -> list[str]:
    """The persistent views of both layers; they follow every later commit by themselves."""
    return (create_views(spark, root, "silver", SILVER, silver_database)
            + create_views(spark, root, "gold", GOLD, gold_database, extra=[LABEL]))


def run(spark: SparkSession, landing_root: str, root: str, as_of=None, views: bool = True,
        silver_database: str = "silver", gold_database: str = "gold") -> dict[str, float]:
    """bronze → silver → gold and the views over them; returns seconds per layer."""
    timings = {}
    t = time.time()
    load_bronze(spark, landing_root, root)
    timings["bronze"] = time.time() - t
    t = time.time()
    load_silver(spark, root, as_of)
    timings["silver"] = time.time() - t
    t = time.time()
    build_gold(spark, root)
    timings["gold"] = time.time() - t
    if views:
        register_views(spark, root, silver_database, gold_database)
    return timings


# Business keys of the silver tables, for the layer monitor.
SILVER_KEYS = {"crm_cust_info": ["cst_id"], "crm_prod_info": ["prd_id"],
               "crm_sales_details": ["sls_ord_num", "sls_prd_key"], "erp_cust_a1z12": ["cid"],
               "erp_loc_a101": ["cid"], "erp_px_cat_g1v2": ["id"]}


# Acceptable range of each monitoring metric.
MAX_LOAD_SECONDS = 300.0
ACCEPTABLE = {"row_count": "> 0", "duplicate_keys": "= 0", "null_keys": "= 0", "load_seconds": "< 300", "load_age_days": "= 0"}


def layer_monitor(spark: SparkSession, root: str, layer: str = "silver", keys=None, today: str | None = None,
                  max_seconds: float = MAX_LOAD_SECONDS) -> DataFrame:
    """Monitoring verdicts of the committed batch of a layer, a row per table and metric:
    table_name, metric, value, acceptable, status.

    Row count, duplicate and NULL business keys are measured on the rows; the duration and the day of
    the load come from the commit record (``today``: default the current UTC date).  ``status`` is OK or
    ALERT.
    """
    keys = keys or SILVER_KEYS
    version = last_version(spark, root, layer)
    loads = commits(spark, root, layer, version)
    tables = read_bronze(spark, root, list(keys)) if layer == "bronze" else read_layer(spark, root, layer, list(keys))
    base = quality.monitor({n: (df, keys[n]) for n, df in tables.items()})
    day = F.lit(today).cast("date") if today is not None else F.to_date(F.lit(str(utc_now().date())))
    # both sides hold one row per table
    wide = base.join(loads.select("table_name", "seconds", F.datediff(day, F.to_date("loaded_at")).alias("age")), "table_name")
    value = {"row_count": F.col("row_count"), "duplicate_keys": F.col("duplicate_keys"), "null_keys": F.col("null_keys"),
             "load_seconds": F.col("seconds"), "load_age_days": F.col("age")}
    good = {"row_count": F.col("row_count") > 0, "duplicate_keys": F.col("duplicate_keys") == 0, "null_keys": F.col("null_keys") == 0,
            "load_seconds": F.col("seconds") < max_seconds, "load_age_days": F.col("age") == 0}
    accepted = {**ACCEPTABLE, "load_seconds": f"< {max_seconds:g}"}
    metrics = F.array(*[F.struct(F.lit(m).alias("metric"), value[m].cast("double").alias("value"), F.lit(accepted[m]).alias("acceptable"),
                                 F.when(good[m], F.lit("OK")).otherwise(F.lit("ALERT")).alias("status")) for m in ACCEPTABLE])
    return wide.select("table_name", F.inline(metrics))
