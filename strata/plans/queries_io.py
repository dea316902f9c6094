"""Registered queries for sources and sinks.

The feeds are landed once per session as delimited files in the shared
folder, then scanned with the tolerant reader; the sinks write to and read
back from the same shared folder.  Each call uses a fresh sub-folder.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from .. import sqlcheck as Q
from ..catalog import register
from ..schemas import BRONZE, FEEDS, GOLD, SILVER
from ..session import shared_dir
from ..sources import delimited
from ..sources.tables import read_table
from . import analytics as A
from . import pipeline as P
from .layers import AS_OF, silver_of, star
from .commitlog import commits
from .publish import publish_layer, read_layer, write_observed
from .ranged import LABEL, RangedTable, Ranges, write_ranged
from .views import create_views

_LANDING: dict[tuple[str, str], tuple[str, set[str]]] = {}
B_CTE = {"crm_cust_info": "b_cust", "crm_prod_info": "b_prod", "crm_sales_details": "b_sales",
         "erp_cust_a1z12": "b_ecust", "erp_loc_a101": "b_loc", "erp_px_cat_g1v2": "b_cat"}


def _scratch(spark, name):
    return shared_dir(spark, f"strata-{name}-{uuid.uuid4().hex[:10]}")


def landing(spark, sf, names=FEEDS) -> str:
    """The feeds named (default: all six) delivered as delimited files, each once per session and input."""
    root, landed = _LANDING.setdefault((spark.sparkContext.applicationId, sf), (_scratch(spark, "landing"), set()))
    for name in names:
        if name not in landed:
            P.land_feeds(spark, sf, root, [name])
            landed.add(name)
    return root


def _decimals_out(df):
    return df.select(*[F.col(f.name).cast("double").alias(f.name) if f.dataType.typeName() == "decimal"
                       else F.col(f.name) for f in df.schema.fields])


def _bronze_sql(feed):
    """The feed as delimited text returns it: decimals as doubles, and an empty
    text field reads as NULL (empty text and NULL are the same in the sources)."""
    cte = B_CTE[feed]

    def out(f):
        kind = f.dataType.typeName()
        if kind == "decimal":
            return f"CAST({f.name} AS DOUBLE) AS {f.name}"
        if kind == "string":
            return f"NULLIF({f.name}, '') AS {f.name}"
        return f.name
    cols = [out(f) for f in BRONZE[feed].fields]
    return Q.chain(f"SELECT {', '.join(cols)} FROM {cte}")


def _register_scan(feed):
    @register(f"scan_{feed}", _bronze_sql(feed))
    def scan(spark, sf):
        good, _ = delimited.ingest_feed(spark, landing(spark, sf, [feed]), feed)
        return _decimals_out(good)
    return scan


for _feed in FEEDS:
    _register_scan(_feed)


@register("scan_counts", Q.chain(" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {c}" for t, c in B_CTE.items())))
def scan_counts(spark, sf):
    root = landing(spark, sf)
    parts = [delimited.read_text_fields(spark, delimited.feed_path(root, f), BRONZE[f])
             .agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(f).alias("table_name"), "row_count")
             for f in FEEDS]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---------------------------------------------------------------- a feed with planted defects

# ERP birth-data records: every 13th has an unreadable date, every 17th an extra
# field, every 19th lacks its trailing gender field (short, but readable), every 23rd
# has a quote that is not closed, every 29th one inside a field (legal).
_PLANTED_SCHEMA = BRONZE["erp_cust_a1z12"]


def _planted_lines(spark, sf):
    k = F.col("c_custkey")
    cid = F.concat(F.lit("AW"), F.lpad(k.cast("string"), 8, "0"))
    born = F.date_format(F.date_add(F.lit("1920-01-01").cast("date"), ((k * 37) % 30000).cast("int")), "yyyy-MM-dd")
    bdate = F.when(k % 13 == 0, F.lit("not-a-date")).otherwise(born)
    gen = F.when(k % 3 == 0, F.lit("F")).when(k % 3 == 1, F.lit("M")).otherwise(F.lit("Female"))
    line = (F.when(k % 19 == 0, F.concat_ws(",", cid, bdate))
             .when(k % 34 == 0, F.concat_ws(",", cid, bdate, gen, F.lit("extra"), F.lit("more")))
             .when(k % 17 == 0, F.concat_ws(",", cid, bdate, gen, F.lit("extra")))
             .when(k % 23 == 0, F.concat(cid, F.lit(',"'), bdate, F.lit(","), gen))
             .when(k % 29 == 0, F.concat_ws(",", cid, bdate, F.lit('6" F')))
             .when(k % 31 == 0, F.concat_ws(",", cid, F.concat(F.lit('"'), bdate, F.lit('"')), F.lit('"say ""M"", please"')))
             .otherwise(F.concat_ws(",", cid, bdate, gen)))
    return read_table(spark, sf, "customer", "c_custkey").select(line.alias("value"))


def planted_feed(spark, sf) -> str:
    path = _scratch(spark, "planted") + "/cust_a1z12.csv"
    _planted_lines(spark, sf).write.mode("overwrite").text(path)
    return path


# the delivered pieces of each line, then what the scan makes of them
_PLANTED_RAW = """
SELECT cid, CASE WHEN quoted THEN day||','||sex ELSE day END AS bdate,
 CASE WHEN short OR quoted THEN NULL ELSE sex END AS gen,
 CASE WHEN long THEN 'extra' END AS _overflow,
 CASE WHEN short THEN cid||','||day WHEN quoted THEN cid||',"'||day||','||sex
      WHEN enclosed THEN cid||',"'||day||'","say ""M"", please"'
      ELSE cid||','||day||','||sex||CASE WHEN k%34=0 AND long THEN ',extra,more' WHEN long THEN ',extra' ELSE '' END END AS _record,
 concat_ws(';', CASE WHEN long THEN 'too_many_fields' END, CASE WHEN quoted THEN 'unclosed_quote' END,
               CASE WHEN k%13=0 OR quoted THEN 'bad_bdate' END) AS reject_reason
FROM (SELECT k, 'AW'||lpad(CAST(k AS VARCHAR),8,'0') AS cid, k%19=0 AS short, k%19<>0 AND k%17=0 AS long,
       k%19<>0 AND k%17<>0 AND k%23=0 AS quoted,
       k%19<>0 AND k%17<>0 AND k%23<>0 AND k%29<>0 AND k%31=0 AS enclosed,
       CASE WHEN k%13=0 THEN 'not-a-date' ELSE strftime(DATE '1920-01-01' + CAST((k*37)%30000 AS INT), '%Y-%m-%d') END AS day,
       CASE WHEN k%19<>0 AND k%17<>0 AND k%23<>0 AND k%29=0 THEN '6" F' WHEN k%19<>0 AND k%17<>0 AND k%23<>0 AND k%31=0 THEN 'say "M", please'
        WHEN k%3=0 THEN 'F' WHEN k%3=1 THEN 'M' ELSE 'Female' END AS sex
      FROM (SELECT c_custkey AS k FROM customer) keys) pieces"""


@register("scan_short_rows", f"SELECT cid, bdate, gen, _overflow FROM ({_PLANTED_RAW}) raw")
def scan_short_rows(spark, sf):
    raw = delimited.read_text_fields(spark, planted_feed(spark, sf), _PLANTED_SCHEMA, header=False)
    return raw.drop(delimited.SOURCE_FILE, delimited.RECORD)


@register("ingest_good", f"SELECT cid, CAST(bdate AS DATE) AS bdate, gen FROM ({_PLANTED_RAW}) raw"
                         " WHERE reject_reason = ''")
def ingest_good(spark, sf):
    good, _ = delimited.ingest(spark, planted_feed(spark, sf), _PLANTED_SCHEMA, header=False)
    return good


@register("ingest_rejects", f"SELECT cid, bdate, gen, _overflow, _record, reject_reason FROM ({_PLANTED_RAW}) raw"
                            " WHERE reject_reason <> ''")
def ingest_rejects(spark, sf):
    _, rejects = delimited.ingest(spark, planted_feed(spark, sf), _PLANTED_SCHEMA, header=False)
    return rejects.drop(delimited.SOURCE_FILE)


# ---------------------------------------------------------------- sinks

@register("refresh_roundtrip", Q.chain("SELECT * FROM s_cust"))
def refresh_roundtrip(spark, sf):
    """Full refresh twice (truncate + insert semantics): the second run replaces the first."""
    path = _scratch(spark, "refresh") + "/crm_cust_info"
    cust = silver_of(star(spark, sf))["crm_cust_info"]
    write_observed(cust, path, mode="overwrite")
    write_observed(cust, path, mode="overwrite")
    return spark.read.parquet(path)


@register("append_load", Q.chain("SELECT * FROM s_cat UNION ALL SELECT * FROM s_cat"))
def append_load(spark, sf):
    path = _scratch(spark, "append") + "/erp_px_cat_g1v2"
    cat = silver_of(star(spark, sf))["erp_px_cat_g1v2"]
    write_observed(cat, path, mode="overwrite")
    write_observed(cat, path, mode="append")
    return spark.read.parquet(path)


_FACT_OUT = ("order_number, product_key, customer_key, order_date, shipping_date, due_date,"
             " CAST(sales_amount AS DOUBLE) AS sales_amount, quantity, CAST(price AS DOUBLE) AS price")


@register("empty_clone", Q.chain(
    "SELECT count(*) AS source_rows, CAST(0 AS BIGINT) AS clone_rows, TRUE AS same_columns FROM fact_sales"))
def empty_clone(spark, sf):
    """A table with the fact's shape and no rows, beside the rows of the fact."""
    path = _scratch(spark, "clone") + "/fact_shape"
    fact = star(spark, sf)["fact_sales"]
    write_observed(fact.filter(F.lit(False)), path)
    clone = spark.read.parquet(path)
    same = [(f.name, f.dataType) for f in clone.schema.fields] == [(f.name, f.dataType) for f in fact.schema.fields]
    both = fact.select(F.lit(1).alias("s"), F.lit(0).alias("c")).unionByName(clone.select(F.lit(0).alias("s"), F.lit(1).alias("c")))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return both.agg(total("s").alias("source_rows"), total("c").alias("clone_rows")).withColumn("same_columns", F.lit(same))


@register("load_audit", Q.chain(" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS rows_written FROM {c}" for t, c in B_CTE.items())))
def load_audit(spark, sf):
    """Bronze publication from the landed files; the audit row counts are
    observed during the writes."""
    root = _scratch(spark, "warehouse")
    audit, _ = P.load_bronze(spark, landing(spark, sf), root)
    return audit.select("table_name", "rows_written")


@register("mv_fact_sales", Q.chain(f"SELECT {_FACT_OUT} FROM fact_sales"))
def mv_fact_sales(spark, sf):
    """The fact materialised once (complete refresh) and served from storage."""
    path = _scratch(spark, "mv") + "/fact_sales"
    write_observed(star(spark, sf)["fact_sales"], path)
    return _decimals_out(spark.read.parquet(path))


# ranges that the orders of the driver tables fall into, the undated in the last
_RANGES = Ranges(bounds=(("p_1996", "1997-01-01"), ("p_1998", "1999-01-01")), last="p_rest")


@register("fact_partitioned", Q.chain("""
SELECT CASE WHEN order_date < DATE '1997-01-01' THEN 'p_1996' WHEN order_date < DATE '1999-01-01' THEN 'p_1998'
 ELSE 'p_rest' END AS order_range, count(*) AS row_count, CAST(sum(sales_amount) AS DOUBLE) AS total_sales
FROM fact_sales GROUP BY 1"""))
def fact_partitioned(spark, sf):
    path = _scratch(spark, "partitioned") + "/fact_sales"
    write_ranged(star(spark, sf)["fact_sales"], path, _RANGES)
    return (spark.read.parquet(path).groupBy(LABEL)
            .agg(F.count(F.lit(1)).alias("row_count"), F.sum("sales_amount").cast("double").alias("total_sales")))


@register("fact_order_window", Q.chain("""
SELECT 'dated' AS part, strftime(order_date, '%Y-%m') AS order_month, count(*) AS row_count, CAST(sum(sales_amount) AS DOUBLE) AS total_sales
FROM fact_sales WHERE order_date >= DATE '1997-11-15' AND order_date < DATE '1998-02-15' GROUP BY 2
UNION ALL
SELECT 'undated', NULL, count(*), CAST(sum(sales_amount) AS DOUBLE) FROM fact_sales WHERE order_date IS NULL"""))
def fact_order_window(spark, sf):
    """Bounds on the order date, read through the ranges: two of three directories stay closed."""
    path = _scratch(spark, "partitioned") + "/fact_sales"
    write_ranged(star(spark, sf)["fact_sales"], path, _RANGES)
    table = RangedTable(spark, path)
    total = (F.count(F.lit(1)).alias("row_count"), F.sum("sales_amount").cast("double").alias("total_sales"))
    dated = table.between("1997-11-15", "1998-02-15").groupBy(F.date_format("order_date", "yyyy-MM").alias("order_month")).agg(*total)
    undated = table.undated().agg(*total).select(F.lit("undated").alias("part"), F.lit(None).cast("string").alias("order_month"), "row_count", "total_sales")
    return dated.select(F.lit("dated").alias("part"), "order_month", "row_count", "total_sales").unionByName(undated)


@register("concurrent_publish", Q.chain("""
SELECT v.version, 'erp_px_cat_g1v2' AS table_name, c.rows_written, TRUE AS one_batch_each
FROM (SELECT unnest([1, 2, 3]) AS version) v, (SELECT count(*) AS rows_written FROM s_cat) c"""))
def concurrent_publish(spark, sf):
    """Three publishers of one layer at a time: every commit gets a number of its own."""
    root = _scratch(spark, "writers")
    cat = silver_of(star(spark, sf))["erp_px_cat_g1v2"]
    with ThreadPoolExecutor(max_workers=3) as pool:
        for done in [pool.submit(publish_layer, spark, root, "silver", {"erp_px_cat_g1v2": cat}) for _ in range(3)]:
            done.result()
    log = commits(spark, root, "silver")
    return log.groupBy("version").agg(F.max("table_name").alias("table_name"), F.max("rows_written").alias("rows_written"),
                                      (F.countDistinct("batch_id") == 1).alias("one_batch_each")).select(
        F.col("version").cast("int").alias("version"), "table_name", "rows_written", "one_batch_each")


@register("views_after_refresh", Q.chain(f"""
SELECT 'first' AS refresh, coalesce(c.country, '-') AS country, count(*) AS line_count, {Q.dbl('sum(f.sales_amount)')} AS total_sales
FROM fact_sales f JOIN dim_customer c ON f.customer_key = c.customer_key WHERE f.order_date < DATE '1997-01-01' GROUP BY 2
UNION ALL
SELECT 'second', coalesce(c.country, '-'), count(*), {Q.dbl('sum(f.sales_amount)')}
FROM fact_sales f JOIN dim_customer c ON f.customer_key = c.customer_key GROUP BY 2"""))
def views_after_refresh(spark, sf):
    """The same SQL over the gold views after two refreshes with different facts."""
    root, database = _scratch(spark, "warehouse"), f"gold_{uuid.uuid4().hex[:10]}"
    g = star(spark, sf)
    dims = {n: g[n] for n in ("dim_customer", "dim_products")}

    def refresh(fact):
        publish_layer(spark, root, "gold", {**dims, "fact_sales": fact}, schemas=GOLD, ranged={"fact_sales": _RANGES})

    def report(label):
        return spark.sql(f"""SELECT '{label}' AS refresh, coalesce(c.country, '-') AS country, count(*) AS line_count,
            CAST(sum(f.sales_amount) AS DOUBLE) AS total_sales
            FROM {database}.fact_sales f JOIN {database}.dim_customer c ON f.customer_key = c.customer_key GROUP BY 2""")

    refresh(g["fact_sales"].where("order_date < date '1997-01-01'"))
    create_views(spark, root, "gold", GOLD, database, extra=[LABEL])
    path = f"{root}/first_report"
    write_observed(report("first"), path)
    refresh(g["fact_sales"])
    return spark.read.parquet(path).unionByName(report("second"))


def _verdicts_sql():
    from .queries_quality import MONITOR_KEYS, _monitor_sql
    tables = " UNION ALL ".join(_monitor_sql(t, k) for t, k in MONITOR_KEYS.items())
    metric = lambda m, value, ok, accept: (f"SELECT table_name, '{m}' AS metric, {value} AS value, '{accept}' AS acceptable,"  # noqa: E731
                                           f" CASE WHEN {ok} THEN 'OK' ELSE 'ALERT' END AS status FROM base")
    return f"SELECT * FROM (WITH base AS ({tables}) " + " UNION ALL ".join([
        metric("row_count", "CAST(row_count AS DOUBLE)", "row_count > 0", "> 0"),
        metric("duplicate_keys", "CAST(duplicate_keys AS DOUBLE)", "duplicate_keys = 0", "= 0"),
        metric("null_keys", "CAST(null_keys AS DOUBLE)", "null_keys = 0", "= 0"),
        metric("load_seconds", "CAST(NULL AS DOUBLE)", "TRUE", "< 3600"), metric("load_age_days", "CAST(0 AS DOUBLE)", "TRUE", "= 0")]) + ") verdicts"


@register("monitor_verdicts", Q.chain(_verdicts_sql()))
def monitor_verdicts(spark, sf):
    """Monitoring of a published silver layer (the seconds themselves differ from run to run)."""
    from .queries_quality import MONITOR_KEYS
    root = _scratch(spark, "warehouse")
    s = silver_of(star(spark, sf))
    publish_layer(spark, root, "silver", {t: s[t] for t in MONITOR_KEYS}, schemas=SILVER)
    rows = P.layer_monitor(spark, root, "silver", MONITOR_KEYS, max_seconds=3600.0)
    return rows.withColumn("value", F.when(F.col("metric") != "load_seconds", F.col("value")))


@register("pipeline_sales_by_country", Q.chain(f"""
SELECT c.country, count(DISTINCT f.customer_key) AS customer_count, count(f.order_number) AS order_count,
 {Q.dbl('sum(f.sales_amount)')} AS total_sales
FROM fact_sales f JOIN dim_customer c ON f.customer_key = c.customer_key GROUP BY c.country"""))
def pipeline_sales_by_country(spark, sf):
    """End to end: landed files → bronze → silver → gold, each published
    all-or-nothing, then the report over the published gold tables."""
    root = _scratch(spark, "warehouse")
    P.run(spark, landing(spark, sf), root, as_of=AS_OF, views=False)
    g = {n: df.drop("dwh_create_date") for n, df in read_layer(spark, root, "gold", P.GOLD_TABLES).items()}
    return A.sales_by_country(g)


# ---------------------------------------------------------------- incremental load

@register("stream_ingest_good", f"SELECT cid, CAST(bdate AS DATE) AS bdate, gen FROM ({_PLANTED_RAW}) raw"
                                " WHERE reject_reason = ''")
def stream_ingest_good(spark, sf):
    """The planted feed picked up by the incremental (streaming) bronze load."""
    from ..streaming import landing as L
    src = planted_feed(spark, sf)
    work = _scratch(spark, "stream")
    q = L.load_arrivals(spark, src, _PLANTED_SCHEMA, f"{work}/bronze", f"{work}/_checkpoint", header=False)
    q.awaitTermination()
    return L.read_loaded(spark, f"{work}/bronze", _PLANTED_SCHEMA).drop(L.EPOCH)
