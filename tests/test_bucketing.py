"""Fact and dimension bucketed by the join key are joined without an exchange."""

import tempfile

from pyspark.sql import functions as F

from strata.plans import publish as P


def test_bucketed_join_has_no_exchange(spark):
    root = tempfile.mkdtemp(prefix="strata-bucket-")
    fact = spark.range(0, 20000).select((F.col("id") % 997).alias("customer_key"), F.col("id").alias("line"))
    dim = spark.range(0, 997).select(F.col("id").alias("customer_key"), (F.col("id") % 7).alias("segment"))
    audit = P.publish_bucketed(spark, root, "goldb", {"fact_sales": fact, "dim_customer": dim},
                               key="customer_key", buckets=8, batch_id="b1")
    assert {r.table_name: r.rows_written for r in audit.collect()} == {"fact_sales": 20000, "dim_customer": 997}
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # force the sort-merge join
    try:
        joined = P.bucketed_table(spark, root, "goldb", "fact_sales").join(P.bucketed_table(spark, root, "goldb", "dim_customer"), "customer_key")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan, plan
        assert joined.count() == 20000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
