"""yyyymmdd integers become dates without a pattern parser."""

from pyspark.sql import functions as F

from strata.functions import cleanse as C


def test_integer_dates_need_no_pattern_parser(spark):
    days = [20240229, 20230229, 19000229, 20000229, 20101332, 20100431, 20100400, 20100010, 99991231, 10000101, 9999999, 100000000, 32154, 0, -20100101, None, 1 << 62]
    df = spark.createDataFrame([(v,) for v in days], "v bigint").select("v", C.int_to_date("v").alias("d"))
    known = {r.v: str(r.d) for r in df.collect() if r.d is not None}
    assert known == {20240229: "2024-02-29", 20000229: "2000-02-29", 99991231: "9999-12-31", 10000101: "1000-01-01"}
    assert "gettimestamp" not in df._jdf.queryExecution().optimizedPlan().toString().lower()
    assert df.where(F.col("d").isNull()).count() == len(days) - 4
