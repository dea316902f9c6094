"""NOT IN keeps SQL three-valued logic at any size (trap N4)."""

from strata.operators import joins


def _ids(df):
    return sorted((r[0] is None, r[0]) for r in df.collect())


def test_not_in_without_nulls(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(2,), (3,)], "r int")
    assert _ids(joins.not_in(left, "k", right, "r")) == [(False, 1)]


def test_not_in_with_null_in_subquery_is_empty(spark):
    left = spark.createDataFrame([(1,), (2,)], "k int")
    right = spark.createDataFrame([(2,), (None,)], "r int")
    assert joins.not_in(left, "k", right, "r").count() == 0


def test_not_in_empty_subquery_keeps_all(spark):
    left = spark.createDataFrame([(1,), (None,)], "k int")
    right = spark.createDataFrame([], "r int")
    assert joins.not_in(left, "k", right, "r").count() == 2


def test_not_exists_keeps_null_probes(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(2,), (None,)], "r int")
    assert _ids(joins.not_exists(left, "k", right, "r")) == [(False, 1), (True, None)]


def test_not_in_matches_spark_sql(spark):
    left = spark.createDataFrame([(i,) for i in range(50)] + [(None,)], "k int")
    right = spark.createDataFrame([(i,) for i in range(0, 50, 3)], "r int")
    left.createOrReplaceTempView("l")
    right.createOrReplaceTempView("r")
    want = spark.sql("SELECT k FROM l WHERE k NOT IN (SELECT r FROM r)")
    assert _ids(joins.not_in(left, "k", right, "r")) == _ids(want)


def test_left_join_spread_matches_left_join(spark):
    from pyspark.sql import functions as F
    left = spark.createDataFrame([(i % 7, f"l{i}") for i in range(40)] + [(None, "ln")], "k int, lv string")
    right_rows = [(1, f"r{i}") for i in range(25)] + [(1, "dup")] * 9 + [(2, "a"), (2, "b"), (None, "rn")] \
        + [(3, f"x{i}") for i in range(6)]
    right = spark.createDataFrame(right_rows, "rk int, rv string")
    # a zero broadcast threshold forces the spread path
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = joins.left_join_spread(left, right, "k", "rk", hot_rows=4)
        rows = got.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "32m")
    want = left.join(right, F.col("k") == F.col("rk"), "left")
    assert sorted(map(str, rows)) == sorted(map(str, want.collect()))


def test_parse_bytes():
    assert [joins.parse_bytes(x) for x in ["10485760b", "32m", "1.5g", "-1", "10MB", "100", "64kb"]] == \
        [10485760, 32 << 20, int(1.5 * (1 << 30)), -1, 10 << 20, 100, 64 << 10]
