"""Distributed numbering and LEAD equal their single-task SQL forms."""

import datetime as dt

from pyspark.sql import functions as F

from strata.operators import dedup
from strata.operators.ordering import lead_within, number_rows


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_number_rows_matches_row_number(spark):
    rows = [(k % 3 if k % 7 else None, f"v{k % 5}") for k in range(200)] + [(1, "v1")] * 40
    df = spark.createDataFrame(rows, "a int, b string").repartition(5)
    got = number_rows(df, [F.col("a").asc_nulls_last()], "rn")
    df.createOrReplaceTempView("t")
    want = spark.sql("SELECT ROW_NUMBER() OVER (ORDER BY a ASC NULLS LAST, b ASC NULLS LAST) AS rn, a, b FROM t")
    assert sorted(map(tuple, got.collect()), key=lambda r: r[0]) == \
        sorted(map(tuple, want.collect()), key=lambda r: r[0])
    assert [r.rn for r in got.collect()] and sorted(r.rn for r in got.collect()) == list(range(1, 241))
    # the only single-partition exchange carries the per-partition counts
    lines = _plan(got).splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            assert "HashAggregate(keys=[_pid" in lines[i + 1], lines[i:i + 2]


def test_number_rows_empty(spark):
    df = spark.createDataFrame([], "a int")
    assert number_rows(df, [F.col("a")], "rn").count() == 0


def test_lead_within_matches_sql_lead_with_ties_and_copies(spark):
    base = dt.date(2020, 1, 1)
    rows = []
    for k in range(30):
        for v in range(k % 4):
            rows.append((f"K{k % 6}", base + dt.timedelta(days=10 * v + k % 3), k))
    rows += [("K1", base, 99)] * 5 + [(None, base, 1), (None, base + dt.timedelta(days=3), 2)]
    df = spark.createDataFrame(rows, "k string, s date, id int").repartition(3)
    got = lead_within(df, ["k"], [F.col("s").asc_nulls_last(), F.col("id").asc_nulls_last()], F.col("s"), "nxt")
    df.createOrReplaceTempView("lt")
    want = spark.sql("SELECT k, s, id, LEAD(s) OVER (PARTITION BY k ORDER BY s, id) AS nxt FROM lt")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_dedup_latest_null_date_wins_and_null_key_dropped(spark):
    rows = [(1, dt.date(2020, 1, 1), "a"), (1, None, "b"), (2, dt.date(2020, 1, 1), "a"),
            (2, dt.date(2021, 1, 1), "b"), (3, dt.date(2020, 1, 1), "b"), (3, dt.date(2020, 1, 1), "a"),
            (None, dt.date(2030, 1, 1), "z")]
    df = spark.createDataFrame(rows, "id int, d date, x string")
    got = dedup.dedup_latest(df, ["id"], [F.col("d").desc_nulls_first()])
    assert sorted(map(tuple, got.collect())) == [(1, None, "b"), (2, dt.date(2021, 1, 1), "b"),
                                                 (3, dt.date(2020, 1, 1), "a")]
    # partial group limit runs before the shuffle
    plan = _plan(got)
    assert "WindowGroupLimit" in plan


def test_superseded_is_multiset_complement(spark):
    rows = [(1, dt.date(2020, 1, 1), "a")] * 3 + [(1, dt.date(2021, 1, 1), "b"), (None, None, "n"), (None, None, "m")]
    df = spark.createDataFrame(rows, "id int, d date, x string")
    got = dedup.superseded(df, ["id"], [F.col("d").desc_nulls_first()])
    assert sorted(map(str, got.collect())) == sorted(map(str, [
        *[spark.createDataFrame([r], "id int, d date, x string").first() for r in
          [(1, dt.date(2020, 1, 1), "a")] * 3 + [(None, None, "n")]]]))


def test_expand_copies_in_chunks(spark):
    from strata.operators.ordering import expand_copies, fold_copies
    df = spark.createDataFrame([("a",)] * 10 + [("b",)] * 3 + [("c",)], "v string")
    out = expand_copies(fold_copies(df), chunk=3).collect()
    got = sorted((r.v, r._copy) for r in out)
    assert got == sorted([("a", i) for i in range(1, 11)] + [("b", i) for i in range(1, 4)] + [("c", 1)])
