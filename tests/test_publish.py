"""All-or-nothing layer publication (V10): commit log, declared schemas, views, ranged fact."""

import json
import os
import re
import tempfile
import threading
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.plans import commitlog as C
from strata.plans import publish as P
from strata.plans import ranged as R
from strata.plans import views as V


def _root(name):
    return tempfile.mkdtemp(prefix=f"strata-{name}-")


def test_failed_refresh_keeps_previous_batch(spark):
    root = _root("pub")
    first = {"a": spark.range(5), "b": spark.range(3)}
    audit = P.publish_layer(spark, root, "silver", first, batch_id="b1")
    assert {r.table_name: (r.version, r.rows_written) for r in audit.collect()} == {"a": (1, 5), "b": (1, 3)}

    def broken():
        return spark.range(4).select((F.lit(1) / F.lit(0)).alias("id"))  # ANSI: division by zero
    with pytest.raises(Exception):
        P.publish_layer(spark, root, "silver", {"a": spark.range(9), "b": broken}, batch_id="b2")
    assert C.current_batch(spark, root, "silver") == "b1"
    tables = P.read_layer(spark, root, "silver", ["a", "b"])
    assert tables["a"].count() == 5 and tables["b"].count() == 3


def test_the_log_has_times_and_durations(spark):
    root = _root("log")
    P.publish_layer(spark, root, "silver", {"a": spark.range(5)})
    r = C.commits(spark, root, "silver").first()
    assert r.version == 1 and r.rows_written == 5 and r.seconds > 0
    assert abs((r.started_at - r.loaded_at).total_seconds()) < 60 and abs((C.utc_now() - r.started_at).total_seconds()) < 300
    with pytest.raises(FileNotFoundError):
        C.current_batch(spark, root, "gold")


@pytest.mark.parametrize("rename", [False, True])
def test_concurrent_commits_get_numbers_of_their_own(spark, monkeypatch, rename):
    """Every writer sees the same last number before any of them claims the next."""
    root, writers = _root("writers"), 6
    if rename:  # the way of a shared store
        def put(spark, path, text):
            with_lock = C._file_system(spark, path)
            with claim:  # the local stand-in for the store checks and renames in two steps
                return C._rename_if_absent(spark, *with_lock, text)
        claim = threading.Lock()
        os.makedirs(C.log_path(root, "gold"))
        monkeypatch.setattr(C, "put_if_absent", put)
    barrier, seen, last = threading.Barrier(writers), threading.local(), C.last_version

    def together(*args):
        found = last(*args)
        if not hasattr(seen, "once"):
            seen.once = True
            barrier.wait(30)
        return found

    monkeypatch.setattr(C, "last_version", together)
    batches = [[C.Written(f"b{i}", "a", i, C.utc_now(), C.utc_now(), 0.5)] for i in range(writers)]
    with ThreadPoolExecutor(max_workers=writers) as pool:
        numbers = [r.first()["version"] for r in pool.map(lambda b: C.commit(spark, root, "gold", b), batches)]
    assert sorted(numbers) == list(range(1, writers + 1))
    log = {r.version: r.batch_id for r in C.commits(spark, root, "gold").collect()}
    assert log == {n: f"b{i}" for i, n in enumerate(numbers)}
    monkeypatch.setattr(C, "last_version", last)
    assert C.current_batch(spark, root, "gold") == log[writers]
    assert sorted(os.path.basename(f) for f in os.listdir(C.log_path(root, "gold")) if f.endswith(".json") and f[0] != ".") == [
        f"{n:020d}.json" for n in range(1, writers + 1)]


def test_a_refresh_based_on_an_old_commit_is_refused(spark):
    root = _root("after")
    P.publish_layer(spark, root, "gold", {"a": spark.range(1)}, batch_id="b1", after=0)
    P.publish_layer(spark, root, "gold", {"a": spark.range(2)}, batch_id="b2", after=1)
    with pytest.raises(C.CommitConflict):
        P.publish_layer(spark, root, "gold", {"a": spark.range(3)}, batch_id="b3", after=1)
    assert C.current_batch(spark, root, "gold") == "b2"


def test_a_record_is_complete_or_absent(spark):
    path = _root("put") + "/x/00000000000000000001.json"
    assert C.put_if_absent(spark, path, '{"version": 1}\n') and not C.put_if_absent(spark, path, "other")
    assert json.loads(open(path).read()) == {"version": 1} and os.listdir(os.path.dirname(path)) == [os.path.basename(path)]


DECLARED = {"t": T.StructType([T.StructField("id", T.LongType()), T.StructField("x", T.StringType())])}


def test_drifted_columns_are_refused_before_the_commit(spark):
    root = _root("drift")
    good = spark.range(3).select("id", F.lit("a").alias("x"))
    P.publish_layer(spark, root, "silver", {"t": good}, batch_id="b1", schemas=DECLARED)
    for drifted in (good.select("x", "id"), good.withColumn("x", F.lit(1)), good.withColumn("y", F.lit(1)), good.select("id"),
                    good.select(F.col("id").cast("int"), "x")):
        with pytest.raises(P.SchemaMismatch):
            P.publish_layer(spark, root, "silver", {"t": drifted}, schemas=DECLARED)
    assert C.last_version(spark, root, "silver") == 1
    assert P.register_layer(spark, root, "silver", ["t"], schemas=DECLARED) == ["silver.t"]
    assert spark.table("silver.t").columns == ["id", "x", "dwh_create_date"] and spark.table("silver.t").count() == 3
    with pytest.raises(P.SchemaMismatch):
        P.register_layer(spark, root, "silver", ["t"], schemas={"t": T.StructType([T.StructField("id", T.StringType())])})
    V.drop_entry(spark, "silver", "t")


def test_views_follow_the_commits(spark):
    root = _root("views")
    row = lambda n, x: spark.range(n).select("id", F.lit(x).alias("x"))
    both = {"t": DECLARED["t"], "u": DECLARED["t"]}
    P.publish_layer(spark, root, "layer_v", {"t": row(3, "a"), "u": row(4, "a")}, schemas=both)
    assert V.create_views(spark, root, "layer_v", both) == ["layer_v.t", "layer_v.u"]
    sql = "SELECT t.x AS tx, u.x AS ux, count(*) AS n FROM layer_v.t t JOIN layer_v.u u ON t.id = u.id GROUP BY 1, 2"
    assert [tuple(r) for r in spark.sql(sql).collect()] == [("a", "a", 3)]
    audit = P.write_batch(spark, root, "layer_v", {"t": row(6, "b"), "u": row(5, "b")}, schemas=both)
    assert [tuple(r) for r in spark.sql(sql).collect()] == [("a", "a", 3)]  # written, not committed
    C.commit(spark, root, "layer_v", audit)
    assert [tuple(r) for r in spark.sql(sql).collect()] == [("b", "b", 5)]  # both views at once
    df = spark.sql("SELECT * FROM layer_v.t")
    assert df.columns == ["id", "x", "dwh_create_date"]
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*dynamicpruning", plan), plan


SPLIT = R.Ranges(bounds=(("p_2023", "2024-01-01"), ("p_2024", "2025-01-01")), last="p_2025")
DAYS = ["2023-05-01", "2023-12-31", "2024-01-01", "2024-12-31", "2025-01-01", "2026-01-01", None]


@pytest.fixture(scope="module")
def ranged(spark):
    path = _root("part") + "/f"
    df = spark.createDataFrame([(d,) for d in DAYS], "d string").select(F.col("d").cast("date").alias("order_date"))
    assert R.write_ranged(df, path, SPLIT) == len(DAYS)
    return path


def test_ranged_layout(spark, ranged):
    got = {r.order_range: r.n for r in spark.read.parquet(ranged).groupBy("order_range").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == {"p_2023": 2, "p_2024": 2, "p_2025": 3}
    table = R.RangedTable(spark, ranged)
    assert table.ranges == SPLIT and table.undated().count() == 1


@pytest.mark.parametrize("start,end", [(None, None), ("2023-12-31", "2024-01-01"), ("2024-01-01", "2024-01-02"), ("2024-12-31", None), (None, "2024-01-01"),
                                       ("2023-01-01", "2027-01-01"), ("2025-06-01", "2025-06-01"), ("2030-01-01", "2020-01-01")])
def test_bounds_on_the_date_become_partition_filters(spark, ranged, start, end):
    df = R.RangedTable(spark, ranged).between(start, end)
    want = sorted(d for d in DAYS if d and (start is None or d >= start) and (end is None or d < end))
    assert sorted(str(r.order_date) for r in df.collect()) == want
    labels = SPLIT.touched(start, end)
    read = {f.split("order_range=")[1].split("/")[0] for f in df.inputFiles()} if labels else set()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not labels or re.search(r"PartitionFilters: \[[^\]]*order_range", plan) or len(labels) == 3, plan
    assert read >= {str(SPLIT_OF(d)) for d in want}


def SPLIT_OF(day):
    return next((label for label, upper in SPLIT.bounds if day < upper), SPLIT.last)


def test_only_touched_ranges_are_read(spark, ranged):
    df = R.RangedTable(spark, ranged).between("2024-02-01", "2024-12-01")
    plan = df._jdf.queryExecution().executedPlan()
    df.collect()
    assert SPLIT.touched("2024-02-01", "2024-12-01") == ["p_2024"]
    assert re.search(r"PartitionFilters: \[[^\]]*\(order_range#\d+ = p_2024\)", plan.toString()), plan.toString()


def test_ranges_must_rise():
    for bounds in ((("a", "2024-01-01"), ("b", "2023-01-01")), (("a", "2024-01-01"), ("a", "2025-01-01"))):
        with pytest.raises(ValueError):
            R.Ranges(bounds=bounds)
