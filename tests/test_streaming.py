"""Incremental bronze load: new files only, quarantine split, replay-safe output."""

import os
import tempfile

from pyspark.sql import types as T

from strata.streaming import landing as L

SCHEMA = T.StructType([T.StructField("cid", T.StringType()), T.StructField("bdate", T.DateType()),
                       T.StructField("gen", T.StringType())])


def _drop(folder, name, lines):
    with open(os.path.join(folder, name), "w") as fh:
        fh.write("cid,bdate,gen\n" + "".join(l + "\n" for l in lines))


def test_two_runs_pick_up_only_new_files(spark):
    base = tempfile.mkdtemp(prefix="strata-stream-")
    src = os.path.join(base, "in")
    os.makedirs(src)
    args = (spark, src, SCHEMA, base + "/bronze", base + "/ckpt")
    _drop(src, "a.csv", ["AW1,1980-01-01,M", "AW2,not-a-date,F", "AW3,1990-02-03"])
    L.load_arrivals(*args).awaitTermination()
    _drop(src, "b.csv", ["AW4,1970-05-06,F", "AW5,1971-05-06,F,extra"])
    L.load_arrivals(*args).awaitTermination()
    good = L.read_loaded(spark, base + "/bronze", SCHEMA)
    assert sorted(r.cid for r in good.collect()) == ["AW1", "AW3", "AW4"]
    bad = L.read_rejected(spark, base + "/bronze", SCHEMA)
    assert sorted((r.cid, r.reject_reason) for r in bad.collect()) == [("AW2", "bad_bdate"), ("AW5", "too_many_fields")]
    assert good.select(L.EPOCH).distinct().count() == 2
