"""Writing layers: refresh, append, audit and all-or-nothing publication.

A layer is published in batches.  Every table of a batch is written under
``<root>/<layer>/<table>/batch=<batch>``; only when all writes succeeded and their files
have the declared schemas is a record appended to the layer's commit log
(:mod:`.commitlog`).  Readers resolve the batch of the newest commit, so a failed
refresh leaves the previous batch readable and nothing is deleted.  Row counts come from
``observe`` on the write itself, not a second scan.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import declared
from .commitlog import Written, commit, current_batch, utc_now
from .ranged import LABEL, Ranges, write_ranged
from .views import drop_entry

LOADED_AT = T.StructField("dwh_create_date", T.TimestampNTZType(), True)


class SchemaMismatch(ValueError):
    """Written files do not have the declared columns."""


def write_observed(df: DataFrame, path: str, mode: str = "overwrite", fmt: str = "parquet",
                   partition_by: list[str] | None = None) -> int:
    """Write and return the number of rows written (counted during the write)."""
    obs = Observation()
    writer = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return int(obs.get["rows"])


def new_batch_id() -> str:
    now = dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f")
    return f"{now}-{uuid.uuid4().hex[:8]}"


def layer_path(root: str, layer: str) -> str:
    return f"{root.rstrip('/')}/{layer}"


def table_path(root: str, layer: str, table: str, batch: str) -> str:
    return f"{layer_path(root, layer)}/{table}/batch={batch}"


def check_schema(spark: SparkSession, path: str, name: str, schema: T.StructType) -> None:
    """Compare the columns of the files under ``path`` with the declared ones (and the load stamp)."""
    found = [(f.name, f.dataType.simpleString()) for f in spark.read.parquet(path).schema.fields if f.name != LABEL]
    want = [(f.name, f.dataType.simpleString()) for f in [*schema.fields, LOADED_AT]]
    if found != want:
        differ = [f"{a} instead of {b}" for a, b in zip(found + [None] * len(want), want + [None] * len(found)) if a != b]
        raise SchemaMismatch(f"{name}: {differ}")


def write_batch(spark: SparkSession, root: str, layer: str,
                tables: Mapping[str, DataFrame | Callable[[], DataFrame]],
                batch_id: str | None = None, loaded_at: dt.datetime | None = None,
                parallel: bool = True, schemas: Mapping[str, T.StructType] | None = None,
                ranged: Mapping[str, Ranges] | None = None) -> list[Written]:
    """Write every table of a batch (not yet visible to readers); returns the
    audit records for :func:`~.commitlog.commit`.

    The tables are independent, so their writes are submitted as concurrent
    Spark jobs (``parallel``).  Each table gains the load timestamp column
    ``dwh_create_date``.  A value may be a callable that builds the table.
    ``schemas``: declared columns; files that differ raise :class:`SchemaMismatch`.
    ``ranged``: tables written in date-range directories.
    """
    batch = batch_id or new_batch_id()
    stamp = loaded_at or utc_now()

    def write_one(name, table):
        started, began = utc_now(), time.monotonic()
        df = table() if callable(table) else table
        df = df.withColumn("dwh_create_date", F.lit(stamp).cast("timestamp_ntz"))
        path = table_path(root, layer, name, batch)
        rows = write_ranged(df, path, ranged[name]) if name in (ranged or {}) else write_observed(df, path)
        if schemas is not None:
            check_schema(spark, path, name, schemas[name])
        return Written(batch, name, rows, started, stamp, round(time.monotonic() - began, 3))

    items = list(tables.items())
    if parallel and len(items) > 1:
        with ThreadPoolExecutor(max_workers=len(items)) as pool:
            futures = [pool.submit(write_one, n, t) for n, t in items]
            return [f.result() for f in futures]  # re-raises the first failure
    return [write_one(n, t) for n, t in items]


def publish_layer(spark: SparkSession, root: str, layer: str,
                  tables: Mapping[str, DataFrame | Callable[[], DataFrame]],
                  batch_id: str | None = None, loaded_at: dt.datetime | None = None,
                  parallel: bool = True, schemas: Mapping[str, T.StructType] | None = None,
                  ranged: Mapping[str, Ranges] | None = None, after: int | None = None) -> DataFrame:
    """Write every table of a layer, then commit the batch; returns the audit.
    Any failure propagates before the commit record is written: the previous
    batch stays current.  ``after``: see :func:`~.commitlog.commit`."""
    audit = write_batch(spark, root, layer, tables, batch_id, loaded_at, parallel, schemas, ranged)
    return commit(spark, root, layer, audit, after)


def read_layer(spark: SparkSession, root: str, layer: str, names, batch: str | None = None) -> dict[str, DataFrame]:
    """The tables of the committed batch (without the range label of a ranged one)."""
    b = batch or current_batch(spark, root, layer)
    return {n: spark.read.parquet(table_path(root, layer, n, b)).drop(LABEL) for n in names}


def register_layer(spark: SparkSession, root: str, layer: str, names, batch: str | None = None,
                   schemas: Mapping[str, T.StructType] | None = None) -> list[str]:
    """Expose one batch of a layer as catalog tables ``<layer>.<table>`` (drop if exists, create with
    the declared schema over the batch's files).

    The tables are external: dropping one never deletes a batch.  They keep showing this batch after
    a refresh; :mod:`.views` follows the commits.  ``schemas`` default to the layer's declared ones.
    """
    b = batch or current_batch(spark, root, layer)
    schemas = schemas or declared(layer)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{layer}`")
    created = []
    for n in names:
        path = table_path(root, layer, n, b)
        check_schema(spark, path, n, schemas[n])
        drop_entry(spark, layer, n)
        label = LABEL in spark.read.parquet(path).columns
        columns = T.StructType([*schemas[n].fields, LOADED_AT, *[T.StructField(LABEL, T.StringType())] * label]).toDDL()
        location = path.replace("'", "\\'")
        spark.sql(f"CREATE TABLE `{layer}`.`{n}` ({columns}) USING parquet {f'PARTITIONED BY ({LABEL})' * label} LOCATION '{location}'")
        if label:
            spark.sql(f"MSCK REPAIR TABLE `{layer}`.`{n}`")
        created.append(f"{layer}.{n}")
    return created


def save_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int) -> int:
    """Write ``df`` as an external catalog table bucketed and sorted by ``key``.

    Two tables bucketed by the join key into the same number of buckets are
    joined without an exchange on either side, which is how a fact and a
    dimension too large to broadcast stay co-located between refreshes.
    Returns the rows written.
    """
    spark = df.sparkSession
    database = table.split(".")[0] if "." in table else None
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    obs = Observation()
    (df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
       .bucketBy(buckets, key).sortBy(key).option("path", path).format("parquet").saveAsTable(table))
    return int(obs.get["rows"])


def publish_bucketed(spark: SparkSession, root: str, layer: str, tables: Mapping[str, DataFrame],
                     key: str, buckets: int, batch_id: str | None = None) -> DataFrame:
    """All-or-nothing like :func:`publish_layer`, but every table is bucketed by ``key`` and known to the
    catalog as ``<layer>.<name>_<batch>``; the batch is committed after all writes.

    A bucketed table belongs to one batch; :func:`bucketed_table` gives the committed batch's, so
    there is nothing to rename after the commit."""
    batch = batch_id or new_batch_id()
    stamp = utc_now()

    def write_one(name, df):
        started, began = utc_now(), time.monotonic()
        rows = save_bucketed(df.withColumn("dwh_create_date", F.lit(stamp).cast("timestamp_ntz")), bucketed_name(layer, name, batch),
                             table_path(root, layer, name, batch), key, buckets)
        return Written(batch, name, rows, started, stamp, round(time.monotonic() - began, 3))

    return commit(spark, root, layer, [write_one(name, df) for name, df in tables.items()])


def bucketed_name(layer: str, name: str, batch: str) -> str:
    return f"`{layer}`.`{name}_{batch.replace('-', '_')}`"


def bucketed_table(spark: SparkSession, root: str, layer: str, name: str) -> DataFrame:
    """The committed batch's bucketed table."""
    return spark.table(bucketed_name(layer, name, current_batch(spark, root, layer)))
