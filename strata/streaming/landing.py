"""Incremental bronze loading of files as they arrive.

The batch bronze load rereads whole feeds; this job picks up only files that
landed since its last run (Structured Streaming file source, progress kept in
the checkpoint), applies the same tolerant parse, and writes every
micro-batch once, split by status like the batch load:
``<table>/_query=<id>/_epoch=<id>/_status=good|rejected``.

Each micro-batch goes to its own folder in overwrite mode: when a batch is
replayed after a failure it replaces its own output, so the table never holds
a batch twice.  ``_query`` is the identity kept in the checkpoint: a new or
reset checkpoint counts its epochs from 0 again, in a folder of its own.  ``available_now`` processes everything
present and stops (scheduled runs); without it the query keeps running.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..sources import delimited

EPOCH = "_epoch"
QUERY = "_query"


def arriving_rows(spark: SparkSession, folder: str, schema: T.StructType, header: bool = True,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming all-text scan of a landing folder, checked against ``schema``."""
    reader = spark.readStream.schema(delimited.text_schema(schema)).option("header", str(header).lower())
    for k, v in delimited.CSV_OPTIONS.items():
        reader = reader.option(k, v)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.csv(folder).withColumn(delimited.SOURCE_FILE, F.col("_metadata.file_path"))
    return delimited.with_rejects(raw, schema)


def load_arrivals(spark: SparkSession, folder: str, schema: T.StructType, table_path: str,
                  checkpoint: str, header: bool = True, available_now: bool = True) -> StreamingQuery:
    checked = arriving_rows(spark, folder, schema, header)

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        # Spark writes the query's id into the checkpoint before the first batch
        query = spark.read.json(f"{checkpoint.rstrip('/')}/metadata").first()["id"]
        good = F.col(delimited.REASON).isNull()
        (batch.withColumn(delimited.STATUS, F.when(good, F.lit("good")).otherwise(F.lit("rejected")))
              .write.mode("overwrite").partitionBy(delimited.STATUS)
              .parquet(f"{table_path}/{QUERY}={query}/{EPOCH}={epoch_id}"))

    writer = checked.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def _part(spark: SparkSession, path: str, schema: T.StructType, status: str) -> DataFrame:
    layout = T.StructType([*delimited.checked_schema(schema).fields, T.StructField(QUERY, T.StringType()), T.StructField(EPOCH, T.LongType()),
                           T.StructField(delimited.STATUS, T.StringType())])
    return spark.read.schema(layout).parquet(path).filter(F.col(delimited.STATUS) == status)


def read_loaded(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All good rows written so far, typed, with their micro-batch id."""
    return _part(spark, path, schema, "good").select(*schema.names, EPOCH)


def read_rejected(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All quarantined rows written so far, as delivered, with reason and file."""
    return delimited.rejected_rows(_part(spark, path, schema, "rejected"), schema)
