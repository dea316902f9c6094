"""A layer for SQL users: views that resolve the committed batch, tables with declared schemas.

The views never change between refreshes.  Each joins the one-row "newest commit" of the
layer's log with the table's batches, so the commit record switches all views of the
layer at once and only the committed batch's directory is read (runtime partition
pruning).  A failed or running refresh has no record and is not seen.  A statement
lists the log first and the batches after, so that it finds every batch it can choose.
It shows the layer as committed when it was analysed; do not put DataFrames from before and
after a refresh into one plan (Spark takes scans of one path for the same).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from .commitlog import log_path


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def drop_entry(spark: SparkSession, database: str, name: str) -> None:
    """Remove a view or an external table of this name, if there is one; files stay."""
    full = f"{_quoted(database)}.{_quoted(name)}"
    if spark.catalog.tableExists(full):
        kind = "VIEW" if spark.catalog.getTable(full).tableType == "VIEW" else "TABLE"
        spark.sql(f"DROP {kind} {full}")


def create_views(spark: SparkSession, root: str, layer: str, schemas: Mapping[str, T.StructType], database: str | None = None,
                 extra: Iterable[str] = ()) -> list[str]:
    """``<database>.<table>`` (default: the layer's name) for every declared table; returns their names.

    ``extra``: further columns (partition labels) that follow the declared ones where a table has them.
    """
    database = database or layer
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(database)}")
    made = []
    for name, schema in schemas.items():
        folder = f"{root.rstrip('/')}/{layer}/{name}"
        have = spark.read.parquet(folder).columns
        columns = ", ".join(f"t.{_quoted(c)}" for c in [*schema.names, "dwh_create_date", *[e for e in extra if e in have]])
        old = f"{_quoted(database)}.{_quoted(name)}"
        if spark.catalog.tableExists(old) and spark.catalog.getTable(old).tableType != "VIEW":
            drop_entry(spark, database, name)
        spark.sql(f"CREATE OR REPLACE VIEW {old} AS SELECT /*+ BROADCAST(c) */ {columns} FROM "
                  f"(SELECT max_by(batch_id, version) AS batch_id FROM json.{_quoted(log_path(root, layer))} WHERE version > 0) c "
                  f"JOIN parquet.{_quoted(folder)} t ON t.batch = c.batch_id")
        made.append(f"{database}.{name}")
    return made
