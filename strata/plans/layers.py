"""Lazy bronze → silver → gold chains over the driver tables.

The dimensions are numbered once per session and input folder (numbering
writes the sorted rows once to the shared folder), so every report of a
session sees the same keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import bound_partitions
from ..sources import feeds
from . import gold, silver

AS_OF = "2025-06-30"  # fixed 'today' of reproducible runs

_STAR_CACHE: dict[tuple[str, str], "Layers"] = {}


class Layers(dict):
    """Tables by name, each built when it is first asked for and kept: a query that needs
    one silver table neither numbers a dimension nor touches another feed."""

    def __init__(self, spark: SparkSession, sf_dir: str, as_of):
        super().__init__()
        self._feeds = feeds.all_feeds(spark, sf_dir)
        self._as_of = as_of

    def __missing__(self, name: str) -> DataFrame:
        if name.startswith("silver."):
            table = silver.build_one(name.split(".", 1)[1], self._feeds, self._as_of)
        elif name == "dim_customer":
            table = gold.dim_customer(silver_of(self))
        elif name == "dim_products":
            table = gold.dim_products(silver_of(self))
        elif name == "fact_sales":
            table = gold.fact_sales(silver_of(self), self["dim_products"], self["dim_customer"])
        else:
            raise KeyError(name)
        self[name] = table
        return table


class _Silver(dict):
    """The silver tables of :class:`Layers` under their plain names."""

    def __init__(self, layers: Layers):
        super().__init__()
        self._layers = layers

    def __missing__(self, name: str) -> DataFrame:
        self[name] = self._layers[f"silver.{name}"]
        return self[name]

    def items(self):
        return [(name, self[name]) for name in silver.NAMES]


def bronze(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    bound_partitions(spark)
    return feeds.all_feeds(spark, sf_dir)


def silver_layer(spark: SparkSession, sf_dir: str, as_of=AS_OF) -> dict[str, DataFrame]:
    return silver.build_silver(bronze(spark, sf_dir), as_of)


def star(spark: SparkSession, sf_dir: str, as_of=AS_OF) -> Layers:
    """silver tables + the three gold tables, built on demand, memoised per session and folder."""
    bound_partitions(spark)
    key = (spark.sparkContext.applicationId, f"{sf_dir}|{as_of}")
    if key not in _STAR_CACHE:
        _STAR_CACHE[key] = Layers(spark, sf_dir, as_of)
    return _STAR_CACHE[key]


def silver_of(layers: Layers) -> dict[str, DataFrame]:
    return _Silver(layers)
