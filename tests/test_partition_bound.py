"""Shuffle partitions that adaptive execution puts together stay small."""

from strata import session
from strata.plans import layers


def test_adaptive_partitions_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(layers, "Layers", lambda *_: {})
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(name)
    try:
        for before, after in (("64m", str(session.PARTITION_BYTES)), ("1m", "1m")):
            spark.conf.set(name, before)
            layers.star(spark, f"/no/such/folder/{before}")
            assert spark.conf.get(name) == after
    finally:
        spark.conf.set(name, old)
