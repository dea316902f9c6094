"""Connected components of a link table, with joins and groupings only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

_MOST_ROUNDS = 200  # label and pointer steps at least halve the longest path; 200 cannot be met


def components(links: DataFrame) -> DataFrame:
    """(node, comp) of every node of ``links`` (a, b): comp is the smallest node of its component.

    Each round a node takes the smallest label around it, then the label of its label
    (pointer jumping), so long chains need a logarithmic number of rounds.  Labels are
    written between rounds.  Minima combine on the map side, so a node with very many
    links is no hot group.
    """
    both = written(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                     .select("node", F.least("node", "m").alias("comp")), "labels")
    for _ in range(_MOST_ROUNDS):
        around = both.join(labels.select(F.col("node").alias("b"), "comp"), "b").groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("m"))
        step = labels.join(around, "node").select("node", F.col("comp").alias("old"), F.least("comp", "m").alias("comp"))
        jump = labels.select(F.col("node").alias("comp"), F.col("comp").alias("to"))
        new = written(step.join(jump, "comp").select("node", "old", F.least("comp", "to").alias("comp")), "labels")
        changed = new.where("comp <> old").limit(1).count()
        labels = new.select("node", "comp")
        if not changed:
            return labels
    raise RuntimeError("components did not settle")
