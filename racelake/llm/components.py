"""Connected components of a link table, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b: long) -> (node, comp): comp is the smallest node reachable.

    Each round every node takes the smallest label among its neighbours and
    then its label's own label (pointer jumping), so long chains close in a
    logarithmic number of rounds.  Minima are pre-aggregated before the shuffle,
    so a node with very many links is no hot spot; each round is a written table.
    """
    both = written(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = written(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("comp"))
                     .withColumnRenamed("a", "node"), "labels")
    while True:
        near = (both.join(labels.withColumnRenamed("node", "b"), "b")
                .groupBy("a").agg(F.min("comp").alias("near")).withColumnRenamed("a", "node"))
        step = labels.join(near, "node").select("node", "comp", F.least("comp", "near").alias("low"))
        jump = labels.select(F.col("node").alias("low"), F.col("comp").alias("lower"))
        labels_new = written(step.join(jump, "low", "left")
                             .select("node", F.least("low", F.coalesce("lower", "low")).alias("comp"),
                                     F.col("comp").alias("old")), "labels")
        changed = labels_new.where(F.col("comp") != F.col("old")).limit(1).count()
        labels = labels_new.select("node", "comp")
        if not changed:
            return labels
