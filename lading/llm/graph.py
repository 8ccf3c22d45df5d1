"""Connected components over a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lading.operators.materialize import Materializer


def components(edges: DataFrame, keep: Materializer, name: str) -> DataFrame:
    """(node, label) for every node of ``edges`` (columns a, b); ``label`` is
    the smallest node of its component.

    Each round takes the smallest label among a node and its neighbours and
    then jumps to that label's own label, so long chains halve.  Labels are
    written to the shared folder every round: lineage stays one round long
    and a lost executor recomputes from files.  Only the count of changed
    labels reaches the driver.
    """
    both = keep(f"{name}_edges", edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct())
    labels = keep(f"{name}_0", both.groupBy("a").agg(F.least(F.first("a"), F.min("b")).alias("label"))
                  .select(F.col("a").alias("node"), "label"))
    step = 0
    while True:
        step += 1
        near = (both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("label").alias("near"))
                .withColumnRenamed("a", "node"))
        lowest = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("low"))
        jump = labels.select(F.col("node").alias("low"), F.col("label").alias("far"))
        moved = lowest.join(jump, "low", "left").select(
            "node", F.least("low", F.coalesce("far", "low")).alias("label"), F.col("label").alias("was"))
        written = keep(f"{name}_{step}", moved)
        if written.where("label <> was").isEmpty():
            return written.select("node", "label")
        labels = written.select("node", "label")
