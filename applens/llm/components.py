"""Connected components of a links table, by joins with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from applens.llm.common import write_shared


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) with label the least node reachable, for every node of `links`.

    Each round a node takes the least label beside it, offers it to the node its
    own label names, and then jumps to its label's label: the number of rounds
    grows with the logarithm of the longest chain. Every round is written to the
    shared folder; aggregates combine before they shuffle, so a hub costs a row per task.
    """
    edges = write_shared(
        links.select(F.col(a).alias("u"), F.col(b).alias("v"))
        .unionByName(links.select(F.col(b).alias("u"), F.col(a).alias("v"))).distinct(), "edges")
    state = write_shared(edges.groupBy(F.col("u").alias("node"))
                         .agg(F.least(F.min("v"), F.col("u")).alias("label")), "labels")
    while True:
        beside = (edges.join(state.withColumnRenamed("node", "v"), "v")
                  .groupBy(F.col("u").alias("node")).agg(F.min("label").alias("near")))
        near = state.join(beside, "node", "left").select("node", "label", F.least("label", "near").alias("near"))
        offers = near.groupBy(F.col("label").alias("node")).agg(F.min("near").alias("offer"))
        met = near.join(offers, "node", "left").select(
            "node", F.col("label").alias("old"), F.least("near", "offer").alias("label"))
        jump = met.select(F.col("node").alias("label"), F.col("label").alias("beyond"))
        new = write_shared(met.join(jump, "label", "left").select(
            "node", "old", F.least("label", "beyond").alias("label")), "labels")
        state = new.select("node", "label")
        if new.filter("old <> label").isEmpty():
            return state
