"""Connected components of a table of links, as a DataFrame loop."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docgraph.sources import scratch


def components(links: DataFrame, folder: str, name: str) -> DataFrame:
    """(node, label) of every node of ``links`` (a, b): label is its component's smallest node.

    Each round takes the smallest label among a node's neighbours and then jumps to
    that label's own label, so rounds grow with the logarithm of a component's
    width. Each round is a table in the shared folder; only a count of changes
    comes to the driver. No links give no rows.
    """
    both = scratch.materialise(links.select("a", "b").union(links.select("b", "a")).distinct(), folder, f"{name}_edges")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near")).select("node", F.least("node", "near").alias("label"))
    labels = scratch.materialise(labels, folder, f"{name}_0")
    turn = 0
    while True:
        turn += 1
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("near"))
        lowered = labels.join(near, F.col("node") == F.col("a")).select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        # Read back, both sides of the next join are shuffled, and Spark can split the many nodes of one label.
        lowered = scratch.materialise(lowered, folder, f"{name}_{turn}_lowered")
        target = lowered.select(F.col("node").alias("target"), F.col("label").alias("beyond"))
        jumped = lowered.join(target, F.col("label") == F.col("target")).select("node", "old", F.least("label", "beyond").alias("label"))
        written = scratch.materialise(jumped, folder, f"{name}_{turn}")
        labels = written.select("node", "label")
        if not written.filter("old <> label").limit(1).count():
            return labels
