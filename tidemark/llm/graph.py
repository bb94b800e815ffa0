"""Connected components of links, in joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.session import Scratch


def components(links: DataFrame, scratch: Scratch, label: str) -> DataFrame:
    """(node, comp) for every end of ``links`` (a, b); comp is the component's smallest node.

    Each round takes the smallest label among the neighbours and then the label of that
    label, so a chain shortens by half or more. Labels are written down after a round:
    a lost executor costs a part of one round. Grouped minima combine before they move,
    so a node with very many links is no hot key.
    """
    both = scratch.put(
        links.select(F.col("a").alias("node"), F.col("b").alias("other"))
        .unionByName(links.select(F.col("b").alias("node"), F.col("a").alias("other"))).distinct(),
        f"{label}-both",
    )
    labels = scratch.put(both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("comp")), f"{label}-0")
    step = 0
    while True:
        step += 1
        near = both.join(labels.select(F.col("node").alias("other"), "comp"), "other").groupBy("node").agg(F.min("comp").alias("near"))
        lower = labels.join(near, "node").select("node", "comp", F.least("comp", "near").alias("low"))
        jump = labels.select(F.col("node").alias("low"), F.col("comp").alias("lowest"))
        moved = scratch.put(lower.join(jump, "low").select("node", F.col("lowest").alias("comp"), (F.col("lowest") < F.col("comp")).alias("moved")), f"{label}-{step}")
        scratch.drop(f"{label}-{step - 1}")
        labels = moved.select("node", "comp")
        if moved.filter("moved").isEmpty():
            scratch.drop(f"{label}-both")
            return labels
