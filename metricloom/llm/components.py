"""Connected components of a table of links, by smallest label and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from metricloom.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, root) for each node of ``links`` (a, b longs): the smallest node it reaches.

    Each round every node points to the smallest node beside it; pointers are followed to
    their end by doubling; links are then drawn between the ends, and those inside a tree
    vanish. A tree has two nodes at least, so that each round halves what is left, whatever
    the length of a chain. Each step is written to the shared folder.
    """
    both = links.select("a", "b").union(links.select(F.col("b"), F.col("a")))
    edges = stored(both.where("a != b").distinct(), "links")
    label = None
    while not edges.isEmpty():
        step = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
        step = stored(step.select("node", F.least("node", "m").alias("root")), "labels")
        moved = True
        while moved:
            up = step.select(F.col("node").alias("root"), F.col("root").alias("next"))
            step = stored(
                step.join(up, "root").select(
                    "node", F.col("next").alias("root"), (F.col("root") != F.col("next")).alias("moved")
                ),
                "labels",
            )
            moved = not step.where("moved").isEmpty()
            step = step.drop("moved")
        if label is None:
            label = step
        else:
            up = step.select(F.col("node").alias("root"), F.col("root").alias("next"))
            label = stored(
                label.join(up, "root", "left").select(
                    "node", F.coalesce("next", "root").alias("root")
                ),
                "labels",
            )
        a = step.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        b = step.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        edges = edges.join(a, "a").join(b, "b").where("ra != rb")
        edges = stored(edges.select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(), "links")
    if label is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root")).limit(0)
    return label
