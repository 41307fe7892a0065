"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sparrowscope.llm.common import Tables


def components(links: DataFrame, tables: Tables) -> DataFrame:
    """node and root (the smallest node of its component) of every node in `links` (a, b
    bigint). Each round takes the smallest root among the neighbours, then the root of
    that root; rounds grow with the logarithm of the longest chain."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = tables.store(both.where("a != b").distinct(), "edges")
    roots = tables.store(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")).select(
            "node", F.least("node", "least").alias("root")
        ),
        "roots",
    )
    while True:
        near = both.join(roots, both["b"] == roots["node"]).groupBy(F.col("a").alias("n")).agg(
            F.min("root").alias("near")
        )
        lowered = roots.join(near, F.col("node") == F.col("n")).select(
            "node", F.col("root").alias("old"), F.least("root", "near").alias("root")
        )
        lowered = tables.store(lowered, "lowered")
        jump = lowered.select(F.col("node").alias("r"), F.col("root").alias("rr"))
        moved = lowered.join(jump, lowered["root"] == F.col("r"), "left").select(
            "node", "old", F.least("root", F.coalesce("rr", "root")).alias("root")
        )
        moved = tables.store(moved, "moved")
        changed = moved.where("old != root").limit(1).count()
        tables.drop(lowered, roots)
        if not changed:
            tables.drop(both)
            return moved.select("node", "root")
        roots = moved
