"""Connected components of a link table by distributed label propagation."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyframe.session import ensure_checkpoint_dir


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root``: every node that has a link, and the smallest node it can reach.

    Each round a node takes the smallest label among itself and its neighbours, then the label of
    that label, so paths shrink as fast as pointers double. Only minima are gathered, never lists of
    neighbours, so a node with very many links costs one combined row per task. Rounds go on until
    no label changes; each is cut with ``checkpoint()`` in the shared folder.
    """
    ensure_checkpoint_dir(links.sparkSession)
    pairs = links.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a is not null and b is not null and a <> b")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct().checkpoint()
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
    labels = labels.select("node", F.least("node", "m").alias("root")).checkpoint()
    while True:
        seen = both.join(labels.select(F.col("node").alias("b"), "root"), "b").groupBy(F.col("a").alias("node"))
        lower = labels.join(seen.agg(F.min("root").alias("m")), "node")
        lower = lower.select("node", F.col("root").alias("old"), F.least("root", "m").alias("root"))
        above = labels.select(F.col("node").alias("root"), F.col("root").alias("up"))
        step = lower.join(above, "root").select("node", "old", F.least("root", "up").alias("root")).checkpoint()
        labels = step.select("node", "root")
        if step.filter("root < old").isEmpty():
            return labels
