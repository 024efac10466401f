"""Connected components of a link table, by rounds of joins; every round is a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotebook.llm.staging import keep, planned


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of the links (a, b): root is the least node of its component.

    Each round a node takes the least root among its neighbours' and then the root of that root, so long chains
    halve. The loop ends when no root changes.
    """
    pairs = links.select(F.col(a).alias("node"), F.col(b).alias("other"))
    both = keep(pairs.unionByName(pairs.select(F.col("other").alias("node"), F.col("node").alias("other"))).distinct(), "cc-links")
    n = both.count()
    roots = keep(both.groupBy("node").agg(F.least("node", F.min("other")).alias("root")), "cc-roots")
    while True:
        near = both.join(planned(roots.select(F.col("node").alias("other"), F.col("root").alias("seen")), n), "other")
        least = near.groupBy("node").agg(F.min("seen").alias("seen"))
        step = roots.join(planned(least, n), "node").select("node", F.col("root").alias("old"), F.least("root", "seen").alias("root"))
        jump = roots.select(F.col("node").alias("root"), F.col("root").alias("further"))
        new = step.join(planned(jump, n), "root", "left").select("node", "old", F.least("root", F.coalesce("further", "root")).alias("root"))
        new = keep(new, "cc-roots")
        roots = new.select("node", "root")
        if new.where("root <> old").isEmpty():
            return roots
