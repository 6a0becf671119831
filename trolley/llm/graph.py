"""Connected components by neighbour minima and pointer jumping, all on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.llm.common import cut_lineage, salted_left_join


def connected_components(edges: DataFrame) -> DataFrame:
    """(vertex, root) for every vertex of ``edges`` (columns a, b); root is the
    smallest vertex of the component.

    Each round every vertex takes the least root among itself and its
    neighbours, then its root's root; a round halves the depth, so a chain of
    n needs about log2(n) rounds.  Labels are written to the shared folder
    every round.  No edges: no rows.
    """
    both = cut_lineage(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
                       .where("a <> b").distinct(), shrink=8)
    labels = cut_lineage(both.groupBy(F.col("a").alias("vertex"))
                         .agg(F.min("b").alias("_m")).select("vertex", F.least("vertex", "_m").alias("root")), shrink=8)
    while True:
        near = (both.join(labels.withColumnRenamed("vertex", "b"), "b")
                .groupBy(F.col("a").alias("vertex")).agg(F.min("root").alias("_near")))
        moved = (labels.join(near, "vertex", "left")
                 .select("vertex", F.col("root").alias("_old"), F.least("root", "_near").alias("root")))
        target = moved.select(F.col("vertex").alias("root"), F.col("root").alias("_next"))
        used = moved.groupBy("root").agg(F.lit(1).alias("_one"))
        step = salted_left_join(moved, used.join(target, "root").drop("_one"), "root", F.col("vertex"))
        new = cut_lineage(step.select("vertex", "_old", F.least("root", "_next").alias("root")), shrink=8)
        changed = new.where("root <> _old").limit(1).count()
        labels = new.select("vertex", "root")
        if not changed:
            return labels
