"""Connected components by alternating large-star and small-star rounds.

Each round is a grouped minimum (combined before the shuffle) and an equi-join
whose skewed keys AQE splits, so a hub with a third of all edges never meets in
one task.  The edges of a round are written to the shared checkpoint folder;
only a row count and a checksum reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.llm.common import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    least = both.groupBy("src").agg(F.min("dst").alias("m")).select("src", F.least("src", "m").alias("m"))
    return (both.where("dst > src").join(least, "src")
            .select(F.col("dst").alias("src"), F.col("m").alias("dst")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("src").agg(F.min("dst").alias("m"))
    moved = edges.join(least, "src").where("dst > m").select(F.col("dst").alias("src"), F.col("m").alias("dst"))
    return moved.unionByName(least.select("src", F.col("m").alias("dst"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(src, dst) edges -> (node, component): every node that has an edge, with its component's smallest node.

    Null ends and self-loops are ignored; repeated edges change nothing; no
    edges give no rows.  Node ids may be of any orderable type.
    """
    current = materialize(
        edges.where("src IS NOT NULL AND dst IS NOT NULL AND src <> dst")
        .select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct(), "cc_edges")
    state = None
    while True:
        seen = current.agg(F.count("*"), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first()
        if seen == state or seen[0] == 0:
            break
        state = seen
        current = materialize(_small_star(_large_star(current)), "cc_edges")
    roots = current.select(F.col("dst").alias("node")).distinct()
    return (current.select(F.col("src").alias("node"), F.col("dst").alias("component"))
            .unionByName(roots.select("node", F.col("node").alias("component"))))
