"""Connected components of a large, possibly skewed graph, as Spark joins.

Contraction: in every round each node points to the neighbour (or itself) with
the smallest random priority, and edges are rewritten to the nodes pointed to.
A fixed fraction of the nodes of every component disappears per round in
expectation, whatever the shape (a long chain too), so the number of rounds is
logarithmic.  Each round's pointers and the remaining edges are written to the
shared checkpoint folder, which cuts the lineage.  Only the number of
remaining edges comes to the driver.

A node with very many edges is pre-aggregated (minimum per map task); the two
rewriting joins are plain equi-joins of one row per node with the edges, which
adaptive execution splits when a key is hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (src long, dst long, any direction, repeats and loops allowed)
    -> (node, root): one row per node that has an edge to another node; nodes
    are in the same component exactly if their ``root`` is equal."""
    left = materialize(edges.where("src <> dst").select(
        F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).distinct())
    history, seed = [], 0
    while not left.isEmpty():
        seed += 1
        both = left.union(left.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        rank = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(seed)).alias("priority"), F.col(c).alias("to"))
        best = both.groupBy("src").agg(F.min(rank("dst")).alias("near"))
        own = rank("src")
        points = materialize(best.select(F.col("src").alias("node"), F.least("near", own)["to"].alias("to")))
        history.append(points)
        hop = (left.join(points.withColumnRenamed("node", "src").withColumnRenamed("to", "a"), "src")
               .join(points.withColumnRenamed("node", "dst").withColumnRenamed("to", "b"), "dst"))
        left = materialize(hop.where("a <> b").select(F.least("a", "b").alias("src"), F.greatest("a", "b").alias("dst"))
                           .distinct())
    if not history:
        return left.select(F.col("src").alias("node"), F.col("dst").alias("root"))
    # from the last round back: where a node's pointer went in later rounds
    roots = history[-1]
    for points in reversed(history[:-1]):
        later = roots.select(F.col("node").alias("mid"), F.col("to").alias("end"))
        roots = (points.join(later, points["to"] == later["mid"], "left")
                 .select("node", F.coalesce("end", "to").alias("to")))
    return roots.withColumnRenamed("to", "root")
