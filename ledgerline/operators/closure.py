"""Closure of a hierarchy: every (root, node) pair of the walks from chosen
nodes (H2), the root of each walk (H5) and the level in it (H3).

``interval_index`` gives each node its place in pre-order and the place after
its last descendant: the subtree of a node is one interval of places.  Both
come from one prefix sum over the paths of ids.  ``closure`` then joins
intervals with places.  The places are cut into blocks of ``BLOCK``; a root is
repeated once for each block that its interval meets, and rows join on the
block.  Only the two end blocks of a root hold nodes of others, so the rows
compared are at most the result's plus two blocks a root, and the rows sent
are a ``BLOCK``-th of the result plus two a root.  No table of all (ancestor,
descendant) pairs is made on the way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .rank import exclusive_prefix_sum
from .tree import MAX_ID

BLOCK = 64
CHUNK = 4096        # blocks a root is repeated over at once


def interval_index(walked: DataFrame) -> DataFrame:
    """``walked`` (from :func:`walk_from_roots`) -> its columns but
    ``path_ids``, plus ``pre`` (0 for the first node in pre-order) and ``stop``:
    the descendants of a node, itself included, are those with pre <= p < stop."""
    walked, ids = materialize(walked), F.col("path_ids")
    event = lambda key, weight, end: F.struct(key.alias("_key"), F.lit(weight).cast("long").alias("_w"), F.lit(end).alias("_is_end"))
    events = walked.select("id", F.explode(F.array(event(ids, 1, False), event(F.concat(ids, F.array(F.lit(MAX_ID))), 0, True))).alias("_e"))
    placed = exclusive_prefix_sum(events.select("id", "_e.*"), "_key", "_w", "_before")
    ends = placed.groupBy("id").agg(F.max(F.when(~F.col("_is_end"), F.col("_before"))).alias("pre"),
                                    F.max(F.when(F.col("_is_end"), F.col("_before"))).alias("stop"))
    return walked.drop("path_ids").join(ends, "id")


def closure(index: DataFrame, roots: DataFrame | None = None) -> DataFrame:
    """(root, node, level) for the walk from every node in ``roots`` (a column
    ``id``; all nodes of ``index`` by default): one row per descendant, the
    root itself included, at level 1.  Chosen ids that are no reachable node have no
    rows; an id chosen twice is one root."""
    chosen = index if roots is None else index.join(roots.select("id").distinct(), "id", "left_semi")
    spans = chosen.select(F.col("id").alias("root"), F.col("level").alias("root_level"), "pre", "stop",
                          F.expr(f"pre div {BLOCK}").alias("first"), F.expr(f"(stop - 1) div {BLOCK}").alias("last"))
    # two steps, so that no row holds a large array
    chunks = spans.withColumn("from", F.explode(F.expr(f"sequence(first, last, {CHUNK}L)")))
    pieces = chunks.select("root", "root_level", "pre", "stop", F.explode(
        F.expr(f"sequence(`from`, least(last, `from` + {CHUNK - 1}))")).alias("block"))
    places = index.select(F.col("id").alias("node"), "level", F.col("pre").alias("place"), F.expr(f"pre div {BLOCK}").alias("block"))
    inside = (F.col("place") >= F.col("pre")) & (F.col("place") < F.col("stop"))
    return pieces.join(places, "block").where(inside).select(
        "root", "node", (F.col("level") - F.col("root_level") + 1).alias("level"))
