"""Adjacency-list hierarchy operators (H1-H7) in O(log depth) Spark rounds.

``walk_from_roots`` is START WITH parent IS NULL CONNECT BY PRIOR id =
parent_id by pointer jumping over the nodes that have children: each keeps a
pointer to an ancestor; each round joins the nodes whose pointer is still open
with their pointer's row, so the distance covered doubles per round.  Nodes
that reached the top, or a parent that is no node, are set aside and written
once; a round only joins and writes the open ones (finished nodes would all
meet on one NULL key).  Nobody points to a leaf: leaves stay out of the rounds
and take the path of their parent at the end, in one join that deals the leaves
of a large directory over the slots.  Pointers are compacted first: the
children of one directory share a pointer, which is resolved once for each of
a fixed number of slots (a hash of the child's id), and rows then join on
(pointer, slot).  A directory that holds most of all nodes is thus dealt over
all slots.

The first pass jumps on (id, ancestor) alone.  A node still open after
log2(nodes) + 1 rounds is on or under a cycle, and :class:`CycleError` is
raised (CONNECT BY without NOCYCLE fails as well) before any path exists.  The
second pass, known to end, carries the path segments.

Every round is a table in the shared checkpoint folder, read back: a round
joins the previous one with itself, so without the cut the plan would double
per round; with it a lost executor recomputes one join.

``subtree_totals`` uses the path of ancestor ids as a pre-order key: the
subtree of x is exactly the keys in [path(x), path(x) ++ [MAX]), so its
total is the difference of two global prefix sums.  Leaves are summed into their
parents first and have no place in the order.  A constant number of
jobs, and no (ancestor, descendant) pairs are ever materialised.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, shuffle_partitions
from .rank import exclusive_prefix_sum

MAX_ID = 9223372036854775807   # sorts after every real id in a pre-order key


class CycleError(ValueError):
    """The hierarchy has a cycle."""


def walk_from_roots(nodes: DataFrame, sep: str = "\\", carry: tuple[str, ...] = ()) -> DataFrame:
    """(id, parent_id, level, path, path_ids, leaf) for every node reachable from a
    root (parent_id NULL).  ``path`` is SYS_CONNECT_BY_PATH(name, sep);
    ``path_ids`` the ids from the root down to the node; ``level`` the
    LEVEL pseudo-column; ``leaf`` whether the node has no children.  Nodes under
    a missing parent are not reachable and are not returned (D26).  Ids must be
    unique (see ``key_violations``).  ``carry`` names node columns passed through
    to the result.  The leaves are joined to their parents whenever the result is
    read: a caller that reads them often writes them first."""
    carry, slots = list(carry), max(8, shuffle_partitions(nodes.sparkSession))
    edges = nodes.select("id", "parent_id", "name", *carry)
    parents = edges.where(F.col("parent_id").isNotNull()).groupBy(F.col("parent_id").alias("_parent")).agg(
        F.count(F.lit(1)).alias("_children"))
    start = materialize(edges.join(parents, edges.id == parents._parent, "left").drop("_parent"))
    inner = materialize(_dealt(start.where(F.col("_children").isNotNull()), slots))
    leaves = start.where(F.col("_children").isNull()).drop("_children")

    pointers = inner.select("id", F.col("parent_id").alias("anc"), "_slot")
    rounds = math.ceil(math.log2(max(2, pointers.count()))) + 1
    left = _jump(pointers, lambda low, up: {}, rounds)[1]
    if left is not None:
        stuck = left.select("id").limit(5).collect()
        raise CycleError("hierarchy has a cycle; e.g. node ids " + ", ".join(str(r.id) for r in stuck))

    own = F.concat(F.lit(sep), F.coalesce(F.col("name"), F.lit("")))
    segments = inner.select(
        "id", F.col("parent_id").alias("anc"), "_slot",
        F.when(F.col("parent_id").isNull(), F.lit(True)).alias("rooted"),       # null: not known yet, or under a missing parent
        own.alias("path"), F.array(F.col("id")).alias("path_ids"), F.lit(1).alias("level"), "parent_id", "_children", *carry)
    walked, _ = _jump(segments, lambda low, up: {
        "rooted": up("rooted"), "path": F.concat(up("path"), low("path")),
        "path_ids": F.concat(up("path_ids"), low("path_ids")), "level": up("level") + low("level")}, rounds)
    above = walked.filter(F.col("rooted"))

    # at most ``slots`` directories have more than a slot's share of the nodes; their leaves are dealt over all slots
    share = start.count() // slots
    large = inner.where(F.col("_children") > share).select(F.col("id").alias("_large"))
    heads = above.select(F.col("id").alias("_to"), *[F.col(c).alias("_" + c) for c in ("level", "path", "path_ids")], F.explode(
        F.when(F.col("_children") > share, F.sequence(F.lit(0), F.lit(slots - 1))).otherwise(F.array(F.lit(0)))).alias("_at"))
    under = leaves.where(F.col("parent_id").isNotNull()).join(F.broadcast(large), F.col("parent_id") == F.col("_large"), "left").withColumn(
        "_slot", F.when(F.col("_large").isNotNull(), F.pmod(F.xxhash64("id"), F.lit(slots)).cast("int")).otherwise(F.lit(0)))
    hung = under.join(heads, (F.col("parent_id") == F.col("_to")) & (F.col("_slot") == F.col("_at"))).select(
        "id", "parent_id", (F.col("_level") + 1).alias("level"), F.concat("_path", own).alias("path"),
        F.concat("_path_ids", F.array(F.col("id"))).alias("path_ids"), F.lit(True).alias("leaf"), *carry)
    alone = leaves.where(F.col("parent_id").isNull()).select(
        "id", "parent_id", F.lit(1).alias("level"), own.alias("path"), F.array(F.col("id")).alias("path_ids"),
        F.lit(True).alias("leaf"), *carry)
    return above.select("id", "parent_id", "level", "path", "path_ids", F.lit(False).alias("leaf"), *carry).unionByName(
        alone).unionByName(hung)


def _dealt(rows: DataFrame, slots: int) -> DataFrame:
    return rows.withColumn("_slot", F.pmod(F.xxhash64("id"), F.lit(slots)))


def _jump(rows: DataFrame, combine: Callable, rounds: int) -> tuple[DataFrame, DataFrame | None]:
    """Jump pointers until none is open, ``rounds`` times at most: (finished
    rows, open rows or None).  ``combine(low, up)`` gives the columns that a
    row takes from its pointer's row (null where that is no row: the row is then
    finished); the others stay its own.  ``_slot`` deals the rows."""
    done, open_ = [rows.filter(F.col("anc").isNull())], rows.filter(F.col("anc").isNotNull())
    taken = [c for c in combine(F.col, F.col)]
    for _ in range(rounds):
        if open_.isEmpty():
            return reduce(DataFrame.unionByName, done), None
        above = reduce(DataFrame.unionByName, [*done, open_]).select(
            F.col("id").alias("_id"), F.col("anc").alias("_anc"), *[F.col(c).alias("_" + c) for c in taken])
        new = combine(F.col, lambda c: F.col("_" + c))
        # a pointer is resolved once for each slot that holds it, then spread back over the slot's rows
        pointers = open_.groupBy(F.col("anc").alias("_to"), F.col("_slot").alias("_at")).agg(F.count(F.lit(1)).alias("_n")).drop("_n")
        resolved = pointers.join(above, F.col("_to") == F.col("_id")).drop("_id")
        step = materialize(open_.join(resolved, (F.col("anc") == F.col("_to")) & (F.col("_slot") == F.col("_at")), "left").select(
            "id", F.col("_anc").alias("anc"), *[new[c].alias(c) if c in new else F.col(c)
                                                for c in rows.columns if c not in ("id", "anc")]))
        done.append(step.filter(F.col("anc").isNull()))
        open_ = step.filter(F.col("anc").isNotNull())
    if open_.isEmpty():
        return reduce(DataFrame.unionByName, done), None
    return reduce(DataFrame.unionByName, done), open_


def subtree_totals(walked: DataFrame, value: str, out: str) -> DataFrame:
    """``walked`` (from :func:`walk_from_roots`, carrying ``value``) plus
    ``out``: the sum of ``value`` (NULL as 0) over each node's subtree,
    itself included.  A leaf's total is its value.  The leaves of a directory are
    one sum in it, and only (key, weight, id) of directories go through the
    prefix sum; their other columns are joined to the totals once."""
    event = lambda key, weight, end: F.struct(key.alias("_key"), weight.alias("_w"), F.lit(end).alias("_is_end"))
    own, ids = F.coalesce(F.col(value), F.lit(0)).cast("long"), F.col("path_ids")
    inner = walked.where(~F.col("leaf"))
    leaves = materialize(walked.where(F.col("leaf")).drop("path_ids"))
    below = leaves.groupBy(F.col("parent_id").alias("_parent")).agg(F.sum(own).alias("_below"))
    weights = materialize(inner.join(below, inner.id == below._parent, "left").select(
        "id", "path_ids", (own + F.coalesce(F.col("_below"), F.lit(0))).alias("_weight")))
    events = weights.select("id", F.explode(F.array(
        event(ids, F.col("_weight"), False),
        event(F.concat(ids, F.array(F.lit(MAX_ID))), F.lit(0).cast("long"), True))).alias("_e")).select("id", "_e.*")
    prefix = exclusive_prefix_sum(events, "_key", "_w", "_before")
    totals = prefix.groupBy("id").agg(F.sum(F.when(F.col("_is_end"), F.col("_before")).otherwise(-F.col("_before"))).alias(out))
    return inner.drop("path_ids").join(totals, "id").unionByName(leaves.withColumn(out, own))
