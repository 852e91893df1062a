"""CUBE aggregation (A9) with the grouping id the reference lacks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def cube_agg(df: DataFrame, keys: list[str], aggs: dict[str, Column]) -> DataFrame:
    """All 2^n subtotals of ``keys``.  Spark expands each row once per
    grouping set before a partial aggregation, so the shuffle carries at most
    (groups x 2^n) partial rows per task, whatever the skew.  ``grouping_id``
    tells a subtotal NULL from a NULL key."""
    return df.cube(*keys).agg(*[a.alias(n) for n, a in aggs.items()],
                              F.grouping_id().cast("long").alias("grouping_id"))


def combined_rounded_avg(sum_col: str, count_col: str) -> Column:
    """AVG stored into an integer column, over pre-aggregated parts: sum of
    sums / sum of counts (NULL when no non-NULL value), rounded half away
    from zero as an Oracle insert does (a bare cast would truncate)."""
    avg = F.try_divide(F.sum(sum_col).cast("double"), F.sum(count_col).cast("double"))
    return F.round(avg, 0).cast("long")
