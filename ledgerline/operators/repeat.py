"""Rows repeated by a count column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STEP = 16       # bits of the count handled by one explode: arrays of 65,536 at most


def repeat_rows(df: DataFrame, count: str) -> DataFrame:
    """Every row ``count`` times (a bigint, 0 to 2^48), without the column.

    The count is taken apart into three levels of at most 2^16 pieces, and
    the pieces of the upper two are dealt to tasks before the last level
    makes the rows, so no row holds a large array and one large count is not
    left to one task."""
    last = F.col(count) - 1
    top = df.filter(F.col(count) > 0).withColumn("_a", F.explode(F.sequence(
        F.lit(0).cast("long"), F.shiftright(last, 2 * STEP))))
    left = last - F.shiftleft(F.col("_a"), 2 * STEP)
    mid = top.withColumn("_b", F.explode(F.sequence(F.lit(0).cast("long"), F.least(
        F.lit((1 << STEP) - 1).cast("long"), F.shiftright(left, STEP)))))
    rest = left - F.shiftleft(F.col("_b"), STEP)
    return (mid.repartition("_a", "_b", *df.columns)
            .withColumn("_c", F.explode(F.sequence(F.lit(0).cast("long"), F.least(F.lit((1 << STEP) - 1).cast("long"), rest))))
            .select(*[c for c in df.columns if c != count]))
