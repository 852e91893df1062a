"""Surrogate keys without gaps that continue a table's keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shuffle_partitions


def numbered(df: DataFrame, by: list[str], out: str, start: Column | int = 0) -> DataFrame:
    """``df`` plus ``out``: start + 1, start + 2, ... in a fixed order of the
    columns ``by``, which should tell rows apart (rows alike in all of them get
    their numbers in any order).

    The order is that of a 64-bit hash of ``by``, then of ``by`` itself.  Equal
    parts of the hash's range hold about equal numbers of rows whatever the
    columns' values, so the first pass counts the rows of each part (at most
    four a shuffle partition: a bounded table, broadcast) and the second numbers
    them inside their part.  A number depends on the rows alone: a task that is
    run again, or a second run of the load, gives the same ones."""
    bits = max(5, (4 * shuffle_partitions(df.sparkSession) - 1).bit_length())
    rows = df.withColumn("_h", F.xxhash64(*by)).withColumn("_range", F.shiftright("_h", 64 - bits))
    counts = rows.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    nth = F.row_number().over(Window.partitionBy("_range").orderBy("_h", *by))
    first = F.lit(start) if isinstance(start, int) else start
    return (rows.withColumn("_nth", nth).join(F.broadcast(offsets), "_range")
            .withColumn(out, (first + F.col("_offset") + F.col("_nth")).cast("long")).drop("_h", "_range", "_nth", "_offset"))


def largest_key(table: DataFrame, key: str) -> Column:
    """The key a continued numbering starts after: 0 for an empty table."""
    return table.select(F.coalesce(F.max(key), F.lit(0)).cast("long")).scalar()
