"""Calendar dimension with three grains in one table.

Day rows (level 1) for every date in [start, end), a month row (level 2) on
each first of month and a year row (level 3) on each 1 January.  Ids follow
the reference's loop order: by date, then level.  The table's size depends
only on the date range (about 3,500 rows per decade), never on data volume,
so numbering it with one ordered window is bounded work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.dates import as_date


def calendar_from_bounds(bounds: DataFrame, start: Column, end_exclusive: Column) -> DataFrame:
    """``bounds`` is a one-row DataFrame; ``start``/``end_exclusive`` are
    DATE expressions over it (e.g. derived from min/max of a fact column)."""
    days = bounds.select(F.explode(F.sequence(start, F.date_sub(end_exclusive, 1),
                                              F.expr("INTERVAL 1 DAY"))).alias("d"))
    levels = days.select(F.explode(F.array(
        F.struct(F.col("d").alias("date_val"), F.lit(1).alias("date_lvl")),
        F.when(F.dayofmonth("d") == 1, F.struct(F.trunc("d", "MM").alias("date_val"), F.lit(2).alias("date_lvl"))),
        F.when((F.dayofmonth("d") == 1) & (F.month("d") == 1),
               F.struct(F.trunc("d", "YYYY").alias("date_val"), F.lit(3).alias("date_lvl"))),
    )).alias("r")).filter(F.col("r").isNotNull()).select("r.date_val", "r.date_lvl")
    numbered = levels.withColumn(
        "dim_date_id", F.row_number().over(Window.orderBy("date_val", "date_lvl")).cast("long"))
    return numbered.select("dim_date_id", "date_val", "date_lvl")


def calendar(spark: SparkSession, start, end_exclusive) -> DataFrame:
    """Calendar for literal bounds, e.g. ('2010-10-01', '2019-12-01')."""
    one = spark.range(1)
    return calendar_from_bounds(one, F.lit(as_date(start)), F.lit(as_date(end_exclusive)))


def calendar_covering(df: DataFrame, ts_col: str) -> DataFrame:
    """Calendar from the first of the month of ``min(ts_col)`` to the end of
    the month of ``max(ts_col)`` (one global aggregate, then a generator)."""
    bounds = df.agg(F.trunc(F.min(ts_col), "MM").alias("_start"),
                    F.add_months(F.trunc(F.max(ts_col), "MM"), 1).alias("_end"))
    return calendar_from_bounds(bounds, F.col("_start"), F.col("_end"))
