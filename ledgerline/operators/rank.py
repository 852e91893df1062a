"""Ranking operators that stay distributed when one group is huge.

* :func:`top_k_by_rank` - ``RANK() OVER (PARTITION BY g ORDER BY v DESC) <= k``
  (W4 + W15) without sorting a whole group in one task.
* :func:`global_percent_rank` - ``PERCENT_RANK() OVER (ORDER BY v)`` (W11)
  without the single-task window Spark plans for an unpartitioned ORDER BY.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize, shuffle_partitions


def _null_safe_join_cond(left: DataFrame, right: DataFrame, cols: list[str], prefix: str) -> Column:
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[prefix + c]) for c in cols])


def top_k_by_rank(df: DataFrame, group_by: list[str], value: str, k: int,
                  descending: bool = True, rank_col: str = "rank",
                  salt_buckets: int | None = None) -> DataFrame:
    """Rows with ``rank() over (partition by group_by order by value) <= k``,
    ties kept (so a group may return more than ``k`` rows), with the rank.

    Plan, all steps bounded per task:
      1. distinct (group, value) with multiplicity - a partial aggregation, so
         a value repeated a billion times is one row after the map-side combine;
      2. salt distinct values into buckets by hash and keep each bucket's top-k
         distinct values - a hot group is split across ``salt_buckets`` tasks;
      3. per group, at most ``k * salt_buckets`` candidates: the rank of a value
         is 1 + the multiplicity of the strictly better candidates.  Every value
         better than a rank<=k value is itself a candidate, so this is exact;
      4. join the qualifying (group, value, rank) back to the rows.
    Rows with a NULL ``value`` never qualify (callers filter them, as the
    reports do with ``is not null``).
    """
    spark = df.sparkSession
    buckets = salt_buckets or max(8, shuffle_partitions(spark))
    order = F.col(value).desc() if descending else F.col(value).asc()
    rows = df.filter(F.col(value).isNotNull())

    distinct_values = rows.groupBy(*group_by, value).agg(F.count(F.lit(1)).alias("_mult"))
    salted = distinct_values.withColumn("_salt", F.pmod(F.xxhash64(F.col(value)), F.lit(buckets)))
    local = (salted
             .withColumn("_local", F.row_number().over(Window.partitionBy(*group_by, "_salt").orderBy(order)))
             .filter(F.col("_local") <= k)
             .drop("_local", "_salt"))
    better = Window.partitionBy(*group_by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    ranked = (local
              .withColumn(rank_col, F.coalesce(F.sum("_mult").over(better), F.lit(0)) + 1)
              .filter(F.col(rank_col) <= k)
              .drop("_mult"))
    prefix = "_r_"
    ranked = ranked.select(*[F.col(c).alias(prefix + c) for c in [*group_by, value]], rank_col)
    cond = _null_safe_join_cond(rows, ranked, group_by, prefix) & (rows[value] == ranked[prefix + value])
    out = rows.join(ranked, cond, "inner")
    return out.drop(*[prefix + c for c in [*group_by, value]])


SAMPLES = 64        # sampled keys a range


def range_bounds(df: DataFrame, order_col: str, ranges: int) -> Column:
    """The sorted keys that cut ``df`` into about equal ranges, as a scalar
    subquery: an array of at most ``ranges - 1`` keys.  They come from a sample
    of about ``SAMPLES`` keys a range, chosen by hash, so that every evaluation
    sees the same ones."""
    every = max(1, df.count() // (SAMPLES * ranges))
    sample = df.where(F.pmod(F.xxhash64(order_col), F.lit(every)) == 0)
    keys = sample.select(F.sort_array(F.collect_list(order_col)).alias("_keys"))
    cuts = F.transform(F.sequence(F.lit(1), F.lit(ranges - 1)), lambda i: F.get(
        "_keys", F.floor(i * F.size("_keys") / ranges).cast("int")))
    return keys.select(F.filter(cuts, lambda c: c.isNotNull())).scalar()


def with_range(df: DataFrame, key: str, bounds: Column, ranges: int, out: str) -> DataFrame:
    """``df`` plus ``out``: how many of the sorted ``bounds`` (fewer than
    ``ranges``) are at most the key; 0 for a null key.  A binary search with one
    projection a step: compiled, which a lambda over an array is not."""
    found = df.withColumn("_bounds", bounds).withColumn(out, F.lit(0))
    for k in reversed(range(max(1, ranges).bit_length())):
        above = F.get("_bounds", F.col(out) + ((1 << k) - 1)) <= F.col(key)         # null past the last bound
        found = found.withColumn(out, F.col(out) + F.when(above, F.lit(1 << k)).otherwise(F.lit(0)))
    return found.drop("_bounds")


def exclusive_prefix_sum(df: DataFrame, order_col: str, weight, out,
                         num_ranges: int | None = None) -> DataFrame:
    """Add ``out`` = sum of ``weight`` over all rows strictly before this one
    in the global order of ``order_col`` (values must be distinct).

    Rows are cut into ranges of the order column by sampled bounds
    (:func:`range_bounds`), so every range holds about 1/num_ranges of the
    rows, and the range is a function of the row.  Per-range sums become
    per-range offsets - one row per range, a table bounded by ``num_ranges``
    that is broadcast - and each row adds the running sum inside its own
    range.  The rows are exchanged once, and no step sorts the whole input in
    one task, unlike ``Window.orderBy`` without a partition.
    ``df`` is evaluated three times (sample, sums, result): callers pass rows
    of a written table.  ``weight`` and ``out`` may be lists of equal length
    (several sums in one pass).
    """
    weights = [weight] if isinstance(weight, str) else list(weight)
    outs = [out] if isinstance(out, str) else list(out)
    ranges = num_ranges or max(2, shuffle_partitions(df.sparkSession))
    ranged = with_range(df, order_col, range_bounds(df, order_col, ranges), ranges, "_range")
    per_range = ranged.groupBy("_range").agg(*[F.sum(w).alias(f"_range_sum{i}") for i, w in enumerate(weights)])
    before_range = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_range.select(
        "_range", *[F.coalesce(F.sum(f"_range_sum{i}").over(before_range), F.lit(0)).alias(f"_offset{i}")
                    for i in range(len(weights))])
    inside = Window.partitionBy("_range").orderBy(order_col).rowsBetween(Window.unboundedPreceding, -1)
    out_df = ranged
    for i, w in enumerate(weights):
        out_df = out_df.withColumn(f"_local{i}", F.coalesce(F.sum(w).over(inside), F.lit(0)))
    out_df = out_df.join(F.broadcast(offsets), "_range")
    for i, o in enumerate(outs):
        out_df = out_df.withColumn(o, F.col(f"_offset{i}") + F.col(f"_local{i}"))
    return out_df.drop("_range", *[f"_offset{i}" for i in range(len(weights))],
                       *[f"_local{i}" for i in range(len(weights))])


def group_medians(df: DataFrame, group: str, value: str, n: str, out: str) -> DataFrame:
    """(group, ``out``): the exact median per group of values with
    multiplicities (one row per group and value), NULL values left out.

    A ``median`` aggregate gathers all distinct values of a group in one
    task.  Here the multiplicities get one prefix sum over the global (group,
    value) order, which splits a hot group over ranges, and the one or two
    middle rows are picked by their position."""
    key = F.struct(F.col(group).alias("group"), F.col(value).alias("value"))
    rows = materialize(df.filter(F.col(value).isNotNull()).select(key.alias("_key"), F.col(n).alias("_n")))
    placed = exclusive_prefix_sum(rows, "_key", "_n", "_before").select(
        F.col("_key.group").alias("group"), F.col("_key.value").alias("value"), "_n", "_before")
    totals = placed.groupBy("group").agg(F.sum("_n").alias("_total"), F.min("_before").alias("_base")).withColumnRenamed(
        "group", "_group")
    first = F.col("_before") - F.col("_base")

    def at(position: Column) -> Column:
        return F.max(F.when((first <= position) & (position < first + F.col("_n")), F.col("value")))

    picked = placed.join(totals, placed["group"].eqNullSafe(totals["_group"])).groupBy("group").agg(
        at(F.expr("(_total - 1) div 2")).alias("_low"), at(F.expr("_total div 2")).alias("_high"))
    return picked.select("group", (F.col("_low") * 0.5 + F.col("_high") * 0.5).alias(out))


def global_percent_rank(df: DataFrame, value: str, out: str,
                        num_ranges: int | None = None) -> DataFrame:
    """``PERCENT_RANK() OVER (ORDER BY value)`` = (rank - 1) / (n - 1), with
    Oracle's ascending NULLS LAST (NULL values rank after every number).

    rank - 1 is the number of rows with a smaller value: distinct values
    with their multiplicity (a partial aggregation, so a value repeated a
    billion times is one row) get an :func:`exclusive_prefix_sum` of the
    multiplicities, and the result is joined back by value.
    """
    n_rows = df.select(F.count(F.lit(1))).scalar()
    non_null_rows = df.select(F.count(F.col(value))).scalar()
    distinct_values = materialize(df.filter(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("_mult")))
    below = (exclusive_prefix_sum(distinct_values, value, "_mult", "_below", num_ranges)
             .select(F.col(value).alias("_pr_value"), "_below"))
    joined = df.join(below, df[value] == below["_pr_value"], "left")
    smaller = F.when(F.col(value).isNull(), non_null_rows).otherwise(F.col("_below"))
    pct = F.when(n_rows > 1, smaller.cast("double") / (n_rows - 1).cast("double")).otherwise(F.lit(0.0))
    return joined.withColumn(out, pct).drop("_pr_value", "_below")
