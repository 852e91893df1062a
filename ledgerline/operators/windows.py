"""Window-shaped operators rewritten so no partition key becomes one task.

A window ``PARTITION BY k`` sorts every row of key ``k`` inside one task; with
one key holding a third of the rows that task holds a third of the data.  The
operators here compute the per-key value with a partial (map-side combined)
aggregation and join it back, so a hot key costs one row after the combine,
and the join back is an equi-join that AQE can split when the key is skewed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arith import safe_ratio
from ..session import materialize


def _keys_equal(left: DataFrame, right: DataFrame, keys: list[str], prefix: str) -> Column:
    # NULL keys form one group in a window partition; keep that with <=>.
    return reduce(lambda a, b: a & b,
                  [left[k].eqNullSafe(right[f"{prefix}{k}"]) for k in keys])


def attach_group_agg(df: DataFrame, keys: list[str], aggs: dict[str, Column],
                     bounded_groups: bool = False) -> DataFrame:
    """Add per-group aggregates to every row (``agg(x) OVER (PARTITION BY keys)``).

    ``bounded_groups=True`` states the number of groups is bounded by a
    parameter (months of a report, years), which licenses a broadcast hint;
    otherwise AQE chooses broadcast from the measured size at run time.
    """
    if not keys:
        # OVER (): one scalar per aggregate, evaluated as a scalar subquery
        # (no single-partition window, no cross join).
        out = df
        for name, agg in aggs.items():
            out = out.withColumn(name, df.select(agg).scalar())
        return out
    prefix = "_g_"
    grouped = df.groupBy(*keys).agg(*[a.alias(n) for n, a in aggs.items()])
    grouped = grouped.select(*[F.col(k).alias(prefix + k) for k in keys], *aggs.keys())
    if bounded_groups:
        grouped = F.broadcast(grouped)
    joined = df.join(grouped, _keys_equal(df, grouped, keys, prefix), "left")
    return joined.drop(*[prefix + k for k in keys])


def ratio_to_report(df: DataFrame, value: str, partition_by: list[str], out: str,
                    bounded_groups: bool = False) -> DataFrame:
    """Oracle ``RATIO_TO_REPORT(value) OVER (PARTITION BY ...)`` (W5): the
    row's share of its partition total; a zero total gives NULL."""
    total = "_rtr_total"
    with_total = attach_group_agg(df, partition_by, {total: F.sum(value)}, bounded_groups)
    return with_total.withColumn(out, safe_ratio(F.col(value), F.col(total))).drop(total)


def argmax_rows(df: DataFrame, group_by: list[str], value: str,
                bounded_groups: bool = False) -> DataFrame:
    """Rows whose ``value`` equals the maximum of their group, ties kept
    (A13, P9, W3 + filter, W4 + ``rank = 1``).  NULL values never match."""
    if not group_by:
        return df.filter(F.col(value) == df.select(F.max(value)).scalar())
    prefix = "_m_"
    maxes = df.groupBy(*group_by).agg(F.max(value).alias("_max_value"))
    maxes = maxes.select(*[F.col(k).alias(prefix + k) for k in group_by], "_max_value")
    if bounded_groups:
        maxes = F.broadcast(maxes)
    cond = _keys_equal(df, maxes, group_by, prefix) & (df[value] == maxes["_max_value"])
    return df.join(maxes, cond, "left_semi")


def trailing_range_sum(df: DataFrame, keys: list[str], order: str, value: str, lower: Column,
                       out: str) -> DataFrame:
    """``SUM(value) OVER (PARTITION BY keys ORDER BY order RANGE BETWEEN
    <lower> PRECEDING AND CURRENT ROW)`` for a DataFrame with one row per
    (keys, order) - e.g. after summing by (key, timestamp); ``lower`` is the
    frame's lower bound as an expression of ``order`` (``order - INTERVAL
    1 MONTH``).  Returns (keys, order, out); ``out`` is NULL when the frame
    holds no non-NULL value.  The input is read once.

    A window would sort all rows of a key in one task.  Instead every row
    contributes its value at key (keys, order) to one global order, and two
    zero-weight probes per row read the prefix sums just after (keys, order)
    and just before (keys, lower): the frame sum is their difference.  The
    prefix sums are range-partitioned on the full key, so a hot key is split
    across ranges.
    """
    from .rank import exclusive_prefix_sum
    w = F.coalesce(F.col(value), F.lit(0)).cast(df.schema[value].dataType)
    c = F.col(value).isNotNull().cast("long")
    zero_w = F.lit(0).cast(df.schema[value].dataType)

    def key(at: Column, kind: int) -> Column:
        return F.struct(*[F.col(k) for k in keys], at.alias("_at"), F.lit(kind).alias("_kind"),
                        F.col(order).alias("_row"))

    rows = materialize(df.select(*keys, order, value, lower.alias("_lower")))
    # one pass over the input: each row emits its value and its two probes
    events = rows.select(F.explode(F.array(
        F.struct(key(F.col(order), 0).alias("_key"), w.alias("_w"), c.alias("_c"), F.lit(0).alias("_probe")),
        F.struct(key(F.col(order), 1).alias("_key"), zero_w.alias("_w"), F.lit(0).cast("long").alias("_c"),
                 F.lit(1).alias("_probe")),
        F.struct(key(F.col("_lower"), -1).alias("_key"), zero_w.alias("_w"), F.lit(0).cast("long").alias("_c"),
                 F.lit(-1).alias("_probe")))).alias("_e")).select("_e.*")
    prefixed = exclusive_prefix_sum(events, "_key", ["_w", "_c"], ["_pw", "_pc"])
    probe_cols = [F.col(f"_key.{k}").alias(k) for k in keys] + [F.col("_key._row").alias(order)]
    upper = prefixed.filter(F.col("_probe") == 1).select(*probe_cols, "_pw", "_pc")
    below = prefixed.filter(F.col("_probe") == -1).select(
        *[F.col(f"_key.{k}").alias(f"_b_{k}") for k in keys], F.col("_key._row").alias("_b_row"),
        F.col("_pw").alias("_bw"), F.col("_pc").alias("_bc"))
    cond = reduce(lambda a, b: a & b, [upper[k].eqNullSafe(below[f"_b_{k}"]) for k in keys]
                  + [upper[order] == below["_b_row"]])
    sums = upper.join(below, cond).select(
        *keys, order,
        F.when(F.col("_pc") - F.col("_bc") > 0, F.col("_pw") - F.col("_bw")).alias(out))
    return sums
