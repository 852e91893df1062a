"""Analytic sales reports.

Defaults are the reference's own dates; the registered queries pass dates
shifted onto the driver tables.  Every report filters the fact first (the
date predicate reaches the orders scan as a pushed filter), aggregates by
ids with a partial aggregation, and only then attaches names and windows, so
windows run over group-sized data whose partitions are bounded by the
report's period (months, years), never by the number of sales of one key.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.arith import safe_ratio
from ..functions.dates import as_date, month_index, month_series, trunc_month, trunc_quarter, trunc_year, ts_lit
from ..functions.text import oracle_concat
from ..operators.densify import densify
from ..operators.rank import global_percent_rank, group_medians, top_k_by_rank
from ..operators.repeat import repeat_rows
from ..operators.windows import argmax_rows, ratio_to_report, trailing_range_sum
from ..session import materialize
from .sales_fact import attach_manager, attach_office, attach_product, in_period, sale_lines

MANAGER_NAMES = ["manager_id", "manager_first_name", "manager_last_name"]


def _money(c) -> F.Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


# --------------------------------------------------------------- R23 ----
def best_manager_bonus(t, grid_start="2013-10-01", n_months=15, period_start="2013-10-01",
                       period_end="2014-12-31", report_from="2014-01-01",
                       rate=Decimal("0.05")) -> DataFrame:
    """Monthly bonus = rate x the best sales over the three previous months.

    Plan: one pass over the view's lines (lineitem LEFT JOIN orders) with a
    partial aggregation per (manager, month), the period applied as a
    conditional sum - so the same join yields both the manager list and the
    monthly sums.  The grid (every manager x ``n_months`` months, generated
    per row: no cross join) and the monthly sums are unioned and meet in the
    one shuffle the RANGE window needs (per manager: <= 2 x n_months rows);
    this replaces the grid LEFT JOIN + GROUP BY of the original, because a
    grid cell's window value is the same whether its month's sum sits on the
    cell or on a sibling row.  The per-month best is a grouped max joined
    back (ties kept)."""
    months = month_series(grid_start, n_months)
    lines = sale_lines(t)
    # group-sized (managers x months), read by the manager list and the sums: written once
    monthly = materialize(lines.groupBy("manager_id", trunc_month("sale_date").alias("sale_month"))
                    .agg(F.sum(F.when(in_period("sale_date", period_start, period_end),
                                      F.col("sale_amount"))).alias("s_sale_amount")))
    managers = attach_manager(monthly.select("manager_id").distinct(), t).select(*MANAGER_NAMES)
    grid = densify(managers, months, "sale_month").select(
        *MANAGER_NAMES, "sale_month", F.lit(None).cast("decimal(38,4)").alias("s_sale_amount"),
        F.lit(True).alias("_cell"))
    # the equi-join of the original never matches a NULL manager
    sums = monthly.filter(F.col("manager_id").isNotNull() & F.col("s_sale_amount").isNotNull()
                          & F.array_contains(months, F.col("sale_month"))).select(
        "manager_id", F.lit(None).cast("string").alias("manager_first_name"),
        F.lit(None).cast("string").alias("manager_last_name"), "sale_month", "s_sale_amount",
        F.lit(False).alias("_cell"))
    prev3 = (Window.partitionBy("manager_id").orderBy(month_index("sale_month")).rangeBetween(-3, -1))
    scored = (grid.unionByName(sums)
              .withColumn("prev_sale_amount", F.sum("s_sale_amount").over(prev3))
              .filter(F.col("_cell") & (F.col("sale_month") >= F.lit(as_date(report_from)))))
    best = argmax_rows(scored, ["sale_month"], "prev_sale_amount", bounded_groups=True)
    return best.select(*MANAGER_NAMES, "sale_month",
                       _money(F.col("prev_sale_amount") * F.lit(rate)).alias("bonus"))


# --------------------------------------------------------------- R24 ----
def best_manager_bonus_first_version(t, after="2013-09-30", before="2015-01-01",
                                     month_after="2013-12-31", month_before="2015-01-01",
                                     rate=Decimal("0.05")) -> DataFrame:
    """The author's first version (as written, D14): per sale, the sum over
    the trailing month of that manager's sales (RANGE on the raw date, peers
    included); its max per calendar month; the 3-previous-months sum of those;
    rank 1 per month.  Sales are first summed per (manager, timestamp): all
    peers share one frame value, so the max per month is unchanged."""
    lines = sale_lines(t).filter((F.col("sale_date") > ts_lit(after)) & (F.col("sale_date") < ts_lit(before)))
    per_ts = lines.groupBy("manager_id", "sale_date").agg(F.sum("sale_amount").alias("ts_amount"))
    trailing = trailing_range_sum(per_ts, ["manager_id"], "sale_date", "ts_amount",
                                  F.col("sale_date") - F.expr("INTERVAL 1 MONTH"), "sum_per_month")
    monthly = (trailing.groupBy("manager_id", trunc_month("sale_date").alias("month"))
               .agg(F.max("sum_per_month").alias("sum_per_month")))
    prev3 = Window.partitionBy("manager_id").orderBy(month_index("month")).rangeBetween(-3, -1)
    scored = (monthly.withColumn("prev_three_months_amount", F.sum("sum_per_month").over(prev3))
              .filter(F.col("prev_three_months_amount").isNotNull()
                      & (F.col("month") > F.lit(as_date(month_after)))
                      & (F.col("month") < F.lit(as_date(month_before)))))
    best = argmax_rows(scored, ["month"], "prev_three_months_amount", bounded_groups=True)
    return (attach_manager(best, t)
            .select(*MANAGER_NAMES, "month",
                    _money(F.col("sum_per_month") * F.lit(rate)).alias("bonus"),
                    _money("prev_three_months_amount").alias("prev_three_months_amount"),
                    F.lit(1).alias("bonus_rank"))
            .orderBy(F.col("month").asc_nulls_last(), "manager_id"))


# --------------------------------------------------------------- R25 ----
def office_year_share(t, start="2013-01-01", end="2014-12-31", n_months=24) -> DataFrame:
    """Each office's share of each year's sales, zero-filled for years
    without sales, and the office's average share over the period."""
    lines = sale_lines(t).filter(in_period("sale_date", start, end))
    per_manager = (lines.groupBy("manager_id", trunc_year("sale_date").alias("sale_year"))
                   .agg(F.sum("sale_amount").alias("amount")))
    # offices x years: tiny; read by the office list, the grid join and the year totals
    per_office = materialize(attach_manager(per_manager, t)
                             .groupBy("office_id", "sale_year").agg(F.sum("amount").alias("amount")))
    offices = attach_office(per_office.filter(F.col("office_id").isNotNull())
                            .select("office_id").distinct(), t) \
        .select("office_id", "office_name", "city_name", "country")
    years = F.array_distinct(F.transform(month_series(start, n_months), lambda m: F.trunc(m, "YYYY")))
    grid = densify(offices, years, "sale_year")
    amounts = (grid.join(per_office, ["office_id", "sale_year"], "left")
               .withColumn("year_amount", F.coalesce(F.col("amount"), F.lit(0).cast("decimal(38,4)")))
               .drop("amount"))
    shared = ratio_to_report(amounts, "year_amount", ["sale_year"], "year_ratio_amount",
                             bounded_groups=True)
    office_keys = ["office_id", "office_name", "city_name", "country"]
    both_years = (Window.partitionBy(*office_keys).orderBy(F.year("sale_year"))
                  .rangeBetween(-1, Window.unboundedFollowing))
    return (shared.select(*office_keys, "sale_year", _money("year_amount").alias("year_amount"), "year_ratio_amount",
                          F.avg("year_ratio_amount").over(both_years).alias("avg_year_ratio"))
            .orderBy(F.col("avg_year_ratio").asc_nulls_last(), "office_id", "sale_year"))


# --------------------------------------------------------------- R26 ----
def product_growth(t, start="2013-12-01", end="2014-06-30", first_month="2013-12-01",
                   filter_after_lag: bool = False) -> DataFrame:
    """Median month-over-previous-month sales ratio per product.  As written
    (D9): months not after ``first_month`` are removed before LAG, so the
    first reported month never gets a ratio; ``filter_after_lag=True`` is the
    repaired variant that lets it compare with ``first_month``.  LAG takes
    the previous row even across a month without sales (D10)."""
    monthly = (sale_lines(t).filter(in_period("sale_date", start, end))
               .groupBy("product_id", trunc_month("sale_date").alias("month"))
               .agg(F.sum("sale_amount").alias("month_amount")))
    after_first = F.col("month") > F.lit(as_date(first_month))
    if not filter_after_lag:
        monthly = monthly.filter(after_first)
    prev = F.lag("month_amount").over(Window.partitionBy("product_id").orderBy("month"))
    trend = monthly.withColumn("trend", safe_ratio(F.col("month_amount"), prev))
    if filter_after_lag:
        trend = trend.filter(after_first)
    trend = trend.filter(F.col("trend").isNotNull())
    medians = trend.groupBy("product_id").agg(F.median("trend").alias("trend_median"))
    return (attach_product(medians, t).select("product_id", "product_name", "trend_median")
            .orderBy(F.col("trend_median").desc_nulls_first(), "product_id"))


# --------------------------------------------------------------- R27 ----
def running_totals(t, start="2014-01-01", end="2014-12-31") -> DataFrame:
    """Monthly sales with running totals through the month and through the
    month's quarter (RANGE frames: peers of the quarter are included).  The
    windows have no partition, but run over <= 12 aggregated months."""
    monthly = (sale_lines(t).filter(in_period("sale_date", start, end))
               .groupBy(trunc_month("sale_date").alias("sale_month"),
                        trunc_quarter("sale_date").alias("sale_quarter"))
               .agg(F.sum("sale_amount").alias("month_sum")))
    upto = Window.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return monthly.select(
        "sale_month", "sale_quarter", _money("month_sum").alias("month_sum"),
        _money(F.sum("month_sum").over(upto.orderBy("sale_month"))).alias("cumul_month_sum"),
        _money(F.sum("month_sum").over(upto.orderBy("sale_quarter"))).alias("cumul_quart_sum")
    ).orderBy(F.col("sale_month").asc_nulls_last())


# --------------------------------------------------------------- R28 ----
def price_tail_share(t, start="2014-01-01", end="2014-12-31", low=0.1, high=0.9) -> DataFrame:
    """Share of total sales of products whose median price lies in the
    cheapest or dearest tail (percent_rank outside [low, high])."""
    # one row per (product, price): the only pass over the fact
    prices = materialize(sale_lines(t).filter(in_period("sale_date", start, end))
                         .groupBy("product_id", F.col("sale_price").cast("double").alias("price"))
                         .agg(F.count(F.lit(1)).alias("n"), F.sum("sale_amount").alias("amount")))
    sums = prices.groupBy("product_id").agg(F.sum("amount").alias("sale_amount_product"))
    medians = group_medians(prices, "product_id", "price", "n", "med_sale_price")
    # product-sized; the rank, its counts and the total all read it
    per_product = materialize(sums.join(medians, sums["product_id"].eqNullSafe(medians["group"]), "left").drop("group"))
    ranked = global_percent_rank(per_product, "med_sale_price", "price_percent_rank")
    total = per_product.select(F.sum("sale_amount_product")).scalar()
    out = (ranked.filter(~F.col("price_percent_rank").between(low, high))
           .withColumn("total_sale_amount", total))
    return attach_product(out, t).select(
        "product_id", "product_name",
        _money("sale_amount_product").alias("sale_amount_product"),
        _money("total_sale_amount").alias("total_sale_amount"),
        safe_ratio("sale_amount_product", "total_sale_amount").alias("percent_from_total_amount"),
        "price_percent_rank")


# --------------------------------------------------------------- R29 ----
def top_managers_by_country(t, start="2014-01-01", end="2014-12-31", k=3) -> DataFrame:
    """Per country, the names of the managers ranked <= k by yearly sales,
    in rank order (ties share a rank, so a list may hold more than k names;
    equal ranks are listed by manager id, D13)."""
    # manager-sized; the candidates and the rows they are joined back to both read it
    per_manager = materialize(sale_lines(t).filter(in_period("sale_date", start, end))
                              .groupBy("manager_id").agg(F.sum("sale_amount").alias("year_sale_amount")))
    located = attach_office(attach_manager(per_manager, t), t).filter(F.col("country").isNotNull())
    ranked = top_k_by_rank(located, ["country"], "year_sale_amount", k, rank_col="bonus_rank")
    named = ranked.withColumn("name", oracle_concat("manager_last_name", F.lit(" "), "manager_first_name"))
    return named.groupBy("country").agg(F.expr(
        "listagg(name, ', ') WITHIN GROUP (ORDER BY bonus_rank, manager_id)").alias("managers_to_bonus"))


# --------------------------------------------------------------- R30 ----
def monthly_price_extremes(t, start="2014-01-01", end="2014-12-31",
                           distinct_products: bool = False) -> DataFrame:
    """Dearest and cheapest product sold in each month.

    As written (D12) the report pairs every line at the top price with every
    line at the bottom price of the month: each product pair is repeated
    count_h x count_l times (:func:`monthly_price_pairs`, a bigint), in
    bounded chunks spread over tasks; ``distinct_products=True`` is the
    repaired variant that returns each product pair once."""
    pairs = monthly_price_pairs(t, start, end)
    pairs = pairs.drop("n_pairs") if distinct_products else repeat_rows(pairs, "n_pairs")
    return pairs.orderBy(F.col("month").asc_nulls_last(), "dearest_product_id", "cheapest_product_id")


def monthly_price_pairs(t, start="2014-01-01", end="2014-12-31") -> DataFrame:
    """Product pairs (dearest, cheapest) of each month with the number of line
    pairs.  Lines are collapsed to (month, price, product, count) in the only
    pass over the fact; extremes and both sides of the pairs are read from
    that.  A month's extremes are bounded by the report's months: broadcast."""
    prices = materialize(sale_lines(t).filter(in_period("sale_date", start, end))
                         .groupBy(trunc_month("sale_date").alias("month"), "sale_price", "product_id")
                         .agg(F.count(F.lit(1)).alias("n")))
    extremes = F.broadcast(prices.groupBy("month").agg(F.max("sale_price").alias("highest_price"),
                                                       F.min("sale_price").alias("lowest_price")))
    at = prices.join(extremes, "month")
    high = at.filter(F.col("sale_price") == F.col("highest_price")).select(
        "month", "highest_price", F.col("product_id").alias("dearest_product_id"), F.col("n").alias("n_high"))
    low = at.filter(F.col("sale_price") == F.col("lowest_price")).select(
        "month", "lowest_price", F.col("product_id").alias("cheapest_product_id"), F.col("n").alias("n_low"))
    names = t["product"].select("product_id", "product_name")
    named = (high.join(low, "month")
             .join(names.toDF("dearest_product_id", "dearest_product_name"), "dearest_product_id", "left")
             .join(names.toDF("cheapest_product_id", "cheapest_product_name"), "cheapest_product_id", "left"))
    return named.select("dearest_product_id", "dearest_product_name", _money("highest_price").alias("highest_price"),
                        "cheapest_product_id", "cheapest_product_name", _money("lowest_price").alias("lowest_price"),
                        "month", (F.col("n_high") * F.col("n_low")).alias("n_pairs"))


# --------------------------------------------------------------- R31 ----
def monthly_profit(t, start="2014-01-01", end="2014-12-31", base_salary=30000,
                   rate=Decimal("0.05"), keep_manager: bool = False) -> DataFrame:
    """Sales/11 minus salaries (base + rate x own sales) per month.

    As written (D11) the salaries are de-duplicated on (month, sales, salary),
    so two managers with the same salary in a month count once;
    ``keep_manager=True`` is the repaired variant."""
    # managers x months; read by the month totals and by the salaries
    per_manager = materialize(sale_lines(t).filter(in_period("sale_date", start, end))
                              .groupBy("manager_id", trunc_month("sale_date").alias("month"))
                              .agg(F.sum("sale_amount").alias("manager_amount")))
    month_sales = F.broadcast(per_manager.groupBy("month").agg(F.sum("manager_amount").alias("sales_amount")))
    salaries = (per_manager.join(month_sales, "month")
                .withColumn("salary", F.lit(base_salary) + F.lit(rate) * F.col("manager_amount")))
    keys = ["month", "sales_amount", "salary"] + (["manager_id"] if keep_manager else [])
    distinct_salaries = salaries.select(*keys).distinct()
    out = distinct_salaries.groupBy("month", "sales_amount").agg(F.sum("salary").alias("salary_amount"))
    return out.select("month", _money("sales_amount").alias("sales_amount"),
                      _money("salary_amount").alias("salary_amount"),
                      (_money("sales_amount") / F.lit(11.0) - _money("salary_amount")).alias("profit"))
