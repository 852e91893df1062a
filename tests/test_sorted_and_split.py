"""Report order (Oracle NULL order, ties), repeated pairs, split medians, write checks."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import test_sales_reports as fx
from ledgerline import schemas as S
from ledgerline.operators.rank import group_medians
from ledgerline.operators.repeat import repeat_rows
from ledgerline.plans import sales_analytics as sa
from ledgerline.sources.checks import checked

ts, line, tables = fx.ts, fx.line, fx.tables


def _column(df, name):
    return [r[name] for r in df.collect()]


def test_r24_by_month(spark):
    orders = [(k, ts(2013 + (9 + k) // 12, (9 + k) % 12 + 1, 5), k % 3 + 1) for k in range(14)]
    lines = [line(k, k, 1, 1, 10 * (k + 1)) for k in range(14)]
    got = _column(sa.best_manager_bonus_first_version(tables(spark, orders, lines)), "month")
    assert got == sorted(got) and len(got) > 3


def test_r25_by_average_share_nulls_last(spark):
    # 2014 without sales: its shares are NULL (zero total), the averages are those of 2013
    orders = [(1, ts(2013, 1, 5), 1), (2, ts(2013, 2, 5), 2), (3, ts(2013, 3, 5), 3)]
    lines = [line(1, 1, 1, 1, 50), line(2, 2, 1, 1, 10), line(3, 3, 1, 1, 50)]
    got = _column(sa.office_year_share(tables(spark, orders, lines)), "avg_year_ratio")
    known = [g for g in got if g is not None]
    assert known == sorted(known) and got[:len(known)] == known


def test_r26_by_median_descending_ties_by_product(spark):
    orders = [(1, ts(2014, 1, 5), 1), (2, ts(2014, 2, 5), 1)]
    lines = [line(10 * o + p, o, p, 1, 100 * o if p < 3 else 100) for o in (1, 2) for p in (1, 2, 3)]
    got = [(r.trend_median, r.product_id) for r in sa.product_growth(tables(spark, orders, lines)).collect()]
    assert got == [(2.0, 1), (2.0, 2), (1.0, 3)]


def test_r27_by_month(spark):
    orders = [(m, ts(2014, m, 5), 1) for m in (7, 1, 12, 3)]
    got = _column(sa.running_totals(tables(spark, orders, [line(m, m, 1, 1, 1) for m in (7, 1, 12, 3)])), "sale_month")
    assert got == [dt.date(2014, m, 1) for m in (1, 3, 7, 12)]


def test_r30_by_month_ties_by_products(spark):
    orders = [(1, ts(2014, 5, 1), 1), (2, ts(2014, 2, 1), 1)]
    lines = [line(1, 1, 1, 1, 9), line(2, 1, 2, 1, 9), line(3, 1, 3, 1, 1), line(4, 2, 2, 1, 4)]
    got = [(r.month.month, r.dearest_product_id, r.cheapest_product_id)
           for r in sa.monthly_price_extremes(tables(spark, orders, lines)).collect()]
    assert got == [(2, 2, 2), (5, 1, 3), (5, 2, 3)]


def test_r30_pair_counts_beyond_int(spark):
    """50,000 lines at the top and 50,000 at the bottom price of a month: 2.5 billion pairs."""
    t = tables(spark, [(1, ts(2014, 5, 1), 1)], [line(1, 1, 1, 1, 1)])
    n = F.col("id")
    t["sales_order_line"] = spark.range(100_000).select(
        n.alias("order_line_id"), F.lit(1).cast("long").alias("sales_order_id"), (n % 2 + 1).alias("product_id"),
        F.lit(1).cast(S.MONEY).alias("product_qty"), ((n % 2) * 5 + 5).cast(S.MONEY).alias("product_price"))
    got = sa.monthly_price_pairs(t).collect()
    assert [(r.dearest_product_id, r.cheapest_product_id, r.n_pairs) for r in got] == [(2, 1, 2_500_000_000)]
    plan = sa.monthly_price_extremes(t)._jdf.queryExecution().executedPlan().toString()
    assert "Range (0, 100000" not in plan          # the fact is read by the written leg only


@pytest.mark.parametrize("n", [0, 1, 2, 65_535, 65_536, 65_537, 200_000])
def test_repeat_rows(spark, n):
    df = spark.createDataFrame([("a", n), ("b", 3), ("c", 0)], "k string, n long")
    got = {r.k: r["count"] for r in repeat_rows(df, "n").groupBy("k").count().collect()}
    assert got == {k: v for k, v in {"a": n, "b": 3}.items() if v}


def test_medians_of_a_hot_group(spark):
    rows = spark.range(20_000).select(
        F.when(F.col("id") % 10 < 8, F.lit(1)).otherwise(F.col("id") % 50).cast("long").alias("g"),
        (F.xxhash64("id") % 1000).cast("double").alias("v"))
    rows = rows.union(spark.createDataFrame([(None, 3.0), (None, 4.0), (77, None), (78, 5.0), (78, None)], "g long, v double"))
    counted = rows.groupBy("g", "v").agg(F.count(F.lit(1)).alias("n"))
    got = {r.group: r.med for r in group_medians(counted, "g", "v", "n", "med").collect()}
    want = {r.g: r.m for r in rows.groupBy("g").agg(F.median("v").alias("m")).collect() if r.m is not None}
    assert got == want


def test_r28_plan_has_no_median_over_lines(spark):
    orders = [(p, ts(2014, 5, 1), 1) for p in range(1, 7)]
    df = sa.price_tail_share(tables(spark, orders, [line(p, p, p, 1, 10 * p) for p in range(1, 7)]))
    assert "percentile" not in df._jdf.queryExecution().executedPlan().toString().lower()


def test_declared_columns_are_checked_on_write(spark, scratch_dir):
    ok = spark.createDataFrame([(1, "a" * 100)], "dim_tag_id long, tag_name string")
    checked(ok, S.DIM_TAGS, {"tag_name": 100}).write.parquet(f"{scratch_dir}/ok")
    for k, row in enumerate([(None, "a"), (1, None), (1, "a" * 101)]):
        bad = spark.createDataFrame([row], "dim_tag_id long, tag_name string")
        with pytest.raises(Exception, match="NULL or too long"):
            checked(bad, S.DIM_TAGS, {"tag_name": 100}).write.parquet(f"{scratch_dir}/bad{k}")
