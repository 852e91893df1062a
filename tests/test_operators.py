"""Generic operators against brute force (Spark's own windows) on data with
skew, ties and NULLs."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerline.functions.text import contains_any, indent, oracle_concat
from ledgerline.operators.calendar import calendar
from ledgerline.operators.densify import densify
from ledgerline.operators.rank import exclusive_prefix_sum, global_percent_rank, top_k_by_rank
from ledgerline.operators.windows import argmax_rows, ratio_to_report
from ledgerline.functions.dates import month_series


def _skewed_rows(n=3000, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        # a third of the rows in one hot group, with many ties
        g = "hot" if i % 3 == 0 else rnd.choice(["a", "b", "c", None])
        v = rnd.choice([5, 5, 5, 7, 9]) if g == "hot" else rnd.randint(0, 40)
        rows.append((i, g, v if rnd.random() > 0.02 else None))
    return rows


@pytest.mark.parametrize("k,desc", [(1, True), (3, True), (3, False), (10, True)])
def test_top_k_by_rank_matches_window_rank(spark, k, desc):
    df = spark.createDataFrame(_skewed_rows(), "id long, g string, v long")
    got = top_k_by_rank(df, ["g"], "v", k, descending=desc, rank_col="rk", salt_buckets=5)
    order = F.col("v").desc() if desc else F.col("v").asc()
    want = (df.filter(F.col("v").isNotNull())
            .withColumn("rk", F.rank().over(Window.partitionBy("g").orderBy(order)))
            .filter(F.col("rk") <= k))
    assert sorted(got.select("id", "g", "v", "rk").collect()) == sorted(want.select("id", "g", "v", "rk").collect())


def test_global_percent_rank_matches_builtin_nulls_last(spark):
    rows = [(i, None if i % 17 == 0 else float(i % 23)) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, v double")
    got = global_percent_rank(df, "v", "pr", num_ranges=6)
    want = df.withColumn("pr", F.percent_rank().over(Window.orderBy(F.col("v").asc_nulls_last())))
    g = {r.id: r.pr for r in got.collect()}
    w = {r.id: r.pr for r in want.collect()}
    assert g.keys() == w.keys()
    assert all(abs(g[i] - w[i]) < 1e-12 for i in g)


def test_global_percent_rank_single_row(spark):
    df = spark.createDataFrame([(1, 3.0)], "id long, v double")
    assert global_percent_rank(df, "v", "pr").collect()[0].pr == 0.0


def test_ratio_to_report_groups_nulls_and_zero_total(spark):
    df = spark.createDataFrame([(1, None, 2), (2, None, 6), (3, 10, 0), (4, 10, 0), (5, 11, 5)],
                               "id long, p long, x long")
    got = {r.id: r.share for r in ratio_to_report(df, "x", ["p"], "share").collect()}
    assert got == {1: 0.25, 2: 0.75, 3: None, 4: None, 5: 1.0}


def test_ratio_to_report_whole_set(spark):
    df = spark.createDataFrame([(1, 1), (2, 3)], "id long, x long")
    got = {r.id: r.share for r in ratio_to_report(df, "x", [], "share").collect()}
    assert got == {1: 0.25, 2: 0.75}


def test_argmax_rows_keeps_ties_and_null_groups(spark):
    df = spark.createDataFrame([(1, "m", 5), (2, "m", 5), (3, "m", 4), (4, None, 1), (5, None, 2), (6, "n", None)],
                               "id long, g string, v long")
    assert sorted(r.id for r in argmax_rows(df, ["g"], "v").collect()) == [1, 2, 5]
    assert sorted(r.id for r in argmax_rows(df, [], "v").collect()) == [1, 2]


def test_densify_is_entities_times_periods(spark):
    e = spark.createDataFrame([(1,), (2,), (None,)], "m long")
    g = densify(e, month_series("2013-10-01", 15), "month")
    assert g.count() == 45
    months = sorted({r.month.isoformat() for r in g.collect()})
    assert months[0] == "2013-10-01" and months[-1] == "2014-12-01"


def test_calendar_reference_range(spark):
    cal = calendar(spark, "2010-10-01", "2019-12-01")
    rows = cal.collect()
    assert len(rows) == 3467
    by_level = {}
    for r in rows:
        by_level[r.date_lvl] = by_level.get(r.date_lvl, 0) + 1
    assert by_level == {1: 3348, 2: 110, 3: 9}
    ordered = sorted(rows, key=lambda r: r.dim_date_id)
    assert [r.dim_date_id for r in ordered] == list(range(1, 3468))
    assert [(r.date_val.isoformat(), r.date_lvl) for r in ordered[:3]] == [
        ("2010-10-01", 1), ("2010-10-01", 2), ("2010-10-02", 1)]
    jan1 = [r.date_lvl for r in ordered if r.date_val.isoformat() == "2011-01-01"]
    assert jan1 == [1, 2, 3]


def test_text_helpers(spark):
    df = spark.createDataFrame([("Москва, Россия",), ("SAINT PETERSBURG",), (None,), ("Paris",)], "loc string")
    got = [r.hit for r in df.select(contains_any("loc", ["москва", "saint petersburg"]).alias("hit")).collect()]
    assert got == [True, True, False, False]
    df2 = spark.createDataFrame([("a", None, 1), (None, None, 2), ("x", "y", 3)], "a string, b string, lvl int")
    got2 = df2.select(oracle_concat("a", "b").alias("c"), indent("lvl").alias("i")).collect()
    assert [r.c for r in got2] == ["a", None, "xy"]
    assert [r.i for r in got2] == ["", "    ", "        "]


def test_trailing_range_sum_matches_interval_window(spark):
    import datetime as dt
    from decimal import Decimal
    from ledgerline.operators.windows import trailing_range_sum
    rnd = random.Random(3)
    days = [dt.datetime(2014, 1, 1) + dt.timedelta(days=d, hours=rnd.choice([0, 0, 13])) for d in range(0, 150, 2)]
    days += [dt.datetime(2014, 3, 31), dt.datetime(2014, 2, 28), dt.datetime(2014, 3, 28)]
    rows = set()
    for i in range(600):
        m = 1 if i % 3 == 0 else rnd.choice([2, 3, None])
        rows.add((m, rnd.choice(days)))
    data = [(m, d, None if rnd.random() < 0.05 else Decimal(rnd.randint(1, 500)) / 4) for m, d in sorted(rows, key=str)]
    df = spark.createDataFrame(data, "m long, d timestamp_ntz, v decimal(20,2)")
    got = trailing_range_sum(df, ["m"], "d", "v", F.col("d") - F.expr("INTERVAL 1 MONTH"), "s")

    def minus_month(d):   # calendar month back, day clamped to the month's end
        y, m = (d.year, d.month - 1) if d.month > 1 else (d.year - 1, 12)
        last = (dt.date(y + (m == 12), m % 12 + 1, 1) - dt.timedelta(days=1)).day
        return d.replace(year=y, month=m, day=min(d.day, last))

    # Brute force of the frame definition.  Spark's own RANGE window is not
    # used as the reference: its frame start only moves forward, and
    # "minus one month" is not monotonic (Mar 30 13:00 -> Feb 28 13:00, but
    # Mar 31 00:00 -> Feb 28 00:00), so it drops rows the definition keeps.
    want = []
    for m, d, _ in data:
        vals = [v for m2, d2, v in data if m2 == m and minus_month(d) <= d2 <= d and v is not None]
        want.append((m, d, sum(vals) if vals else None))
    assert got.columns == ["m", "d", "s"]
    assert sorted(((r.m, r.d, r.s) for r in got.collect()), key=str) == sorted(want, key=str)


def test_oracle_date_formats_and_truncation(spark):
    import datetime as dt
    from ledgerline.functions.dates import parse_dmy_dots, parse_ymd_dots, trunc_day, trunc_quarter
    df = spark.createDataFrame([("2016.01.31", "21.07.2017", dt.datetime(2014, 8, 15, 23, 59))],
                               "a string, b string, t timestamp_ntz")
    r = df.select(parse_ymd_dots("a").alias("a"), parse_dmy_dots("b").alias("b"),
                  trunc_day("t").alias("d"), trunc_quarter("t").alias("q")).first()
    assert (r.a, r.b, r.d, r.q) == (dt.date(2016, 1, 31), dt.date(2017, 7, 21), dt.date(2014, 8, 15),
                                    dt.date(2014, 7, 1))


def test_ranges_of_a_prefix_sum_are_found_by_compiled_code(spark):
    """A lambda over an array is interpreted: 27 us a row and range lookup on paths."""
    rows = spark.range(500).select(F.array(F.lit(1).cast("long"), F.col("id") * 7 % 500).alias("key"), (F.col("id") % 3).alias("w"))
    got = exclusive_prefix_sum(rows, "key", "w", "before", num_ranges=9)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "_range" in plan and not [line for line in plan.splitlines() if "_range" in line and "lambda" in line]
    weights = {r["key"][1]: r["w"] for r in rows.collect()}
    assert {r["key"][1]: r["before"] for r in got.collect()} == {k: sum(weights[j] for j in range(k)) for k in range(500)}


def test_with_range_counts_the_bounds_up_to_a_key(spark):
    from bisect import bisect_right

    from ledgerline.operators.rank import with_range
    for bounds, ranges in (([], 4), ([5], 2), ([2, 2, 9], 4), (list(range(0, 30, 2)), 16), (list(range(0, 32, 2)), 17)):
        keys = [*range(-1, 34), None]
        held = F.array(*[F.lit(b).cast("long") for b in bounds]).cast("array<long>")
        got = with_range(spark.createDataFrame([(k,) for k in keys], "k long"), "k", held, ranges, "r").collect()
        assert {r["k"]: r["r"] for r in got} == {k: 0 if k is None else bisect_right(bounds, k) for k in keys}
