"""Sales reports on tiny fixtures in the reference's own schema, one edge
case (SURVEY D-rows / FIXTURES.md section 3) per test."""

import datetime as dt
from decimal import Decimal as D

import pytest

from ledgerline import schemas as S
from ledgerline.plans import sales_analytics as sa
from ledgerline.plans import sales_basic as sb
from ledgerline.plans.sales_fact import VIEW_COLUMNS, v_fact_sale


def ts(y, m, d, h=0):
    return dt.datetime(y, m, d, h)


def tables(spark, orders, lines, managers=None):
    managers = managers or [(1, "Henry", "Smith", 10), (2, "Anna", "Brown", 10),
                            (3, "Henry", "Jones", 20), (4, "Olga", "Ivanova", 30),
                            (5, "Ivan", "Petrov", 30)]
    return {
        "sales_order": spark.createDataFrame(orders, S.SALES_ORDER),
        "sales_order_line": spark.createDataFrame(lines, S.SALES_ORDER_LINE),
        "manager": spark.createDataFrame(managers, S.MANAGER),
        "office": spark.createDataFrame([(10, "Office A", 100), (20, "Office B", 200), (30, "Office C", 300)], S.OFFICE),
        "city": spark.createDataFrame([(100, "London", "UK", "England"), (200, "Paris", "France", None),
                                       (300, "London", "USA", "Ohio")], S.CITY),
        "product": spark.createDataFrame([(p, f"prod{p}") for p in range(1, 8)], S.PRODUCT),
    }


def line(i, order, product, qty, price):
    return (i, order, product, D(str(qty)), D(str(price)))


def test_view_is_line_driven_left_joins(spark):
    t = tables(spark, [(1, ts(2014, 1, 5), 1)], [line(1, 1, 1, 2, 10), line(2, 99, 2, 1, 5)])
    rows = {r.fact_id: r for r in v_fact_sale(t).collect()}
    assert list(v_fact_sale(t).columns) == VIEW_COLUMNS
    assert rows[1].sale_amount == D("20.0000") and rows[1].country == "UK"
    assert rows[2].manager_id is None and rows[2].sale_date is None and rows[2].product_name == "prod2"


def test_r23_grid_gap_and_null_manager(spark):
    # manager 2 sells only in Oct-Nov 2013, then nothing: still wins January 2014
    # on the previous three months; the line without an order (NULL manager) never wins.
    orders = [(1, ts(2013, 10, 3), 2), (2, ts(2013, 11, 3), 2), (3, ts(2014, 1, 10), 1)]
    lines = [line(1, 1, 1, 10, 100), line(2, 2, 1, 10, 100), line(3, 3, 1, 1, 50), line(4, 77, 1, 99, 99)]
    got = {(r.sale_month.isoformat(), r.manager_id): r.bonus
           for r in sa.best_manager_bonus(tables(spark, orders, lines)).collect()}
    assert got[("2014-01-01", 2)] == pytest.approx(100.0)   # 0.05 * 2000
    assert ("2014-02-01", 2) in got and all(m is not None for _, m in got)


def test_r23_order_at_23h_on_last_day_is_outside_between(spark):
    orders = [(1, ts(2013, 10, 1), 1), (2, ts(2014, 12, 31, 23), 2)]
    lines = [line(1, 1, 1, 1, 10), line(2, 2, 1, 1, 1000)]
    got = sa.best_manager_bonus(tables(spark, orders, lines)).collect()
    assert all(r.manager_id == 1 for r in got)


def test_r25_zero_fill_and_average_share(spark):
    orders = [(1, ts(2013, 3, 1), 1), (2, ts(2014, 3, 1), 1), (3, ts(2014, 5, 1), 3)]
    lines = [line(1, 1, 1, 1, 100), line(2, 2, 1, 1, 300), line(3, 3, 1, 1, 100)]
    got = {(r.office_id, r.sale_year.year): r for r in sa.office_year_share(tables(spark, orders, lines)).collect()}
    assert got[(20, 2013)].year_amount == 0.0 and got[(20, 2013)].year_ratio_amount == 0.0
    assert got[(20, 2014)].year_ratio_amount == pytest.approx(0.25)
    assert got[(10, 2013)].avg_year_ratio == pytest.approx((1.0 + 0.75) / 2)


def test_r26_lag_skips_gap_and_drops_first_month(spark):
    # product 1: Dec 100, Jan 100, Feb 200, (no March), Apr 100
    orders = [(i, d, 1) for i, d in enumerate([ts(2013, 12, 5), ts(2014, 1, 5), ts(2014, 2, 5), ts(2014, 4, 5)], 1)]
    lines = [line(i, i, 1, 1, p) for i, p in enumerate([100, 100, 200, 100], 1)]
    got = sa.product_growth(tables(spark, orders, lines)).collect()
    # December removed before LAG (D9): ratios Feb/Jan = 2, Apr/Feb = 0.5 (D10) -> median 1.25
    assert [(r.product_id, r.trend_median) for r in got] == [(1, 1.25)]


def test_r27_quarter_running_total_includes_peers(spark):
    orders = [(1, ts(2014, 1, 5), 1), (2, ts(2014, 2, 5), 1), (3, ts(2014, 4, 5), 1)]
    lines = [line(1, 1, 1, 1, 10), line(2, 2, 1, 1, 20), line(3, 3, 1, 1, 40)]
    got = {r.sale_month.month: r for r in sa.running_totals(tables(spark, orders, lines)).collect()}
    assert got[1].cumul_month_sum == 10.0 and got[1].cumul_quart_sum == 30.0
    assert got[4].cumul_month_sum == 70.0 and got[4].cumul_quart_sum == 70.0


def test_r29_tie_at_rank_three_lists_four_names_in_rank_then_id_order(spark):
    orders = [(i, ts(2014, 6, 1), m) for i, m in enumerate([1, 2, 3, 5, 4], 1)]
    # managers 1,2 -> UK; 3 -> France; 4,5 -> USA.  UK: 1:50, 2:50 (tie at 1)
    lines = [line(1, 1, 1, 1, 50), line(2, 2, 1, 1, 50), line(3, 3, 1, 1, 5),
             line(4, 4, 1, 1, 7), line(5, 5, 1, 1, 7)]
    got = {r.country: r.managers_to_bonus for r in sa.top_managers_by_country(tables(spark, orders, lines)).collect()}
    assert got["UK"] == "Smith Henry, Brown Anna"
    assert got["USA"] == "Ivanova Olga, Petrov Ivan"
    managers = [(m, f"F{m}", f"L{m}", 10) for m in range(1, 6)]
    orders = [(m, ts(2014, 6, 1), m) for m in range(1, 6)]
    lines = [line(m, m, 1, 1, p) for m, p in zip(range(1, 6), [9, 8, 7, 7, 1])]
    got = sa.top_managers_by_country(tables(spark, orders, lines, managers)).collect()
    assert [r.managers_to_bonus for r in got] == ["L1 F1, L2 F2, L3 F3, L4 F4"]


def test_r30_pairs_multiply_as_written_and_variant_dedupes(spark):
    orders = [(1, ts(2014, 3, 1), 1)]
    lines = [line(1, 1, 1, 1, 90), line(2, 1, 1, 1, 90), line(3, 1, 2, 1, 90), line(4, 1, 3, 1, 10)]
    t = tables(spark, orders, lines)
    as_written = sa.monthly_price_extremes(t).collect()
    assert len(as_written) == 3            # 3 lines at the top price x 1 at the bottom
    variant = sa.monthly_price_extremes(t, distinct_products=True).collect()
    assert sorted((r.dearest_product_id, r.cheapest_product_id) for r in variant) == [(1, 3), (2, 3)]


def test_r31_equal_salaries_merge_as_written(spark):
    orders = [(1, ts(2014, 2, 1), 1), (2, ts(2014, 2, 2), 2)]
    lines = [line(1, 1, 1, 1, 100), line(2, 2, 1, 1, 100)]
    t = tables(spark, orders, lines)
    r = sa.monthly_profit(t).collect()[0]
    assert r.sales_amount == 200.0 and r.salary_amount == 30005.0          # D11: one salary
    assert r.profit == pytest.approx(200.0 / 11 - 30005.0)
    r2 = sa.monthly_profit(t, keep_manager=True).collect()[0]
    assert r2.salary_amount == 60010.0


def test_r28_tails_by_percent_rank(spark):
    orders = [(p, ts(2014, 5, 1), 1) for p in range(1, 7)]
    lines = [line(p, p, p, 1, 10 * p) for p in range(1, 7)]
    got = {r.product_id: r for r in sa.price_tail_share(tables(spark, orders, lines)).collect()}
    assert sorted(got) == [1, 6]
    assert got[6].price_percent_rank == 1.0 and got[1].price_percent_rank == 0.0
    assert got[6].percent_from_total_amount == pytest.approx(60 / 210)


def test_r20_no_sales_gives_one_null_row_and_r22_keeps_ties(spark):
    orders = [(1, ts(2016, 1, 10), 1), (2, ts(2016, 1, 11), 2), (3, ts(2016, 1, 31, 12), 3)]
    lines = [line(1, 1, 1, 2, 50), line(2, 2, 1, 1, 100), line(3, 3, 1, 5, 1000)]
    t = tables(spark, orders, lines)
    assert [r.qty for r in sb.quantity_sold(t).collect()] == [3.0]      # Jan 31 excluded as written
    assert [r.qty for r in sb.quantity_sold(t, "2010-01-01", "2010-02-01").collect()] == [None]
    got = sorted((r.manager_last_name, r.max_income) for r in sb.best_managers(t).collect())
    assert got == [("Jones", 5000.0)]
    lines[2] = line(3, 3, 1, 1, 100)
    t = tables(spark, orders, lines)
    assert sorted(r.manager_last_name for r in sb.best_managers(t).collect()) == ["Brown", "Jones", "Smith"]


def test_basic_city_queries(spark):
    t = tables(spark, [(1, ts(2016, 1, 2), 1)], [line(1, 1, 1, 1, 1)])
    assert sorted(r.country for r in sb.countries(t).collect()) == ["France", "UK", "USA"]
    assert sorted(tuple(r) for r in sb.country_regions(t).collect()) == [("UK", "England"), ("USA", "Ohio")]
    assert {r.country: r.city_amount for r in sb.cities_per_country(t).collect()} == {"UK": 1, "France": 1, "USA": 1}
    assert sorted(r.title for r in sb.place_titles(t).collect()) == sorted(
        ["London", "Paris", "UK", "France", "USA", "England", "Ohio"])
    assert [r.manager_last_name for r in sb.managers_named(t).orderBy("manager_id").collect()] == ["Smith", "Jones"]
    assert sb.orders_of_managers_named(t).columns.count("manager_id") == 1


def test_oracle_null_order_in_sorted_reports(spark):
    """Ascending puts NULL last, descending puts NULL first."""
    from pyspark.sql import functions as F
    orders = [(1, ts(2016, 3, 1), 1), (2, ts(2016, 2, 1), 2), (3, ts(2016, 5, 1), 3)]
    t = tables(spark, orders, [line(1, 1, 1, 1, 1)])
    t["sales_order"] = t["sales_order"].union(
        spark.createDataFrame([(4, None, 4)], S.SALES_ORDER))
    asc = [r.sales_order_id for r in sb.orders_after(t).collect()]
    assert asc == [2, 1, 3]            # NULL dates fail the filter and are absent
    # ordering rule itself, on the report's sort expressions
    df = t["sales_order"]
    assert [r.sales_order_id for r in df.orderBy(F.col("order_date").desc_nulls_first()).collect()][0] == 4
    assert [r.sales_order_id for r in df.orderBy(F.col("order_date").asc_nulls_last()).collect()][-1] == 4
    desc = [r.sales_order_id for r in sb.orders_between(t).collect()]
    assert desc == [3, 1, 2]
