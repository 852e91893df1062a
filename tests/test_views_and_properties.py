"""Spark SQL over registered views, and whole-table properties on the driver
tables (shares sum to one, cube totals, tree totals)."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from ledgerline.sources import standins
from ledgerline.sources.views import register_sales_views

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def test_sql_over_views_matches_dataframe_report(spark):
    register_sales_views(standins.sales_tables(spark, SF), prefix="lv_")
    sql = spark.sql("""
        WITH pay AS (
          SELECT trunc(sale_date, 'MM') AS month, manager_id, sum(sale_amount) AS sold
          FROM lv_v_fact_sale WHERE sale_date >= DATE '1996-01-01' AND sale_date <= DATE '1996-12-31'
          GROUP BY trunc(sale_date, 'MM'), manager_id),
        salaries AS (SELECT month, sum(s) AS total FROM (SELECT DISTINCT month, 30000 + 0.05 * sold AS s FROM pay) GROUP BY month)
        SELECT month, CAST(sum(sold) AS DOUBLE) AS sales_amount, CAST(first(total) AS DOUBLE) AS salary_amount
        FROM pay JOIN salaries USING (month) GROUP BY month""")
    df = E.queries()["r31_monthly_profit"](spark, SF).drop("profit")
    assert sorted(map(tuple, sql.collect())) == sorted(map(tuple, df.collect()))


def test_year_shares_sum_to_one(spark):
    df = E.queries()["r25_office_year_share"](spark, SF)
    for r in df.groupBy("sale_year").agg(F.sum("year_ratio_amount").alias("s")).collect():
        assert r.s == pytest.approx(1.0)


def test_cube_grand_total_is_detail_count(spark):
    cube = E.queries()["r08_fact_cube"](spark, SF)
    detail = E.queries()["r07_fact_detail"](spark, SF)
    grand = cube.filter(F.col("grouping_id") == 3).first()
    assert grand.total_amount == detail.count()
    by_date = cube.filter(F.col("grouping_id") == 1).agg(F.sum("total_amount")).first()[0]
    assert by_date == grand.total_amount


def test_tree_root_sizes_sum_to_all_files(spark):
    tree = E.queries()["r32_tree_report"](spark, SF)
    roots = tree.filter(F.col("parent_id").isNull()).agg(F.sum("dir_size")).first()[0]
    files = standins.file_system(spark, SF).agg(F.sum("file_size")).first()[0]
    assert roots == files
    assert tree.filter(F.col("parent_id").isNull()).agg(F.sum("dir_ratio")).first()[0] == pytest.approx(1.0)
