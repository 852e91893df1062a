"""Malformed XML records, text dates, and reports as SQL text."""

import datetime as dt
import os

import pytest

import __spark_entry__ as E
from ledgerline.plans import experts
from ledgerline.plans.sales_fact import VIEW_COLUMNS, dimensions_for, v_fact_sale
from ledgerline.schemas import POSTS_XML, USERS_XML
from ledgerline.sources import standins
from ledgerline.sources.text_dates import with_dates
from ledgerline.sources.views import run_sql, view_columns
from ledgerline.sources.xml import read_rows_xml_checked

SF = "/root/testdata/sf0.001"


def test_malformed_records_are_refused_and_the_rest_is_read(spark, scratch_dir):
    with open(os.path.join(scratch_dir, "posts.xml"), "w", encoding="utf-8") as f:
        f.write('<posts>\n<row Id="1" PostTypeId="1" Tags="brewing" Score="3"/>\n<row Id="x2" Score="5"/>\n'
                '<row Id="3" ParentId="1" OwnerUserId="9" Score="n/a"/>\n<row Id="4" ParentId="1" OwnerUserId="9"\n Score="7"/>\n'
                '<row Id="5" Score="7" Score="8"/>\n<row Id="6" Score=10/>\n<row Id="7" Other="q"/>\n<row Id="8" Sco\n</posts>')
    rows, rejects = read_rows_xml_checked(spark, scratch_dir, POSTS_XML)
    assert rows.columns == [f.name for f in POSTS_XML.fields]
    assert {r._Id for r in rows.collect()} == {1, 4, 7}
    texts = [r.record for r in rejects.collect()]
    assert len(texts) == 5 and any('Id="x2"' in t for t in texts) and any("Score=10" in t for t in texts)
    users = spark.createDataFrame([(9, "Ann", "Moscow", 90)], USERS_XML)
    assert [r.sum_score for r in experts.topic_experts(rows, users).collect()] == [7]


def test_a_file_without_bad_records_has_no_rejects(spark, scratch_dir):
    with open(os.path.join(scratch_dir, "a.xml"), "w", encoding="utf-8") as f:
        f.write('<posts><row Id="1"/></posts>')
    rows, rejects = read_rows_xml_checked(spark, scratch_dir, POSTS_XML)
    assert rows.count() == 1 and rejects.count() == 0


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo"])
def test_text_dates_of_both_forms(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        texts = ["2014.02.28", "28.02.2014", "2016.02.29", "29.02.2015", "2014.13.01", "2014.2.8", "", None, "x", "2018.11.04"]
        rows, rejects = with_dates(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string"), "t", "d")
        assert {(r.id, r.d) for r in rows.collect()} == {
            (0, dt.date(2014, 2, 28)), (1, dt.date(2014, 2, 28)), (2, dt.date(2016, 2, 29)), (9, dt.date(2018, 11, 4))}
        assert {r.id for r in rejects.collect()} == {3, 4, 5, 6, 7, 8} and rejects.columns == ["id", "t"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def scans(df):
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return sum("Relation" in line for line in plan.splitlines()), plan.count("Join ")


def test_sql_text_leaves_out_dimensions_it_does_not_read(spark):
    t = standins.sales_tables(spark, SF)
    for text, frame in (("r20q_quantity_sold_sql_text", "r20_quantity_sold"), ("r27q_running_totals_sql_text", "r27_running_totals")):
        assert scans(E.queries()[text](spark, SF))[0] == scans(E.queries()[frame](spark, SF))[0] == 2, text
    full = run_sql(spark, "SELECT * FROM v_fact_sale", t)
    assert full.columns == VIEW_COLUMNS and scans(full)[0] == 7          # nation stands for office and city
    by_city = run_sql(spark, "SELECT city_name, sum(sale_qty) AS q FROM v_fact_sale GROUP BY city_name", t)
    assert scans(by_city)[0] == 6
    by_product = run_sql(spark, "SELECT product_name, count(*) AS n FROM v_fact_sale GROUP BY product_name", t)
    assert scans(by_product)[0] == 3
    whole = v_fact_sale(t).groupBy("city_name").agg({"sale_qty": "sum"})
    assert sorted(map(repr, map(tuple, by_city.collect()))) == sorted(map(repr, map(tuple, whole.collect())))


def test_columns_a_statement_may_read():
    assert view_columns("select count(*) from v_fact_sale") == []
    assert view_columns("SELECT Sale_Qty, count( * ) FROM v_fact_sale where REGION = 'x'") == ["region", "sale_qty"]
    assert view_columns("select *, 1 from v_fact_sale") == view_columns("select v.* from v_fact_sale v") == VIEW_COLUMNS
    assert dimensions_for(["region"]) == ["manager", "office", "city"] and dimensions_for(["sale_date", "manager_id"]) == []


def test_owners_without_scores_come_last(spark):
    posts = spark.createDataFrame([(1, 1, None, 5, 0, "brewing"), (2, 2, 1, 20, None, None), (3, 2, 1, 21, -4, None)], POSTS_XML)
    users = spark.createDataFrame([(20, "A", "Moscow", 1), (21, "B", "Moscow", 2)], USERS_XML)
    assert [r.sum_score for r in experts.topic_experts(posts, users).collect()] == [-4, None]
    assert [r.sum_scr for r in experts.topic_experts_sql_form(posts, users, topic="brewing").collect()] == [-4, None]
