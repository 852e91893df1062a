"""Basic sales queries (R12-R22): scans, filters, distinct, union, argmax.

Date bounds are strict where the reference's are (``>``/``<``) and compare a
TIMESTAMP column with midnight of the given day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import ts_lit
from ..operators.windows import argmax_rows


def all_orders(t) -> DataFrame:                                        # R12
    return t["sales_order"]


def orders_after(t, day="2016-01-01") -> DataFrame:                    # R13
    return (t["sales_order"].filter(F.col("order_date") > ts_lit(day))
            .orderBy(F.col("order_date").asc_nulls_last()))


def orders_between(t, after="2016-01-01", before="2016-07-15") -> DataFrame:   # R14
    return (t["sales_order"]
            .filter((F.col("order_date") > ts_lit(after)) & (F.col("order_date") < ts_lit(before)))
            .orderBy(F.col("order_date").desc_nulls_first()))   # Oracle DESC puts NULL first


def managers_named(t, first_name="Henry") -> DataFrame:                # R15
    return t["manager"].filter(F.col("manager_first_name") == first_name)


def orders_of_managers_named(t, first_name="Henry") -> DataFrame:      # R16
    """All columns of both tables; the join key appears once."""
    m = managers_named(t, first_name)
    return t["sales_order"].join(m, "manager_id", "inner").select(
        "sales_order_id", "order_date", "manager_id", "manager_first_name", "manager_last_name", "office_id")


def countries(t) -> DataFrame:                                          # R17
    return t["city"].select("country").distinct()


def country_regions(t) -> DataFrame:                                    # R18
    return t["city"].filter(F.col("region").isNotNull()).select("country", "region").distinct()


def cities_per_country(t) -> DataFrame:                                 # R19
    """Distinct (city, country) pairs counted per country: a NULL city name
    still counts once, which ``count(distinct city)`` would not do."""
    return (t["city"].select("city_name", "country").distinct()
            .groupBy("country").agg(F.count(F.lit(1)).alias("city_amount")))


def quantity_sold(t, after="2015-12-31", before="2016-01-31") -> DataFrame:    # R20
    """One row; NULL when nothing sold.  The reference's ORDER BY on a
    non-grouped column has no effect on one row and is dropped (O4)."""
    so = t["sales_order"].filter((F.col("order_date") > ts_lit(after)) & (F.col("order_date") < ts_lit(before)))
    joined = so.join(t["sales_order_line"], "sales_order_id", "inner")
    return joined.agg(F.sum("product_qty").cast("double").alias("qty"))


def place_titles(t) -> DataFrame:                                       # R21
    """City names, countries and non-NULL regions in one distinct column
    (the WHERE binds to the third branch only)."""
    c = t["city"]
    return (c.select(F.col("city_name").alias("title"))
            .union(c.select("country"))
            .union(c.filter(F.col("region").isNotNull()).select("region"))
            .distinct())


def best_managers(t, after="2015-12-31", before="2016-02-01") -> DataFrame:    # R22
    """Manager(s) with the highest income in the period, ties kept."""
    so = t["sales_order"].filter((F.col("order_date") > ts_lit(after)) & (F.col("order_date") < ts_lit(before)))
    lines = t["sales_order_line"].select("sales_order_id", "product_price", "product_qty")
    mgr_ids = t["manager"].select("manager_id")
    income = (so.join(mgr_ids, "manager_id").join(lines, "sales_order_id")
              .groupBy("manager_id")
              .agg(F.sum(F.col("product_price") * F.col("product_qty")).alias("total_income")))
    best = argmax_rows(income, [], "total_income")
    return best.join(t["manager"], "manager_id").select(
        F.col("total_income").cast("double").alias("max_income"), "manager_last_name", "manager_first_name")
