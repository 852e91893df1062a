"""The sales fact view V_FACT_SALE (R33) and its pieces.

The view is line-driven with left joins only (a line without an order keeps
NULL manager, office and date).  Reports that need few columns call the
pieces instead of the whole view: every dimension key is declared a primary
key (``sources.checks.key_violations`` lists violations), so leaving out a left join
whose columns are unused does not change the rows, and attaching names
*after* aggregating by id turns a fact-sized join into a group-sized one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VIEW_COLUMNS = ["fact_id", "product_id", "product_name", "sales_order_id", "manager_id",
                "manager_first_name", "manager_last_name", "office_id", "office_name",
                "city_id", "city_name", "country", "region", "sale_qty", "sale_price",
                "sale_amount", "sale_date"]


def sale_lines(t: dict[str, DataFrame]) -> DataFrame:
    """order lines LEFT JOIN orders: ids, quantities, amount and date."""
    ol = t["sales_order_line"]
    so = t["sales_order"].select("sales_order_id", "order_date", "manager_id")
    return (ol.join(so, "sales_order_id", "left")
              .select(F.col("order_line_id").alias("fact_id"), "product_id", "sales_order_id",
                      "manager_id",
                      F.col("product_qty").alias("sale_qty"),
                      F.col("product_price").alias("sale_price"),
                      (F.col("product_qty") * F.col("product_price")).alias("sale_amount"),
                      F.col("order_date").alias("sale_date")))


def attach_manager(df: DataFrame, t: dict[str, DataFrame]) -> DataFrame:
    m = t["manager"].select("manager_id", "manager_first_name", "manager_last_name", "office_id")
    return df.join(m, "manager_id", "left")


def attach_office(df: DataFrame, t: dict[str, DataFrame]) -> DataFrame:
    """Needs ``office_id``; adds office and city columns (two left joins)."""
    o = t["office"].select("office_id", "office_name", "city_id")
    c = t["city"].select("city_id", "city_name", "country", "region")
    return df.join(o, "office_id", "left").join(c, "city_id", "left")


def attach_product(df: DataFrame, t: dict[str, DataFrame]) -> DataFrame:
    p = t["product"].select("product_id", "product_name")
    return df.join(p, "product_id", "left")


#: The view's columns by the dimension that supplies them, and the dimension whose row holds its key.
SUPPLIED = {"product": (("product_name",), None),
            "manager": (("manager_first_name", "manager_last_name", "office_id"), None),
            "office": (("office_name", "city_id"), "manager"),
            "city": (("city_name", "country", "region"), "office")}
DIMENSION_KEYS = {"product": "product_id", "manager": "manager_id", "office": "office_id", "city": "city_id"}


def dimensions_for(columns) -> list[str]:
    """The dimensions that a reader of ``columns`` of the view needs.  Their
    keys are declared primary keys and the joins are left joins, so leaving
    out the others changes no row."""
    need = set()
    for name, (supplied, _) in SUPPLIED.items():
        if set(supplied) & set(columns):
            while name:
                need.add(name)
                name = SUPPLIED[name][1]
    return [d for d in SUPPLIED if d in need]


def v_fact_sale(t, columns=tuple(VIEW_COLUMNS)) -> DataFrame:
    """The view: all 17 columns in its order, or just ``columns``, without the
    joins of dimensions that supply none of them.

    The view's chain lines LEFT JOIN orders LEFT JOIN manager LEFT JOIN
    office LEFT JOIN city is re-associated as lines LEFT JOIN (orders LEFT
    JOIN manager LEFT JOIN office LEFT JOIN city): every later join's key
    comes from the orders side, so the rows are the same, and the manager,
    office and city joins run over orders instead of over every line - one
    fact-sized shuffle fewer."""
    orders = t["sales_order"].select("sales_order_id", "order_date", "manager_id")
    need = dimensions_for(columns)
    for name in need:
        if name != "product":
            orders = orders.join(t[name].select(DIMENSION_KEYS[name], *SUPPLIED[name][0]), DIMENSION_KEYS[name], "left")
    df = t["sales_order_line"].join(orders, "sales_order_id", "left").select(
        F.col("order_line_id").alias("fact_id"), "product_id", "sales_order_id", "manager_id",
        *[c for name in need if name != "product" for c in SUPPLIED[name][0]],
        F.col("product_qty").alias("sale_qty"), F.col("product_price").alias("sale_price"),
        (F.col("product_qty") * F.col("product_price")).alias("sale_amount"),
        F.col("order_date").alias("sale_date"))
    return (attach_product(df, t) if "product" in need else df).select(*[c for c in VIEW_COLUMNS if c in columns])


def in_period(col: str, start, end) -> F.Column:
    """``col BETWEEN start AND end`` with DATE bounds: inclusive, and the
    upper bound is midnight of ``end`` (a sale at 10:00 that day is out)."""
    from ..functions.dates import ts_lit
    return F.col(col).between(ts_lit(start), ts_lit(end))
