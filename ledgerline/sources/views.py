"""Temp views over the report inputs (S9), so statements written against
the original table and view names run as Spark SQL unchanged in shape."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def register_views(tables: dict[str, DataFrame], prefix: str = "") -> list[str]:
    """``createOrReplaceTempView`` for every DataFrame; returns the names."""
    names = []
    for name, df in tables.items():
        df.createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    return names


def register_sales_views(t: dict[str, DataFrame], prefix: str = "") -> list[str]:
    """The six sales tables plus the fact view ``v_fact_sale``."""
    from ..plans.sales_fact import v_fact_sale
    return register_views({**t, "v_fact_sale": v_fact_sale(t)}, prefix)


def view_columns(text: str) -> list[str]:
    """The columns of the fact view that a statement may read: those that it
    names, and all where a bare ``*`` asks for them."""
    from ..plans.sales_fact import VIEW_COLUMNS
    if re.search(r"(?<!count\()\*(?=\s*(,|from\b))", text, re.I):
        return VIEW_COLUMNS
    return [c for c in VIEW_COLUMNS if re.search(rf"\b{c}\b", text, re.I)]


def run_sql(spark: SparkSession, text: str, t: Mapping[str, DataFrame], **values) -> DataFrame:
    """A report given as Spark SQL over the sales tables and ``v_fact_sale``
    by their original names; ``values`` are its named parameters (``:name``).

    Only tables and views that the text names are registered, and the view is
    made without the joins of dimensions that the text reads no column of."""
    from ..plans.sales_fact import v_fact_sale
    named = lambda name: re.search(rf"\b{name}\b", text, re.I)
    register_views({name: t[name] for name in t if named(name)})
    if named("v_fact_sale"):
        register_views({"v_fact_sale": v_fact_sale(t, view_columns(text))})
    return spark.sql(text, args=values)
