"""Registered reports on the driver tables: name -> (spark, sf_dir) -> DataFrame.

Dates are the reference's dates shifted onto the driver tables' 1995-2001
range; see ``oracle_sql`` for the matching DuckDB formulation.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..functions.dates import trunc_month, ts_lit
from ..operators.calendar import calendar_covering
from ..operators.closure import closure, interval_index
from ..operators.numbering import largest_key
from ..operators.tree import walk_from_roots
from ..session import held_by, materialize, new_table_path
from ..sources import gates, standins
from . import sales_analytics as sa
from . import sales_basic as sb
from . import sales_sql, star, star_load
from . import experts as ex
from .tree_report import tree_report
from ..schemas import EXPERTS_XML, MANAGER, POSTS_XML, SALES_ORDER, SALES_ORDER_LINE
from ..sources.checks import foreign_key_violations, key_violations
from ..sources.tables import write_table
from ..sources.text_dates import with_dates
from ..sources.views import run_sql
from ..sources.xml import read_rows_xml, read_rows_xml_checked, write_rows_xml
from .sales_fact import VIEW_COLUMNS, v_fact_sale

Query = Callable[[SparkSession, str], DataFrame]


def _sales(spark, sf_dir):
    return standins.sales_tables(spark, sf_dir)


def r33(spark, sf_dir):
    from pyspark.sql import functions as F
    v = v_fact_sale(_sales(spark, sf_dir))
    money = {"sale_qty", "sale_price", "sale_amount"}
    return v.select(*[F.col(c).cast("double").alias(c) if c in money else F.col(c) for c in VIEW_COLUMNS])


def r23(spark, sf_dir):
    return sa.best_manager_bonus(_sales(spark, sf_dir), grid_start="1995-10-01", n_months=15,
                                 period_start="1995-10-01", period_end="1996-12-31",
                                 report_from="1996-01-01")


def r24(spark, sf_dir):
    return sa.best_manager_bonus_first_version(_sales(spark, sf_dir), after="1995-09-30",
                                               before="1997-01-01", month_after="1995-12-31",
                                               month_before="1997-01-01")


def r25(spark, sf_dir):
    return sa.office_year_share(_sales(spark, sf_dir), start="1995-01-01", end="1996-12-31")


def r26(spark, sf_dir):
    return sa.product_growth(_sales(spark, sf_dir), start="1995-12-01", end="1996-06-30",
                             first_month="1995-12-01")


def r27(spark, sf_dir):
    return sa.running_totals(_sales(spark, sf_dir), start="1996-01-01", end="1996-12-31")


def r28(spark, sf_dir):
    return sa.price_tail_share(_sales(spark, sf_dir), start="1996-01-01", end="1996-12-31")


def r29(spark, sf_dir):
    return sa.top_managers_by_country(_sales(spark, sf_dir), start="1996-01-01", end="1996-12-31")


def r30(spark, sf_dir):
    return sa.monthly_price_extremes(_sales(spark, sf_dir), start="1996-01-01", end="1996-12-31")


def r31(spark, sf_dir):
    return sa.monthly_profit(_sales(spark, sf_dir), start="1996-01-01", end="1996-12-31")


# The 2016 dates of the basic queries move to 1996; 'Henry' becomes a market segment.
FIRST_NAME = "BUILDING"


def _basic(fn, **kw):
    return lambda spark, sf_dir: fn(_sales(spark, sf_dir), **kw)


# The questions of a second load; a declared length that some names break.
SECOND_LOAD_FROM = "1998-01-01"
NAME_LENGTH = 12

# Fixed value: the one-day report's date, 2017-07-21 moved to the driver range.
REPORT_DAY = "1998-07-21"


def _qa(spark, sf_dir):
    return standins.qa_tables(spark, sf_dir)


def _star_fact(spark, sf_dir, with_fact_id=True):
    """The detail rows.  The question-tag view is read by the tag dimension
    and by the fact, so it is written once; queries with one reader don't
    write it."""
    qa = _qa(spark, sf_dir)
    qt = materialize(star.question_tags(qa))
    dd, dt = star.date_dimension(qa), star.tag_dimension(qt)
    return star.fact_detail(qt, dd, dt, with_fact_id=with_fact_id), dd, dt


def a16(spark, sf_dir):
    return star.date_profile(_qa(spark, sf_dir))


def r04(spark, sf_dir):
    return star.date_dimension(_qa(spark, sf_dir))


def r05(spark, sf_dir):
    return star.question_tags(_qa(spark, sf_dir))


def r06(spark, sf_dir):
    return star.tag_dimension(r05(spark, sf_dir))


def r07(spark, sf_dir):
    return _star_fact(spark, sf_dir, with_fact_id=False)[0]


def s07_fact_ids(spark, sf_dir):
    """Row count, distinct and missing surrogate keys of the fact (their values are arbitrary)."""
    from pyspark.sql import functions as F
    return _star_fact(spark, sf_dir)[0].agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("fact_id").alias("n_fact_ids"),
        F.sum(F.col("fact_id").isNull().cast("long")).alias("n_missing"))


def r08(spark, sf_dir):
    return star.fact_cube(_star_fact(spark, sf_dir)[0])


def r09(spark, sf_dir):
    return star.day_tag_report_pruned(_qa(spark, sf_dir), day=REPORT_DAY)


def s07_stored_cube(spark, sf_dir):
    """The whole load: dimensions, detail and cube rows written as tables, the
    one-day report answered from the stored cube rows."""
    out = new_table_path(spark)
    paths = star.run_star_etl(_qa(spark, sf_dir), out)
    stored = {n: spark.read.parquet(p) for n, p in paths.items()}
    cube = stored["fact_questioned"].where("row_kind = 'cube'")
    return held_by(star.day_tag_report(cube, stored["dim_date"], stored["dim_tags"], day=REPORT_DAY), out)


def s07_reloaded(spark, sf_dir):
    """The load killed between detail and cube, resumed, and run a second time;
    the one-day report answered from what is committed."""
    qa, out = _qa(spark, sf_dir), new_table_path(spark)
    try:
        star_load.load_star(qa, out, stop_after="cube")
    except star_load.Killed:
        pass
    star_load.load_star(qa, out)
    star_load.load_star(qa, out)
    stored = star_load.read_star(spark, out)
    cube = stored["fact_questioned"].where("row_kind = 'cube'")
    return held_by(star.day_tag_report(cube, stored["dim_date"], stored["dim_tags"], day=REPORT_DAY), out)


def s07_load_record(spark, sf_dir):
    """Rows of each step after a killed, a resumed and a second run, as recorded and as stored."""
    from pyspark.sql import functions as F
    qa, out = _qa(spark, sf_dir), new_table_path(spark)
    for stop in ("detail", "cube", None, None):
        try:
            star_load.load_star(qa, out, stop_after=stop)
        except star_load.Killed:
            pass
    stored = star_load.read_star(spark, out)
    fact = stored["fact_questioned"]
    rows = [stored["dim_date"].select(F.lit("dim_date").alias("step")), stored["dim_tags"].select(F.lit("dim_tags").alias("step")),
            fact.select(F.col("row_kind").alias("step"))]
    counted = reduce(DataFrame.union, rows).groupBy("step").agg(F.count(F.lit(1)).alias("n_stored"))
    recorded = spark.createDataFrame([(r.step, r.n_rows) for r in star_load.commits(spark, out)], "step string, n_recorded long")
    return held_by(recorded.join(counted, "step"), out)


def s13_keys_continue(spark, sf_dir):
    """Two loads of facts, the second numbered after the first one's largest
    key: one row per load, and the keys of both together."""
    from pyspark.sql import functions as F
    qa = _qa(spark, sf_dir)
    qt = materialize(star.question_tags(qa))
    dd, dt = star.date_dimension(qa), materialize(star.tag_dimension(qt))
    early = F.col("q_creation_date") < ts_lit(SECOND_LOAD_FROM)
    first = materialize(star.fact_detail(qt.where(early), dd, dt))
    second = materialize(star.fact_detail(qt.where(~early | early.isNull()), dd, dt, after=largest_key(first, "fact_id")))
    both = first.select(F.lit(1).alias("load_no"), "fact_id").union(second.select(F.lit(2).alias("load_no"), "fact_id"))
    return both.groupBy("load_no").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("fact_id").alias("n_ids"),
        F.min("fact_id").alias("first_id"), F.max("fact_id").alias("last_id"))


def s08_gate_report(spark, sf_dir):
    """What the gates say of four tables: rows that break each declared rule."""
    qa, sales = _qa(spark, sf_dir), _sales(spark, sf_dir)
    rules = [
        (gates.Rules("sales_order", SALES_ORDER, "sales_order_id", foreign={"manager_id": (sales["manager"], "manager_id")}),
         sales["sales_order"]),
        (gates.Rules("sales_order_line", SALES_ORDER_LINE, "order_line_id", foreign={
            "sales_order_id": (sales["sales_order"], "sales_order_id"), "product_id": (sales["product"], "product_id")}),
         sales["sales_order_line"]),
        (gates.Rules("manager", MANAGER, "manager_id", {"manager_last_name": NAME_LENGTH}, ("manager_first_name",),
                     {"office_id": (sales["office"], "office_id")}), sales["manager"]),
        (gates.Rules("tagsynonyms", StructType([]), unique=("sourcetagname",), foreign={"targettagname": (qa["tags"], "tagname")}),
         qa["tagsynonyms"]),
    ]
    reports = []
    for rule, df in rules:
        seen_df, seen = gates.watched(df, rule)
        reports.append(gates.report(rule, materialize(seen_df), seen))
    return gates.as_table(spark, reports)


def s01_rejects(spark, sf_dir):
    """Posts as XML text in which some records are malformed: rows read and
    records refused, with the scores that were read."""
    from pyspark.sql import functions as F
    posts, _ = _experts(spark, sf_dir)
    attribute = lambda name: F.when(F.col(f"_{name}").isNotNull(), F.concat(
        F.lit(f' {name}="'), F.col(f"_{name}").cast("string"), F.lit('"'))).otherwise(F.lit(""))
    fields = F.concat(*[attribute(f.name[1:]) for f in POSTS_XML.fields if f.name != "_Score"])
    score = F.col("_Score").cast("string")
    line = (F.when(F.col("_Id") % 97 == 0, F.concat(F.lit("<row"), fields, F.lit(' Score="n/a"/>')))
            .when(F.col("_Id") % 89 == 0, F.concat(F.lit("<row"), fields, F.lit(" Score="), score, F.lit("/>")))
            .when(F.col("_Id") % 83 == 0, F.concat(F.lit("<row"), fields, F.lit(' Score="'), score, F.lit('" Score="0"/>')))
            .otherwise(F.concat(F.lit("<row"), fields, F.lit(' Score="'), score, F.lit('"/>'))))
    path = new_table_path(spark)
    posts.select(line.alias("value")).write.text(path)
    rows, rejects = read_rows_xml_checked(spark, path, POSTS_XML)
    held_by(rows, path)
    return rows.agg(F.lit("read").alias("kind"), F.count(F.lit(1)).alias("n_rows"), F.sum("_Score").alias("sum_score")).union(
        rejects.agg(F.lit("refused").alias("kind"), F.count(F.lit(1)).alias("n_rows"), F.lit(None).cast("long").alias("sum_score")))


def _text_dates(spark, sf_dir):
    """Order dates as text: one form for even ids, the other for odd ones, and broken ones."""
    from pyspark.sql import functions as F
    order = F.col("sales_order_id")
    text = (F.when(order % 97 == 0, F.date_format("order_date", "yyyy.MM.dd").substr(F.lit(1), F.lit(7)))
            .when(order % 89 == 0, F.concat(F.lit("31.02."), F.year("order_date").cast("string")))
            .when(order % 2 == 0, F.date_format("order_date", "yyyy.MM.dd")).otherwise(F.date_format("order_date", "dd.MM.yyyy")))
    return with_dates(_sales(spark, sf_dir)["sales_order"].select("sales_order_id", text.alias("date_text")), "date_text", "order_day")


def f01_text_dates(spark, sf_dir):
    """Orders by the month of a date that arrived as text, on the calendar made from those dates."""
    from pyspark.sql import functions as F
    rows, _ = _text_dates(spark, sf_dir)
    months = calendar_covering(rows, "order_day").where("date_lvl = 2")
    counted = rows.groupBy(trunc_month("order_day").alias("month")).agg(F.count(F.lit(1)).alias("n_orders"))
    return months.join(counted, months["date_val"] == counted["month"], "left").select(
        "dim_date_id", "date_val", F.coalesce("n_orders", F.lit(0)).alias("n_orders"))


def f02_text_date_rejects(spark, sf_dir):
    """The texts that are no date, and their rows."""
    from pyspark.sql import functions as F
    _, rejects = _text_dates(spark, sf_dir)
    return rejects.groupBy("date_text").agg(F.count(F.lit(1)).alias("n_orders"))


def r20_sql(spark, sf_dir):
    return run_sql(spark, sales_sql.QUANTITY_SOLD, _sales(spark, sf_dir), after="1995-12-31", before="1996-01-31")


def r22_sql(spark, sf_dir):
    return run_sql(spark, sales_sql.BEST_MANAGERS, _sales(spark, sf_dir), after="1995-12-31", before="1996-02-01")


def r27_sql(spark, sf_dir):
    return run_sql(spark, sales_sql.RUNNING_TOTALS, _sales(spark, sf_dir), first="1996-01-01", last="1996-12-31")


def r32_closure(spark, sf_dir):
    """The walks from every directory: (root, node, level)."""
    nodes = standins.file_system(spark, sf_dir)
    index = materialize(interval_index(walk_from_roots(nodes, carry=("type",))))
    return closure(index, index.where("type = 'dir'").select("id"))


def r10(spark, sf_dir):
    return star.missing_synonym_targets(_qa(spark, sf_dir), r06(spark, sf_dir))


def r11(spark, sf_dir):
    return star.untagged_questions(r05(spark, sf_dir))


def s10_tags(spark, sf_dir):
    return key_violations(r06(spark, sf_dir), ["dim_tag_id"])


def s10_tag_names(spark, sf_dir):
    return key_violations(r06(spark, sf_dir), ["tag_name"])


def s10_dates(spark, sf_dir):
    return key_violations(r04(spark, sf_dir), ["dim_date_id"])


def s11_fact_dates(spark, sf_dir):
    detail, dd, _ = _star_fact(spark, sf_dir, with_fact_id=False)
    return foreign_key_violations(detail, "d_date_id", dd, "dim_date_id")


def s11_fact_tags(spark, sf_dir):
    detail, _, dt = _star_fact(spark, sf_dir, with_fact_id=False)
    return foreign_key_violations(detail, "d_tag_id", dt, "dim_tag_id")


def s11_synonym_targets(spark, sf_dir):
    """Synonyms whose target is no tag: real orphans of the tables."""
    qa = _qa(spark, sf_dir)
    return foreign_key_violations(qa["tagsynonyms"], "targettagname", qa["tags"], "tagname")


def s12_line_ids(spark, sf_dir):
    """Line ids that several lines share (the stand-in rule does not keep them unique)."""
    return key_violations(_sales(spark, sf_dir)["sales_order_line"], ["order_line_id"])


# The topic and location lists moved onto the driver tables
# (order priorities stand for tags, nation names for user locations).
TOPIC = "URGENT"
LOCATIONS = ["nation_1", "nation_7"]
LOCATIONS_SMALL = ["nation_2", "nation_22"]


def _experts(spark, sf_dir):
    return standins.expert_posts(spark, sf_dir), standins.expert_users(spark, sf_dir)


def r01(spark, sf_dir):
    return ex.topic_experts_sql_form(*_experts(spark, sf_dir), topic=TOPIC, locations=LOCATIONS)


def r02(spark, sf_dir):
    return ex.topic_experts(*_experts(spark, sf_dir), topic=TOPIC, locations=LOCATIONS)


def r03(spark, sf_dir):
    return ex.topic_experts(*_experts(spark, sf_dir), topic=TOPIC, locations=LOCATIONS_SMALL)


def r01_table(spark, sf_dir):
    """R1's result created as a table, and read back."""
    path = new_table_path(spark)
    write_table(r01(spark, sf_dir), path)
    return held_by(spark.read.parquet(path), path)


def r01_exact(spark, sf_dir):
    """The variant that matches one whole tag instead of a part of the tag string."""
    posts, users = _experts(spark, sf_dir)
    return ex.topic_experts_sql_form(posts, users, topic=TOPIC, locations=LOCATIONS, exact_tag=True)


def s01_xml(spark, sf_dir):
    """The job end to end: posts and users as XML files, XML result, read back."""
    posts, users = _experts(spark, sf_dir)
    base = new_table_path(spark)
    write_rows_xml(posts, f"{base}/posts", root_tag="posts")
    write_rows_xml(users, f"{base}/users", root_tag="users")
    ex.run_expert_job(spark, f"{base}/posts", f"{base}/users", f"{base}/out", topic=TOPIC, locations=LOCATIONS)
    return held_by(read_rows_xml(spark, f"{base}/out", EXPERTS_XML), base)


def r32(spark, sf_dir):
    return tree_report(standins.file_system(spark, sf_dir))


def r26_variant(spark, sf_dir):
    return sa.product_growth(_sales(spark, sf_dir), start="1995-12-01", end="1996-06-30",
                             first_month="1995-12-01", filter_after_lag=True)


def r30_variant(spark, sf_dir):
    return sa.monthly_price_extremes(_sales(spark, sf_dir), start="1996-01-01", end="1996-12-31",
                                     distinct_products=True)


def r31_variant(spark, sf_dir):
    return sa.monthly_profit(_sales(spark, sf_dir), start="1996-01-01", end="1996-12-31", keep_manager=True)


QUERIES: dict[str, Query] = {
    "r26v_product_growth_filter_after_lag": r26_variant,
    "r30v_monthly_price_extremes_distinct_products": r30_variant,
    "r31v_monthly_profit_per_manager_salary": r31_variant,
    "r01_topic_experts_sql_form": r01,
    "r02_topic_experts": r02,
    "r03_topic_experts_small_list": r03,
    "r32_tree_report": r32,
    "a16_post_date_profile": a16,
    "r04_date_dimension": r04,
    "r05_question_tags": r05,
    "r06_tag_dimension": r06,
    "r07_fact_detail": r07,
    "r08_fact_cube": r08,
    "r09_day_tag_report": r09,
    "r10_missing_synonym_targets": r10,
    "r11_untagged_questions": r11,
    "s10_dim_tags_key_check": s10_tags,
    "s10_dim_tags_name_check": s10_tag_names,
    "s10_dim_date_key_check": s10_dates,
    "s11_fact_date_fk_check": s11_fact_dates,
    "s11_fact_tag_fk_check": s11_fact_tags,
    "s11_synonym_target_fk_check": s11_synonym_targets,
    "s12_order_line_key_check": s12_line_ids,
    "s07_fact_id_check": s07_fact_ids,
    "s07_stored_cube_report": s07_stored_cube,
    "s07_reloaded_cube_report": s07_reloaded,
    "s07_load_record": s07_load_record,
    "s08_load_gate_report": s08_gate_report,
    "s13_fact_keys_continue": s13_keys_continue,
    "r32c_tree_closure": r32_closure,
    "s01r_xml_rejects": s01_rejects,
    "f01_text_dates": f01_text_dates,
    "f02_text_date_rejects": f02_text_date_rejects,
    "r20q_quantity_sold_sql_text": r20_sql,
    "r22q_best_managers_sql_text": r22_sql,
    "r27q_running_totals_sql_text": r27_sql,
    "s01_xml_experts": s01_xml,
    "r01t_topic_experts_table": r01_table,
    "r01v_topic_experts_exact_tag": r01_exact,
    "r12_all_orders": _basic(sb.all_orders),
    "r13_orders_after": _basic(sb.orders_after, day="1996-01-01"),
    "r14_orders_between": _basic(sb.orders_between, after="1996-01-01", before="1996-07-15"),
    "r15_managers_named": _basic(sb.managers_named, first_name=FIRST_NAME),
    "r16_orders_of_managers_named": _basic(sb.orders_of_managers_named, first_name=FIRST_NAME),
    "r17_countries": _basic(sb.countries),
    "r18_country_regions": _basic(sb.country_regions),
    "r19_cities_per_country": _basic(sb.cities_per_country),
    "r20_quantity_sold": _basic(sb.quantity_sold, after="1995-12-31", before="1996-01-31"),
    "r21_place_titles": _basic(sb.place_titles),
    "r22_best_managers": _basic(sb.best_managers, after="1995-12-31", before="1996-02-01"),
    "r23_best_manager_bonus": r23,
    "r24_best_manager_bonus_first_version": r24,
    "r25_office_year_share": r25,
    "r26_product_growth": r26,
    "r27_running_totals": r27,
    "r28_price_tail_share": r28,
    "r29_top_managers_by_country": r29,
    "r30_monthly_price_extremes": r30,
    "r31_monthly_profit": r31,
    "r33_sales_fact_view": r33,
}

# Registry order: by name (profile, reports r01-r33 with variants next to
# their report, then the data checks).
QUERIES = dict(sorted(QUERIES.items(), key=lambda kv: (kv[0][0] == "s", kv[0])))
