"""Question-and-tag star schema (R4-R11): calendar, tag dimension with
synonym resolution and unknown member, fact load, cube, one-day report and
the data checks.

``run_star_etl`` writes the tables; the other functions return DataFrames
so each stage can be checked on its own.
"""

from __future__ import annotations

import datetime
import os

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import as_date, trunc_day, ts_lit
from ..operators.calendar import calendar_covering
from ..operators.cube import combined_rounded_avg, cube_agg
from ..operators.numbering import numbered
from ..schemas import DIM_DATE, DIM_TAGS, FACT_QUESTIONED
from ..session import materialize
from ..sources.checks import checked
from ..sources.tables import write_table

NO_TAG_ID = -1          # fixed value: unknown tag member
NO_TAG_NAME = "no_tag"  # fixed value: unknown tag member
CUBE_FACT_ID = -5       # fixed value: marks cube rows in the fact table
TAG_NAME_LENGTH = 100   # fixed value: declared length of a tag name


def date_profile(qa: dict[str, DataFrame]) -> DataFrame:                      # A16
    """MIN/MAX profile of the question dates: the range the calendar must
    cover (one global aggregate, partial per task)."""
    return qa["posts"].agg(F.min("creationdate").alias("min_creationdate"),
                           F.max("creationdate").alias("max_creationdate"),
                           F.count(F.lit(1)).alias("n_posts"))


def date_dimension(qa: dict[str, DataFrame]) -> DataFrame:                    # R4
    return calendar_covering(qa["posts"], "creationdate")


def question_tags(qa: dict[str, DataFrame]) -> DataFrame:                     # R5
    """One row per question x tag; a synonym tag is replaced by its target's
    id and name.  As written (D21): a source with two existing targets gives
    two rows; a missing target drops the synonym and the tag keeps its own."""
    tags = qa["tags"]
    syn = qa["tagsynonyms"]
    tsyn = tags.select(F.col("id").alias("syn_id"), F.col("tagname").alias("syn_name"))
    torig = tags.select(F.col("id").alias("orig_id"), F.col("tagname").alias("orig_name"))
    resolved = (syn.join(tsyn, syn.sourcetagname == tsyn.syn_name, "inner")
                   .join(torig, syn.targettagname == torig.orig_name, "inner")
                   .select("syn_id", "orig_id", "orig_name"))
    posts = qa["posts"].filter(F.col("posttypeid") == 1)
    pt = qa["posttags"]
    t = tags.select(F.col("id").alias("t_id"), F.col("tagname").alias("t_name"))
    q = (posts.join(pt, posts.id == pt.postid, "left")
              .join(t, pt.tagid == t.t_id, "left")
              .join(resolved, t.t_id == resolved.syn_id, "left"))
    return q.select(F.col("id").alias("q_id"),
                    F.col("creationdate").alias("q_creation_date"),
                    F.col("viewcount").alias("q_viewcount"),
                    F.col("score").alias("q_score"),
                    F.col("answercount").alias("q_answercount"),
                    F.coalesce("orig_id", "t_id").alias("q_tag_id"),
                    F.coalesce("orig_name", "t_name").alias("q_tag_name"))


def tag_dimension(question_tag: DataFrame) -> DataFrame:                       # R6
    return question_tag.select(
        F.coalesce("q_tag_id", F.lit(NO_TAG_ID).cast("long")).alias("dim_tag_id"),
        F.coalesce("q_tag_name", F.lit(NO_TAG_NAME)).alias("tag_name")).distinct()


def fact_detail(question_tag: DataFrame, dim_date: DataFrame, dim_tags: DataFrame,
                with_fact_id: bool = True, after: Column | int = 0) -> DataFrame:                         # R7
    """Date key from the day-level calendar (the level filter is applied to
    the dimension *before* the left join, so unmatched questions stay), tag
    key by name with the unknown-member default (as written, D20).

    ``fact_id`` is numbered without gaps from ``after`` + 1 on, in a fixed
    order (the reference's sequence order is arbitrary)."""
    days = dim_date.filter(F.col("date_lvl") == 1).select("dim_date_id", "date_val")
    tags = dim_tags.select("dim_tag_id", "tag_name")
    f = (question_tag
         .join(days, trunc_day("q_creation_date") == days.date_val, "left")
         .join(tags, F.coalesce("q_tag_name", F.lit(NO_TAG_NAME)) == tags.tag_name, "left"))
    cols = [F.col("dim_date_id").alias("d_date_id"), F.col("dim_tag_id").alias("d_tag_id")]
    if with_fact_id:
        f = numbered(f, ["q_id", "q_tag_id", "dim_tag_id", "dim_date_id"], "fact_id", after)
        cols.append(F.col("fact_id"))
    cols += [F.col("q_viewcount").alias("views_amount"), F.col("q_answercount").alias("answers_amount"),
             F.lit(1).cast("long").alias("total_amount"), F.col("q_score").alias("score")]
    return f.select(*cols)


def fact_cube(detail: DataFrame) -> DataFrame:                                   # R8
    """CUBE(date, tag) over the detail rows only (the snapshot, S12).

    The detail rows are first reduced to one row per (date, tag) carrying
    sums and counts, so the 4x expansion of the cube runs over groups, not
    fact rows; the cube then combines them (an average is sum / count of
    the combined parts, exactly the average of the rows)."""
    pre = detail.groupBy("d_date_id", "d_tag_id").agg(
        F.sum("views_amount").alias("_views_sum"), F.count("views_amount").alias("_views_n"),
        F.sum("answers_amount").alias("_answers"), F.sum("total_amount").alias("_total"),
        F.sum("score").alias("_score_sum"), F.count("score").alias("_score_n"))
    c = cube_agg(pre, ["d_date_id", "d_tag_id"], {
        "views_amount": combined_rounded_avg("_views_sum", "_views_n"),
        "answers_amount": F.sum("_answers"),
        "total_amount": F.sum("_total"),
        "score": combined_rounded_avg("_score_sum", "_score_n"),
    })
    return c.select("d_date_id", "d_tag_id", F.lit(CUBE_FACT_ID).cast("long").alias("fact_id"),
                    "views_amount", "answers_amount", "total_amount", "score", "grouping_id")


def day_tag_report(fact: DataFrame, dim_date: DataFrame, dim_tags: DataFrame, day="2017-07-21") -> DataFrame:  # R9
    """Cube cells of one day; the inner joins drop the subtotal rows whose
    date or tag key is NULL."""
    cube_rows = fact.filter(F.col("fact_id") == CUBE_FACT_ID)
    dd = dim_date.filter(F.col("date_val") == F.lit(as_date(day))).select("dim_date_id", "date_val")
    dt = dim_tags.select("dim_tag_id", "tag_name")
    j = (cube_rows.join(dd, cube_rows.d_date_id == dd.dim_date_id, "inner")
                  .join(dt, cube_rows.d_tag_id == dt.dim_tag_id, "inner"))
    return j.select(F.col("date_val").alias("date_created"), F.col("tag_name").alias("tag"),
                    F.col("views_amount").alias("avg_views"), "total_amount",
                    F.col("score").alias("avg_score"))


def day_tag_report_from_detail(detail: DataFrame, dim_date: DataFrame, dim_tags: DataFrame,
                               day="2017-07-21") -> DataFrame:
    """R9 computed from the detail rows without a materialised cube.

    The report keeps only cube cells whose date key is the day's and whose
    tag key is non-NULL, and such a cell aggregates exactly the detail rows
    of that (date, tag).  So the detail rows are restricted to the day's
    date ids *before* the cube - the filter Catalyst cannot push through
    the join and the Expand by itself - and the result is unchanged."""
    day_ids = dim_date.filter(F.col("date_val") == F.lit(as_date(day))).select(
        F.col("dim_date_id").alias("_day_id"))
    todays = detail.join(F.broadcast(day_ids), detail.d_date_id == day_ids._day_id, "left_semi")
    return day_tag_report(fact_cube(todays).drop("grouping_id"), dim_date, dim_tags, day)


def day_tag_report_pruned(qa: dict[str, DataFrame], day="2017-07-21") -> DataFrame:
    """R9 without a stored cube, reading one day of posts.

    A cell of the report aggregates exactly the day's questions, so the posts
    are restricted to the day's half-open timestamp range before the
    question-tag view is built: the range reaches the posts scan as a pushed
    filter, and post tags are semi-joined to the day's posts below their
    DISTINCT.  The tag dimension is that of the day; it gives the same report
    as the whole dimension because tag names are unique (S10 name check)."""
    spark = qa["posts"].sparkSession
    lo, hi = ts_lit(day), ts_lit(as_date(day) + datetime.timedelta(days=1))
    posts = qa["posts"].filter((F.col("creationdate") >= lo) & (F.col("creationdate") < hi))
    posttags = qa["posttags"].join(posts.select(F.col("id").alias("postid")), "postid", "left_semi")
    qt = materialize(question_tags(dict(qa, posts=posts, posttags=posttags)))       # day-sized, read twice
    dim_date = spark.range(1).select(F.lit(1).cast("long").alias("dim_date_id"), F.lit(as_date(day)).alias("date_val"),
                                     F.lit(1).alias("date_lvl"))
    dim_tags = tag_dimension(qt)
    detail = fact_detail(qt, dim_date, dim_tags)
    return day_tag_report(fact_cube(detail).drop("grouping_id"), dim_date, dim_tags, day)


def missing_synonym_targets(qa: dict[str, DataFrame], dim_tags: DataFrame) -> DataFrame:   # R10
    return qa["tagsynonyms"].join(dim_tags, qa["tagsynonyms"].targettagname == dim_tags.tag_name, "left_anti")


def untagged_questions(question_tag: DataFrame) -> DataFrame:                           # R11
    return question_tag.filter(F.col("q_tag_id").isNull() | F.col("q_tag_name").isNull())


def run_star_etl(qa: dict[str, DataFrame], out_dir: str, mode: str = "errorifexists") -> dict[str, str]:
    """Write dim_date, dim_tags and fact_questioned (partitioned by
    ``row_kind``: detail rows first, then the cube computed from the written
    detail partition, appended as ``row_kind=cube``)."""
    spark = qa["posts"].sparkSession
    paths = {n: os.path.join(out_dir, n) for n in ("dim_date", "dim_tags", "fact_questioned")}
    write_table(checked(date_dimension(qa), DIM_DATE), paths["dim_date"], mode)
    qt = materialize(question_tags(qa))                # read by the dimension and by the fact
    write_table(checked(tag_dimension(qt), DIM_TAGS, {"tag_name": TAG_NAME_LENGTH}), paths["dim_tags"], mode)
    dim_date = spark.read.parquet(paths["dim_date"])
    dim_tags = spark.read.parquet(paths["dim_tags"])
    detail = checked(fact_detail(qt, dim_date, dim_tags), FACT_QUESTIONED).withColumn("row_kind", F.lit("detail"))
    write_table(detail, paths["fact_questioned"], mode, partition_by=["row_kind"])
    snapshot = (spark.read.parquet(paths["fact_questioned"])
                .filter(F.col("row_kind") == "detail").drop("row_kind"))
    cube = fact_cube(snapshot).drop("grouping_id").withColumn("row_kind", F.lit("cube"))
    write_table(cube, paths["fact_questioned"], "append", partition_by=["row_kind"])
    return paths
