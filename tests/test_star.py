"""Star schema on a Q&A fixture: synonyms (two targets, missing target),
unknown member, rounding of stored averages, cube totals, ETL tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerline import schemas as S
from ledgerline.plans import star


@pytest.fixture()
def qa(spark):
    posts = [(1, 1, dt.datetime(2011, 1, 1, 10, 30), 10, -3, 2),
             (2, 1, dt.datetime(2011, 1, 1, 23, 0), 11, -2, 1),
             (3, 1, dt.datetime(2011, 1, 15), 5, 4, 0),
             (4, 1, dt.datetime(2011, 1, 20), 7, 1, 3),
             (5, 1, dt.datetime(2011, 1, 31, 8), 1, 0, 0),
             (6, 2, dt.datetime(2011, 1, 2), 100, 100, 100)]          # an answer: ignored
    tags = [(1, "java"), (2, "python"), (3, "py"), (4, "js"), (5, "pg"), (6, "postgres"), (7, "sql")]
    posttags = [(1, 1), (1, 3), (2, 5), (4, 4), (5, 99), (6, 1)]
    syn = [("py", "python"), ("js", "javascript"), ("pg", "postgres"), ("pg", "sql")]
    return {"posts": spark.createDataFrame(posts, S.POSTS),
            "posttags": spark.createDataFrame(posttags, S.POSTTAGS),
            "tags": spark.createDataFrame(tags, S.TAGS),
            "tagsynonyms": spark.createDataFrame(syn, S.TAGSYNONYMS)}


def test_question_tags_resolve_synonyms(qa):
    got = sorted((r.q_id, r.q_tag_id, r.q_tag_name) for r in star.question_tags(qa).collect())
    assert got == [(1, 1, "java"), (1, 2, "python"), (2, 6, "postgres"), (2, 7, "sql"),
                   (3, None, None), (4, 4, "js"), (5, None, None)]


def test_tag_dimension_unknown_member_and_checks(qa):
    qt = star.question_tags(qa)
    dim = sorted(tuple(r) for r in star.tag_dimension(qt).collect())
    assert dim == [(-1, "no_tag"), (1, "java"), (2, "python"), (4, "js"), (6, "postgres"), (7, "sql")]
    missing = star.missing_synonym_targets(qa, star.tag_dimension(qt)).collect()
    assert [(r.sourcetagname, r.targettagname) for r in missing] == [("js", "javascript")]
    assert sorted(r.q_id for r in star.untagged_questions(qt).collect()) == [3, 5]


def test_fact_and_cube(qa):
    qt = star.question_tags(qa)
    dd = star.date_dimension(qa)
    assert dd.count() == 31 + 1 + 1           # January 2011: days, one month row, one year row
    dt_ = star.tag_dimension(qt)
    detail = star.fact_detail(qt, dd, dt_)
    rows = detail.collect()
    assert len(rows) == 7 and len({r.fact_id for r in rows}) == 7
    assert all(r.d_date_id is not None and r.d_tag_id is not None for r in rows)
    day1 = dd.filter((F.col("date_val") == dt.date(2011, 1, 1)) & (F.col("date_lvl") == 1)).first().dim_date_id
    assert sum(1 for r in rows if r.d_date_id == day1) == 4     # time of day ignored
    cube = {(r.d_date_id, r.d_tag_id): r for r in star.fact_cube(detail).collect()}
    grand = cube[(None, None)]
    assert grand.total_amount == 7 and grand.grouping_id == 3 and grand.fact_id == -5
    # day 1: views 10,10,11,11 -> 10.5 -> 11 (half away from zero); scores -3,-3,-2,-2 -> -2.5 -> -3
    d1 = cube[(day1, None)]
    assert d1.views_amount == 11 and d1.score == -3 and d1.answers_amount == 6
    assert sum(r.total_amount for k, r in cube.items() if k[0] is not None and k[1] is None) == 7
    report = star.day_tag_report(star.fact_cube(detail).drop("grouping_id"), dd, dt_, day="2011-01-01").collect()
    assert sorted((r.tag, r.total_amount) for r in report) == [
        ("java", 1), ("postgres", 1), ("python", 1), ("sql", 1)]
    pushed = star.day_tag_report_from_detail(detail, dd, dt_, day="2011-01-01").collect()
    assert sorted(tuple(r) for r in pushed) == sorted(tuple(r) for r in report)


def test_etl_writes_detail_then_cube_partition(qa, spark, scratch_dir):
    paths = star.run_star_etl(qa, scratch_dir)
    fact = spark.read.parquet(paths["fact_questioned"])
    kinds = {r.row_kind: r["count"] for r in fact.groupBy("row_kind").count().collect()}
    assert kinds["detail"] == 7
    cube = fact.filter(F.col("row_kind") == "cube")
    assert cube.filter(F.col("fact_id") != -5).count() == 0
    assert cube.filter(F.col("d_date_id").isNull() & F.col("d_tag_id").isNull()).first().total_amount == 7
    with pytest.raises(Exception):
        star.run_star_etl(qa, scratch_dir)      # default save mode: target exists


def test_tag_found_by_name_fans_out_on_duplicate_names(spark):
    """D20, as written: two tag ids with one name give each matching
    question one fact row per id, and the name check reports the name."""
    from ledgerline.sources.checks import key_violations
    posts = spark.createDataFrame([(1, 1, dt.datetime(2011, 1, 3), 5, 1, 0)], S.POSTS)
    tags = spark.createDataFrame([(1, "java"), (2, "java")], S.TAGS)
    qa = {"posts": posts, "posttags": spark.createDataFrame([(1, 1)], S.POSTTAGS), "tags": tags,
          "tagsynonyms": spark.createDataFrame([], S.TAGSYNONYMS)}
    qt = star.question_tags(qa)
    dim = star.tag_dimension(qt).union(spark.createDataFrame([(2, "java")], S.DIM_TAGS))
    detail = star.fact_detail(qt, star.date_dimension(qa), dim, with_fact_id=False).collect()
    assert sorted(r.d_tag_id for r in detail) == [1, 2]
    assert [r.tag_name for r in key_violations(dim, ["tag_name"]).collect()] == ["java"]
