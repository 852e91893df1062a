"""Topic experts by location (R1-R3), and the XML-in/XML-out job.

Questions on a topic -> their answers -> answer owners whose location
contains any of a list of place names -> score per owner.  All predicates
are column expressions (no row lambda), so the topic test reaches the scan
as a pushed StringContains filter and the location test is code-generated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import contains_any
from ..schemas import POSTS_XML, USERS_XML
from ..sources.xml import read_rows_xml, write_rows_xml

# The reference's location lists.
LOCATIONS_HIVE = ["russia", "russian federation", "moscow", "saint petersburg",
                  "россия", "москва", "санкт-петерург"]
LOCATIONS_JOB = ["russia", "russian federation", "moscow", "saint petersburg",
                 "россия", "москва", "санкт-петербург"]
LOCATIONS_DEBUG = ["london", "new york", "usa", "united states"]


def topic_experts_sql_form(posts: DataFrame, users: DataFrame, topic: str = "hadoop",
                           locations=tuple(LOCATIONS_HIVE), exact_tag: bool = False) -> DataFrame:
    """Questions are type 1 whose tag string contains ``topic`` (a
    substring test, D4: 'hadoop' also matches longer tag names; ``exact_tag``
    is the variant matching one whole ``<tag>``).  Sum of answer scores and
    number of answers per located owner, highest score first (owners whose
    scores are all NULL come last, as in the engines of the original, D28)."""
    tag_test = (F.col("_Tags").contains(f"<{topic}>") if exact_tag else F.col("_Tags").contains(topic))
    questions = posts.filter((F.col("_PostTypeId") == 1) & tag_test).select(F.col("_Id").alias("q_id"))
    located = users.filter(contains_any("_Location", locations)).select(
        "_Id", F.col("_Location").alias("location"), F.col("_DisplayName").alias("display_name"),
        F.col("_AccountId").alias("account_id"))
    joined = located.join(_per_owner(posts, questions, "q_id"), F.col("_Id") == F.col("owner"), "inner")
    return (joined.groupBy("location", "display_name", "account_id")
            .agg(F.sum("score").alias("sum_scr"), F.sum("answers").alias("answered_num"))
            .orderBy(F.col("sum_scr").desc_nulls_last()))


def _per_owner(posts: DataFrame, questions: DataFrame, key: str) -> DataFrame:
    """Score and number of the answers to ``questions`` per owner: partial
    sums before the shuffle, so a prolific owner is one row a task, and the
    join with the users is owner-sized."""
    answers = posts.select("_ParentId", F.col("_OwnerUserId").alias("owner"), "_Score").join(
        questions, F.col("_ParentId") == F.col(key), "inner")
    return answers.filter(F.col("owner").isNotNull()).groupBy("owner").agg(
        F.sum("_Score").alias("score"), F.count(F.lit(1)).alias("answers"))


def topic_experts(posts: DataFrame, users: DataFrame, topic: str = "brewing",
                  locations=tuple(LOCATIONS_JOB)) -> DataFrame:
    """The DataFrame job's form - any post whose tags contain the
    topic (no type filter, D1), answers joined by parent id, owners by
    location; ``sum_score`` per (name, account, location), descending.  The
    aggregate is aliased so the result is writable as XML (D6)."""
    ids = posts.filter(F.col("_Tags").contains(topic)).select(F.col("_Id").cast("long").alias("value"))
    located = users.filter(contains_any("_Location", locations))
    joined = located.join(_per_owner(posts, ids, "value"), F.col("_Id") == F.col("owner"), "inner")
    return (joined.groupBy("_DisplayName", "_AccountId", "_Location")
            .agg(F.sum("score").alias("sum_score"))
            .orderBy(F.col("sum_score").desc_nulls_last()))


def run_expert_job(spark: SparkSession, posts_path: str, users_path: str, output_path: str,
                   topic: str = "brewing", locations=tuple(LOCATIONS_JOB)) -> None:
    """The reference job end to end: XML dumps in, XML ``<users><row .../>``
    out; fails if the output exists (the default save mode)."""
    posts = read_rows_xml(spark, posts_path, POSTS_XML)
    users = read_rows_xml(spark, users_path, USERS_XML)
    write_rows_xml(topic_experts(posts, users, topic, locations), output_path,
                   root_tag="users", row_tag="row")


def main(argv: list[str] | None = None) -> None:
    """``python -m ledgerline.plans.experts POSTS USERS OUTPUT [--topic T]
    [--locations a,b,...]``: the job's three positional paths."""
    import argparse
    p = argparse.ArgumentParser(description="Topic experts by location, XML in and out")
    p.add_argument("posts")
    p.add_argument("users")
    p.add_argument("output")
    p.add_argument("--topic", default="brewing")
    p.add_argument("--locations", default=",".join(LOCATIONS_JOB))
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("topic-experts").getOrCreate()
    run_expert_job(spark, a.posts, a.users, a.output, a.topic, [x for x in a.locations.split(",") if x])


if __name__ == "__main__":
    main()
