"""Expert ranking: XML in, XML out, location and topic predicates."""

import os

from ledgerline.plans import experts as ex
from ledgerline.schemas import POSTS_XML, USERS_XML
from ledgerline.sources.xml import read_rows_xml

POSTS = """<?xml version="1.0" encoding="utf-8"?>
<posts>
  <row Id="1" PostTypeId="1" Tags="&lt;brewing&gt;&lt;beer&gt;" Score="5" OwnerUserId="10" />
  <row Id="2" PostTypeId="2" ParentId="1" Score="7" OwnerUserId="20" />
  <row Id="3" PostTypeId="2" ParentId="1" Score="3" OwnerUserId="21" />
  <row Id="4" PostTypeId="1" Tags="&lt;homebrewing&gt;" Score="1" OwnerUserId="10" />
  <row Id="5" PostTypeId="2" ParentId="4" Score="2" OwnerUserId="20" />
  <row Id="6" PostTypeId="2" ParentId="1" Score="4" />
  <row Id="7" PostTypeId="1" Tags="&lt;wine&gt;" Score="1" OwnerUserId="10" />
  <row Id="8" PostTypeId="2" ParentId="7" Score="9" OwnerUserId="20" />
  <row Id="9" PostTypeId="2" ParentId="1" Score="1" OwnerUserId="22" />
</posts>
"""
USERS = """<?xml version="1.0" encoding="utf-8"?>
<users>
  <row Id="20" DisplayName="Ivan" Location="МОСКВА, Россия" AccountId="200" />
  <row Id="21" DisplayName="Bob" Location="London" AccountId="210" />
  <row Id="22" DisplayName="NoLoc" AccountId="220" />
</users>
"""


def _write(d):
    p, u = os.path.join(d, "posts.xml"), os.path.join(d, "users.xml")
    with open(p, "w", encoding="utf-8") as f:
        f.write(POSTS)
    with open(u, "w", encoding="utf-8") as f:
        f.write(USERS)
    return p, u


def test_xml_job_round_trip(spark, scratch_dir):
    p, u = _write(scratch_dir)
    out = os.path.join(scratch_dir, "result")
    ex.run_expert_job(spark, p, u, out)
    back = spark.read.format("xml").option("rowTag", "row").load(out).collect()
    assert [(r._DisplayName, r._AccountId, r._Location, r.sum_score) for r in back] == [
        ("Ivan", 200, "МОСКВА, Россия", 9)]
    with open([os.path.join(out, f) for f in os.listdir(out) if f.startswith("part-")
               and os.path.getsize(os.path.join(out, f)) > 0][0], encoding="utf-8") as f:
        text = f.read()
    assert "<users>" in text and "<row " in text
    try:
        ex.run_expert_job(spark, p, u, out)
        raise AssertionError("existing output must not be overwritten")
    except Exception as e:  # noqa: BLE001
        assert "already exists" in str(e) or "PATH_ALREADY_EXISTS" in str(e)


def test_sql_form_counts_answers_and_exact_tag_variant(spark, scratch_dir):
    p, u = _write(scratch_dir)
    posts = read_rows_xml(spark, p, POSTS_XML)
    users = read_rows_xml(spark, u, USERS_XML)
    got = ex.topic_experts_sql_form(posts, users, topic="brewing", locations=ex.LOCATIONS_HIVE).collect()
    assert [(r.display_name, r.sum_scr, r.answered_num) for r in got] == [("Ivan", 9, 2)]
    exact = ex.topic_experts_sql_form(posts, users, topic="brewing", locations=ex.LOCATIONS_HIVE,
                                      exact_tag=True).collect()
    assert [(r.display_name, r.sum_scr, r.answered_num) for r in exact] == [("Ivan", 7, 1)]
    english = ex.topic_experts(posts, users, topic="brewing", locations=ex.LOCATIONS_DEBUG).collect()
    assert [(r._DisplayName, r.sum_score) for r in english] == [("Bob", 3)]


def test_job_form_has_no_type_filter(spark):
    """The DataFrame job takes any post whose tags contain the topic; the
    SQL form only questions (type 1)."""
    posts = spark.createDataFrame(
        [(1, 2, None, 20, 1, "<brewing>"),      # an answer that carries the tag
         (2, 2, 1, 20, 6, None)],               # a reply to that answer
        POSTS_XML)
    users = spark.createDataFrame([(20, "Ivan", "Moscow", 200)], USERS_XML)
    job = ex.topic_experts(posts, users, topic="brewing").collect()
    assert [(r._DisplayName, r.sum_score) for r in job] == [("Ivan", 6)]
    assert ex.topic_experts_sql_form(posts, users, topic="brewing").collect() == []
