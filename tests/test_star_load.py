"""The repeatable load: killed, resumed, run again, changed inputs, broken inputs."""

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.numbering import largest_key, numbered
from ledgerline.plans import star, star_load
from ledgerline.schemas import DIM_TAGS
from ledgerline.session import path_exists
from ledgerline.sources import gates, standins

SF = "/root/testdata/sf0.001"


def facts(spark, out):
    return sorted(map(repr, star_load.read_star(spark, out)["fact_questioned"].collect()))


@pytest.mark.parametrize("stop", star_load.STEPS)
def test_a_killed_load_is_resumed_to_the_same_table(spark, scratch_dir, stop):
    qa = standins.qa_tables(spark, SF)
    whole, killed = f"{scratch_dir}/whole", f"{scratch_dir}/killed"
    star_load.load_star(qa, whole)
    with pytest.raises(star_load.Killed):
        star_load.load_star(qa, killed, stop_after=stop)
    with pytest.raises(LookupError):
        star_load.read_star(spark, killed)              # nothing is seen before the last record
    star_load.load_star(qa, killed)
    assert facts(spark, killed) == facts(spark, whole)
    before = star_load.commits(spark, killed)
    star_load.load_star(qa, killed)                     # a second run writes nothing
    assert star_load.commits(spark, killed) == before and len(before) == 4
    assert facts(spark, killed) == facts(spark, whole)


def test_changed_inputs_are_a_new_version(spark, scratch_dir):
    qa = standins.qa_tables(spark, SF)
    first = star_load.load_star(qa, scratch_dir)
    n = star_load.read_star(spark, scratch_dir)["fact_questioned"].where("row_kind = 'detail'").count()
    fewer = dict(qa, posts=qa["posts"].where("id % 2 = 0"))
    second = star_load.load_star(fewer, scratch_dir)
    assert first != second
    assert 0 < star_load.read_star(spark, scratch_dir)["fact_questioned"].where("row_kind = 'detail'").count() < n


def test_a_broken_load_commits_nothing(spark, scratch_dir):
    qa = standins.qa_tables(spark, SF)
    good = star_load.load_star(qa, scratch_dir)
    long = F.when(F.col("id") == 3, F.repeat(F.lit("x"), 150)).otherwise(F.col("tagname"))
    twice = qa["tags"].withColumn("tagname", long).union(qa["tags"].where("id = 5").withColumn("tagname", F.lit("Brand#other")))
    with pytest.raises(gates.LoadRejected) as e:
        star_load.load_star(dict(qa, tags=twice), scratch_dir)
    assert {r: bad for _, r, _, bad in e.value.report if bad} == {"key dim_tag_id": 1, "length tag_name": 1}
    assert {r.load_version for r in star_load.commits(spark, scratch_dir) if r.step != "dim_date"} == {good}
    assert star_load.read_star(spark, scratch_dir)["dim_tags"].where("length(tag_name) > 100").count() == 0


def test_gates_count_each_rule(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c" * 101), (4, None), (5, "a")], "dim_tag_id long, tag_name string")
    parent = spark.createDataFrame([("a",), ("b",)], "name string")
    rule = gates.Rules("t", DIM_TAGS, "dim_tag_id", {"tag_name": 100}, ("tag_name",), {"tag_name": (parent, "name")})
    df, seen = gates.watched(rows, rule)
    df.collect()
    got = {r: bad for _, r, n, bad in gates.report(rule, rows, seen) if n == 5}
    want = {"length tag_name": 1, "key dim_tag_id": 2, "unique tag_name": 1, "foreign tag_name": 1}
    want |= {f"not null {f.name}": rows.where(F.col(f.name).isNull()).count() for f in DIM_TAGS.fields if not f.nullable}
    assert got == want
    with pytest.raises(gates.LoadRejected):
        gates.gate(gates.report(rule, rows, seen))
    gates.gate([("t", "r", 5, 0)])


def test_keys_without_gaps_whatever_the_partitions(spark):
    rows = spark.range(5000).select((F.col("id") % 100).alias("a"), F.col("id").cast("string").alias("b"))
    one = {tuple(r) for r in numbered(rows.repartition(1), ["a", "b"], "k", 10).collect()}
    two = {tuple(r) for r in numbered(rows.repartition(7), ["a", "b"], "k", 10).collect()}
    assert one == two and sorted(r[2] for r in one) == list(range(11, 5011))
    more = numbered(rows, ["b"], "k", largest_key(spark.createDataFrame(list(one), "a long, b string, k long"), "k"))
    assert sorted(r.k for r in more.collect()) == list(range(5011, 10011))
    none = rows.limit(0)
    assert numbered(none, ["a"], "k").count() == 0
    assert none.select(largest_key(none.withColumn("k", F.col("a")), "k").alias("x")).count() == 0
    alike = numbered(spark.range(50).select(F.lit(1).alias("a")), ["a"], "k")
    assert sorted(r.k for r in alike.collect()) == list(range(1, 51))


def test_detail_ids_are_the_same_again(spark):
    qa = standins.qa_tables(spark, SF)
    qt = star.question_tags(qa)
    dd, dt = star.date_dimension(qa), star.tag_dimension(qt)
    runs = [sorted(map(tuple, star.fact_detail(qt.repartition(n), dd, dt).collect()), key=repr) for n in (2, 5)]
    assert runs[0] == runs[1]
    assert sorted(r[2] for r in runs[0]) == list(range(1, len(runs[0]) + 1))


def test_path_exists(spark, scratch_dir):
    assert path_exists(spark, scratch_dir) and not path_exists(spark, scratch_dir + "/none")
