import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import types as T

from ledgerline.llm import exact_dedup

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("digest", T.StringType()), T.StructField("kept", T.StringType()),
                     T.StructField("node", T.IntegerType())])
LONG = "Word " * 60_000


def rows():
    out = [(1, "Same"), (2, "sAME"), (3, "same "), (4, None), (5, ""), (6, "É"), (7, "é"), (8, LONG), (9, LONG.upper()),
           (10, "twice"), (10, "twice"), (None, "nobody"), (None, "nobody"), (None, "SAME")]
    out += [(100 + i, "hot text") for i in range(300)]
    return [(i, t, "x", None, None) for i, t in out]


def brute(data, best):
    groups = defaultdict(list)
    for i, t, *_ in data:
        groups["".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")].append(i)
    out = []
    for t, ids in groups.items():
        named = [i for i in ids if i is not None]
        keep = best(named) if named else None
        seen = False
        for i in ids:
            out.append((i, keep, len(ids), i == keep and not seen, hashlib.sha256(t.encode()).hexdigest()))
            seen |= i == keep
    return sorted(map(repr, out))


@pytest.mark.parametrize("keep,best", [("largest", max), ("smallest", min)])
def test_against_brute_force(spark, keep, best):
    got = exact_dedup.exact_groups(spark.createDataFrame(rows(), DOCS), keep=keep).collect()
    assert sorted(repr(tuple(r)) for r in got) == brute(rows(), best)


def test_stage_keeps_columns_and_one_row_a_group(spark):
    df = spark.createDataFrame(rows(), DOCS).withColumnRenamed("digest", "text_digest").withColumnRenamed("kept", "w_id")
    got = exact_dedup.drop_exact_copies(df, keep="largest")
    assert got.columns == df.columns
    assert sorted(map(str, (r.doc_id for r in got.collect()))) == sorted(
        map(str, [2, 3, 5, 6, 7, 9, 10, None, 399]))


def test_empty(spark):
    assert exact_dedup.exact_groups(spark.createDataFrame([], DOCS)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = exact_dedup.exact_groups(spark.createDataFrame(rows(), DOCS))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_repeated_rows_are_made_in_bounded_pieces(spark):
    docs = spark.range(70_000).selectExpr("cast(null AS long) AS doc_id", "'same text' AS text").union(
        spark.createDataFrame([(1, "other"), (1, "other"), (2, "alone")], "doc_id long, text string"))
    df = exact_dedup.exact_groups(docs)
    assert "sequence(1, copies" not in df._jdf.queryExecution().optimizedPlan().toString()
    got = {tuple(r) for r in df.groupBy("doc_id", "keep_id", "group_size", "kept").count().collect()}
    assert got == {(None, None, 70_000, True, 1), (None, None, 70_000, False, 69_999), (1, 1, 2, True, 1),
                   (1, 1, 2, False, 1), (2, 2, 1, True, 1)}
