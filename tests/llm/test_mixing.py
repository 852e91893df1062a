import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import mixing, queries

SF = "/root/testdata/sf0.01"
WORDS = re.compile("[^\x20\x09-\x0D]+")


def slow_targets(sizes, weights=(5, 2, 1), cap=3):
    """Bisection on the common factor instead of resharing."""
    w = [weights[i % len(weights)] for i in range(len(sizes))]
    lo, hi = 0.0, 1e12
    for _ in range(300):
        mid = (lo + hi) / 2
        if sum(min(cap * s, mid * x) for s, x in zip(sizes, w)) < sum(sizes):
            lo = mid
        else:
            hi = mid
    return [min(cap * s, lo * x) for s, x in zip(sizes, w)]


@pytest.mark.parametrize("sizes", [[10, 10, 10], [1, 100, 1000, 0, 7], [5], [0, 0], [], [1000, 1, 1, 1, 1, 1], list(range(40))])
def test_targets(sizes):
    got = mixing.targets(sizes)
    assert np.allclose(got, slow_targets(sizes)) or not sum(sizes)
    assert abs(sum(got) - sum(sizes)) < 1e-6


@pytest.mark.parametrize("n", [1, 2, 3, 17, 64, 1000])
def test_permutation_and_its_inverse(n):
    p = mixing.permuted(np.arange(n), n, (1, 2, 3))
    assert sorted(p) == list(range(n))
    assert (mixing.permuted(p, n, (1, 2, 3), inverse=True) == np.arange(n)).all()


def test_shard_counts_meet_the_totals():
    totals = np.array([100, 0, 37, 900, 1])
    first = np.zeros(5, int)
    for shard in range(21):
        at, got = mixing.shard_counts(shard, 21, 50, totals, 3)
        assert (at == first).all() and got.sum() == min(50, totals.sum() - 50 * shard)
        first = first + got
    assert (first == totals).all()
    big = np.array([10 ** 12, 3 * 10 ** 12])
    assert mixing.shard_counts(0, 1000, 4 * 10 ** 9, big, 0)[1].sum() == 4 * 10 ** 9


def check(got, docs):
    per, taken = defaultdict(int), defaultdict(int)
    n = Counter()
    for r in docs:
        per[r.source] += len(WORDS.findall(r.text or ""))
    order = sorted(per, key=lambda s: (s is None, s or ""))
    aim = dict(zip(order, slow_targets([per[s] for s in order])))
    sources = {r.doc_id: r.source for r in docs}
    size = {r.doc_id: len(WORDS.findall(r.text or "")) for r in docs}
    for r in got:
        s = sources[r.doc_id]
        n[r.doc_id] += 1
        assert r["size"] == size[r.doc_id] and r.source_size == per[s]
        assert abs(r.target - aim[s]) < 1e-6 * max(1, aim[s])
        assert 0 <= r.taken <= 3 * r["size"]
        taken[s] += r.taken
    assert set(n.values()) == {1} and set(n) == set(size)
    for s in order:
        assert abs(taken[s] - aim[s]) <= 1


def test_query_meets_every_target(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = queries.op9_mixing(spark, SF).collect()
    check(got, docs)
    assert sorted(map(tuple, got)) == sorted(map(tuple, queries.op9_mixing(spark, SF).collect()))


def fixture(spark):
    rows = [(i, " ".join("w%d_%d" % (i, k) for k in range(i % 50)), "s%d" % (i % 7 if i % 3 else 0), i) for i in range(400)]
    rows += [(1000, None, "s1", 0), (1001, " \t", None, 0), (1002, "one two", None, 0), (1003, "alone", "z", 0),
             (1004, "x " * 30_000, "s5", 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, size long")


def test_fixture(spark):
    df = fixture(spark)
    check(mixing.Mix(df, block_words=16, shard_slots=100).taken().collect(), df.collect())


def test_mixed_documents_hold_the_taken_words(spark):
    df = fixture(spark)
    mix = mixing.Mix(df, block_words=16, shard_slots=100)
    out = mix.documents()
    assert out.columns == df.columns
    words, source = defaultdict(Counter), {r.doc_id: (r.text or "").split() for r in df.collect()}
    for r in out.collect():
        words[r.doc_id].update(r.text.split())
        assert r.text.strip()
    for r in mix.taken().collect():
        assert sum(words[r.doc_id].values()) == r.taken
        own = Counter(source[r.doc_id])
        assert all(n <= 3 * own[w] for w, n in words[r.doc_id].items())
    # the slots of a shard are all used, in an order of their own
    slots = mix.slots.groupBy("shard").agg(F.count("*").alias("n"), F.countDistinct("place").alias("d"), F.max("place").alias("m"))
    assert all(r.n == r.d == r.m + 1 for r in slots.collect())


def test_repeated_ids_null_ids_and_empty(spark):
    df = spark.createDataFrame([(1, "a b c", "s"), (1, "a b c", "s"), (1, "d e", "t"), (None, "f g", "t"), (None, None, "t")],
                               "doc_id long, text string, source string")
    got = mixing.Mix(df, block_words=2).taken().collect()
    assert len(got) == 5 and sum(r.taken for r in got) == 10
    assert sum(len(r.text.split()) for r in mixing.Mix(df, block_words=2).documents().collect()) == 10
    none = mixing.Mix(df.where("false"))
    assert none.taken().count() == 0 and none.documents().count() == 0


def test_parts_of_rows_that_share_an_id_are_apart(spark):
    docs = spark.createDataFrame([(None, " ".join(f"r{k}w{i}" for i in range(9)), "a") for k in range(40)],
                                 "doc_id long, text string, source string")
    mix = mixing.Mix(docs)
    out = mix.documents()
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"Aggregate \[id#\d+L?, h#\d+L?, nth#\d+L?\], .*collect_list", plan)
    got = [r.text.split() for r in out.collect()]
    assert all(len({w.split("w")[0] for w in t}) == 1 for t in got)
    assert sum(map(len, got)) == sum(r.taken for r in mix.taken().collect()) == 360


def test_many_rows_without_an_id(spark):
    """Null ids are told apart by text; the mix is whole and no numbering group holds them all."""
    df = spark.range(3000).selectExpr("cast(if(id % 3 = 0, id, null) as long) doc_id", "concat('w', id % 900, ' and some words') text",
                                      "concat('s', id % 2) source", "'x' h", "1 nth")
    mix = mixing.Mix(df, block_words=16, shard_slots=64)
    rows = mix.taken().collect()
    assert len(rows) == 3000 and all(r.taken <= 3 * r.size for r in rows)
    for target in {(r.source_size, r.target) for r in rows}:
        taken = sum(r.taken for r in rows if (r.source_size, r.target) == target)
        assert abs(taken - round(target[1])) <= 1
    assert mix.sized.groupBy("id", "h").count().agg({"count": "max"}).first()[0] < 10
    out = mix.documents()
    assert out.columns == df.columns
    assert sum(len(r.text.split()) for r in out.collect()) == sum(r.taken for r in rows)
