"""Closure of a hierarchy against a walk in Python."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import closure as C
from ledgerline.operators.tree import walk_from_roots
from ledgerline.schemas import FILE_SYSTEM


def brute(parents, roots=None):
    out = set()
    for node in parents:
        chain, at = [node], parents[node]
        while at is not None and at in parents:
            chain.append(at)
            at = parents[at]
        if at is not None:
            continue                                # under a missing parent: not reachable
        out |= {(r, node, level + 1) for level, r in enumerate(chain) if roots is None or r in roots}
    return out


def index_of(spark, parents):
    rows = [(i, p, f"n{i}", "dir", 1) for i, p in parents.items()]
    return C.interval_index(walk_from_roots(spark.createDataFrame(rows, FILE_SYSTEM)))


@pytest.mark.parametrize("kind", ["random", "chain", "star", "two roots and an orphan"])
def test_closure_against_a_walk(spark, kind):
    rng = random.Random(3)
    parents = {"random": {i: None if i < 3 else rng.randrange(max(0, i - 40), i) for i in range(400)},
               "chain": {i: i - 1 if i else None for i in range(150)},
               "star": {i: 0 if i else None for i in range(300)},
               "two roots and an orphan": {1: None, 2: 1, 3: None, 4: 99, 5: 4}}[kind]
    index = index_of(spark, parents)
    assert {tuple(r) for r in C.closure(index).collect()} == brute(parents)
    some = spark.createDataFrame([(i,) for i in (0, 1, 1, 4, 77, 5000)], "id long")
    got = [tuple(r) for r in C.closure(index, some).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(parents, {0, 1, 4, 77, 5000})


def test_intervals_and_no_pairs_on_the_way(spark):
    parents = {i: (i - 1) // 2 if i else None for i in range(2000)}
    index = index_of(spark, parents)
    rows = index.select("id", "pre", "stop").collect()
    assert sorted(r.pre for r in rows) == list(range(2000))
    top = spark.createDataFrame([(0,)], "id long")
    plan_rows = C.closure(index, top)
    assert plan_rows.count() == 2000
    # a root over everything is sent once a block, not once a node
    spans = index.where("id = 0").select(F.expr(f"(stop - 1) div {C.BLOCK} - pre div {C.BLOCK} + 1")).first()[0]
    assert spans == -(-2000 // C.BLOCK)


def test_empty(spark):
    index = C.interval_index(walk_from_roots(spark.createDataFrame([], FILE_SYSTEM)))
    assert C.closure(index).count() == 0
