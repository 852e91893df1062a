"""Tree report: two roots, NULL sizes, empty directories, an orphan subtree,
a cycle, and a chain deeper than the built-in recursion limit."""

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.tree import CycleError, walk_from_roots
from ledgerline.plans.tree_report import tree_report
from ledgerline.schemas import FILE_SYSTEM

NODES = [(1, None, "C:", "dir", None), (2, 1, "docs", "dir", None), (3, 2, "a.txt", "file", 10),
         (4, 2, "b.txt", "file", 30), (5, 1, "empty", "dir", None), (9, 5, "void", "dir", None),
         (6, None, "D:", "dir", None), (7, 6, "c.bin", "file", 60), (8, 99, "orphan", "file", 5),
         (12, 8, "under-orphan", "file", 1)]


def test_tree_report_fixture(spark):
    got = {r.id: r for r in tree_report(spark.createDataFrame(NODES, FILE_SYSTEM)).collect()}
    assert sorted(got) == [1, 2, 3, 4, 5, 6, 7, 9]          # orphan subtree dropped (D26)
    assert {i: got[i].dir_size for i in got} == {1: 40, 2: 40, 3: 10, 4: 30, 5: 0, 6: 60, 7: 60, 9: 0}
    assert got[1].dir_ratio == pytest.approx(0.4) and got[6].dir_ratio == pytest.approx(0.6)
    assert got[2].dir_ratio == 1.0 and got[5].dir_ratio == 0.0
    assert got[3].dir_ratio == 0.25 and got[9].dir_ratio is None       # zero total (D27)
    assert got[1].full_name == "\\C:"
    assert got[3].full_name == "        \\C:\\docs\\a.txt"
    ids = [r.id for r in tree_report(spark.createDataFrame(NODES, FILE_SYSTEM)).collect()]
    assert ids == sorted(ids)


def test_cycle_raises(spark):
    nodes = NODES + [(10, 11, "x", "dir", None), (11, 10, "y", "dir", None)]
    with pytest.raises(CycleError):
        walk_from_roots(spark.createDataFrame(nodes, FILE_SYSTEM))


def test_chain_deeper_than_recursion_limit(spark):
    depth = 110
    nodes = [(i, None if i == 1 else i - 1, f"n{i}", "dir" if i < depth else "file", 1) for i in range(1, depth + 1)]
    got = {r.id: r for r in tree_report(spark.createDataFrame(nodes, FILE_SYSTEM)).collect()}
    assert len(got) == depth
    assert got[1].dir_size == depth and got[depth].dir_size == 1
    assert got[depth].full_name.startswith(" " * 4 * (depth - 1) + "\\n1\\n2\\")


def test_cycle_in_a_large_forest_raises_before_paths_grow(spark):
    """20,000 flat roots and a two-node cycle: no written path is longer than the true depth."""
    from pyspark.sql import functions as F

    import ledgerline.session as session
    roots = spark.range(20_000).select(F.col("id"), F.lit(None).cast("long").alias("parent_id"), F.col("id").cast("string").alias("name"),
                                       F.lit("dir").alias("type"), F.lit(1).cast("long").alias("file_size"))
    loop = spark.createDataFrame([(50_000, 50_001, "x", "dir", 1), (50_001, 50_000, "y", "dir", 1)], FILE_SYSTEM)
    before = set(session.written_tables(spark))
    with pytest.raises(CycleError):
        walk_from_roots(roots.union(loop))
    for path in set(session.written_tables(spark)) - before:
        written = spark.read.parquet(path)
        if "path_ids" in written.columns:
            assert written.agg(F.max(F.size("path_ids"))).first()[0] <= 1


def test_a_directory_with_most_of_the_nodes_is_dealt_over_slots(spark):
    """90% of the nodes under one parent: no task of a round reads a large share of them."""
    import ledgerline.session as session
    n = 20_000
    rows = spark.range(1, n + 1).select(
        "id", F.when(F.col("id") == 1, None).when(F.col("id") < n // 10, F.lit(1)).otherwise(F.lit(7)).cast("long").alias("parent_id"),
        F.concat(F.lit("n"), "id").alias("name"), F.lit("dir").alias("type"), F.lit(1).cast("long").alias("file_size"))
    legs = []
    look = lambda df: legs.append(df)
    session.ON_WRITE.append(look)
    try:
        walked = walk_from_roots(rows)
    finally:
        session.ON_WRITE.remove(look)
    assert {(r.level, r["count"]) for r in walked.groupBy("level").count().collect()} == {
        (1, 1), (2, n // 10 - 2), (3, n - n // 10 + 1)}
    keys = [df._jdf.queryExecution().executedPlan().toString() for df in legs[1:]]
    assert keys and all("_slot" in plan for plan in keys)
    slots = max(8, session.shuffle_partitions(spark))
    largest = rows.groupBy("parent_id", F.pmod(F.xxhash64("id"), F.lit(slots))).count().agg(F.max("count")).first()[0]
    assert largest < 1.5 * n / slots


def test_subtree_totals_look_ranges_up_without_lambdas(spark):
    plan = tree_report(spark.createDataFrame(NODES, FILE_SYSTEM))._jdf.queryExecution().optimizedPlan().toString()
    assert "_range" in plan and not [line for line in plan.splitlines() if "_range" in line and "lambda" in line]


def test_leaves_stay_out_of_the_rounds_and_the_prefix_sum(spark, monkeypatch):
    """5,000 files in 20 directories: the rounds write directories only, and only these go through the prefix sum."""
    import ledgerline.operators.tree as tree
    import ledgerline.session as session
    dirs, n = 20, 5_000
    rows = spark.range(n).select(
        "id", F.when(F.col("id") == 0, None).when(F.col("id") < dirs, F.expr("(id - 1) div 2")).otherwise(
            F.col("id") % dirs).cast("long").alias("parent_id"),
        F.concat(F.lit("n"), "id").alias("name"), F.when(F.col("id") < dirs, "dir").otherwise("file").alias("type"),
        F.when(F.col("id") >= dirs, 1).cast("long").alias("file_size"))
    rounds, summed, prefix_sum = [], [], tree.exclusive_prefix_sum
    look = lambda df: rounds.append(df.count()) if "anc" in df.columns else None
    monkeypatch.setattr(tree, "exclusive_prefix_sum", lambda df, *args: summed.append(df.count()) or prefix_sum(df, *args))
    session.ON_WRITE.append(look)
    try:
        report = tree_report(rows)
    finally:
        session.ON_WRITE.remove(look)
    assert rounds and max(rounds) <= dirs
    assert summed == [2 * dirs]
    assert report.count() == n and report.where("id = 0").first().dir_size == n - dirs


def test_tree_report_against_a_walk(spark):
    """Roots without children, chains under a missing parent, null sizes and names, sized directories, and one
    directory whose leaves are dealt over the slots."""
    import random
    rng = random.Random(5)
    nodes = {i: (None if i < 4 else 10_000 + i if i < 7 else rng.randrange(2, i), f"n{i}" if i % 50 else None,
                 None if i % 7 == 0 else i) for i in range(120)}
    nodes |= {i: (12, f"n{i}", i) for i in range(200, 500)} | {i: (5, f"n{i}", i) for i in range(500, 520)}
    lines = {}
    for i in nodes:
        line, at = [i], nodes[i][0]
        while at is not None and at in nodes:
            line, at = [at, *line], nodes[at][0]
        if at is None:
            lines[i] = line
    size, family = dict.fromkeys(lines, 0), {}
    for i, line in lines.items():
        for above in line:
            size[above] += nodes[i][2] or 0
    for i in lines:
        family[nodes[i][0]] = family.get(nodes[i][0], 0) + size[i]
    rows = spark.createDataFrame([(i, p, name, "dir", s) for i, (p, name, s) in nodes.items()], FILE_SYSTEM)
    got = {r.id: r for r in tree_report(rows).collect()}
    assert set(got) == set(lines) and 12 in lines and 5 not in lines
    for i, line in lines.items():
        path = " " * 4 * (len(line) - 1) + "".join("\\" + (nodes[x][1] or "") for x in line)
        share = size[i] / family[nodes[i][0]] if family[nodes[i][0]] else None
        assert (got[i].full_name, got[i].dir_size, got[i].dir_ratio) == (path, size[i], pytest.approx(share) if share is not None else None)
    assert {r.id: r.leaf for r in walk_from_roots(rows).collect()} == {i: i not in {p for p, _, _ in nodes.values()} for i in lines}
