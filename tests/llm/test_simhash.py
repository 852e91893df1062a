import hashlib
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import types as T

from ledgerline.llm import simhash
from ledgerline.llm.components import connected_components

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("fp", T.StringType()), T.StructField("component_id", T.StringType())])


def slow_print(text):
    import re
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def grouped(data, radius=3):
    """(fingerprints, the root of every row)."""
    fps = [slow_print(t) for _, t in data]
    root = list(range(len(data)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(data)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= radius:
                root[find(i)] = find(j)
    return fps, [find(i) for i in range(len(data))]


def brute(data, radius=3):
    fps, root = grouped(data, radius)
    comp = {}
    for i, (d, _) in enumerate(data):
        if d is not None:
            comp[root[i]] = min(comp.get(root[i], d), d)
    return sorted(repr((d, f"{fps[i]:016x}", comp.get(root[i]))) for i, (d, _) in enumerate(data))


def documents(seed=1):
    rng = random.Random(seed)
    vocab = ["w%d" % i for i in range(400)] + ["É", "straße", "x y", "日本"]
    data = [(0, None), (1, ""), (2, " \t\n\x0b"), (3, "one"), (4, "ONE"), (5, "two words"), (None, "one"),
            (None, "lonely text here")]
    n = 10
    for _ in range(25):
        base = [rng.choice(vocab) for _ in range(rng.choice([4, 80, 400, 2000]))]
        for _ in range(rng.choice([1, 2, 12])):
            words = list(base)
            for _ in range(rng.choice([0, 1, 3])):
                words[rng.randrange(len(words))] = rng.choice(vocab)
            data.append((n, rng.choice([" ", "\n", "  "]).join(words)))
            n += 1
    data.append((10, data[-1][1]))
    return data


@pytest.mark.parametrize("wide", [2, 2048])
def test_against_brute_force(spark, wide):
    data = documents()
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in data], DOCS)
    got = simhash.near_groups(df, wide_bucket=wide)
    assert sorted(repr(tuple(r)) for r in got.collect()) == brute(data)


@pytest.mark.parametrize("radius", [1, 2, 3, 4])
def test_masks_cover_the_radius(radius):
    rng = random.Random(3)
    masks = simhash.covering_masks(radius)
    assert len(masks) == 2 ** (radius + 1) - 1
    for _ in range(3000):
        diff = sum(1 << b for b in rng.sample(range(64), radius))
        assert any(diff & m == 0 for m in masks)


def test_a_doubly_dealt_bucket_is_small():
    assert simhash.widest(3) <= 20


def test_no_task_compares_a_wide_bucket(spark, monkeypatch):
    """Fingerprints that no table tells apart go to groups of about two blocks."""
    free = [i for i in range(64) if not (simhash.covering_masks(3, 1)[0] | simhash.covering_masks(3, 23)[0]) >> i & 1]
    fps = [sum(1 << b for j, b in enumerate(free[:9]) if k >> j & 1) for k in range(512)]
    fps = [f - (1 << 64) if f >> 63 else f for f in fps]
    seen = []
    links = simhash._links

    def watched(buckets, keys, radius):
        seen.append(max((r["count"] for r in buckets.groupBy(*keys).count().collect()), default=0))
        return links(buckets, keys, radius)

    monkeypatch.setattr(simhash, "_links", watched)
    got = simhash.covering_links(spark.createDataFrame([(f,) for f in fps], "fp long"), wide_bucket=64)
    roots = {r.node: r.root for r in connected_components(got).collect()}
    assert len({roots[f] for f in fps}) == 1                  # a cube: all reachable
    assert seen[0] <= 64 and 64 < seen[1] < 3 * 64


def test_links_of_one_hot_bucket(spark):
    rng = np.random.default_rng(0)
    fps = sorted({int(sum(1 << int(b) for b in rng.choice(64, 2, replace=False))) for _ in range(600)})
    fps = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    links = simhash.covering_links(df, wide_bucket=50)
    assert links.count() < 40 * len(fps)                    # forests, not all pairs
    roots = connected_components(links).collect()
    near = lambda a, b: bin((a ^ b) & (1 << 64) - 1).count("1") <= 3
    group, todo = set(), [fps[0]]
    while todo:
        x = todo.pop()
        if x not in group:
            group.add(x)
            todo += [y for y in fps if y not in group and near(x, y)]
    root = {r.node: r.root for r in roots}
    assert {f for f in fps if root.get(f, f) == root.get(fps[0], fps[0])} == group


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1001 + i) for i in range(300)] + [(7, 7), (5000, 5000)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert len({got[i] for i in range(201)}) == 1 and len({got[i] for i in range(1000, 1301)}) == 1
    assert got[0] != got[1000] and 5000 not in got


def test_stage_and_empty(spark):
    data = documents()
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in data], DOCS)
    got = simhash.drop_near_copies(df)
    assert got.columns == df.columns
    # one row of every component: the smallest id, then the smallest digest
    best = {}
    for (d, t), r in zip(data, grouped(data)[1]):
        key = (d is None, d or 0, hashlib.sha256((t or "").encode()).digest())
        if r not in best or key < best[r][0]:
            best[r] = key, (d, t)
    assert sorted(repr((r.doc_id, r.text)) for r in got.collect()) == sorted(repr(row) for _, row in best.values())
    none = spark.createDataFrame([], DOCS)
    assert simhash.near_groups(none).count() == 0 and simhash.drop_near_copies(none).count() == 0


def test_stage_keeps_a_row_of_every_component(spark):
    """Null ids and a shared id: the winner is chosen per component, not per id."""
    words = lambda k, n=60: " ".join(f"{k}{i}" for i in range(n))
    data = [(None, words("a")), (None, words("b")), (None, words("b")), (None, words("c")), (1, words("c")),
            (5, words("d")), (5, words("e")), (2, words("e")), (7, words("f")), (7, words("g")), (7, words("g"))]
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in data], DOCS)
    got = sorted(((r.doc_id, r.text) for r in simhash.drop_near_copies(df).collect()), key=repr)
    assert got == sorted([(None, words("a")), (None, words("b")), (1, words("c")), (5, words("d")), (2, words("e")),
                          (7, words("f")), (7, words("g"))], key=repr)
