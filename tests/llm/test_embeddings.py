import math

import numpy as np
import pytest

from ledgerline.llm import embeddings, queries

SF = "/root/testdata/sf0.1"


def brute(rows, threshold=0.98):
    """(n_links, component) of every row, by all pairs."""
    n = len(rows)

    def fit(v):
        return v is not None and len(v) and all(c is not None and math.isfinite(c) for c in v) and any(v)
    ok = [fit(v) and label is not None for _, v, label in rows]
    links, root = [0] * n, list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    vec = [np.array(v, float) if o else None for (_, v, _), o in zip(rows, ok)]
    for i in range(n):
        for j in range(i):
            if ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(vec[i]) == len(vec[j]):
                if vec[i] @ vec[j] / math.sqrt((vec[i] @ vec[i]) * (vec[j] @ vec[j])) >= threshold:
                    links[i] += 1
                    links[j] += 1
                    root[find(i)] = find(j)
    first = {}
    for i, (k, _, _) in enumerate(rows):
        if k is not None:
            first[find(i)] = min(first.get(find(i), k), k)
    return sorted(repr((k, links[i], first.get(find(i)), k == first.get(find(i)))) for i, (k, _, _) in enumerate(rows))


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """The table of SF with near copies, copies and multiples of its vectors added."""
    rng = np.random.default_rng(8)
    rows = [(r.vec_id, np.array(r.embedding, float), r.label) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    k = 10 ** 6
    for i, v, label in rows[:200]:
        for _ in range(int(rng.integers(1, 6))):
            noise = rng.normal(size=len(v))
            angle = rng.choice([0.0, 0.1, 0.17, 0.198, 0.202, 0.25])             # cosine 0.98 is 0.2003
            noise -= noise @ v / (v @ v) * v
            near = v / np.linalg.norm(v) * math.cos(angle) + noise / np.linalg.norm(noise) * math.sin(angle)
            rows.append((k, near * rng.choice([1.0, 3.0]), label))
            k += 1
    rows += [(k + j, rows[0][1], rows[0][2]) for j in range(500)]
    path = str(tmp_path_factory.mktemp("planted"))
    spark.createDataFrame([(i, [float(c) for c in v], label) for i, v, label in rows],
                          "vec_id long, embedding array<float>, label int").write.parquet(f"{path}/embeddings.parquet")
    return path


def test_query_against_brute_force(spark, planted):
    t = spark.read.parquet(f"{planted}/embeddings.parquet").collect()
    got = queries.op7_embedding_near_dedup(spark, planted).collect()
    assert len(got) == len(t)
    x = np.array([r.embedding for r in t], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([r.label for r in t])
    near = (x @ x.T >= 0.98) & (label[:, None] == label[None])
    want = {r.vec_id: int(n) - 1 for r, n in zip(t, near.sum(axis=1))}
    found, there = sum(r.n_links for r in got), sum(want.values())
    assert there > 250_000 and all(r.n_links <= want[r.vec_id] for r in got)
    assert found >= 0.999 * there                                   # recall of the index, links
    right = sum(r.n_links == want[r.vec_id] for r in got if want[r.vec_id])
    assert right >= 0.99 * sum(n > 0 for n in want.values())        # and vectors
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


@pytest.mark.parametrize("bucket_rows", [3, 2048])
def test_fixture(spark, bucket_rows):
    rng = np.random.default_rng(3)
    rows, k = [], 0
    for c in range(30):
        base = rng.normal(size=16)
        for _ in range(rng.integers(1, 15)):
            v = base + rng.normal(size=16) * 0.02
            for _ in range(rng.integers(1, 4)):
                rows.append((k, v.tolist(), int(c % 3)))
                k += 1
    v = rows[0][1]
    rows += [(900, None, 0), (901, [0.0] * 16, 0), (902, [None] + v[1:], 0), (903, [float("nan")] + v[1:], 0),
             (904, [float("inf")] + v[1:], 0), (905, v, None), (906, v, None), (907, [2 * c for c in v], 0), (908, v[:8], 0),
             (909, v[:8], 0), (910, [], 0), (911, [-c for c in v], 0), (None, v, 0), (3, v, 2), (3, v, 2)]
    df = spark.createDataFrame([(i, x, y, "z") for i, x, y in rows], "vec_id long, embedding array<double>, label int, cid string")
    got = embeddings.near_links(df, bucket_rows=bucket_rows, recall=1 - 1e-9).collect()
    assert sorted(repr(tuple(r)) for r in got) == brute(rows)
    assert embeddings.near_links(df.where("false")).count() == 0


def test_estimate_is_unbiased_and_bounded():
    rng = np.random.default_rng(5)
    a = rng.normal(size=(1, 64))
    b = a + rng.normal(size=(1, 64)) * 0.5
    a, b = a / np.linalg.norm(a), b / np.linalg.norm(b)
    got = []
    for r in embeddings.rotations(64, 400, 9):
        ra, sa, fa = embeddings.codes(a, r)
        got.append(float((sa @ (b @ r.T).T)[0, 0] / (8 * fa[0])))
        assert embeddings.maybe_near(ra, sa, fa, b @ r.T, float((a @ b.T)[0, 0]), 4.0)[0, 0]
    assert abs(np.mean(got) - float((a @ b.T)[0, 0])) < 0.02


def test_plan_grows_with_the_classes():
    plans = [embeddings.key_plan(n, 0.98, 0.999) for n in (10, 10_000, 10 ** 9)]
    assert [b for b, _ in plans] == sorted(b for b, _ in plans) and plans[2][1] < 60
