import math
import random
import re
from collections import Counter

import pytest

from ledgerline.llm import lexical

TERM = "[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
DOCS = "doc_id long, text string, item_id int, id string, n int, terms string, rank int, score string, salt int"
ITEMS = "item_id long, text string, item string, terms int, size int"


def split(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(TERM, low)


def brute(docs, items, k=50):
    held = [(d, Counter(split(t))) for d, t in docs if split(t)]
    n_docs, length = len(held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    one = {}
    for i, t in items:
        one.setdefault(i, set()).update(split(t))
    out = []
    for i, query in one.items():
        got = []
        for d, c in held:
            m = 100 - 50 + (50 * c.total() * n_docs) // length
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 20 * m))
                    for t in query if t in c)
            if s > 0:
                got.append((-s, d is not None, d or 0, d))
        got.sort(key=lambda r: r[:3])
        out += [(i, r + 1, g[3], -g[0]) for r, g in enumerate(got[:k])]
    return sorted(out, key=repr)


def tables(seed):
    rng = random.Random(seed)
    vocab = ["w%d" % i for i in range(300)] + ["É", "straße", "日本", "The", "X9"]
    words = lambda n: rng.choice([" ", ", ", "\n"]).join(vocab[int(len(vocab) * rng.random() ** 3)] for _ in range(n))
    docs = [(0, None), (1, ""), (2, " .,;"), (3, "The the THE"), (None, words(30)), (None, words(9)), (4, words(20000))]
    docs += [(k, words(rng.choice([1, 5, 60, 200]))) for k in range(10, 400)]
    docs += [(400 + k, docs[20][1]) for k in range(70)] + [(11, docs[20][1]), (11, docs[20][1])]
    items = [(0, None), (1, ""), (2, "unknown words"), (3, docs[20][1]), (None, "w1 w2 w250"), (5, "w0"), (6, "the É 日本"),
             (3, "W299 extra")] + [(k, words(rng.choice([2, 30, 80]))) for k in range(10, 40)]
    return docs, items


@pytest.mark.parametrize("run, k, block", [(1 << 20, 50, 1 << 23), (300, 7, 1 << 23), (2000, 50, 1000)])
def test_against_brute_force(spark, run, k, block):
    docs, items = tables(run)
    d = spark.createDataFrame([(i, t, 1, "a", 2, "b", 3, "c", 4) for i, t in docs], DOCS).repartition(3)
    q = spark.createDataFrame([(i, t, "a", 1, 2) for i, t in items], ITEMS)
    got = lexical.search(d, q, k=k, run_postings=run, block_bytes=block)
    assert got.columns == ["item_id", "rank", "doc_id", "score"] and dict(got.dtypes)["rank"] == "int"
    assert sorted(map(tuple, got.collect()), key=repr) == brute(docs, items, k)


def test_accumulators_are_limited_and_exact():
    """Common terms create none once the rare ones have filled the best k."""
    import numpy as np
    docs = 5000
    rare, common = np.arange(60), np.arange(docs)
    doc = np.concatenate([rare, common])
    term = np.concatenate([np.zeros(60, np.int64), np.ones(docs, np.int64)])
    index = lexical.Postings(np.arange(docs), np.full(docs, 100), doc, term, np.ones(len(doc), np.int64))
    rows, scores = index.search([(0, 9000), (1, 10)], 50, 0)
    assert rows.tolist() == list(range(60)) and len(set(scores.tolist())) == 1
    one = int(index.impact[0])
    assert scores[0] == 9010 * one and not index.scores.any()
    assert len(index.search([(1, 10)], 50, 10 * one + 1)[0]) == 0      # a threshold of other runs
    assert len(index.search([(1, 10)], 50, 10 * one)[0]) == docs       # ties stay


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    for d, q in ((docs, items), (some, items), (docs, some.withColumnRenamed("doc_id", "item_id"))):
        got = lexical.search(d, q)
        assert got.columns == ["item_id", "rank", "doc_id", "score"] and got.count() == 0
