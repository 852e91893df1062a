import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import queries, substring_dedup
from ledgerline.llm.fm_index import FmIndex

SF = "/root/testdata/sf0.01"


def brute(data, window=20):
    """data: (id, text) -> rows, windows in the order of ids."""
    def key(r):
        return (r[0] is not None, r[0] or 0)
    seen, out = {}, {}
    docs = sorted({(d, t) for d, t in data}, key=key)
    for d, t in docs:
        w = (t or "").encode().split()
        for i in range(len(w) - window + 1):
            seen.setdefault(tuple(w[i:i + window]), (d, i))
    for d, t in docs:
        w = (t or "").encode().split()
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] != (d, i):
                gone.update(range(i, i + window))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out[d, t] = (d, len(w), len(gone), hashlib.sha256(kept).hexdigest())
    return sorted(repr(out[d, t]) for d, t in data)


def corpus(seed):
    rng = random.Random(seed)
    vocab = ["v%d" % i for i in range(30)] + ["é", "日本"]
    passage = [rng.choice(vocab) for _ in range(60)]
    phrase = ["the", "common", "phrase", "of", "twelve", "words", "that", "all", "documents", "share", "here", "now"]
    data = [(0, None), (1, ""), (2, "a " * 19), (3, "a " * 20), (4, "a " * 100), (5, "a b " * 60), (6, "a b c " * 40)]
    for k in range(10, 70):
        w = [rng.choice(vocab) + str(rng.randrange(50)) for _ in range(rng.choice([5, 40, 120]))]
        if k % 3 == 0:
            a = rng.randrange(len(passage) - 30)
            w[3:3] = passage[a:a + rng.randrange(15, 30)]
        if k % 2:
            w[1:1] = phrase
        data.append((k, rng.choice([" ", "\n", " \t"]).join(w)))
        if k % 5 == 0:
            data.append((1000 - k, data[-1][1]))
        if k % 7 == 0:
            w[len(w) // 2] = "changed"
            data.append((2000 + k, " ".join(w)))
    return data + [(12, data[5][1]), (12, data[5][1]), (None, data[6][1] + " x y z")]


@pytest.mark.parametrize("wide", [1, 2048])
def test_against_brute_force(spark, wide):
    data = corpus(3)
    data = [r for i, r in enumerate(data) if r not in data[:i] or r[0] == 12]
    ids = [d for d, _ in data]
    data = [r for r in data if ids.count(r[0]) == 1 or r == (12, data[5][1])]
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in data], "doc_id long, text string, seg string, mz long")
    got = substring_dedup.remove_repeats(df, wide_group=wide).collect()
    assert sorted(repr(tuple(r)) for r in got) == brute(data)


def test_texts_are_returned(spark):
    data = [(1, " ".join(map(str, range(30)))), (2, "x " + " ".join(map(str, range(5, 28))) + " y"), (3, "short"), (4, None)]
    got = substring_dedup.remove_repeats(spark.createDataFrame(data, "doc_id long, text string"), with_text=True).collect()
    assert sorted((r.doc_id, r.kept_text) for r in got) == [(1, data[0][1]), (2, "x y"), (3, "short"), (4, "")]


def test_query_against_brute_force(spark):
    data = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = queries.op2_substring_dedup(spark, SF).collect()
    assert sorted(repr(tuple(r)) for r in got) == brute(data)
    assert sum(r.n_removed for r in got) > 0


def test_empty(spark):
    assert substring_dedup.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_index_counts_patterns():
    rng = np.random.default_rng(1)
    text = rng.integers(0, 4, 400)
    index = FmIndex(text)
    for _ in range(200):
        n = int(rng.integers(1, 12))
        pattern = rng.integers(1, 4, n)
        lo, hi = np.array([0]), np.array([len(text)])
        for w in pattern[::-1]:
            lo, hi = index.before(np.array([w]), lo, hi)
        want = [i for i in range(len(text) - n + 1) if (text[i:i + n] == pattern).all()]
        assert sorted(index.suffixes[int(lo[0]):int(hi[0])].tolist()) == want
    ends = np.arange(len(text))
    lengths, lo, hi = index.matching_statistics(ends, 10)
    for e in range(0, len(text), 7):
        k = 0
        while k < 10 and e - k >= 0 and (text[e - k:e + 1] > 0).all() and sum(
                (text[i:i + k + 1] == text[e - k:e + 1]).all() for i in range(len(text) - k)) >= 2:
            k += 1
        assert lengths[e] == k


def test_null_ids_with_texts_of_one_narrow_hash(spark):
    """Texts of rows without an id are told apart by more than 32 bits."""
    texts = spark.range(400_000).selectExpr("concat_ws(' ', transform(sequence(1, 25), k -> concat(id, 'w', k))) AS t")
    same = texts.groupBy(F.hash("t")).agg(F.min("t").alias("a"), F.max("t").alias("b")).where("a <> b").first()
    data = [(None, same.a), (None, same.b), (None, same.b + " and more"), (3, same.a)]
    got = substring_dedup.remove_repeats(spark.createDataFrame(data, "doc_id long, text string"), with_text=True).collect()
    kept = sorted(r.kept_text for r in got if r.doc_id is None)
    whole = sorted(t for t in kept if t)
    # the two rows that share b's words: one of them stays whole, the other loses what it repeats
    assert len(kept) == 3 and kept.count(same.a) == 1
    assert whole in (sorted([same.a, same.b, "and more"]), sorted([same.a, same.b + " and more"]))
    assert [r.kept_text for r in got if r.doc_id == 3] == [""]


@pytest.mark.parametrize("window", [40, 50])
def test_windows_over_32(spark, window):
    rng = random.Random(window)
    head = [rng.choice("ab") for _ in range(34)]
    data = [(k, " ".join(["s%d" % k, *head, *(rng.choice("ab") for _ in range(40)), *head * 2, "e%d" % k])) for k in range(30)]
    data += [(100 + k, " ".join(data[k][1].split()[3:70])) for k in range(30)]
    got = substring_dedup.remove_repeats(spark.createDataFrame(data, "doc_id long, text string"), window=window).collect()
    assert sorted(repr(tuple(r)) for r in got) == brute(data, window)


def test_rows_that_repeat_id_and_text_share_one_list(spark):
    text = " ".join(map(str, range(60)))
    df = spark.createDataFrame([(7, text)] * 200 + [(8, text)] * 200, "doc_id long, text string")
    documents, spans = substring_dedup.repeats(df)
    lists = spark.read.parquet(*documents.inputFiles())
    assert lists.count() == 400 and lists.selectExpr("max(size(l))").first()[0] <= 3 * 60
    got = substring_dedup.remove_repeats(df).collect()
    assert sorted(tuple(r)[:3] for r in got) == [(7, 60, 0)] * 200 + [(8, 60, 60)] * 200


def test_segments_come_from_the_bytes_of_a_batch_without_a_walk_over_texts():
    """Words, hashes and segments of a whole Arrow batch: equal to a plain walk, texts never joined at their ends."""
    import pyarrow as pa
    rng = random.Random(5)
    texts = [None, "", " ", "a", *("".join(rng.choice("ab  \t\n\x0b\x0c\x1c\x85é") for _ in range(rng.randrange(300))) for _ in range(200)),
             "x" * 70_000 + " " + "y " * 40 + "x" * 70_000, "z" * 300_000]
    for column in (pa.array(texts), pa.array(["cut off", *texts])[1:], pa.array([], pa.string())):
        words = [(t or "").encode().split() for t in column.to_pylist()]
        hashes, counts = {}, []
        for first, n, h in substring_dedup._word_hashes(column):
            counts += n.tolist()
            for w, x in zip((w for ws in words[first:first + len(n)] for w in ws), h.tolist()):
                assert hashes.setdefault(w, x) == x
        assert counts == [len(w) for w in words] and len(set(hashes.values())) == len(hashes)
        covered, minimizers = [[] for _ in words], {}
        for i, mz, start, size, twice in zip(*(c.tolist() for c in substring_dedup.runs(column, 5, 2, twice=True))):
            assert size <= substring_dedup.MOST_WINDOWS
            windows = [tuple(words[i][k:k + 5]) for k in range(len(words[i]) - 4)]
            assert twice == any(windows.count(w) > 1 for w in windows[start:start + size])
            assert all(minimizers.setdefault(w, mz) == mz for w in windows[start:start + size])
            covered[i] += range(start, start + size)
        assert covered == [list(range(max(0, len(w) - 4))) for w in words]
