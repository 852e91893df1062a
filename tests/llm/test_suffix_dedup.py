import hashlib
import random

import numpy as np
import pytest

from ledgerline.llm import suffix_array, suffix_dedup

CLASHING = "doc_id long, text string, doc string, tag int, mz string, seg string, first int, n int, id string, l int"


def brute(data, window=100):
    def key(r):
        return (r[0] is not None, r[0] or 0)
    seen, out = {}, []
    for d, t in sorted(data, key=key):
        b = (t or "").encode()
        for i in range(len(b) - window + 1):
            seen.setdefault(b[i:i + window], (d, i))
    for d, t in data:
        b = (t or "").encode()
        gone = [False] * len(b)
        for i in range(len(b) - window + 1):
            if seen[b[i:i + window]] != (d, i):
                gone[i:i + window] = [True] * window
        kept = bytes(x for x, g in zip(b, gone) if not g)
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def corpus(seed):
    rng = random.Random(seed)
    text = lambda n: "".join(rng.choice("abcdefgh éß\n日\0") for _ in range(n))
    passage, phrase = text(400), text(70)
    data = [(0, None), (1, ""), (2, "a" * 99), (3, "a" * 100), (4, "a" * 500), (5, "xy" * 150), (6, ("line " * 9 + "\n") * 30)]
    for k in range(10, 60):
        t = text(rng.choice([20, 150, 900]))
        if k % 3 == 0:
            a = rng.randrange(300)
            t = t[:50] + passage[a:a + rng.randrange(60, 250)] + t[50:]
        if k % 2:
            t = t[:30] + phrase + t[30:]
        data.append((k, t))
        if k % 5 == 0:
            data.append((1000 - k, t))
        if k % 7 == 0:
            data.append((2000 + k, t[:len(t) // 2] + "!" + t[len(t) // 2:]))
    return data + [(12, data[9][1]), (None, data[6][1] + " tail")]


@pytest.mark.parametrize("wide", [1, 2048])
def test_against_brute_force(spark, wide):
    data = corpus(3)
    rows = [(d, t, "z", 1, "m", "s", 2, 3, "i", 4) for d, t in data]
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, CLASHING), wide_group=wide)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(data)


@pytest.mark.parametrize("window, grams", [(30, None), (150, (20, 150)), (7, (7,))])
def test_other_windows(spark, window, grams):
    data = corpus(5)
    df = spark.createDataFrame(data, "doc_id long, text string")
    got = suffix_dedup.remove_repeats(df, window=window, grams=grams)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(data, window)


def test_rows_that_repeat_an_id_and_text_are_judged_alike(spark):
    rng = random.Random(1)
    t = "".join(rng.choice("abcd") for _ in range(300))
    df = spark.createDataFrame([(None, t)] * 50 + [(7, t)] * 2, "doc_id long, text string")
    got = suffix_dedup.remove_repeats(df).groupBy("doc_id", "n_removed").count().collect()
    assert {(r.doc_id, r.n_removed, r["count"]) for r in got} == {(None, 0, 50), (7, 300, 2)}


def test_kept_bytes_and_empty(spark):
    t = "0123456789" * 30
    df = spark.createDataFrame([(1, t), (2, "A" + t)], "doc_id long, text string")
    got = {r.doc_id: bytes(r.kept) for r in suffix_dedup.remove_repeats(df, with_bytes=True).collect()}
    # the text repeats itself every ten bytes: the bytes before its second period are new
    assert got == {1: t.encode()[:10], 2: b"A"}
    none = spark.createDataFrame([], "doc_id long, text string")
    assert suffix_dedup.remove_repeats(none).count() == 0


def test_a_long_text(spark):
    rng = random.Random(2)
    t = "".join(rng.choice("abcdefghijklmnop ") for _ in range(1 << 21))
    df = spark.createDataFrame([(1, t), (2, t[5000:1_500_000] + "x" * 1000)], "doc_id long, text string")
    got = {r.doc_id: (r.n_removed, r.n_spans) for r in suffix_dedup.remove_repeats(df).collect()}
    assert got == {1: (0, 0), 2: (1_495_000 + 999, 2)}      # the x's from the second on repeat


@pytest.mark.parametrize("long_buckets", [0, 400, 10 ** 9])
def test_suffix_array_and_prefixes_against_sorting(monkeypatch, long_buckets):
    monkeypatch.setattr(suffix_array, "LONG_BUCKETS", long_buckets)
    for seed in range(120):
        rng = random.Random(seed)
        b = bytes(rng.randrange(1, rng.choice([1, 2, 4, 250]) + 1) for _ in range(rng.choice([0, 1, 2, 5, 30, 150]))) + b"\0"
        text = np.frombuffer(b, np.uint8)
        got = suffix_array.suffix_array(text.astype(np.int64), 256)
        assert got.tolist() == sorted(range(len(b)), key=lambda i: b[i:])
        shared = suffix_array.common_prefixes(text, got)
        for x, y in zip(got[:-1].tolist(), got[1:].tolist()):
            n = next((k for k, (p, q) in enumerate(zip(b[x:], b[y:])) if p != q), min(len(b) - x, len(b) - y))
            assert shared[y] == n


def test_a_window_is_once_in_a_segment():
    for text in (b"a" * 400, b"ab" * 200, bytes(range(200)) * 3):
        mz, start, size = suffix_dedup.segments(text, 100, 32)
        assert start[0] == 0 and (start[1:] == np.cumsum(size)[:-1]).all() and size.sum() == len(text) - 99
        for s, n in zip(start.tolist(), size.tolist()):
            own = [text[i:i + 100] for i in range(s, s + n)]
            assert len(set(own)) == len(own)
