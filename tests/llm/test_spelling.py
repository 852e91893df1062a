import random
import re
import zlib
from collections import Counter

from ledgerline.llm import spelling

DOCS = "doc_id long, text string, word string, n int, node string, form int, id string, pos int"


def counted(data):
    out = Counter()
    for d, t in data:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            if h % 31 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            if len(w) >= 7:
                out[w] += 1
    return {w: n for w, n in out.items() if n >= 2}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(data):
    n = counted(data)
    near = {w: [x for x in n if abs(len(x) - len(w)) < 2 and one_edit(w, x)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        if best is not None and n[best] >= 10 * n[w]:
            form[w] = best
    out = []
    for w in n:
        r = w
        while r in form:
            r = form[r]
        out.append((w, form.get(w), r, n[w], len(near[w]), n[form[w]] if w in form else None))
    return sorted(out, key=repr)


def corpus(seed, docs=60):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcé") for _ in range(rng.choice([6, 7, 8, 9, 14]))) for _ in range(60)]
    base += ["aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "aaaabaaa", "àaaaaaa", "ÿaaaaaa", "Àaaaaaa"]
    data = [(0, None), (1, ""), (2, "1 2 3"), (None, " ".join(base)), (None, " ".join(base[:9]))]
    for k in range(10, 10 + docs):
        w = []
        for _ in range(rng.choice([3, 40])):
            x = base[int(len(base) * rng.random() ** 2)]
            if rng.random() < .3:
                i = rng.randrange(len(x))
                x = rng.choice([x[:i] + x[i + 1:], x[:i] + "z" + x[i:], x[:i] + "b" + x[i + 1:]])
            w.append(rng.choice([x, x.upper() if x.isascii() else x, x.capitalize() if x.isascii() else x]))
        data.append((k, rng.choice([" ", "-", "×1"]).join(w)))
    return data + [data[-1]] * 3 + [(10, data[9][1])]


def frame(spark, data):
    return spark.createDataFrame([(d, t, "x", 1, "y", 2, "z", 3) for d, t in data], DOCS)


def test_against_brute_force(spark):
    data = corpus(1)
    got = spelling.variants(frame(spark, data).repartition(3))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = brute(data)
    assert sum(r[1] is not None for r in want) > 5
    assert sorted(map(tuple, got.collect()), key=repr) == want


def test_chains_of_forms(spark):
    """Forms of forms are followed to the last."""
    chain = ["kettles" + "q" * k for k in range(4)]
    data = [(k, " ".join([w] * (2 * 11 ** (3 - k)))) for k, w in enumerate(chain)]
    got = sorted(map(tuple, spelling.variants(frame(spark, data)).collect()), key=repr)
    assert got == brute(data) and [r[2] for r in got] == [chain[0]] * 4


def test_one_hot_prefix_and_very_long_words(spark):
    rng = random.Random(4)
    hot = [("prefixes" + "".join(rng.choice("abc") for _ in range(6)), 2) for _ in range(300)]
    long = "".join(rng.choice("abcdef") for _ in range(30_000))
    more = [(long, 2), (long[:100] + long[101:], 2), (long[:29_000] + "zz" + long[29_000:], 2), (long + "a", 3)]
    rows = sorted(set(hot)) + more
    got = {tuple(r) for r in spelling.near_words(spark.createDataFrame(rows, "word string, n long")).collect()}
    names = [w for w, _ in rows]
    short = [w for w in names if len(w) < 99]
    want = {(a, b) for a in short for b in short if one_edit(a, b)}
    want |= {(long, more[1][0]), (more[1][0], long), (long, long + "a"), (long + "a", long)}
    assert got == want


def test_empty(spark):
    for data in ([], [(1, "short ones only")]):
        got = spelling.variants(frame(spark, data))
        assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"] and got.count() == 0
