import hashlib
import random
import re
import string

import numpy as np

from ledgerline.llm import queries, secrets

SF = "/root/testdata/sf0.01"
RULES = {
    "assign": (r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 12),
    "access": (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 18),
    "hex": (r"[0-9a-f]+", lambda m: len(m[0]) >= 16),
}


def brute(text):
    out = []
    for k, (kind, (rule, keep)) in enumerate(RULES.items()):
        flags = re.A | (re.I if kind == "assign" else 0)
        out += [(m.start(), k, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(rule, text or "", flags) if keep(m)]
    return [s for _, _, s in sorted(out)]


def check(rows, texts):
    for r in rows:
        want = brute(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s.startswith(k) for s in want) for k in RULES]
        spans = r.spans.split(",") if r.spans else []
        assert [s for s in spans if not s.startswith("markov")] == want
        at = [int(s.split(":")[1]) for s in spans]
        assert at == sorted(at)
        cover = {i for s in want for i in range(*map(int, s.split(":")[1:]))}
        for s in spans:
            if s.startswith("markov"):
                assert not cover & set(range(*map(int, s.split(":")[1:])))


def test_query_against_the_plain_rules(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.op6_secrets(spark, SF).collect()
    assert len(got) == len(texts) and sum(r.n_assign + r.n_access + r.n_hex for r in got) > 0
    check(got, texts)


def test_models_tell_random_strings_from_identifiers(spark):
    rng = random.Random(1)
    key = lambda n: "".join(rng.choice(string.ascii_letters + string.digits) for _ in range(n))
    words = ["connection", "manager", "request", "handler", "default", "timeout", "session", "password", "stream", "value"]
    name = lambda: rng.choice("_-").join(rng.choice(words) for _ in range(4))
    prose = lambda: " ".join(name() for _ in range(25))
    rows = [(i, f"{prose()} uses token = '{key(32)}' and {prose()}") for i in range(400)]
    rows += [(1000 + i, f"see {key(32)} here") for i in range(50)] + [(2000 + i, f"see {name()} here") for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in queries.secret_report(df).collect()}
    assert all("markov:4:36" == got[1000 + i].spans for i in range(50))
    assert all(got[2000 + i].spans == "" for i in range(50))
    assert all(got[i].n_assign == 1 and "markov" not in got[i].spans for i in range(400))
    check(got.values(), dict(rows))


def test_odd_texts(spark):
    odd = [None, "", "é" * 9 + " api_key:  \"abcdefghijkl\"", "APIKEY=short", "ToKeN='" + "A" * 12, "token=token=abcdefgh",
           "secret : : password=aaaaaaaaaaaaaaaaaaaaaaaa", "xAKIA" + "A" * 13 + " AKIAAKIA" + "Z9" * 9, "0123456789abcdefg" * 3,
           "paſſword=abcdefghijklmnop toKen=abcdefghijklmnop", "0" * 200_000, "token=" + "a." * 30_000, "api__key=abcdefghijklmno",
           "password\n=abcdefghijklmno", "😀 token=abcdefghijklmno 0123456789abcdef"]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(odd)], "doc_id long, text string, spans string")
    got = queries.secret_report(df).collect()
    assert len(got) == len(odd)
    check(got, dict(enumerate(odd)))
    assert queries.secret_report(df.where("false")).count() == 0
    twice = queries.secret_report(df.union(df).withColumn("doc_id", df["doc_id"] * 0))
    assert twice.count() == 2 * len(odd)


def test_pair_counts():
    t = secrets.pair_counts("abé a".encode())
    assert t.sum() == 7 and t.reshape(95, 95)[0, ord("a") - 0x20] == 2 and np.count_nonzero(t) == 5
