"""The pipeline against a plain Python run of the same rules, stage by stage."""

import hashlib
import re
from collections import defaultdict

import corpus_pipeline
import pytest
import xxhash
from tokenizers import Tokenizer

from ledgerline.llm import queries, toxicity
from ledgerline.session import materialize

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for _, f in corpus_pipeline.STAGES:
        out.append(materialize(f(spark, out[-1], SF)))
    return out


def test_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "simhash_near_dedup", "mixing", "bpe"]
    for df in stages[1:5]:
        assert df.columns == stages[0].columns


def test_toxicity(spark, stages):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    score = toxicity.train(stages[0], labels, train_rows=queries.training_rows()).scorer()
    want = sorted(tuple(r) for r in stages[0].collect() if score(r.text) < 0.5)
    assert sorted(map(tuple, stages[1].collect())) == want


def test_exact(stages):
    best = {}
    for r in stages[1].collect():
        t = "".join(c.lower() if "A" <= c <= "Z" else c for c in r.text or "")
        best[t] = max(best.get(t, r), r, key=lambda x: x.doc_id)
    assert sorted(map(tuple, stages[2].collect())) == sorted(map(tuple, best.values()))


def test_simhash(stages):
    rows = stages[2].collect()
    fps = []
    for r in rows:
        w = re.findall("[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in r.text or ""))
        sh = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
        h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in sh]
        fps.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)))
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    group = defaultdict(list)
    for i, r in enumerate(rows):
        group[find(i)].append(r)
    want = [min(g, key=lambda r: r.doc_id) for g in group.values()]
    assert sorted(map(tuple, stages[3].collect())) == sorted(map(tuple, want))


def test_mixing(stages):
    before = {r.doc_id: r for r in stages[3].collect()}
    size, got = defaultdict(int), defaultdict(int)
    for r in before.values():
        size[r.source] += len((r.text or "").split())
    for r in stages[4].collect():
        own = before[r.doc_id]
        assert (r.lang, r.source) == (own.lang, own.source) and r.n_chars == len(r.text)
        assert set(r.text.split()) <= set(own.text.split())
        got[r.source] += len(r.text.split())
    from ledgerline.llm.mixing import targets
    order = sorted(size, key=lambda s: (s is None, s or ""))
    for s, t in zip(order, targets([size[s] for s in order])):
        assert abs(got[s] - t) <= 1


def test_bpe_and_run(spark, stages):
    lib = Tokenizer.from_file(queries.tokenizer_path())
    want = []
    for r in stages[4].collect():
        ids = lib.encode(r.text, add_special_tokens=False).ids
        want.append((r.doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest(), tuple(ids)))
    plain = lambda df: sorted((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256, tuple(r.ids)) for r in df.collect())
    assert plain(stages[5]) == sorted(want)
    assert plain(corpus_pipeline.run(spark, SF)) == sorted(want)


def test_empty_tables(spark, scratch_dir):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("false")
    docs.write.parquet(f"{scratch_dir}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").where("false").write.parquet(f"{scratch_dir}/labels.parquet")
    assert corpus_pipeline.run(spark, scratch_dir).count() == 0
