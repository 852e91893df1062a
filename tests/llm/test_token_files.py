import zlib

import numpy as np
import pytest
import public_tokenizers
from tokenizers import Tokenizer

from ledgerline.llm import queries, token_files

PATH = public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.01"


def cases():
    rng = np.random.default_rng(4)
    yield np.array([2]), np.array([True])
    yield np.full(5000, 7), np.arange(5000) == 4999
    yield np.tile([1, 2, 3, 1, 2], 900), np.arange(4500) % 450 == 449
    yield rng.integers(0, 5, 20_000), np.append(rng.random(19_999) < 0.01, True)
    yield rng.integers(0, 40_000, 20_000), np.append(rng.random(19_999) < 0.5, True)
    yield rng.zipf(1.3, 50_000) % 49_408, np.append(rng.random(49_999) < 0.002, True)


@pytest.mark.parametrize("ids,last", list(cases()))
def test_round_trip_and_random_access(ids, last):
    seq, marks, rules, lengths = token_files.repair(ids, last, 49_408)
    payload = token_files.pack(seq, rules, lengths, 49_408)
    first, r, n, s = token_files.unpack(payload)
    assert (token_files.expand(s, first, r, n) == ids).all() and marks.sum() == last.sum()
    for k, (a, b) in enumerate(r):
        assert a < first + k and b < first + k
        assert len(token_files.expand(np.array([first + k]), first, r, n)) == n[k]
    rng = np.random.default_rng(0)
    for _ in range(30):
        a, b = sorted(rng.integers(0, len(ids) + 1, 2))
        assert (token_files.decode_range(payload, a, b) == ids[a:b]).all()
    if len(set(ids.tolist())) < 10 and len(ids) > 100:
        assert len(seq) < len(ids) / 2


def test_query_against_the_library(spark):
    lib = Tokenizer.from_file(PATH)
    got = {r.doc_id: r for r in queries.op8_token_files(spark, SF).collect()}
    start = 0
    docs = sorted(spark.read.parquet(f"{SF}/documents.parquet").collect(), key=lambda r: r.doc_id)
    assert len(got) == len(docs)
    for d in docs:
        ids = lib.encode(d.text or "", add_special_tokens=False).ids + [2]
        r = got[d.doc_id]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_edges_blocks_and_shards(spark):
    df = spark.createDataFrame([(5, None), (5, ""), (None, "Hello # <|endoftext|>"), (2, "word " * 30_000), (9, "## #"), (5, "b")]
                               + [(100 + i, "some words %d" % i) for i in range(300)], "doc_id long, text string")
    blocks = token_files.write_blocks(token_files.token_ids(df, PATH, 49_408, shards=3), 49_408, block_ids=50)
    assert blocks.count() > 5
    got = token_files.read_documents(blocks).orderBy("start").collect()
    assert [r.id for r in got] == [None, 2, 5, 5, 5, 9, *range(100, 400)]
    at = 0
    for r in got:
        assert r.start == at and r.tokens[-1] == 2
        at += len(r.tokens)
    none = token_files.write_blocks(token_files.token_ids(df.where("false"), PATH, 49_408), 49_408)
    assert token_files.read_documents(none).count() == 0


def test_joined_words_agree_with_the_library():
    from test_bpe import texts
    model = open(PATH, encoding="utf-8").read()
    lib, words = Tokenizer.from_file(PATH), token_files.WordIds(model, words_at_once=50)
    assert words.joins
    chunks = [c for t in texts() for c in t.encode().decode().split()]
    chunks += ["Then,", "then", "THEN!!", "É.", "İstanbul,", "क़ल", "Ω", "a.b", "...", "word.,!", "É", "'s", "s", "<|ENDOFTEXT|>,"]
    for part in (chunks, chunks[:1], ["..."], []):
        starts, flat = words(part)
        assert [flat[a:b].tolist() for a, b in zip(starts[:-1], starts[1:])] == [
            lib.encode(c, add_special_tokens=False).ids for c in part]
    # a tokenizer that keeps case is probed to be another one, and asked chunk by chunk
    import json
    told = json.loads(model)
    told["normalizer"] = None
    kept = token_files.WordIds(json.dumps(told))
    assert not kept.joins
    starts, flat = kept(["The", "the,"])
    assert flat.tolist() == [i for c in ("The", "the,") for i in Tokenizer.from_str(json.dumps(told)).encode(c).ids]


def test_no_pair_is_left_and_wide_symbols(capsys):
    rng = np.random.default_rng(1)
    ids = rng.zipf(1.2, 300_000) % 65_400
    last = np.append(rng.random(299_999) < 0.002, True)
    seq, marks, rules, lengths = token_files.repair(ids, last, 65_400)
    assert len(rules) > 200                                     # beyond 16 bits: a bit plane
    pair = (seq[:-1].astype(np.int64) << 32 | seq[1:])[~marks[:-1]]
    found, n = np.unique(pair, return_counts=True)
    runs = found >> 32 == found & 0xFFFFFFFF                    # a run of one symbol holds half as many pairs as places
    assert n[~runs].max() < 8
    first, r, n, s = token_files.unpack(token_files.pack(seq, rules, lengths, 65_400))
    assert (s == seq).all() and (r == rules).all() and (token_files.expand(s, first, r, n) == ids).all()


def test_one_id_takes_many_shards(spark):
    df = spark.range(40_000).selectExpr("case when id % 10 < 9 then null else id end doc_id", "concat('words of ', id % 50) text")
    tokens = token_files.token_ids(df, PATH, 49_408, shards=16)
    sizes = [r["count"] for r in tokens.groupBy("shard").count().collect()]
    assert max(sizes) < 40_000 / 4 and sum(sizes) == 40_000
    got = token_files.read_documents(token_files.write_blocks(tokens, 49_408, block_ids=5000), with_tokens=False)
    rows = got.orderBy("start").collect()
    assert [r.id for r in rows] == [None] * 36_000 + list(range(9, 40_000, 10))
    assert rows[0].start == 0 and all(b.start == a.start + a.n_tokens for a, b in zip(rows, rows[1:]))


def test_words_are_given_to_the_library_once_a_worker_whatever_marks_follow(monkeypatch):
    with open(PATH, encoding="utf-8") as f:
        words = token_files.WordIds(f.read())
    given = []
    rows = token_files.WordIds._rows
    monkeypatch.setattr(words, "_rows", lambda lib, texts: given.extend(w for t in texts for w in t.split()) or rows(lib, texts))
    lib = Tokenizer.from_file(PATH)

    def check(chunks):
        starts, flat = words(chunks)
        for k, c in enumerate(chunks):
            assert flat[starts[k]:starts[k + 1]].tolist() == lib.encode(c, add_special_tokens=False).ids, c

    check(["thoning%%%", "Thoning***", "garçon", "it's", "a<|endoftext|>**", "x1", "***", "l'", "don't)", "</w>", "a</w>"])
    assert "thoning" in given and not [w for w in given if w.startswith("thoning") and w != "thoning"]
    given.clear()
    check(["thoning", "THONING###", "thoning.", "garçon\")", "it's", "new-one", "'s", "thoning'", "a'\"s"])
    assert not {"thoning", "garçon", "it's"} & set(given)
    # more words than are kept: the table starts anew, the ids stay right
    monkeypatch.setattr(token_files, "UNITS_KEPT", 3)
    check(["thoning$", "other", "words^_^", "ñandú~", "ñandú"])
    check(["thoning$", "x" * 300 + "[]", "Ünter&&"])


def test_added_tokens_of_words_and_marks_are_left_to_the_library():
    import json
    with open(PATH, encoding="utf-8") as f:
        told = json.load(f)
    for content in ("***", "stop%"):
        more = dict(told, added_tokens=[*told["added_tokens"], dict(
            told["added_tokens"][0], id=49408, content=content, special=False)])
        text = json.dumps(more)
        lib, words = Tokenizer.from_str(text), token_files.WordIds(text)
        chunks = ["nonstop%", "stop%%", "a***", "a*****", "stop"]
        starts, flat = words(chunks)
        assert [flat[a:b].tolist() for a, b in zip(starts, starts[1:])] == [lib.encode(c, add_special_tokens=False).ids for c in chunks]
