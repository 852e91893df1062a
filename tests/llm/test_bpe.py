import hashlib
import os
import random

import numpy as np
import pytest
import public_tokenizers
from tokenizers import Tokenizer

from ledgerline.llm import bpe, queries

PATH = public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def lib():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def codec():
    return bpe.BpeCodec(open(PATH, encoding="utf-8").read())


def texts():
    rng = random.Random(5)
    odd = ["", " ", "don't We'LL I'D 'S it's", "a<|endoftext|>b <|startoftext|>", "<|endoftext|><|endoftext|>", "<|ENDOFTEXT|>",
           "É é Ω x y\x85z \x1c\x1d", "ΟΔΟΣ Σ", "日本語テキスト", "😀😀 👩‍👩‍👧", "x" * 5000, "!" * 4097, "ab" * 3000,
           "0123456789 ١٢٣ ½", "\x00\x01 null", "naïve café œuvre ﬁn Straße İstanbul", "à́b", " ́x", "foo​bar",
           "A.B,C;d--e...f!!!?", "aaaa aaa aa a", "각", "tab\tnew\nline\r\x0b\x0c end"]
    letters = "abcdefghij ÉßñABC'.,!0123 \n<|>"
    odd += ["".join(rng.choice(letters) for _ in range(rng.choice([3, 30, 300]))) for _ in range(300)]
    return odd


def test_ids_and_text_agree_with_the_library(lib, codec):
    from ledgerline.llm.chunks import ChunkedTexts
    ts = texts()
    held = ChunkedTexts(codec.encode_chunks, chunks_kept=50)
    rows = []
    for k, t in enumerate(ts):
        held.add(t)
        if k % 40 == 39 or k + 1 == len(ts):
            for ids, lengths in held.flush(refs_at_once=7):
                rows += [x.tolist() for x in np.split(ids, np.cumsum(lengths)[:-1])]
    assert len(rows) == len(ts)
    decoder = bpe.BpeDecoder(open(PATH, encoding="utf-8").read())
    for t, got in zip(ts, rows):
        want = lib.encode(t, add_special_tokens=False).ids
        assert got == want, t[:80]
        assert decoder.decode(got) == lib.decode(want, skip_special_tokens=False)


def test_merges_that_bring_up_lower_ranks(lib):
    """Made-up merge orders, against one word at a time by the plain rule."""
    import json
    rng = random.Random(2)
    for _ in range(60):
        vocab, merges = ["a", "b", "c"], []
        for _ in range(14):
            x, y = rng.choice(vocab), rng.choice(vocab)
            if (x, y) not in merges:
                merges.append((x, y))
                if x + y not in vocab:
                    vocab.append(x + y)
        rng.shuffle(merges)
        model = {"added_tokens": [], "model": {"vocab": {v: i for i, v in enumerate(vocab)}, "end_of_word_suffix": None,
                                               "merges": [list(m) for m in merges]}}
        merger = bpe.PairMerger(json.dumps(model))
        words = ["".join(rng.choice("abc") for _ in range(rng.randrange(1, 12))) for _ in range(40)] + ["a" * 9, "ab" * 7]
        starts, flat = merger.merge(words)
        rank = {m: i for i, m in enumerate(merges)}
        for k, w in enumerate(words):
            parts = list(w)
            while True:
                best = min((rank.get(p, 99), i) for i, p in enumerate([*zip(parts, parts[1:]), ("", "")]))
                if best[0] == 99:
                    break
                parts[best[1]:best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
            assert [vocab[i] for i in flat[starts[k]:starts[k + 1]]] == parts


def test_query_against_the_library(spark, lib):
    got = {r.doc_id: r for r in queries.op10_bpe(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = lib.encode(d.text or "", add_special_tokens=False).ids
        r = got[d.doc_id]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_edges(spark):
    df = spark.createDataFrame([(1, None, 5), (1, "", 5), (None, "Hello  World", 5), (2, "word " * 60_000, 5)],
                               "doc_id long, text string, ids int")
    got = bpe.decode(bpe.encode(df, PATH), PATH).collect()
    assert sorted((str(r.doc_id), len(r.ids), r.decoded[:30]) for r in got) == [
        ("1", 0, ""), ("1", 0, ""), ("2", 60_000, "word</w> word</w> word</w> wor"), ("None", 2, "hello</w> world</w>")]
    assert bpe.encode(df.where("false"), PATH).count() == 0
    assert os.path.exists(PATH)
