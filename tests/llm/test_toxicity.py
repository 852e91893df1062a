import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import queries, toxicity

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    got = queries.op3_toxicity(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where(
        "held_out").select("doc_id", "score", "predicted", "toxic").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in got)
    tp = sum(r.predicted and r.toxic for r in got)
    print(len(got), tp, sum(r.predicted for r in got), sum(r.toxic for r in got))
    assert tp >= 0.9 * sum(r.toxic for r in got) and tp >= 0.95 * sum(r.predicted for r in got)


def test_negative_risk_does_not_run_away():
    """Pure noise: unlabelled equal to positive; the scores stay near the prior instead of memorising."""
    rng = np.random.default_rng(1)
    rows = [np.flatnonzero(rng.random(300) < 0.05) for _ in range(200)]
    w, b = toxicity.fit_nnpu(rows, np.arange(200) < 20, 300, 0.1)
    g = np.array([b + w[r].sum() for r in rows])
    assert np.isfinite(w).all() and (1 / (1 + np.exp(-g)) > 0.5).mean() < 0.2


def test_words():
    assert toxicity.word_features("(Idiot!)") == ["idiot", "idi*", "idio*"]
    assert toxicity.word_features("--") == [] and toxicity.word_features("a") == ["a"]


def test_edges(spark):
    docs = spark.createDataFrame(
        [(i, ("fine words here %d" % i) + (" idiot" if i % 4 == 0 else ""), i, "x") for i in range(200)]
        + [(900, None, 1, "x"), (901, "", 1, "x"), (902, "idiot " * 50_000, 1, "x"), (3, "fine", 1, "x"), (None, "idiot", 1, "x")],
        "doc_id long, text string, score long, y string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(120)] + [(4, 1), (None, 1), (5, None)],
                                   "doc_id long, toxic int")
    model = toxicity.train(docs, labels, train_rows=F.col("doc_id") % 7 != 0)
    got = {r.doc_id: r for r in toxicity.scores(docs, model).collect()}
    assert all(got[i].predicted == (i % 4 == 0) for i in range(200)) and got[None].predicted == 1
    assert got[900].score == got[901].score < 0.5 and got[902].predicted == 1
    assert toxicity.scores(docs, model).count() == 205
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() == 205 - 50 - 2
    again = toxicity.train(docs, labels, train_rows=F.col("doc_id") % 7 != 0)
    assert again.weights == model.weights and again.bias == model.bias


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    assert toxicity.scores(docs, model).count() == 0
    some = spark.createDataFrame([(1, "text")], "doc_id long, text string")
    assert toxicity.scores(some, model).first().score == 0.0
    one = spark.createDataFrame([(9, 1)], "doc_id long, toxic int")
    assert toxicity.scores(some, toxicity.train(some, one)).first().score == 0.0


def test_caps_below_the_labelled_rows(spark):
    """The toxic rows added to a capped sample are no part of the unlabelled text."""
    docs = spark.createDataFrame([(i, "plain words here" + (" idiot" if i % 7 == 0 else "")) for i in range(1400)],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 7 == 0)) for i in range(1400)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels, max_positive=180, max_unlabelled=200)
    got = toxicity.scores(docs, model).collect()
    assert {(r.doc_id % 7 == 0, r.predicted) for r in got} == {(True, 1), (False, 0)}


def test_small_tables(spark):
    """What is learned does not vanish with the number of labelled rows."""
    docs = spark.createDataFrame([(i, "plain words here" + (" idiot" if i % 5 == 0 else "")) for i in range(80)],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(40)], "doc_id long, toxic int")
    got = toxicity.scores(docs, toxicity.train(docs, labels)).collect()
    assert {(r.doc_id % 5 == 0, r.predicted) for r in got} == {(True, 1), (False, 0)}
    sf = SF.replace("sf0.1", "sf0.001")
    got = queries.op3_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    caught = sum(r.predicted and r.toxic for r in got)
    assert caught >= 0.9 * sum(r.toxic for r in got) and caught >= 0.95 * sum(r.predicted for r in got)
