"""Toxicity scores by non-negative positive-unlabelled learning.

Training data are confirmed toxic documents (label 1) and unlabelled text: the
labelled rows with their labels ignored.  Label 0 is never used as a negative.
A logistic model on the presence and density of words and prefixes is fitted in numpy to the
class-prior-corrected risk

    prior * E_P[l(g)] + max(0, E_U[l(-g)] - prior * E_P[l(-g)])

whose second term estimates the risk on the (unseen) negatives; where it turns
negative, the step undoes the overfitting instead.  The class prior is the
share of label 1 among all training labels.

Bounds (parameters): the fit sees two samples, ``max_unlabelled`` of all
labelled documents as unlabelled text and ``max_positive`` of the toxic ones,
each those with the smallest hash of their id (toxic rows of the first sample
are confirmed examples too, the second never counts as unlabelled: with it the
unlabelled text would hold more toxic rows than the prior says), and ``max_features`` features, those whose rate differs most between the
two samples, in standard deviations z of smoothed rates.  No z is too small to
be learned from: a feature enters the model with the weight's scale z^2 / (z^2 +
2 ln m), m the number of features counted, so that what chance finds among m
features (z near sqrt(2 ln m)) moves slowly and is held down by the decay on
small tables as on large ones.  Feature counts are aggregated by Spark; only the chosen features and the
sample's presence lists for them come to the driver.  Every document is scored
on its whole text.

Defined results: null and empty texts get the model's bias; without any
positive example every score is 0; a document with several labels counts as
toxic if one of them is 1; null labels are ignored; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import fresh, same_columns

PREFIXES = (3, 4, 5, 6)
DENSE = 100
CACHED_WORDS = 1 << 18


@dataclass
class Model:
    """Weights by feature; ``scored`` is false if there was nothing to learn from."""
    weights: dict[str, float] = field(default_factory=dict)
    bias: float = 0.0
    scored: bool = False

    def scorer(self):
        cache: dict[str, tuple] = {}
        known = {f.rstrip("!") for f in self.weights}

        def score(text: str | None) -> float:
            if not self.scored:
                return 0.0
            words, counts = (text or "").split(), Counter()
            for word, n in Counter(words).items():
                hits = cache.get(word)
                if hits is None:
                    if len(cache) >= CACHED_WORDS:
                        cache.clear()
                    hits = cache[word] = tuple(f for f in word_features(word) if f in known)
                for f in hits:
                    counts[f] += n
            g = self.bias + sum(self.weights[f] for f in sorted(_dense(counts, len(words))) if f in self.weights)
            return float(1.0 / (1.0 + np.exp(-min(50.0, max(-50.0, g)))))

        return score


def word_features(word: str) -> list[str]:
    """The lower-cased word without marks around it, and its first letters."""
    w = word.lower()
    a, b = 0, len(w)
    while a < b and not w[a].isalnum():
        a += 1
    while b > a and not w[b - 1].isalnum():
        b -= 1
    w = w[a:b]
    return [w, *(w[:k] + "*" for k in PREFIXES if len(w) > k)] if w else []


def _dense(counts: Counter, n_words: int) -> set[str]:
    """The features counted, and marked "!" once more those that make up a
    share of 1 in ``DENSE`` of the words: a long text holds rare words by chance."""
    return set(counts) | {f + "!" for f, n in counts.items() if n * DENSE >= n_words}


def _features(text: str | None) -> set[str]:
    words, counts = (text or "").split(), Counter()
    for w, n in Counter(words).items():
        for f in word_features(w):
            counts[f] += n
    return _dense(counts, len(words))


def fit_nnpu(rows: list[np.ndarray], positive: np.ndarray, n_features: int, prior: float, epochs: int = 800,
             batches: int = 1, rate: float = 0.05, decay: float = 1e-4, seed: int = 0,
             unlabelled: np.ndarray | None = None, scale: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    """Weights and bias minimising the non-negative risk by Adam.  ``rows``
    hold the indices of the features present; those marked ``unlabelled`` (all
    rows if not given) are the sample of the population, those marked
    ``positive`` the confirmed examples, a row may be both.  A feature that is
    present counts as its ``scale`` (1 if not given).  Whole-batch
    steps keep the estimate of the negatives' risk from turning negative by
    chance, which would stop separable examples short."""
    lengths = np.array([len(r) for r in rows])
    scale = np.ones(n_features) if scale is None else scale
    flat = np.concatenate([*rows, np.empty(0, np.int64)]).astype(np.int64)
    starts = np.concatenate([[0], np.cumsum(lengths)])
    theta, m, v = (np.zeros(n_features + 1) for _ in range(3))
    theta[-1] = np.log(prior / (1 - prior)) if prior < 1 else 0.0
    rng, step = np.random.default_rng(seed), 0
    is_p, every = np.flatnonzero(positive), np.arange(len(rows)) if unlabelled is None else np.flatnonzero(unlabelled)

    def margins(which):
        owner = np.repeat(np.arange(len(which)), lengths[which])
        cols = flat[np.concatenate([np.arange(starts[i], starts[i + 1]) for i in which])] if len(which) else flat[:0]
        g = theta[-1] + np.bincount(owner, (theta[:-1] * scale)[cols], len(which))
        return 1 / (1 + np.exp(-np.clip(g, -30, 30))), owner, cols, g

    def back(d, owner, cols):                       # d: derivative of the risk in each margin
        return np.append(np.bincount(cols, d[owner], n_features) * scale, d.sum())

    for _ in range(epochs):
        for p, u in zip(np.array_split(rng.permutation(is_p), batches), np.array_split(rng.permutation(every), batches)):
            if not len(p) or not len(u):
                continue
            sp, op, cp, gp = margins(p)
            su, ou, cu, gu = margins(u)
            soft = lambda x: np.logaddexp(0, x)
            negative_risk = soft(gu).mean() - prior * soft(gp).mean()
            grad_n = back(su / len(u), ou, cu) - back(prior * sp / len(p), op, cp)
            grad = back(prior * (sp - 1) / len(p), op, cp) + grad_n if negative_risk >= 0 else -grad_n
            grad[:-1] += decay * theta[:-1]
            step += 1
            m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
            theta = theta - rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return theta[:-1] * scale, float(theta[-1])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", train_rows: Column | None = None, max_positive: int = 2000,
          max_unlabelled: int = 6000, max_features: int = 2048, least_rows: int = 4) -> Model:
    """A model from the labelled rows for which ``train_rows`` holds (a column
    expression over ``id_col``)."""
    known = labels.select(F.col(id_col).alias(id_col), F.col(label_col).cast("int").alias("y")).where(
        F.col("y").isNotNull() & F.col(id_col).isNotNull())
    if train_rows is not None:
        known = known.where(train_rows)
    known = known.groupBy(F.col(id_col).alias("id")).agg((F.max("y") > 0).cast("int").alias("y"))
    total = known.agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("p")).first()
    if not total.p:
        return Model()
    prior = total.p / total.n
    order = F.xxhash64("id")
    picked = (known.where("y = 1").orderBy(order, "id").limit(max_positive).withColumn("u", F.lit(0))
              .union(known.orderBy(order, "id").limit(max_unlabelled).withColumn("u", F.lit(1)))
              .groupBy("id", "y").agg(F.max("u").alias("u")))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    # at most max_positive + max_unlabelled rows: of rows that repeat an id the text of the smallest hash is learnt from
    first = F.min(F.struct(F.xxhash64("text").alias("h"), "text", "y", "u")).alias("r")
    sample = materialize(texts.join(F.broadcast(picked), "id").groupBy("id").agg(first).select("id", "r.text", "r.y", "r.u"))

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [(f, y, u) for t, y, u in zip(*(c.to_pylist() for c in b.columns)) for f in _features(t)]
            yield pa.RecordBatch.from_arrays([pa.array([f for f, _, _ in got], pa.string()), pa.array([y for _, y, _ in got], pa.int32()),
                                              pa.array([u for _, _, u in got], pa.int32())], ["f", "y", "u"])

    n = sample.agg(F.sum("u").alias("u"), F.sum("y").alias("p")).first()
    if not n.p:
        return Model()
    counts = materialize(sample.select("text", "y", "u").mapInArrow(listed, "f string, y int, u int")
                         .groupBy("f").agg(F.sum("u").alias("u"), F.sum("y").alias("p"), F.count(F.lit(1)).alias("n"))
                         .where(F.col("n") >= least_rows))
    rate = (F.col("u") + 1) / F.lit((n.u or 0) + 2)          # smoothed: a feature may miss in the unlabelled sample
    z = F.abs((F.col("p") + rate) / F.lit(n.p + 1) - rate) / F.sqrt(rate * (1 - rate) / F.lit(n.p))
    best = counts.select("f", z.alias("z")).orderBy(F.desc("z"), "f").limit(max_features).collect()
    chosen, power = [r.f for r in best], np.array([r.z * r.z for r in best])
    scale = power / (power + 2 * np.log(max(2, counts.count())))
    place = {f: i for i, f in enumerate(chosen)}

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hits = [sorted(place[f] for f in _features(t) if f in place) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), b.column(3), pa.array(hits, pa.list_(pa.int32()))],
                                             ["id", "y", "u", "hits"])

    rows = sample.select("id", "text", "y", "u").mapInArrow(
        present, f"id {sample.schema['id'].dataType.simpleString()}, y int, u int, hits array<int>").orderBy("id", "hits").collect()
    weights, bias = fit_nnpu([np.array(r.hits, np.int64) for r in rows], np.array([r.y == 1 for r in rows]),
                             len(chosen), prior, unlabelled=np.array([r.u == 1 for r in rows]), scale=scale)
    return Model({f: float(w) for f, w in zip(chosen, weights) if abs(w) > 1e-6}, bias, True)


def scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id_col, score (0 to 1), predicted (1 if score >= 0.5)."""
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    held = docs.sparkSession.sparkContext.broadcast(model)            # at most max_features weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = held.value.scorer()
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([score(t.as_py()) for t in b.column(1)], pa.float64())],
                                             ["id", "score"])

    scored = slim.mapInArrow(run, f"id {slim.schema['id'].dataType.simpleString()}, score double")
    return scored.select(F.col("id").alias(id_col), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows scored 0.5 or more, all columns as they were;
    scored in the scan, without a shuffle."""
    name = fresh(docs, "toxic_score")
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        one = held.value.scorer()
        for part in texts:
            yield part.map(one)

    return docs.select(*same_columns(docs), score(F.col(text_col).cast("string")).alias(name)).where(
        F.col(name) < 0.5).drop(name)
