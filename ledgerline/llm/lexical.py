"""Ranked lexical search: accumulator-limited term-at-a-time.

Every query item is scored against every document.  The documents are read
once for a block of items into a written table of postings (document, its
length, numbers and frequencies of the terms that any item of the block
holds); statistics come from that table.  A task then reads a run of documents
at a time, turns its postings around (term -> documents) and evaluates every
item term at a time, rarest term first.  A document gets an accumulator when a
term of the item meets it; once the terms still to come cannot lift a document
without an accumulator over the k-th best partial score, no more are created,
and the remaining terms only update those that exist, exactly.  The best k of
an item live on from one run of a task to the next, so later runs start with a
threshold.  The tasks' best k meet in two levels of row numbers.

Partial scores only grow (weights and impacts are never negative), the k-th
best partial score is at most the k-th best score, and creation stops only if
the bound is strictly below it, so ties survive: the result is exact.

Items come to the driver in blocks of about ``block_bytes`` of distinct terms
(the query set against all rows, block by block); the documents never do.

Defined results: null or empty texts have no terms and no rows; null document
ids come before all others in ties, rows that repeat an id are documents of
their own; rows of one item id (null is an id) are one item with the terms of
all its rows; items without a matching document have no rows; very long texts
are split into terms in one piece, a document's postings are bounded by the
block's terms; empty tables give an empty result; other columns are ignored.
Document and item ids are integers.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

# Fixed value: ASCII letters and digits and everything beyond ASCII are term bytes, A-Z become a-z.
TERM_BYTES = bytes((b + 32 if 65 <= b <= 90 else b) if 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 else 32
                   for b in range(256))


def terms(text: str | None) -> list[bytes]:
    return text.encode("utf-8").translate(TERM_BYTES).split() if text else []


def counted(text: str | None) -> Counter:
    return Counter(terms(text))


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Postings:
    """The postings of a run of documents by term, and term-at-a-time search."""

    def __init__(self, ids: np.ndarray, norm: np.ndarray, doc: np.ndarray, term: np.ndarray, tf: np.ndarray):
        order = np.argsort(term, kind="stable")
        self.ids, self.doc, term, tf = ids, doc[order], term[order], tf[order]
        self.impact = (1_000_000_000 * tf) // (1000 * tf + 20 * norm[self.doc])
        held, self.begin = np.unique(term, return_index=True)
        self.end = np.append(self.begin[1:], len(term))
        self.at = {t: i for i, t in enumerate(held.tolist())}
        self.highest = np.maximum.reduceat(self.impact, self.begin) if len(held) else np.empty(0, np.int64)
        self.scores = np.zeros(len(ids), np.int64)

    def search(self, item: list[tuple[int, int]], k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """(document rows, scores) of the documents that may be among the best
        ``k`` of ``item``, its (term, weight) rarest first; ``floor`` is a
        score that k documents of other runs have already."""
        here = [(self.at[t], w) for t, w in item if t in self.at]
        left = sum(w * int(self.highest[t]) for t, w in here)
        scores, touched, some, create = self.scores, [], 0, True
        for t, w in here:
            docs, gain = self.doc[self.begin[t]:self.end[t]], w * self.impact[self.begin[t]:self.end[t]]
            create = create and left >= floor
            if create:
                new = docs[(scores[docs] == 0) & (gain > 0)]
                scores[docs] += gain
                touched.append(new)
                some += len(new)
                if some >= k:
                    got = scores[np.concatenate(touched)]
                    floor = max(floor, int(np.partition(got, len(got) - k)[len(got) - k]))
            else:
                old = scores[docs] > 0
                scores[docs[old]] += gain[old]
            left -= w * int(self.highest[t])
        found = np.unique(np.concatenate(touched)) if touched else np.empty(0, np.int64)
        got = scores[found]
        scores[found] = 0
        keep = (got > 0) & (got >= floor)
        return found[keep], got[keep]


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The best k: highest score, then smallest id."""
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


NULL_ID = -(1 << 63)


def _postings(docs: DataFrame, id_col: str, text_col: str, number: dict[bytes, int]) -> DataFrame:
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, held, often = [], [], []
            for text in b.column(1):
                found = counted(text.as_py())
                sizes.append(found.total())
                own = [(number[t], n) for t, n in found.items() if t in number]
                held.append([t for t, _ in own])
                often.append([n for _, n in own])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64()), pa.array(held, pa.list_(pa.int32())),
                                              pa.array(often, pa.list_(pa.int32()))], ["id", "n", "terms", "tfs"])

    slim = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("id"), F.col(text_col).cast("string").alias("text"))
    return slim.where("text IS NOT NULL").mapInArrow(index, "id long, n long, terms array<int>, tfs array<int>").where("n > 0")


def _blocks(items: DataFrame, item_id: str, item_text: str, block_bytes: int) -> Iterator[dict]:
    """Items with their distinct terms, a bounded block at a time."""
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [list(counted(t.as_py())) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.list_(pa.binary())),
                                              pa.array([sum(map(len, f)) + 16 for f in found], pa.int64())], ["item", "terms", "size"])

    held = materialize(items.select(F.col(item_id).cast("long").alias("item"), F.col(item_text).cast("string").alias("text"))
                       .mapInArrow(split, "item long, terms array<binary>, size long"))
    total = held.agg(F.sum("size")).first()[0] or 0
    blocks = -(-total // block_bytes)
    for k in range(blocks):
        rows = held.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == k).select("item", "terms").collect()
        one: dict = {}
        for r in rows:
            one.setdefault(r["item"], set()).update(map(bytes, r["terms"]))
        yield one


def search(docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text",
           item_id: str = "item_id", item_text: str = "text", block_bytes: int = 1 << 23, run_postings: int = 1 << 20) -> DataFrame:
    """(item_id, rank int, id_col, score): the ``k`` documents of every item
    with the highest score above 0, equal scores by ascending id."""
    spark, parts = docs.sparkSession, []
    for block in _blocks(items, item_id, item_text, block_bytes):
        number = {t: i for i, t in enumerate(sorted(set().union(*block.values())))}
        table = materialize(_postings(docs, id_col, text_col, number))
        n_docs, length = table.agg(F.count(F.lit(1)), F.sum("n")).first()
        if not n_docs:
            continue
        df = {r[0]: r[1] for r in table.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1))).collect()}
        queries = [(item, [(t, weight(n_docs, df[t])) for t in sorted((number[x] for x in held if number[x] in df),
                                                                     key=lambda t: (df[t], t))]) for item, held in block.items()]
        parts.append(_ranked(table, [q for q in queries if q[1]], k, n_docs, length, run_postings))
    if not parts:
        return spark.createDataFrame([], f"`{item_id}` long, rank int, `{id_col}` long, score long")
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out.select(F.col("item").alias(item_id), "rank", F.when(F.col("id") != NULL_ID, F.col("id")).alias(id_col), "score")


def _ranked(table: DataFrame, queries: list, k: int, n_docs: int, length: int, run_postings: int) -> DataFrame:
    """The best k of every query over all rows of ``table``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top: list = [None] * len(queries)
        held, size = [], 0

        def evaluate():
            ids = np.concatenate([h[0] for h in held])
            norm = 50 + (50 * np.concatenate([h[1] for h in held]) * n_docs) // length
            doc = np.repeat(np.arange(len(ids)), np.concatenate([h[2] for h in held]))
            index = Postings(ids, norm, doc, *(np.concatenate([h[c] for h in held]) for c in (3, 4)))
            for q, (_, item) in enumerate(queries):
                old = top[q]
                rows, scores = index.search(item, k, int(old[1][-1]) if old and len(old[1]) == k else 0)
                if len(rows):
                    new = ids[rows], scores
                    if old:
                        new = tuple(np.concatenate(x) for x in zip(old, new))
                    top[q] = best(*new, k)

        for b in batches:
            counts = np.diff(b.column(2).offsets.to_numpy())
            held.append((b.column(0).to_numpy(), b.column(1).to_numpy(), counts,
                         b.column(2).flatten().to_numpy().astype(np.int64), b.column(3).flatten().to_numpy().astype(np.int64)))
            size += int(counts.sum()) + len(counts)
            if size >= run_postings:
                evaluate()
                held, size = [], 0
        if held:
            evaluate()
        for (item, _), found in zip(queries, top):
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([item] * len(found[0]), pa.int64()), pa.array(found[0]), pa.array(found[1])],
                                                 ["item", "id", "score"])

    found = table.mapInArrow(run, "item long, id long, score long").withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(64)))
    order = [F.col("score").desc(), F.col("id").asc()]
    for keys in (["item", "salt"], ["item"]):
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)
    return found.select("item", "rank", "id", "score")
