"""Mixing sources to target weights by blocks of tokens.

Each source's words, in a fixed order of its documents, are packed into blocks
of ``block_words``.  A source's target fixes how many blocks the mix takes
from it.  The mix is cut into output shards; each draws its source counts, a
multinomial draw given that every source meets its total (drawn down a binary
tree of shards, so a shard's counts need no other shard).  The k-th slot of a
source is mapped to a block by a keyed pseudorandom permutation of that
source's block numbers, one permutation per pass over the source, and slots
and blocks are joined by that number.  A block is thus taken at most once per
pass, so no document exceeds ``max_repeats`` times its size.  The last slot of
a source is cut to the words still wanted, so each source's taken words equal
its target up to rounding.

Everything is a function of the data and the seed: reruns and recomputed tasks
agree.  A source may hold any share of the rows: its documents are numbered in
hash buckets, whose totals alone are summed per source.  One row per *source*
(name, size) comes to the driver, for the targets.

Defined results: null and white-space texts have size 0 and take nothing; a
null source is a source, last in the order; rows that repeat an id, or have
none, are mixed each on its own (copies of one row, equal in id, text and
source, are numbered in one task); an empty table gives an empty result; other columns are kept
out of the way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize, shuffle_partitions
from .common import fresh, same_columns

WORD = "[^\\x20\\x09-\\x0D]+"
FEW = 64                       # draws made one by one


def targets(sizes: list[int], weights: tuple[float, ...] = (5, 2, 1), max_repeats: int = 3) -> list[float]:
    """Target words of each source, in order: shares of the total by the
    repeating ``weights``; a target stops at ``max_repeats`` times the size
    and its excess is shared again among the others by weight."""
    w = [weights[i % len(weights)] for i in range(len(sizes))]
    out, open_, left = [0.0] * len(sizes), set(range(len(sizes))), float(sum(sizes))
    while open_:
        total = sum(w[i] for i in open_)
        above = {i for i in open_ if left * w[i] / total > max_repeats * sizes[i]}
        for i in above or open_:
            out[i] = float(max_repeats * sizes[i]) if above else left * w[i] / total
        if not above:
            break
        open_ -= above
        left -= sum(out[i] for i in above)
    return out


def _round(x: np.ndarray, key: int) -> np.ndarray:
    x = (x ^ np.uint64(key)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def permuted(x: np.ndarray, n: int, key: tuple[int, ...], inverse: bool = False) -> np.ndarray:
    """A keyed pseudorandom permutation of 0..n-1 at ``x``: a balanced Feistel
    network on the next even number of bits, walked until inside the range."""
    half = max(1, ((max(n - 1, 1)).bit_length() + 1) // 2)
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    keys = [int(k) for k in np.random.SeedSequence(key).generate_state(4, np.uint64)]
    y = np.array(x, np.uint64)
    todo = np.arange(len(y))
    while len(todo):
        a, b = y[todo] >> shift, y[todo] & mask
        for k in reversed(keys) if inverse else keys:
            a, b = (b ^ (_round(a, k) & mask), a) if inverse else (b, a ^ (_round(b, k) & mask))
        y[todo] = (a << shift) | b
        todo = todo[y[todo] >= n]
    return y.astype(np.int64)


def slots_wanted(size: int, target: float, block: int, key: tuple[int, ...]) -> tuple[int, int]:
    """Number of slots of a source and the words taken from its last one."""
    if size <= 0:
        return 0, 0
    n = -(-size // block)
    short = size - (n - 1) * block
    passes, rest = divmod(int(round(target)), size)
    if not rest:
        return passes * n, block
    place = int(permuted(np.array([n - 1]), n, (*key, passes), inverse=True)[0])     # slot of the short last block

    def words(k):
        return k * block - (block - short) * (place < k)
    k = -(-rest // block)
    k += words(k) < rest
    return passes * n + k, rest - words(k - 1)


def drawn_of(counts: np.ndarray, n: int, rng: np.random.Generator) -> np.ndarray:
    """How many of each kind are among ``n`` items drawn without replacement
    from ``counts`` items of each kind, for counts of any size.

    If each item is taken by itself with one probability, any two sets of as
    many items are equally likely.  So binomial draws give a fair set of about
    n items, and the difference, of the order of its square root, is drawn in
    the same way from the items not taken (or is given back from those taken),
    until it is few enough to be drawn one by one."""
    taken, want = np.zeros(len(counts), np.int64), int(n)
    pool, sign = counts.astype(np.int64), 1
    while want > FEW:
        got = rng.binomial(pool, min(1.0, want / int(pool.sum())))
        taken, want = taken + sign * got, want - int(got.sum())
        # too many: give back a fair set of those just taken; too few: go on with the rest
        pool, sign, want = (got, -sign, -want) if want < 0 else (pool - got, sign, want)
    for _ in range(want):
        kind = int(np.searchsorted(np.cumsum(pool), rng.integers(int(pool.sum())), "right"))
        taken[kind] += sign
        pool[kind] -= 1
    return taken


def shard_counts(shard: int, shards: int, slots: int, totals: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(slots of each source before this shard, slots of each source in it)."""
    lo, hi, left, first = 0, shards, totals.astype(np.int64), np.zeros(len(totals), np.int64)
    while hi - lo > 1:
        mid = (lo + hi) // 2
        draw = drawn_of(left, (mid - lo) * slots, np.random.default_rng((seed, lo, hi)))
        if shard < mid:
            hi, left = mid, draw
        else:
            lo, left, first = mid, left - draw, first + draw
    return first, left


class Mix:
    """The mix of ``docs``; see the module text.  ``taken()`` is the report of
    one row per document, ``documents()`` the mixed documents."""

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                 weights: tuple[float, ...] = (5, 2, 1), max_repeats: int = 3, block_words: int = 256,
                 shard_slots: int = 4096, seed: int = 0):
        self.docs, self.id_col, self.text_col, self.source_col = docs, id_col, text_col, source_col
        spark = docs.sparkSession
        slim = docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
                           F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
                           .alias("size"), self._row_key(F.col(text_col), F.col(source_col)).alias("h"))
        # rows that share an id are told apart by text and source; only copies of one row are numbered
        one = Window.partitionBy("id", "h").orderBy("source")
        sized = materialize(slim.withColumn("nth", F.row_number().over(one)))
        # one row per source
        per = sorted(((r.source, r.size) for r in sized.groupBy("source").agg(F.sum("size").alias("size")).collect()),
                     key=lambda r: (r[0] is None, r[0] or ""))
        size = [s for _, s in per]
        aim = targets(size, weights, max_repeats)
        wanted = [slots_wanted(s, t, block_words, (seed, i)) for i, (s, t) in enumerate(zip(size, aim))]
        named = spark.createDataFrame([(i, n, s, t) for i, ((n, s), t) in enumerate(zip(per, aim))],
                                      "sid int, source string, source_size long, target double")
        self.sized = sized.join(named, sized["source"].eqNullSafe(named["source"])).select(
            "id", "h", "nth", "size", "sid", "source_size", "target")
        self.pieces = self._pieces(block_words)
        self.slots = self._slots(size, wanted, block_words, shard_slots, seed)

    @staticmethod
    def _row_key(text: Column, source: Column) -> Column:
        return F.xxhash64(text.cast("string"), source.cast("string"))

    def _pieces(self, block: int) -> DataFrame:
        """Parts of documents by block: sid, block, at (place in the block), id, h, nth, from_word, words."""
        buckets = 4 * max(16, shuffle_partitions(self.docs.sparkSession))
        rows = self.sized.where("size > 0").select(
            "id", "h", "nth", "size", "sid", F.pmod(F.xxhash64("id", "h", "nth"), F.lit(buckets)).alias("bucket"))
        before = Window.partitionBy("sid").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        heads = rows.groupBy("sid", "bucket").agg(F.sum("size").alias("n")).select(       # <= buckets rows a source
            "sid", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("head"))
        inside = Window.partitionBy("sid", "bucket").orderBy("id", "h", "nth").rowsBetween(Window.unboundedPreceding, -1)
        placed = rows.withColumn("start", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(
            heads, ["sid", "bucket"]).withColumn("start", F.col("start") + F.col("head"))
        split = placed.withColumn("block", F.explode(F.sequence(
            F.expr(f"start div {block}"), F.expr(f"(start + size - 1) div {block}"))))
        lo = F.greatest(F.col("block") * block, F.col("start"))
        hi = F.least((F.col("block") + 1) * block, F.col("start") + F.col("size"))
        return split.select("sid", "block", (lo - F.col("block") * block).alias("at"), "id", "h", "nth",
                            (lo - F.col("start")).alias("from_word"), (hi - lo).alias("words"))

    def _slots(self, size, wanted, block, shard_slots, seed) -> DataFrame:
        """Slots of the mix: shard, place (order inside the shard), sid, pass, block, most (words to take)."""
        totals = np.array([k for k, _ in wanted], np.int64)
        last = [m for _, m in wanted]
        blocks = [-(-s // block) for s in size]
        shards = max(1, -(-int(totals.sum()) // shard_slots)) if len(totals) else 0

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for shard in b.column(0).to_pylist():
                    first, count = shard_counts(shard, shards, shard_slots, totals, seed)
                    parts = []
                    for i in np.flatnonzero(count):
                        j = np.arange(first[i], first[i] + count[i])
                        turn, k = j // blocks[i], j % blocks[i]
                        at = np.empty_like(j)
                        for e in np.unique(turn):
                            at[turn == e] = permuted(k[turn == e], blocks[i], (seed, int(i), int(e)))
                        parts.append((np.full(len(j), i), turn, at, np.where(j == totals[i] - 1, last[i], block)))
                    if not parts:
                        continue
                    sid, turn, at, most = (np.concatenate(c).astype(np.int64) for c in zip(*parts))
                    place = np.random.default_rng((seed, shard, 1)).permutation(len(sid))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(sid), shard)), pa.array(place), pa.array(sid.astype(np.int32)), pa.array(turn),
                         pa.array(at), pa.array(most)], ["shard", "place", "sid", "pass", "block", "most"])

        spark = self.docs.sparkSession
        return spark.range(shards).repartition(max(1, min(shards, shuffle_partitions(spark)))).mapInArrow(
            run, "shard long, place long, sid int, pass long, block long, most long")

    def drawn(self) -> DataFrame:
        """Parts of documents in the mix: shard, place, at, pass, id, h, nth, from_word, words."""
        # Spark sizes the slots by the few shards they are made from: never broadcast them
        hit = self.slots.join(self.pieces.hint("merge"), ["sid", "block"]).withColumn(
            "words", F.least("words", F.col("most") - F.col("at")))
        return hit.where("words > 0").select("shard", "place", "at", "pass", "id", "h", "nth", "from_word", "words")

    def taken(self) -> DataFrame:
        """One row per input row: id_col, size, source_size, target, taken."""
        words = self.drawn().groupBy("id", "h", "nth").agg(F.sum("words").alias("words")).select(
            F.col("id").alias("t_id"), F.col("h").alias("t_h"), F.col("nth").alias("t_nth"), "words")
        s = self.sized
        same = s["id"].eqNullSafe(words["t_id"]) & (s["h"] == words["t_h"]) & (s["nth"] == words["t_nth"])
        return s.join(words, same, "left").select(
            F.col("id").alias(self.id_col), "size", "source_size", "target",
            F.coalesce("words", F.lit(0)).cast("long").alias("taken"))

    def documents(self) -> DataFrame:
        """The mix as documents: for each pass in which the mix takes words of
        a document, one row with all its columns and, as text, the words taken
        in their order (the text unchanged where all are taken, else joined by
        one space).  Documents of which nothing is taken are not in the mix."""
        docs = self.docs
        key, key_h, key_nth, h, nth, parts, texts = (fresh(docs, c) for c in (
            "mix_id", "mix_row", "mix_key", "mix_hash", "mix_nth", "mix_parts", "mix_texts"))
        part = F.struct("pass", "from_word", "words")
        lists = self.drawn().groupBy("id", "h", "nth").agg(F.sort_array(F.collect_list(part)).alias("l")).select(
            F.col("id").alias(key), F.col("h").alias(key_h), F.col("nth").alias(key_nth), F.flatten(F.transform("l", lambda p: F.array(
                p["pass"], p["from_word"], p["words"]))).alias(parts))
        hashed = docs.select(*same_columns(docs), self._row_key(F.col(self.text_col), F.col(self.source_col)).alias(h))
        numbered = hashed.withColumn(nth, F.row_number().over(Window.partitionBy(self.id_col, h).orderBy(self.source_col)))
        hit = numbered.join(lists, F.col(self.id_col).eqNullSafe(F.col(key)) & (F.col(h) == F.col(key_h))
                            & (F.col(nth) == F.col(key_nth)))

        @F.pandas_udf("array<string>")
        def cut(text: pd.Series, flat: pd.Series) -> pd.Series:
            return pd.Series([_passes(t, p) for t, p in zip(text, flat)], dtype=object)

        cast = docs.schema[self.text_col].dataType
        out = hit.withColumn(texts, F.explode(cut(F.col(self.text_col).cast("string"), F.col(parts))))
        return out.withColumn(self.text_col, F.col(texts).cast(cast)).select(*[F.col(f"`{c}`") for c in docs.columns])


def _passes(text: str | None, flat: np.ndarray) -> list[str]:
    rows = np.asarray(flat, np.int64).reshape(-1, 3)
    words, out = (text or "").encode("utf-8", "surrogatepass").split(), []       # bytes: ASCII white space only
    for e in np.unique(rows[:, 0]):
        mine = rows[rows[:, 0] == e]
        if mine[:, 2].sum() == len(words):
            out.append(text)
        else:
            out.append(b" ".join(w for _, a, n in mine.tolist() for w in words[a:a + n]).decode("utf-8", "surrogatepass"))
    return out
