"""Substring dedup: windows of words that occur earlier in the corpus.

A window is ``window`` consecutive words of one document.  A window is a
repeat if its words also start earlier: in a document with a smaller id, or
earlier in the same one.  Every word covered by a repeat is removed; windows
are judged on the input.

How the corpus is cut into shards: every window has a minimizer, the smallest
hash among its ``gram``-word sequences, so equal windows have equal
minimizers.  Consecutive windows of one minimizer form a segment, at most
``MOST_WINDOWS`` windows long.  Minimizers that occur once in the corpus are
dropped (their windows are unique); the segments of the others are dealt to
shards by minimizer, so every document is streamed to just the shards that can
hold its windows.  Equal segments are collapsed to the earliest before the
shuffle; the others of a class repeat it as a whole.

In a shard the segments are indexed by an FM-index over a wavelet matrix of
word numbers.  Backward search gives, for every position, how many words up to
it occur at least twice (matching statistics); where that reaches ``window``,
the window's occurrences are an interval of suffixes, and all but the earliest
are repeats.

A minimizer shared by more than ``wide_group`` different segments (a frequent
phrase shorter than the window) would be a shard without bound; its windows
are dealt one by one, pre-aggregated to the earliest of each, and the rest
flagged by a join.  Nothing is sampled or dropped.

Defined results: null texts have no words; documents shorter than the window
have no repeats; a null id comes before all others; rows that repeat an id
count as one document each, in the order of a 64-bit text hash (which tells
their texts apart), and rows that repeat id and text are judged alike; an empty table gives an empty result; other
columns are ignored.  Ids are integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .fm_index import FmIndex

MOST_WINDOWS = 32
SHARD_WORDS = 1 << 17
PIECE = 1 << 18                                     # bytes hashed at once
LONG_WORD = 1 << 16                                 # longer words are hashed one by one
NULL_ID = -(1 << 63)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


# A word's hash is a polynomial in its bytes, so all words are hashed from running sums over the bytes.
_BASE = 0x9E3779B97F4A7C15
_UP, _DOWN = _powers(_BASE, PIECE + LONG_WORD), _powers(pow(_BASE, -1, 1 << 64), PIECE + LONG_WORD)
_BYTE = np.array([xxhash.xxh64_intdigest(bytes([k]), 7) for k in range(256)], np.uint64)
_IN_WORD = np.ones(256, bool)
_IN_WORD[[9, 10, 11, 12, 13, 32]] = False


def _hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words ``data[start:stop]``; a hash follows from the word's bytes alone."""
    out = np.empty(len(starts), np.uint64)
    a = 0
    while a < len(starts):
        if stops[a] - starts[a] > LONG_WORD:
            out[a] = xxhash.xxh64_intdigest(data[starts[a]:stops[a]], 7)
            a += 1
            continue
        b = int(np.searchsorted(starts, starts[a] + PIECE))
        long_ = np.flatnonzero(stops[a:b] - starts[a:b] > LONG_WORD)
        b = a + int(long_[0]) if len(long_) else b
        part = data[starts[a]:stops[b - 1]]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_BYTE[part] * _UP[:len(part)], out=sums[1:])
        first, last = starts[a:b] - starts[a], stops[a:b] - starts[a]
        out[a:b] = (sums[last] - sums[first]) * _DOWN[first]
        a = b
    out ^= out >> np.uint64(32)
    return out


def _word_hashes(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first text, number of words of each text, hashes of their words) for
    groups of texts of about ``PIECE`` bytes."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    if not len(texts):
        return
    _, offsets, held = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    held = np.frombuffer(held, np.uint8) if held else np.empty(0, np.uint8)
    a = 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(ends, ends[a] + PIECE, "right")) - 1)
        cuts, data = ends[a:b + 1] - ends[a], held[ends[a]:ends[b]]
        inside = _IN_WORD[data]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        seam = cuts[(cuts > 0) & (cuts < len(data))]           # a word ends with its text
        first[seam], last[seam - 1] = inside[seam], inside[seam - 1]
        starts = np.flatnonzero(first)
        yield a, np.diff(np.searchsorted(starts, cuts)), _hashes(data, starts, np.flatnonzero(last) + 1)
        a = b


def _rolled(h: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of every n consecutive hashes."""
    out = np.zeros(len(h) - n + 1, np.uint64)
    for i in range(n):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[i:len(h) - n + 1 + i]
    out ^= out >> np.uint64(31)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(29))


def runs(texts: pa.Array, window: int, gram: int, twice: bool = False) -> list[np.ndarray]:
    """Segments of texts: [number of the text, minimizer, first window, number
    of windows, and with ``twice`` whether a window of it occurs twice in its text]."""
    got = [[np.empty(0, np.int64)] * 4 + [np.empty(0, bool)] * twice]
    for base, words, h in _word_hashes(texts):
        counts = np.maximum(words - window + 1, 0)
        heads, n = np.cumsum(counts) - counts, int(counts.sum())
        if not n:
            continue
        low, span = _rolled(h, gram), 1
        wide = window - gram + 1
        while 2 * span <= wide:
            low, span = np.minimum(low[:-span], low[span:]), 2 * span
        if span < wide:
            low = np.minimum(low[:len(low) - (wide - span)], low[wide - span:])
        k = np.arange(n)
        at = k + np.repeat(np.cumsum(words) - words - heads, counts)       # windows over the end of a text are none
        low = low[at]
        new = np.empty(n, bool)
        new[0], new[1:] = True, low[1:] != low[:-1]
        new[heads[counts > 0]] = True
        start = np.flatnonzero(new | ((k - np.maximum.accumulate(np.where(new, k, 0))) % MOST_WINDOWS == 0))
        owner = np.searchsorted(heads + counts, start, "right")
        rows = [base + owner, low[start].view(np.int64), start - heads[owner], np.diff(np.append(start, n))]
        if twice:
            whole = _rolled(h, window)[at] + np.repeat(np.arange(len(counts), dtype=np.uint64) * np.uint64(_BASE), counts)
            order = np.argsort(whole)
            whole = whole[order]
            same = whole[1:] == whole[:-1]
            again = np.zeros(n, bool)
            again[order[1:][same]] = again[order[:-1][same]] = True
            rows.append(np.logical_or.reduceat(again, start))
        got.append(rows)
    return [np.concatenate(column) for column in zip(*got)]


def shard_repeats(segments: list[bytes], doc: np.ndarray, tag: np.ndarray, start: np.ndarray, window: int) -> tuple:
    """Repeats among the windows of different segments, each at its earliest
    place (doc, tag, start): (segment number, first window, number of windows)."""
    number: dict[bytes, int] = {}
    rows = [[number.setdefault(w, len(number) + 1) for w in s.split(b" ")] for s in segments]
    sizes = np.array([len(r) for r in rows])
    text = np.zeros(int(sizes.sum()) + len(rows) + 1, np.int64)
    begin = 1 + np.cumsum(sizes + 1) - (sizes + 1)                 # a separator before each segment, one at the end
    for b, r in zip(begin, rows):
        text[b:b + len(r)] = r
    index = FmIndex(text, depth=max(32, window))
    owner = np.repeat(np.arange(len(rows)), sizes - window + 1)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(sizes - window + 1) - (sizes - window + 1), sizes - window + 1)
    lengths, lo, hi = index.matching_statistics(begin[owner] + inside + window - 1, window)
    hit = np.flatnonzero(lengths == window)
    if not len(hit):
        return tuple(np.empty(0, np.int64) for _ in range(3))
    # the earliest window of every interval
    place = np.lexsort((start[owner[hit]] + inside[hit], tag[owner[hit]], doc[owner[hit]]))
    first = np.full(index.n, len(hit), np.int64)
    rank = np.empty(len(hit), np.int64)
    rank[place] = np.arange(len(hit))
    np.minimum.at(first, lo[hit], rank)
    again = hit[rank != first[lo[hit]]]
    return owner[again], inside[again], np.ones(len(again), np.int64)


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20, gram: int = 6,
            wide_group: int = 2048) -> tuple[DataFrame, DataFrame]:
    """(documents, spans).  documents: one row per input row: id, doc and tag
    (the key of the spans), text (null where nothing can repeat), n_words,
    kept_sha256.  spans: (doc, tag, first, stop) word ranges to remove."""
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).select(
        "id", F.coalesce("id", F.lit(NULL_ID)).alias("doc"), F.xxhash64("text").alias("tag"), "text")

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            _, key, _, _, twice = runs(b.column(0), window, gram, twice=True)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(1 + twice.astype(np.int64))], ["mz", "n"])

    often = materialize(slim.select("text").mapInArrow(grams, "mz long, n long").groupBy("mz")
                        .agg(F.sum("n").alias("n")).where("n > 1").select("mz"))

    def located(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, key, start, size = runs(b.column(2), window, gram)
            yield pa.RecordBatch.from_arrays([pa.array(key), b.column(0).take(pa.array(row)), b.column(1).take(pa.array(row)),
                                              pa.array(start.astype(np.int32)), pa.array(size.astype(np.int32))],
                                             ["mz", "doc", "tag", "start", "size"])

    places = slim.select("doc", "tag", "text").mapInArrow(located, "mz long, doc long, tag long, start int, size int").join(
        often.hint("shuffle_hash"), "mz")
    # sets: rows that repeat id and text have the same places, so a list is bounded by one document
    lists = places.groupBy("doc", "tag").agg(F.collect_set(F.struct("start", "size", "mz")).alias("l")).select(
        "doc", "tag", F.flatten(F.transform("l", lambda r: F.array(r["start"].cast("long"), r["size"].cast("long"), r["mz"]))).alias("l"))

    lists = materialize(lists)                          # its shuffles end before the texts are dealt

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts, digests, texts = [], [], []
            for t, found in zip(b.column(3), b.column(4)):
                text = t.as_py()
                words = (text or "").encode("utf-8").split()
                counts.append(len(words))
                digests.append(None if found.is_valid else hashlib.sha256(b" ".join(words)).hexdigest())
                texts.append(text if found.is_valid else None)
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(texts, pa.string()), pa.array(counts, pa.int64()),
                                              pa.array(digests, pa.string()), b.column(4)],
                                             ["id", "doc", "tag", "text", "n_words", "kept_sha256", "l"])

    documents = materialize(slim.join(lists.hint("shuffle_hash"), ["doc", "tag"], "left").select("id", "doc", "tag", "text", "l").mapInArrow(
        told, "id long, doc long, tag long, text string, n_words long, kept_sha256 string, l array<long>"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int32()]
        for b in batches:
            rows, size = [], 0
            for d, g, t, found in zip(*(b.column(c) for c in range(4))):
                d, g, words = d.as_py(), g.as_py(), (t.as_py() or "").encode("utf-8").split()
                for start, n, mz in dict.fromkeys(map(tuple, found.values.to_numpy().reshape(-1, 3).tolist())):
                    rows.append((mz, b" ".join(words[start:start + n + window - 1]), d, g, start))
                    size += 16 * n + 400
                    if size > 1 << 23:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                        rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    names = ["mz", "seg", "doc", "tag", "start"]
    segments = documents.where("kept_sha256 IS NULL").select("doc", "tag", "text", "l").mapInArrow(
        cut, "mz long, seg binary, doc long, tag long, start int")
    return documents.drop("l"), _spans(segments, window, wide_group)


def _spans(segments: DataFrame, window: int, wide_group: int) -> DataFrame:
    own = F.struct("doc", "tag", "start")
    digest = F.unhex(F.md5("seg"))
    classes = materialize(segments.groupBy("mz", "seg").agg(F.min(own).alias("first"), F.count(F.lit(1)).alias("n")))
    # later members of a class repeat it as a whole
    several = classes.where("n > 1").select("mz", digest.alias("digest"), "first")
    words = F.size(F.split(F.col("seg").cast("string"), " "))
    later = (segments.select("mz", digest.alias("digest"), words.alias("words"), own.alias("own")).join(several, ["mz", "digest"])
             .where(F.col("own") != F.col("first")).select("own.doc", "own.tag", F.col("own.start").alias("first"),
                                                           (F.col("own.start") + F.col("words")).alias("stop")))
    wide = materialize(classes.groupBy("mz").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > wide_group).select("mz"))
    flat = classes.select("mz", "seg", "first.doc", "first.tag", "first.start")
    shards = flat.join(wide, "mz", "left_anti").repartition("mz").sortWithinPartitions("mz")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = [], 0, None

        def out():
            seg, d, g, s = zip(*held)
            d, g, s = np.array(d, np.int64), np.array(g, np.int64), np.array(s, np.int64)
            which, at, n = shard_repeats(list(seg), d, g, s, window)
            first = s[which] + at
            return pa.RecordBatch.from_arrays(
                [pa.array(d[which]), pa.array(g[which]), pa.array(first.astype(np.int32)),
                 pa.array((first + n + window - 1).astype(np.int32))], ["doc", "tag", "first", "stop"])

        for b in batches:
            for mz, seg, d, g, s in zip(*(c.to_pylist() for c in b.columns)):
                if size >= SHARD_WORDS and mz != last:
                    yield out()
                    held, size = [], 0
                held.append((seg, d, g, s))
                size += seg.count(b" ") + 1
                last = mz
        if held:
            yield out()

    spans = "doc long, tag long, first int, stop int"
    found = shards.mapInArrow(search, spans)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in range(0, b.num_rows, 4096):
                rows = []
                for _, seg, d, g, s in zip(*(c.to_pylist() for c in b.slice(part, 4096).columns)):
                    w = seg.split(b" ")
                    rows += [(b" ".join(w[k:k + window]), d, g, s + k) for k in range(len(w) - window + 1)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                    zip(*rows), (pa.binary(), pa.int64(), pa.int64(), pa.int32()))], ["seg", "doc", "tag", "start"])

    single = flat.join(wide, "mz", "left_semi").mapInArrow(windows, "seg binary, doc long, tag long, start int")
    earliest = single.groupBy("seg").agg(F.min(own).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select(
        digest.alias("digest"), "first")
    dealt = single.select(digest.alias("digest"), own.alias("own")).join(earliest, "digest").where(
        F.col("own") != F.col("first")).select("own.doc", "own.tag", F.col("own.start").alias("first"),
                                               (F.col("own.start") + window).alias("stop"))
    return later.union(found).union(dealt)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20, gram: int = 6,
                   wide_group: int = 2048, with_text: bool = False) -> DataFrame:
    """One row per input row: id_col, n_words, n_removed, kept_sha256 (SHA-256
    of the kept words joined by one space), and kept_text ``with_text``."""
    if with_text:
        wide_docs, spans = repeats(docs, id_col, text_col, window, gram, wide_group)
        wide_docs = wide_docs.drop("text").join(docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("doc"),
                                                            F.xxhash64(F.col(text_col).cast("string")).alias("tag"),
                                                            F.col(text_col).cast("string").alias("text")).distinct(), ["doc", "tag"])
        wide_docs = wide_docs.withColumn("kept_sha256", F.lit(None).cast("string")).select(
            "id", "doc", "tag", "text", "n_words", "kept_sha256")
    else:
        wide_docs, spans = repeats(docs, id_col, text_col, window, gram, wide_group)
    lists = spans.groupBy("doc", "tag").agg(F.collect_set(F.struct("first", "stop")).alias("l")).select(
        "doc", "tag", F.flatten(F.transform("l", lambda r: F.array(r["first"], r["stop"]))).alias("l"))
    done = wide_docs.where("kept_sha256 IS NOT NULL").select(
        "id", "n_words", F.lit(0).cast("long").alias("n_removed"), "kept_sha256", F.lit(None).cast("string").alias("kept_text"))
    open_ = wide_docs.where("kept_sha256 IS NULL").join(lists.hint("shuffle_hash"), ["doc", "tag"], "left").select("id", "text", "l")

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for i, t, found in zip(*(b.column(c) for c in range(3))):
                words = (t.as_py() or "").encode("utf-8").split()
                depth = np.zeros(len(words) + 1, np.int64)
                if found.is_valid:
                    ends = found.values.to_numpy().reshape(-1, 2)
                    np.add.at(depth, ends[:, 0], 1)
                    np.add.at(depth, ends[:, 1], -1)
                stay = np.cumsum(depth)[:len(words)] == 0
                text = b" ".join([words[k] for k in np.flatnonzero(stay).tolist()])
                rows.append((i.as_py(), len(words), int(len(words) - stay.sum()), hashlib.sha256(text).hexdigest(),
                             text.decode("utf-8") if with_text else None))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()))],
                    ["id", "n_words", "n_removed", "kept_sha256", "kept_text"])

    out = done.union(open_.mapInArrow(kept, "id long, n_words long, n_removed long, kept_sha256 string, kept_text string"))
    out = out.withColumnRenamed("id", id_col)
    return out if with_text else out.drop("kept_text")
