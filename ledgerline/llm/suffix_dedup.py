"""Suffix-array dedup: byte strings that occur earlier in the corpus.

A window is ``window`` consecutive bytes of one document (UTF-8).  A window is
a repeat if its bytes also start earlier: in a document with a smaller id, or
earlier in the same one.  Every byte covered by a repeat is removed; windows
are judged on the input.

The corpus is cut into shards that hold all places of a window: every window
has a minimizer, the smallest hash among its ``gram``-byte strings, and the
consecutive windows that share the place of their minimizer form a segment (no
window occurs twice in a segment).  Minimizers that occur once in the corpus
are dropped, their windows are unique.  The segments of the others are dealt
by minimizer, equal segments of a minimizer collapsed into one class that
knows its earliest place and its size.

A shard's classes are joined to one text, whose suffix array is made by
induced sorting and whose common prefixes by the permuted array
(``suffix_array``).  Neighbours in the array with ``window`` characters in
common are places of the same window: all but the earliest are repeats.  A
class of several segments holds each of its windows several times: all its
members but the first are repeats as a whole.  A minimizer of one class has no
other text to be compared with (no window occurs twice in a segment) and takes
no place in a shard.

A minimizer shared by more than ``wide_group`` classes (a frequent phrase
shorter than the window) would be a shard without bound.  Its segments are cut
again by minimizers of longer strings (``grams``); the last are whole windows,
of which a minimizer has one class.

Defined results: null texts are empty; documents shorter than the window have
no repeats; a null id comes before all others; rows that repeat an id are
documents of their own, in the order of a 64-bit text hash (which tells their
texts apart), and rows that repeat id and text are judged alike; very long
texts are whole; an empty table gives an empty result; other columns are
ignored.  Ids are integers.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .suffix_array import common_prefixes, suffix_array

SHARD_BYTES = 1 << 18          # a shard's lists stay in a processor's cache
BATCH_BYTES = 1 << 22
NULL_ID = -(1 << 63)
PLACE_BITS = 20
# A byte that UTF-8 never uses ends each segment of a shard's text.
SEPARATOR = b"\xfe"


def gram_hashes(text: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of every n consecutive bytes, joined from powers of two."""
    with np.errstate(over="ignore"):
        power = (text.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        power ^= power >> np.uint64(29)
        out, have, span = None, 0, 1
        while True:
            if n & span:
                if out is None:
                    out, have = power, span
                else:
                    m = len(power) - have
                    out = out[:m] * np.uint64(0xBF58476D1CE4E5B9) + power[have:]
                    out ^= out >> np.uint64(31)
                    have += span
            if 2 * span > n:
                return out * np.uint64(0x94D049BB133111EB)
            m = len(power) - span
            power = power[:m] * np.uint64(0xD6E8FEB86659FD93) + power[span:]
            power ^= power >> np.uint64(30)
            span *= 2


def segments(text: bytes, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(minimizer, first window, number of windows) of a text's segments."""
    if len(text) < window:
        return (np.empty(0, np.int64),) * 3
    h = gram_hashes(np.frombuffer(text, np.uint8), gram)
    mask = np.uint64((1 << PLACE_BITS) - 1)
    low = (h & ~mask) | (np.arange(len(h), dtype=np.uint64) & mask)        # ties: the first place
    wide, span = window - gram + 1, 1
    while 2 * span <= wide:
        low, span = np.minimum(low[:-span], low[span:]), 2 * span
    if span < wide:
        low = np.minimum(low[:len(low) - (wide - span)], low[wide - span:])
    start = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
    place = start + ((low[start] - start.astype(np.uint64)) & mask).astype(np.int64)
    return h[place].view(np.int64), start, np.diff(np.append(start, len(low)))


def shard_repeats(found: list[bytes], doc: np.ndarray, tag: np.ndarray, start: np.ndarray, window: int) -> tuple:
    """Windows of the (different) segments ``found`` that occur earlier in another, as runs:
    (segment number, first window, number of windows)."""
    text = np.frombuffer(SEPARATOR.join(found) + SEPARATOR + b"\xff", np.uint8) + np.uint8(1)     # the end mark is 0
    size = np.array([len(s) for s in found])
    begin = np.cumsum(size + 1) - (size + 1)
    order = suffix_array(text.astype(np.int64), 256)
    shared = common_prefixes(text, order)
    owner = np.repeat(np.arange(len(found)), size + 1)
    inside = np.arange(len(owner)) - begin[owner]
    whole = np.append(inside + window <= size[owner], False)
    interval = np.cumsum(shared[order] < window)
    kept = whole[order]
    place, interval = order[kept], interval[kept]
    several = np.bincount(interval)[interval] > 1
    place, interval = place[several], interval[several]
    o = owner[place]
    by = np.lexsort((start[o] + inside[place], tag[o], doc[o], interval))
    again = np.concatenate([[False], interval[by][1:] == interval[by][:-1]]) if len(by) else np.empty(0, bool)
    flag = np.zeros(len(text) + 1, np.int8)
    flag[place[by[again]]] = 1
    edge = np.diff(flag, prepend=np.int8(0))
    first, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    return owner[first], inside[first], stop - first


def _bytes(value: pa.Scalar) -> bytes:
    return (value.as_py() or "").encode("utf-8")


def _cut(docs: DataFrame, window: int, gram: int, rows: Callable, schema: str) -> DataFrame:
    """``rows(columns of ids, minimizer, start, size)`` of the segments of every text, the last column."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got, size = [], 0
            ids = [c.to_numpy() for c in b.columns[:-1]]
            for k, text in enumerate(b.column(b.num_columns - 1)):
                raw = _bytes(text)
                got.append((k, *segments(raw, window, gram)))
                size += len(raw)
                if size > BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays(rows(ids, got), names)
                    got, size = [], 0
            if got:
                yield pa.RecordBatch.from_arrays(rows(ids, got), names)

    return docs.mapInArrow(run, schema)


def _minimizers(ids: list, got: list) -> list:
    return [pa.array(x) for x in np.unique(np.concatenate([g[1] for g in got]), return_counts=True)]


def _places(ids: list, got: list) -> list:
    row = np.concatenate([np.full(len(g[1]), g[0]) for g in got])
    mz, start, size = (np.concatenate([g[c] for g in got]) for c in (1, 2, 3))
    return [pa.array(mz), *(pa.array(c[row]) for c in ids), pa.array(start.astype(np.int32)), pa.array(size.astype(np.int32))]


SEGMENT = "mz long, seg binary, doc long, tag long, start int"


def _segment_batch(rows: list) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int32())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["mz", "seg", "doc", "tag", "start"])


def candidates(slim: DataFrame, window: int, gram: int) -> DataFrame:
    """(mz, seg, doc, tag, start): the segments whose minimizer occurs more than once."""
    often = materialize(_cut(slim.select("text"), window, gram, _minimizers, "mz long, n long").groupBy("mz")
                        .agg(F.sum("n").alias("n")).where("n > 1").select("mz"))
    places = _cut(slim.select("doc", "tag", "text"), window, gram, _places,
                  "mz long, doc long, tag long, start int, size int").join(often.hint("shuffle_hash"), "mz")
    # sets: rows that repeat id and text have the same places, so a list is bounded by one document
    lists = places.groupBy("doc", "tag").agg(F.collect_set(F.struct("start", "size", "mz")).alias("l")).select(
        "doc", "tag", F.flatten(F.transform("l", lambda r: F.array(r["start"].cast("long"), r["size"].cast("long"), r["mz"]))).alias("l"))
    lists = materialize(lists)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held, size = [], 0
            for d, g, text, l in zip(*(b.column(c) for c in range(4))):
                places, raw = l.values.to_numpy().reshape(-1, 3), np.frombuffer(_bytes(text), np.uint8)
                for part in np.array_split(places, 1 + len(places) * 2 * window // BATCH_BYTES):
                    start, many = part[:, 0], part[:, 1] + window - 1
                    ends = np.cumsum(many)
                    at = np.arange(ends[-1]) + np.repeat(start - ends + many, many)
                    held.append((part[:, 2], raw[at], many, np.full(len(part), d.as_py()), np.full(len(part), g.as_py()), start))
                    size += len(at)
                    if size > BATCH_BYTES:
                        yield batch(held)
                        held, size = [], 0
            if held:
                yield batch(held)

    def batch(held: list) -> pa.RecordBatch:
        mz, data, many, d, g, start = (np.concatenate(c) for c in zip(*held))
        offsets = np.concatenate([[0], np.cumsum(many)]).astype(np.int32)
        seg = pa.Array.from_buffers(pa.binary(), len(mz), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])
        return pa.RecordBatch.from_arrays([pa.array(mz), seg, pa.array(d), pa.array(g), pa.array(start.astype(np.int32))],
                                          ["mz", "seg", "doc", "tag", "start"])

    # one short row a key on the right: hashed, so that the texts need no sort
    return materialize(slim.join(lists.hint("shuffle_hash"), ["doc", "tag"]).select("doc", "tag", "text", "l").mapInArrow(cut, SEGMENT))


def _cut_again(found: DataFrame, window: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, size = [], 0
            for seg, d, g, s in zip(*(b.column(c).to_pylist() for c in range(1, 5))):
                for mz, start, n in zip(*(x.tolist() for x in segments(seg, window, gram))):
                    rows.append((mz, seg[start:start + n + window - 1], d, g, s + start))
                    size += n + window + 100
                    if size > BATCH_BYTES:
                        yield _segment_batch(rows)
                        rows, size = [], 0
            if rows:
                yield _segment_batch(rows)

    return materialize(found.select("mz", "seg", "doc", "tag", "start").mapInArrow(run, SEGMENT))


def repeats(slim: DataFrame, window: int, grams: tuple[int, ...], wide_group: int) -> DataFrame:
    """(doc, tag, first, stop): the byte ranges to remove, overlapping."""
    own = F.struct("doc", "tag", "start")
    found, members, shards = candidates(slim, window, grams[0]), [], []
    for gram in [*grams[1:], None]:
        classes = materialize(found.groupBy("mz", "seg").agg(F.min(own).alias("first"), F.count(F.lit(1)).alias("n")))
        wide = materialize(classes.groupBy("mz").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > wide_group).select("mz"))
        if gram is None or wide.isEmpty():
            members.append(found)
            shards.append(classes)
            break
        members.append(found.join(wide, "mz", "left_anti").select(*found.columns))
        shards.append(classes.join(wide, "mz", "left_anti").select(*classes.columns))
        found = _cut_again(found.join(wide, "mz", "left_semi"), window, gram)
    all_members, all_classes = members[0], shards[0]
    for m, c in zip(members[1:], shards[1:]):
        all_members, all_classes = all_members.union(m), all_classes.union(c)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(held: list, several: list) -> pa.RecordBatch:
            d, g, first, stop = (np.empty(0, np.int64),) * 4
            if held:
                _, seg, d, g, s, _ = zip(*held)
                d, g, s = (np.array(x, np.int64) for x in (d, g, s))
                which, at, many = shard_repeats(list(seg), d, g, s, window)
                d, g, first = d[which], g[which], s[which] + at
                stop = first + many + window - 1
            # classes of several segments: all windows of their members but the first are repeats
            mz, digest, place = [r[0] for r in several], [hashlib.md5(r[1]).digest() for r in several], [r[2:5] for r in several]
            none = [None] * len(d)
            more = np.array(place, np.int64).reshape(-1, 3)
            return pa.RecordBatch.from_arrays(
                [pa.array([*none, *mz], pa.int64()), pa.array([*none, *digest], pa.binary()),
                 *(pa.array(np.concatenate([x, more[:, c]]).astype(k)) for x, c, k in (
                     (d, 0, np.int64), (g, 1, np.int64), (first, 2, np.int32), (stop, 2, np.int32)))],
                ["mz", "digest", "doc", "tag", "first", "stop"])

        held, several, group, size = [], [], [], 0
        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
        for row in itertools.chain(rows, [None]):
            if group and (row is None or row[0] != group[0][0]):
                several += [r for r in group if r[5] > 1]
                if len(group) > 1:              # a minimizer of one class has no other text to be compared with
                    held += group
                    size += sum(len(r[1]) + 1 for r in group)
                group = []
                if size >= SHARD_BYTES or len(several) > 1 << 14:
                    yield out(held, several)
                    held, several, size = [], [], 0
            if row is not None:
                group.append(row)
        yield out(held, several)

    told = materialize(all_classes.select("mz", "seg", "first.*", "n").repartition("mz").sortWithinPartitions("mz").mapInArrow(
        search, "mz long, digest binary, doc long, tag long, first int, stop int"))
    several = told.where("mz IS NOT NULL").select("mz", "digest", F.struct("doc", "tag", F.col("first").alias("start")).alias("first"))
    later = (all_members.select("mz", F.unhex(F.md5("seg")).alias("digest"), F.length("seg").alias("size"), own.alias("own"))
             .join(several.hint("shuffle_hash"), ["mz", "digest"]).where(F.col("own") != F.col("first"))
             .select("own.doc", "own.tag", F.col("own.start").alias("first"), (F.col("own.start") + F.col("size")).alias("stop")))
    return told.where("mz IS NULL").select("doc", "tag", "first", "stop").union(later)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 100,
                   grams: tuple[int, ...] | None = None, wide_group: int = 2048, with_bytes: bool = False) -> DataFrame:
    """One row per input row: id_col, n_bytes, n_removed, n_spans (maximal
    removed runs), kept_sha256 (of the kept bytes), and kept ``with_bytes``.
    ``grams`` are the lengths of the strings whose hashes deal the windows,
    the last one the window's."""
    grams = grams or tuple(dict.fromkeys((max(1, window * 8 // 25), max(1, window * 16 // 25), window)))
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).select(
        "id", F.coalesce("id", F.lit(NULL_ID)).alias("doc"), F.xxhash64("text").alias("tag"), "text")
    lists = repeats(slim, window, grams, wide_group).groupBy("doc", "tag").agg(
        F.collect_set(F.struct("first", "stop")).alias("l")).select(
        "doc", "tag", F.flatten(F.transform("l", lambda r: F.array(r["first"], r["stop"]))).alias("l"))

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for i, text, l in zip(*(b.column(c) for c in range(3))):
                raw, n, spans = _bytes(text), 0, 0
                stay = raw
                if l.is_valid:
                    ends = l.values.to_numpy().reshape(-1, 2)
                    depth = np.zeros(len(raw) + 1, np.int64)
                    np.add.at(depth, ends[:, 0], 1)
                    np.add.at(depth, ends[:, 1], -1)
                    gone = np.cumsum(depth)[:len(raw)] > 0
                    n = int(gone.sum())
                    spans = int((np.diff(gone.astype(np.int8), prepend=np.int8(0)) == 1).sum())
                    stay = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                rows.append((i.as_py(), len(raw), n, spans, hashlib.sha256(stay).hexdigest(), stay if with_bytes else None))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (
                    pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()))],
                    ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    out = slim.join(lists.hint("shuffle_hash"), ["doc", "tag"], "left").select("id", "text", "l").mapInArrow(
        kept, "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary").withColumnRenamed("id", id_col)
    return out if with_bytes else out.drop("kept")
