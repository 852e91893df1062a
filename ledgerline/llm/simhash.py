"""SimHash near-dedup with covering locality-sensitive hashing.

Fingerprints: 64-bit SimHash of the 3-word shingles (repeats included) of the
whole text, A-Z lower-cased, words split at ASCII white space.

Candidates: every bit position gets a non-zero vector of GF(2)^(r+1); table v
(for each non-zero v) compares the positions whose vector is not orthogonal to
v.  Two fingerprints with at most r differing bits always agree in some table:
r vectors never span GF(2)^(r+1), so some v is orthogonal to all of them.
Nothing is lost and no table is probabilistic.

Equal fingerprints are collapsed first.  A bucket with more than
``wide_bucket`` different fingerprints is dealt again by a second covering
family inside the bucket; a bucket still wider than that (:func:`widest` bounds
it) is cut into blocks, and every two blocks are a group.  A group thus holds
about twice ``wide_bucket`` fingerprints at most.  A task emits a spanning forest of its links,
never all pairs.  Components come from :mod:`components`.

Defined results: null and white-space texts have fingerprint zero and link
like any other; fewer words than the shingle length make one shingle; rows
that repeat an id are each returned, with the component of their own text; a
null id is never a component id unless the whole component has null ids; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import fresh, same_columns, spread_lookup
from .components import connected_components

SEED = 42
HASHES_AT_ONCE = 1 << 20


def fingerprint(text: str | None, shingle_words: int = 3) -> int:
    """The fingerprint as a signed 64-bit integer."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()   # bytes: ASCII white space, A-Z only
    if not words:
        return 0
    k = min(shingle_words, len(words))
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = (ends[:len(words) - k + 1] - [len(w) + 1 for w in words[:len(words) - k + 1]]).tolist()
    stops = (ends[k - 1:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, len(starts), HASHES_AT_ONCE):
        part = slice(at, at + HASHES_AT_ONCE)
        h = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[part], stops[part])], np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits((2 * ones > len(starts)).astype(np.uint8), bitorder="little")
    return int(bits.view(np.int64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3) -> DataFrame:
    """One row per input row: (id_col, fp long)."""
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return _prints(slim, shingle_words).withColumnRenamed("id", id_col)


def _prints(slim: DataFrame, shingle_words: int) -> DataFrame:
    """``slim`` with fp in the place of its last column, the text."""
    names = [*slim.columns[:-1], "fp"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *others, texts = batch.columns
            fps = [fingerprint(t.as_py(), shingle_words) for t in texts]
            yield pa.RecordBatch.from_arrays([*others, pa.array(fps, pa.int64())], names)

    types = [f"{c} {slim.schema[c].dataType.simpleString()}" for c in names[:-1]]
    return slim.mapInArrow(run, ", ".join([*types, "fp long"]))


def covering_masks(radius: int, stride: int = 1, bits: int = 64) -> list[int]:
    """The masks of one covering family, as signed 64-bit integers.  Another odd
    ``stride`` assigns the vectors to the positions in another order."""
    n = (1 << (radius + 1)) - 1
    vectors = [1 + i * stride % bits % n for i in range(bits)]
    masks = [sum(1 << i for i, u in enumerate(vectors) if bin(u & v).count("1") % 2) for v in range(1, n + 1)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def widest(radius: int) -> int:
    """Most positions that a pair of tables of both families leaves free: a
    bucket dealt twice holds at most 2 ** widest different fingerprints."""
    a, b = covering_masks(radius, 1), covering_masks(radius, 23)
    return max(64 - bin((x | y) & (1 << 64) - 1).count("1") for x in a for y in b)


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of n rows by the links (a[i], b[i])."""
    root = np.arange(n)
    while len(a):
        ra, rb = root[a], root[b]
        open_ = ra != rb
        if not open_.any():
            break
        a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:                                    # flatten
            up = root[root]
            if (up == root).all():
                break
            root = up
    return root


def bucket_links(bucket: np.ndarray, fp: np.ndarray, radius: int, pairs_at_once: int = 1 << 21) -> tuple:
    """Rows sorted by bucket -> (a, b): a spanning forest of the fingerprints
    of a bucket that differ in at most ``radius`` bits."""
    n = len(fp)
    every = np.arange(n)
    root, found, size = every, [], 0
    i = every[:-1]
    for d in range(1, n):
        i = i[i + d < n]
        i = i[bucket[i] == bucket[i + d]]
        if not len(i):
            break
        near = i[np.bitwise_count((fp[i] ^ fp[i + d]).view(np.uint64)) <= radius]
        found.append((near, near + d))
        size += len(near)
        if size > pairs_at_once:                        # fold what was found into one link a row
            root = _forest(n, *map(np.concatenate, zip((every, root), *found)))
            found, size = [], 0
    root = _forest(n, *map(np.concatenate, zip((every, root), *found)))
    child = np.flatnonzero(root != every)
    return fp[child], fp[root[child]]


def _links(buckets: DataFrame, keys: list[str], radius: int, rows_at_once: int = 1 << 16) -> DataFrame:
    """``buckets`` (keys..., fp) -> links (src, dst) between fingerprints."""
    dealt = buckets.repartition(*keys).sortWithinPartitions(*keys, "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.empty((0, len(keys) + 1), np.int64)

        def out(rows):
            change = (rows[1:, :-1] != rows[:-1, :-1]).any(axis=1)
            bucket = np.concatenate([[0], np.cumsum(change)])
            a, b = bucket_links(bucket, np.ascontiguousarray(rows[:, -1]), radius)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["src", "dst"])

        for batch in batches:
            rows = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns], axis=1)
            held = np.concatenate([held, rows]) if len(held) else rows
            if len(held) >= rows_at_once:               # up to the start of the last, perhaps unfinished, bucket
                other = np.flatnonzero((held[:, :-1] != held[-1, :-1]).any(axis=1))
                if len(other):
                    yield out(held[:other[-1] + 1])
                    held = held[other[-1] + 1:]
        if len(held):
            yield out(held)

    return dealt.mapInArrow(run, "src long, dst long")


def covering_links(prints: DataFrame, radius: int = 3, wide_bucket: int = 2048) -> DataFrame:
    """Distinct fingerprints (fp) -> links (src, dst) that connect exactly the
    fingerprints connected by differences of at most ``radius`` bits."""
    def dealt(df, masks, name):
        tables = F.explode(F.array(*[F.struct(F.lit(t).cast("long").alias("t"), F.lit(m).cast("long").alias("m"))
                                     for t, m in enumerate(masks)]))
        return (df.withColumn("_m", tables).withColumn(f"table{name}", F.col("_m.t"))
                .withColumn(f"key{name}", F.col("fp").bitwiseAND(F.col("_m.m"))).drop("_m"))

    cover = dealt(prints.select("fp"), covering_masks(radius, 1), 1)
    wide = materialize(cover.groupBy("table1", "key1").agg(F.count(F.lit(1)).alias("n"))
                       .where(F.col("n") > wide_bucket).drop("n"))
    narrow = cover.join(wide, ["table1", "key1"], "left_anti")
    again = dealt(cover.join(wide, ["table1", "key1"], "left_semi"), covering_masks(radius, 23), 2)
    # what is still wide goes block against block, every pair of blocks a group of its own
    keys = ["table1", "key1", "table2", "key2"]
    sizes = again.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > wide_bucket)
    cut = again.join(sizes, keys, "left").withColumn("blocks", F.coalesce(F.ceil(F.col("n") / wide_bucket), F.lit(1))).withColumn(
        "own", F.pmod(F.xxhash64("fp"), F.col("blocks"))).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    blocks = cut.select(*keys, F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "fp")
    return (_links(narrow.select("table1", "key1", "fp"), ["table1", "key1"], radius)
            .union(_links(blocks, [*keys, "lo", "hi"], radius)))


def _placed(classes: DataFrame, radius: int, wide_bucket: int = 2048) -> DataFrame:
    """``classes`` (one row per fp) with the root of their component."""
    roots = connected_components(covering_links(classes, radius, wide_bucket))
    return classes.join(roots, classes["fp"] == roots["node"], "left").select(
        *[classes[c] for c in classes.columns], F.coalesce("root", "fp").alias("root"))


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3,
                radius: int = 3, wide_bucket: int = 2048) -> DataFrame:
    """One row per input row: id_col, fingerprint (16 hex digits), component_id
    (smallest id reachable by links, the row's own included)."""
    prints = materialize(fingerprints(docs, id_col, text_col, shingle_words).withColumnRenamed(id_col, "id"))
    classes = materialize(prints.groupBy("fp").agg(F.min("id").alias("first_id")))
    placed = _placed(classes, radius, wide_bucket)
    smallest = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = spread_lookup(placed.select("fp", "root"), smallest, "root", "fp").select("fp", "component_id")
    return spread_lookup(prints, named, "fp", "id").select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3,
                     radius: int = 3) -> DataFrame:
    """``docs`` with one row of each component (the smallest id; if several of
    its rows share it, or all its ids are null, the one whose text has the
    smallest digest), all columns as they were."""
    w_id, w_text, digest = (fresh(docs, c) for c in ("winner", "winner_text", "text_digest"))
    sha = F.unhex(F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")), 256))
    slim = docs.select(F.col(id_col).alias("id"), sha.alias("digest"), F.col(text_col).cast("string").alias("text"))
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "digest"))
    classes = materialize(_prints(slim, shingle_words).groupBy("fp").agg(first.alias("first")))
    # equal texts are of one component: id and digest name a component's row, whatever rows share the id
    winners = _placed(classes, radius).groupBy("root").agg(F.min("first").alias("first")).select(
        F.col("first.id").alias(w_id), F.col("first.digest").alias(w_text))
    tagged = docs.select(*same_columns(docs), sha.alias(digest))
    kept = tagged.join(winners, F.col(id_col).eqNullSafe(F.col(w_id)) & (F.col(digest) == F.col(w_text)), "left_semi")
    # repeated rows (same id and text): one of them, reduced in the map tasks already
    return kept.dropDuplicates([id_col, digest]).drop(digest)
