"""Embedding near-dedup with randomised-rotation binary codes.

Vectors are compared only inside a label.  Equal vectors of a label are one
class.  Each unit vector is rotated at random; its code is the signs of the
rotated coordinates, and a correction factor is stored with it: the inner
product of the vector with its code.  From code and factor follows an unbiased
estimate of the inner product with any other vector, and a confidence bound
that shrinks with the dimension.  A pair is recomputed exactly (cosine, double
precision) if its estimate plus bound reaches the threshold; only pairs that
pass the exact test are linked.

Candidate pairs agree in all bits of a key in some table; keys are slices of
the codes of further rotations.  Key length follows the number of classes and
the number of tables follows from it, so that a pair just at the threshold is
met with probability ``recall``.  A pair met in several tables counts in the
first.  A bucket with more than ``bucket_rows`` classes is cut into blocks and
compared block against block, every block pair in a group of its own.  Tasks
emit link counts and a spanning forest of the links, never all pairs.

Defined results: a vector that is null, zero, or holds null or non-finite
components, or whose label is null, links with nothing; vectors of different
lengths do not link; rows that repeat an id are vectors of their own; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import spread_lookup
from .components import connected_components

ROWS_AT_ONCE = 4096
SIDE = 1024


def rotations(dim: int, count: int, seed: int = 0) -> np.ndarray:
    """``count`` random rotations of ``dim`` dimensions (one matrix each)."""
    out = []
    for i in range(count):
        q, r = np.linalg.qr(np.random.default_rng((seed, dim, i)).normal(size=(dim, dim)))
        out.append(q * np.sign(np.diag(r)))
    return np.stack(out)


def key_plan(classes: int, threshold: float, recall: float) -> tuple[int, int]:
    """(bits of a key, number of tables): about 64 unrelated classes a bucket,
    and a pair at the threshold is missed with probability 1 - recall."""
    bits = max(4, math.ceil(math.log2(max(classes, 1) / 64 + 1)))
    meet = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(1 - recall) / math.log(1 - meet)))


def codes(unit: np.ndarray, rotation: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rotated vectors, signs, correction factors)."""
    rotated = unit @ rotation.T
    signs = np.where(rotated >= 0, 1.0, -1.0)
    return rotated, signs, (signs * rotated).sum(axis=1) / math.sqrt(unit.shape[1])


def maybe_near(rotated_a, signs_a, factor_a, rotated_b, threshold: float, sigmas: float) -> np.ndarray:
    """Pairs (a, b) that the estimate of their inner product does not rule out."""
    dim = signs_a.shape[1]
    estimate = (signs_a @ rotated_b.T) / (math.sqrt(dim) * factor_a[:, None])
    bound = sigmas * np.sqrt(np.maximum(1 - factor_a ** 2, 0)) / (factor_a * math.sqrt(max(dim - 1, 1)))
    return estimate + bound[:, None] >= threshold - 1e-9


def _bits(unit: np.ndarray, turns: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """Keys of every vector in every table."""
    signs = np.concatenate([unit @ r.T >= 0 for r in turns], axis=1)[:, :bits * tables]
    return (signs.reshape(len(unit), tables, bits) * (1 << np.arange(bits, dtype=np.int64))).sum(axis=2)


def block_links(ids, copies, x, keys, table, side, across, threshold, sigmas, rotation):
    """Links inside one bucket: (ids, link counts, (a, b) of a spanning forest).
    With ``across`` only pairs of different blocks (``side``) are compared."""
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    rotated, signs, factor = codes(unit, rotation)
    n = len(ids)
    links, root = np.zeros(n, np.int64), np.arange(n)
    for a in range(0, n, SIDE):
        for b in range(a, n, SIDE):
            i, j = np.nonzero(maybe_near(rotated[a:a + SIDE], signs[a:a + SIDE], factor[a:a + SIDE],
                                         rotated[b:b + SIDE], threshold, sigmas))
            i, j = i + a, j + b
            use = (i < j) & ((side[i] != side[j]) if across else True)
            i, j = i[use], j[use]
            for s in range(0, len(i), 1 << 17):                       # exact recomputation, bounded at a time
                p, q = i[s:s + (1 << 17)], j[s:s + (1 << 17)]
                cosine = (x[p] * x[q]).sum(axis=1) / np.sqrt((x[p] ** 2).sum(axis=1) * (x[q] ** 2).sum(axis=1))
                near = cosine >= threshold
                if table:                                             # met before in an earlier table?
                    near &= ~(keys[p, :table] == keys[q, :table]).any(axis=1)
                p, q = p[near], q[near]
                np.add.at(links, p, copies[q])
                np.add.at(links, q, copies[p])
                root = _join(root, p, q)
    child = np.flatnonzero(root != np.arange(n))
    hit = np.flatnonzero(links)
    return ids[hit], links[hit], ids[child], ids[root[child]]


def _join(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    while len(a):
        ra, rb = root[a], root[b]
        other = ra != rb
        if not other.any():
            break
        a, b = a[other], b[other]
        np.minimum.at(root, np.maximum(ra, rb)[other], np.minimum(ra, rb)[other])
        while (root[root] != root).any():
            root = root[root]
    return root


def near_links(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
               threshold: float = 0.98, recall: float = 0.999, sigmas: float = 4.0, bucket_rows: int = 2048,
               seed: int = 0) -> DataFrame:
    """One row per input row: id_col, n_links, component_id (smallest id
    reachable, the row's own included), kept (id equals component_id)."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("x"),
                          F.col(label_col).cast("string").alias("label"))
    finite = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    good = F.col("x").isNotNull() & F.col("label").isNotNull() & finite & F.exists("x", lambda c: c != 0)
    same = F.when(F.coalesce(good, F.lit(False)), F.sha2(F.concat_ws("|", "label", F.col("x").cast("string")), 256))
    rows = rows.withColumn("same", same)
    # classes of equal vectors; written once, which fixes their numbers
    classes = materialize(rows.where("same IS NOT NULL").groupBy("same").agg(
        F.min("id").alias("first_id"), F.count(F.lit(1)).alias("copies"), F.first("x").alias("x"), F.first("label").alias("label"))
        .withColumn("cid", F.monotonically_increasing_id()).withColumn("dim", F.size("x")))
    parts = []
    for r in classes.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).orderBy("dim").collect():   # a row a vector length
        parts.append(_found(classes.where(F.col("dim") == r.dim), r.dim, r.n, threshold, recall, sigmas, bucket_rows, seed))
    if parts:
        found = parts[0]
        for p in parts[1:]:
            found = found.union(p)
    else:
        found = spark.createDataFrame([], "cid long, links long, other long")
    found = materialize(found)
    links = found.where("other IS NULL").groupBy("cid").agg(F.sum("links").alias("links"))
    roots = connected_components(found.where("other IS NOT NULL").select(F.col("cid").alias("src"), F.col("other").alias("dst")))
    placed = (classes.select("cid", "same", "first_id", "copies").join(links, "cid", "left")
              .join(roots.withColumnRenamed("node", "cid"), "cid", "left")
              .select("same", "first_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                      F.coalesce("root", "cid").alias("root")))
    smallest = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = spread_lookup(placed, smallest, "root", "same").select("same", "n_links", "component_id")
    alone = F.col("same").isNull()
    told = spread_lookup(rows.select("id", F.coalesce("same", F.concat(F.lit("alone "), F.col("id").cast("string"), F.lit("")))
                                     .alias("same"), alone.alias("alone")), named, "same", "id")
    component = F.when(F.col("alone"), F.col("id")).otherwise(F.col("component_id"))
    return told.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                       component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


def _found(classes: DataFrame, dim: int, n: int, threshold, recall, sigmas, bucket_rows, seed) -> DataFrame:
    """(cid, links, other): link counts (other null) and forest links (links null) of one vector length."""
    bits, tables = key_plan(n, threshold, recall)
    turns = rotations(dim, 1 + math.ceil(bits * tables / dim), seed)
    held = classes.sparkSession.sparkContext.broadcast(turns)          # dim x dim numbers a rotation

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            if len(x):
                keys = _bits(x, held.value[1:], bits, tables)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * tables), pa.array(keys.ravel()))
                yield pa.RecordBatch.from_arrays([*b.columns, lists], ["cid", "copies", "x", "label", "keys"])

    coded = materialize(classes.select("cid", "copies", "x", "label").mapInArrow(
        keyed, "cid long, copies long, x array<double>, label string, keys array<long>"))
    dealt = coded.select("*", F.posexplode("keys").alias("t", "key"))
    sizes = dealt.groupBy("label", "t", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # large buckets: blocks by class number, every pair of blocks a group of its own
    cut = dealt.join(sizes, ["label", "t", "key"]).withColumn("blocks", F.ceil(F.col("n") / bucket_rows)).withColumn(
        "own", F.pmod(F.xxhash64("cid"), F.col("blocks"))).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    names = ["label", "t", "key", "lo", "hi"]
    groups = cut.select("label", "t", "key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"),
                        "own", "cid", "copies", "x", "keys").repartition(*names).sortWithinPartitions(*names, "own", "cid")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_rows = None

        def out(rows):
            cid, links, a, b = [], [], [], []
            bounds = np.concatenate([[0], np.flatnonzero(_changes(rows)) + 1, [rows.num_rows]])
            x = rows.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            keys = rows.column("keys").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, tables)
            ids, copies, t, own, lo, hi = (rows.column(c).to_numpy() for c in ("cid", "copies", "t", "own", "lo", "hi"))
            for s, e in zip(bounds[:-1], bounds[1:]):
                if e - s > 1:
                    c, n_, p, q = block_links(ids[s:e], copies[s:e], x[s:e], keys[s:e], int(t[s]), own[s:e],
                                              lo[s] != hi[s], threshold, sigmas, held.value[0])
                    cid.append(c), links.append(n_), a.append(p), b.append(q)
            cat = lambda c: np.concatenate([*c, np.empty(0, np.int64)])
            cid, links, a, b = map(cat, (cid, links, a, b))
            none = lambda k: pa.nulls(k, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(cid), pa.array(links), none(len(cid))], ["cid", "links", "other"])
            yield pa.RecordBatch.from_arrays([pa.array(a), none(len(a)), pa.array(b)], ["cid", "links", "other"])

        for batch in batches:
            rows = pa.Table.from_batches([batch])
            held_rows = rows if held_rows is None else pa.concat_tables([held_rows, rows])
            if held_rows.num_rows >= ROWS_AT_ONCE:                    # up to the start of the last, perhaps unfinished, group
                ends = np.flatnonzero(_changes(held_rows))
                if len(ends):
                    yield from out(held_rows.slice(0, int(ends[-1]) + 1))
                    held_rows = held_rows.slice(int(ends[-1]) + 1)
        if held_rows is not None and held_rows.num_rows:
            yield from out(held_rows)

    return groups.mapInArrow(run, "cid long, links long, other long")


def _changes(rows: pa.Table) -> np.ndarray:
    """True where the next row belongs to another group."""
    change = np.zeros(max(rows.num_rows - 1, 0), bool)
    for c in ("label", "t", "key", "lo", "hi"):
        v = rows.column(c).to_numpy()
        change |= v[1:] != v[:-1]
    return change


def drop_near_vectors(vectors: DataFrame, **how) -> DataFrame:
    """The rows that ``near_links`` keeps, as (id, n_links, component_id)."""
    return near_links(vectors, **how).where("kept").drop("kept")
