"""Spelling variant grouping: a frontier of states walked down a trie by joins.

Words are counted over the whole corpus.  Their trie is a table of edges: a
node is kept where words branch or end, and an edge from it is known by its
first character and carries the length and hash of the rest of its label, so
the depth of the table follows the branching, not the length, of the words.
A node has at most one edge per character of the alphabet.

The frontier holds (word, position, node, edits).  Its states without an edit
are the kept nodes of the words' own paths, as the trie's making gives them.
The first round joins them with the edge table and makes the edit: the next
character is deleted, or replaced by a greater one that the node has an edge
for.  Every further round joins the states with the edge that their word
spells, level by level.  A state is dropped where the label differs, or where no
word below can end like it (an edge has a bit for the length and for the hash
of every ending below it).  A word whose characters are used up at a node
where a word ends has a neighbour there.

Two words that differ by one edit part at a kept node, so edits are tried at
kept nodes only; a deletion read backwards is the insertion, and a replacement
by a greater character the one by a smaller, so each pair is walked from one
side and then turned around.  Nodes near the root have many edges and would
start most of the states, all in vain: the walk is done on the trie of the
words for edits in the second half of a word and on the trie of the words
written backwards for the others.  Neighbours are checked by edit distance at
the end (labels and nodes are 64-bit hashes).  Words that share a node or edge
are one key of a join, which adaptive execution splits.

Forms: the near word of largest count, ties by code points, if its count is at
least ``factor`` times the word's.  Counts grow by that factor along forms, so
roots are found by pointer jumping in few rounds.

Defined results: null texts have no words; the null id is the empty text in
the hash of a run; rows that repeat an id count as documents of their own;
runs and words of any length are whole; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import spread_lookup

# Fixed value: the characters of a run.
RUN = "[A-Za-zÀ-ÿ]"
LOWER = {c: c + 32 for c in range(65, 91)}
HELD_WORDS = 200_000


def misspelt(text: str, doc: bytes, least: int, every: int) -> Iterator[tuple[str, int]]:
    """The words of a text with counts, one run in about ``every`` without one of its characters."""
    begin = crc32(doc + b":")
    for run, n in Counter(re.findall(f"{RUN}{{{least},}}", text)).items():
        word = run.lower() if run.isascii() else run.translate(LOWER)
        h = crc32(word.encode("utf-8"), begin)
        if h % every == 0:
            k = h % len(word)
            word = word[:k] + word[k + 1:]
            if len(word) < least:
                continue
        yield word, n


def words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 7, every: int = 31,
          least_count: int = 2) -> DataFrame:
    """(word, n): the words of at least ``least`` characters that occur ``least_count`` times or more."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])

        for b in batches:
            for i, text in zip(b.column(0).to_pylist(), b.column(1)):
                if text.is_valid:
                    for w, n in misspelt(text.as_py(), (i or "").encode("utf-8"), least, every):
                        held[w] += n
                    if len(held) > HELD_WORDS:
                        yield out()
                        held = Counter()
        if held:
            yield out()

    slim = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"))
    return (slim.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= least_count))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _prefixes(least_depth: int, whole: bool = False):
    """Every prefix of every word from ``least_depth`` characters on: (id of the
    word, depth, node, next character or 0).  A node is the hash of the prefix,
    the id that of the word.  ``whole``: the words and their ids only."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held, size = [], 0
            for w in b.column(0).to_pylist():
                held.append(w)
                size += len(w)
                if size > 1 << 18:
                    yield _prefix_rows(held, least_depth, whole)
                    held, size = [], 0
            if held:
                yield _prefix_rows(held, least_depth, whole)
    return run


def _prefix_rows(held: list[str], least_depth: int, whole: bool) -> pa.RecordBatch:
    sizes = np.array([len(w) for w in held], np.int64)
    chars = np.frombuffer("".join(held).encode("utf-32-le"), np.uint32)
    first = np.cumsum(sizes) - sizes
    inside = np.arange(len(chars)) - np.repeat(first, sizes)
    with np.errstate(over="ignore"):
        power = np.multiply.accumulate(np.full(int(sizes.max()) + 1, 0x9E3779B97F4A7C15, np.uint64))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mixed(chars.astype(np.uint64) + np.uint64(0x51ED27)) * power[inside])])
        node = lambda word, depth: _mixed(
            sums[first[word] + depth] - sums[first[word]] + depth.astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D)).view(np.int64)
        ids = node(np.arange(len(held)), sizes)
        if whole:
            return pa.RecordBatch.from_arrays([pa.array(held, pa.string()), pa.array(ids)], ["word", "id"])
        many = sizes + 1 - least_depth
        word = np.repeat(np.arange(len(held)), many)
        depth = np.arange(len(word)) - np.repeat(np.cumsum(many) - many, many) + least_depth
        nodes = node(word, depth)
    follow = np.where(depth < sizes[word], np.append(chars, 0)[first[word] + depth], 0)
    return pa.RecordBatch.from_arrays([pa.array(ids[word]), pa.array(depth.astype(np.int32)), pa.array(nodes),
                                       pa.array(follow.astype(np.int32))], ["id", "depth", "node", "follow"])


def _bit(n):
    return F.call_function("shiftleft", F.lit(1).cast("long"), n)


def _ending(text):
    """A bit for the rest of a word: of its length, and of its hash."""
    return _bit(F.least(F.length(text), F.lit(63))), _bit(F.pmod(F.xxhash64(text), F.lit(64)).cast("int"))


def trie(counted: DataFrame, least_depth: int = 0) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``counted`` (word) -> (edges, ends, path), the trie from ``least_depth``
    on.  edges: (node, c, size, rest, child, lengths, hashes): an edge by its first
    character, the length of its label, the hash of the label after that
    character, and a bit for the length and for the hash of what follows the
    label in each word.  ends: (node, word) where a word ends.  path: (word,
    depth, node), the kept nodes of every word."""
    rows = materialize(counted.select("word").mapInArrow(_prefixes(least_depth), "id long, depth int, node long, follow int"))
    kept = materialize(rows.groupBy("node", "depth").agg(F.min("follow").alias("a"), F.max("follow").alias("b")).where(
        "a = 0 OR a <> b").select("node", "depth"))
    ids = materialize(counted.select("word").mapInArrow(_prefixes(0, whole=True), "word string, id long"))
    path = materialize(rows.select("id", "depth", "node").join(kept, ["node", "depth"]).groupBy("id").agg(
        F.sort_array(F.collect_list(F.struct("depth", "node"))).alias("path")).join(ids, "id").select("word", "path"))
    steps = path.select("word", F.explode(F.arrays_zip(F.expr("slice(path, 1, size(path) - 1)").alias("up"),
                                                       F.expr("slice(path, 2, size(path) - 1)").alias("down"))).alias("s"))
    size = F.col("s.down.depth") - F.col("s.up.depth")
    length, hashed = _ending(F.substring("word", F.col("s.down.depth") + 1, F.length("word")))
    edges = steps.groupBy(
        F.col("s.up.node").alias("node"), F.col("s.down.node").alias("child"), size.alias("size"),
        F.substring("word", F.col("s.up.depth") + 1, F.lit(1)).alias("c"),
        F.xxhash64(F.substring("word", F.col("s.up.depth") + 2, size - 1)).alias("rest")).agg(
            F.bit_or(length).alias("lengths"), F.bit_or(hashed).alias("hashes"))
    ends = ids.select(F.col("id").alias("node"), "word")
    return edges, ends, path.select("word", F.explode("path").alias("p")).select("word", "p.depth", "p.node")


def _walked(counted: DataFrame, least_depth: int, from_depth: str) -> DataFrame:
    """(word, near) of the pairs whose edit lies at the depth ``from_depth`` (an
    expression of the word) or behind it, a deletion or a replacement by a
    greater character."""
    edges, ends, path = trie(counted, least_depth)
    # a word's end as an edge without characters, so that a deletion at the end finds it
    length, hashed = _ending(F.lit(""))
    stop = ends.select("node", F.lit("").alias("c"), F.lit(0).alias("size"), F.xxhash64(F.lit("")).alias("rest"),
                       F.col("node").alias("child"), length.alias("lengths"), hashed.alias("hashes"))
    edges = materialize(edges.select(*stop.columns).union(stop))
    length = F.length("word")
    seeds = path.where((F.col("depth") >= F.expr(from_depth)) & (F.col("depth") < length)).select(
        "word", F.col("depth").alias("pos"), "node")

    def fits(pos, skipped: int):
        """The edge's label stands in the word (its first ``skipped`` characters apart), and the rest of the word may follow."""
        stop_at = pos + F.col("size")
        long, hashed = _ending(F.substring("word", stop_at + 1, length))
        return ((stop_at <= length) & (F.col("lengths").bitwiseAND(long) != 0) & (F.col("hashes").bitwiseAND(hashed) != 0)
                & (F.col("rest") == F.xxhash64(F.substring("word", pos + 1 + skipped, F.col("size") - skipped))))

    at = lambda pos: F.substring("word", pos + 1, F.lit(1))
    pos, after = F.col("pos"), F.col("pos") + 1
    move = lambda ok, p: F.when(ok, F.struct((p + F.col("size")).cast("int").alias("pos"), F.col("child").alias("node")))
    met = seeds.join(edges, "node").where((F.col("c") > at(pos)) | (F.col("c") == at(after)))
    first = met.select("word", F.explode(F.array(
        move((F.col("c") > at(pos)) & fits(pos, 1), pos), move((F.col("c") == at(after)) & fits(after, 1), after))).alias("m"))
    step = materialize(first.where("m IS NOT NULL").select("word", "m.*"))
    arrived, open_ = [step.where(pos == length)], step.where(pos < length)
    while not open_.isEmpty():
        states = open_.withColumn("c", at(pos))
        step = materialize(states.join(edges, ["node", "c"]).where(fits(pos, 1)).select(
            "word", (pos + F.col("size")).alias("pos"), F.col("child").alias("node")))
        arrived.append(step.where(pos == length))
        open_ = step.where(pos < length)
    found = arrived[0]
    for more in arrived[1:]:
        found = found.union(more)
    return found.distinct().join(ends.withColumnRenamed("word", "near"), "node").select("word", "near")


def near_words(counted: DataFrame) -> DataFrame:
    """(word, near): the pairs of words of ``counted`` that differ by one
    inserted, deleted or replaced character, in both directions."""
    shortest = counted.agg(F.min(F.length("word"))).first()[0] or 1
    least_depth = (shortest - 1) // 2                  # no edit is made at a smaller depth
    half = "(length(word) - 1) div 2"
    # written backwards an edit at place p is at length - 1 - p: the places before the half
    back = _walked(counted.select(F.reverse("word").alias("word")), least_depth, f"length(word) - {half}").select(
        F.reverse("word").alias("word"), F.reverse("near").alias("near"))
    pairs = materialize(_walked(counted.select("word"), least_depth, half).union(back).distinct().where(F.levenshtein("word", "near", 1) == 1))
    return pairs.union(pairs.select(F.col("near").alias("word"), F.col("word").alias("near"))).distinct()


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 7, every: int = 31,
             least_count: int = 2, factor: int = 10) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n."""
    counted = materialize(words(docs, id_col, text_col, least, every, least_count))
    if counted.isEmpty():
        return docs.sparkSession.createDataFrame([], "word string, form string, root string, n long, n_near long, form_n long")
    near = materialize(near_words(counted))
    told = spread_lookup(near, counted.withColumnRenamed("word", "near").withColumnRenamed("n", "near_n"), "near", "word")
    best = told.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                    F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    has = F.coalesce(-F.col("best.less") >= factor * F.col("n"), F.lit(False))
    formed = materialize(counted.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(has, F.col("best.near")).alias("form"), F.when(has, -F.col("best.less")).alias("form_n")))
    # forms followed to the last: each round doubles the way; words without a form end it
    hops = formed.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        ahead = hops.select(F.col("word").alias("root"), F.col("root").alias("next"))
        hops = materialize(spread_lookup(hops, ahead, "root", "word").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if hops.where("moved").isEmpty():
            break
        hops = hops.drop("moved")
    return formed.join(hops.select("word", "root"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
