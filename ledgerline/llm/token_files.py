"""Token-id files compressed by Re-Pair grammars, with random access.

Texts are encoded with the tokenizers library (by their distinct white-space
chunks), an end id is appended to each document, and the documents are
dealt by id ranges into shards (bounds: approximate quantiles of the ids, a
scan of that column alone).  A shard is cut into blocks of about
``block_ids`` ids at document ends; each block gets its own grammar: frequent
pairs of adjacent symbols are replaced, again and again, by nonterminals.  A
pair never spans two documents, so each document stays a run of symbols.

A file is a Parquet table written by Spark (committed as a whole, readable
from any store), one row a block:

    shard int, block int, n_ids long, ids array (of the documents, ascending),
    symbol_starts array<int>, payload binary

payload: "RPAIR2", then little-endian unsigned 32-bit numbers: the first
nonterminal, the number of rules, the number of symbols, the number of bit
planes; then the rules (two symbols each), their expansion lengths (32 bit)
and the symbols.  Symbols are stored as their low 16 bits (little endian)
followed by a plane (8 symbols a byte) for each further bit.  Rule k is nonterminal first + k and refers to smaller
symbols only.  The expansion lengths let :func:`decode_range` decode any range
of a block's ids without expanding the rest.

Defined results: null and empty texts are the end id alone; rows that repeat
an id (null ids too) are stored one after another, in an order that follows
from their places in the input, over as many shards as their number asks for;
null ids come first; a text longer than a block is a block of its own; an empty
table gives an empty table; other columns are ignored.  Ids of documents are
numbers.
"""

from __future__ import annotations

import json
import os
import string
import struct
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize, shuffle_partitions
from .chunks import Known, encode_batches, gather, ragged

MAGIC = b"RPAIR2"
HEAD = struct.Struct("<6s4I")
CHUNKS_KEPT = 1_200_000
UNITS_KEPT = 600_000                              # words and marks of a worker


def _frequent(seq: np.ndarray, pos: np.ndarray, least: int, turn: int) -> tuple[np.ndarray, ...]:
    """Of the positions ``pos`` those whose pair occurs ``least`` times at
    least: (positions, number of each one's pair, keys of the pairs, their
    counts, positions left undecided).  Pairs are counted in hash slots; of
    pairs that share a slot one is counted, the others are undecided: ``turn``
    changes the hash, so they come up in a later round."""
    bits = min(20, max(10, len(pos).bit_length() + 1))
    key = seq[pos].astype(np.int64)
    key <<= 32
    key |= seq[pos + 1]
    slot = key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15 + 2 * turn)
    slot >>= np.uint64(64 - bits)
    slot = slot.view(np.int64)
    often = np.flatnonzero((np.bincount(slot, minlength=1 << bits) >= least)[slot])
    pos, key, slot = pos[often], key[often], slot[often]
    stands = np.empty(1 << bits, np.int64)
    stands[slot] = key
    same = stands[slot] == key
    undecided = pos[~same]
    pos, slot = pos[same], slot[same]
    counts = np.bincount(slot, minlength=1 << bits)
    slots = np.flatnonzero(counts >= least)
    number = np.full(1 << bits, -1, np.int32)
    number[slots] = np.arange(len(slots))
    which = number[slot]
    good = which >= 0
    return pos[good], which[good], stands[slots], counts[slots], undecided


def repair(ids: np.ndarray, last: np.ndarray, first_rule: int, least: int = 8,
           share: int = 64) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Re-Pair of ``ids``; ``last`` marks the positions no pair may begin at.

    Each round takes the pairs at least 1/``share`` as frequent as the most
    frequent one, most frequent first where they overlap.  Ends when no pair
    occurs ``least`` times (a rule must pay for itself).  A pair counted below
    ``least`` is not counted again: only a replacement beside it makes a new pair.
    -> (symbols, marks of the last positions, rules (n, 2), expansion lengths)."""
    seq, last = ids.astype(np.int32), last.copy()
    rules, lengths = np.empty((0, 2), np.int32), np.empty(0, np.int64)
    open_, turn = np.flatnonzero(~last[:-1]), 0
    while len(open_):
        every, which, keys, counts, undecided = _frequent(seq, open_, least, turn)
        turn += 1
        if not len(every):
            open_ = undecided
            continue
        chosen = np.flatnonzero(counts >= max(least, counts.max() // share))
        chosen = chosen[np.argsort(-counts[chosen], kind="stable")]
        rank = np.full(len(keys), len(keys), np.int64)
        rank[chosen] = np.arange(len(chosen))
        r = rank[which]
        later = every[r == len(keys)]
        pos, r = every[r < len(keys)], r[r < len(keys)]
        # overlaps: in runs of one pair every other position, then the better of two neighbours
        touch = np.concatenate([[False], pos[1:] == pos[:-1] + 1])
        run = touch & np.concatenate([[False], r[1:] == r[:-1]])
        k = np.arange(len(pos))
        odd = (k - np.maximum.accumulate(np.where(run, 0, k))) % 2 == 1
        some, some_r = pos, r
        pos, r = pos[~odd], r[~odd]
        touch = np.concatenate([[False], pos[1:] == pos[:-1] + 1, [False]])
        worse_left = touch[:-1] & (r >= np.concatenate([[-1], r[:-1]]))
        worse_right = touch[1:] & (r > np.concatenate([r[1:], [-1]]))
        take = ~(worse_left | worse_right)
        pos, r = pos[take], r[take]
        used = np.bincount(r, minlength=len(chosen))
        kept = np.flatnonzero(used >= 2)
        number = np.full(len(chosen), -1, np.int64)
        number[kept] = np.arange(len(kept))
        some = some[number[some_r] >= 0]                 # occurrences that overlapped with others come up again
        pos, r = pos[number[r] >= 0], number[r[number[r] >= 0]]
        pair = keys[chosen[kept]]
        new = np.stack([pair >> 32, pair & 0xFFFFFFFF], axis=1).astype(np.int32)
        known = np.concatenate([np.ones(first_rule, np.int64), lengths])
        at = first_rule + len(rules)
        rules, lengths = np.concatenate([rules, new]), np.concatenate([lengths, known[new[:, 0]] + known[new[:, 1]]])
        seq[pos], last[pos] = at + r, last[pos + 1]
        look = np.zeros(len(seq), bool)
        for part in (later, undecided, some, pos, pos[pos > 0] - 1):
            look[part] = True
        look[last] = look[-1] = False
        stay = np.ones(len(seq), bool)
        stay[pos + 1] = False
        seq, last, open_ = seq[stay], last[stay], np.flatnonzero(look[stay])
    return seq, last, rules, lengths


def _put(numbers: np.ndarray, planes: int) -> bytes:
    low = (numbers & 0xFFFF).astype("<u2").tobytes()
    return low + b"".join(np.packbits(((numbers >> (16 + k)) & 1).astype(np.uint8)).tobytes() for k in range(planes))


def _take(payload: bytes, at: int, n: int, planes: int) -> tuple[np.ndarray, int]:
    out = np.frombuffer(payload, "<u2", n, at).astype(np.int64)
    at, size = at + 2 * n, -(-n // 8)
    for k in range(planes):
        out |= np.unpackbits(np.frombuffer(payload, np.uint8, size, at), count=n).astype(np.int64) << (16 + k)
        at += size
    return out, at


def pack(seq: np.ndarray, rules: np.ndarray, lengths: np.ndarray, first_rule: int) -> bytes:
    planes = max(0, (first_rule + len(rules) - 1).bit_length() - 16)
    return (HEAD.pack(MAGIC, first_rule, len(rules), len(seq), planes) + _put(rules.ravel(), planes)
            + lengths.astype("<u4").tobytes() + _put(seq, planes))


def unpack(payload: bytes) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """(first nonterminal, rules, expansion lengths, symbols)."""
    magic, first, n_rules, n, planes = HEAD.unpack_from(payload)
    if magic != MAGIC:
        raise ValueError("not a token-id block")
    rules, at = _take(payload, HEAD.size, 2 * n_rules, planes)
    lengths = np.frombuffer(payload, "<u4", n_rules, at).astype(np.int64)
    return first, rules.reshape(-1, 2), lengths, _take(payload, at + 4 * n_rules, n, planes)[0]


def expand(symbols: np.ndarray, first: int, rules: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The ids that symbols stand for: every distinct symbol is expanded once,
    level by level (together no more ids than the result's), and gathered."""
    there = np.zeros(first + len(rules), bool)
    there[symbols] = True
    level = used = np.flatnonzero(there)
    while True:
        big = level >= first
        if not big.any():
            break
        at = np.cumsum(1 + big) - 1 - big
        out = np.empty(len(level) + int(big.sum()), np.int64)
        out[at[~big]] = level[~big]
        pair = rules[level[big] - first]
        out[at[big]], out[at[big] + 1] = pair[:, 0], pair[:, 1]
        level = out
    starts = np.concatenate([[0], np.cumsum(_sizes(used, first, lengths))])
    return gather(starts, level, (np.cumsum(there) - 1)[symbols])[0]


def _sizes(symbols: np.ndarray, first: int, lengths: np.ndarray) -> np.ndarray:
    """Number of ids of each symbol."""
    return np.where(symbols < first, 1, np.concatenate([lengths, [0]])[np.maximum(symbols - first, -1)])


def decode_range(payload: bytes, start: int, stop: int) -> np.ndarray:
    """Ids ``start`` to ``stop`` of a block: only the symbols that meet the range are expanded."""
    first, rules, lengths, symbols = unpack(payload)
    ends = np.cumsum(_sizes(symbols, first, lengths))
    a = int(np.searchsorted(ends, start, "right"))
    b = int(np.searchsorted(ends, stop, "left")) + 1
    head = int(ends[a - 1]) if a else 0
    return expand(symbols[a:b], first, rules, lengths)[start - head:stop - head]


class WordIds:
    """Ids of chunks from the library.  Its cost is mostly one of calls and of
    normalising, so words made of letters alone are given to it many in one
    text, each once whatever its case and the marks after it, and the ids are cut
    at the symbols that end a word.  That the tokenizer treats such words so is
    probed, not assumed; all other chunks go to it one by one.  Ids of words are
    kept from call to call, ``UNITS_KEPT`` or those of one call."""

    MARKS = string.punctuation.replace("'", "")

    def __init__(self, model_text: str, words_at_once: int = 1 << 12):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers
        self.lib, self.words_at_once = Tokenizer.from_str(model_text), words_at_once
        self.lib.no_truncation()
        self.lib.no_padding()
        told = json.loads(model_text)
        suffix = told["model"].get("end_of_word_suffix")
        bodies = [t["content"].rstrip(self.MARKS) for t in told.get("added_tokens") or ()]
        own_way = any(not body or body.isalpha() for body in bodies)
        self._forget()
        ends = [i for t, i in self.lib.get_vocab(with_added_tokens=False).items() if suffix and t.endswith(suffix)]
        self.ends = np.zeros(1 + max(self.lib.get_vocab().values(), default=0), bool)
        self.ends[ends] = True
        self.joins = bool(ends) and not own_way and self._splits_marks() and self._lowers()
        # lower-case ASCII letters: nothing to normalise, and white space alone parts them
        self.plain = Tokenizer.from_str(model_text)
        self.plain.no_truncation()
        self.plain.no_padding()
        if self.joins:
            self.plain.normalizer = normalizers.Sequence([])
            self.plain.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
            self.joins = self._rows(self.plain, PROBES) == self._rows(self.lib, PROBES)

    def _pieces(self, text: str) -> list[str]:
        if self.lib.normalizer is None or self.lib.pre_tokenizer is None:
            return []
        return [w for w, _ in self.lib.pre_tokenizer.pre_tokenize_str(self.lib.normalizer.normalize_str(text))]

    def _forget(self) -> None:
        self.units = Known(), Known(), Known()              # single, plain, other

    def _splits_marks(self) -> bool:
        runs = [*self.MARKS, *(a + b for a in self.MARKS for b in self.MARKS), "...", ";:,", self.MARKS]
        return all(self._pieces(f"{w}{m}") == [w, m] for w in PROBES[:3] for m in runs)

    def _lowers(self) -> bool:
        return all(self._pieces(w.upper()) == [w] for w in PROBES)

    @staticmethod
    def _rows(lib, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in lib.encode_batch_fast(texts, add_special_tokens=False)]

    def _singly(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        rows = []
        for a in range(0, len(texts), 1 << 15):
            rows += self._rows(self.lib, texts[a:a + (1 << 15)])
        return ragged(rows)

    def _joined(self, lib, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        starts, flat = [np.zeros(1, np.int64)], [np.empty(0, np.int32)]
        for a in range(0, len(words), self.words_at_once):
            part = words[a:a + self.words_at_once]
            ids = np.array(self._rows(lib, [" ".join(part)])[0], np.int32)
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) != len(part) or cuts[-1] != len(ids):         # some word is more than one to the tokenizer
                one, ids = self._singly(part)
                cuts = one[1:]
            starts.append(cuts + starts[-1][-1])
            flat.append(ids)
        return np.concatenate(starts), np.concatenate(flat)

    def __call__(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if not self.joins:
            return self._singly(chunks)
        if sum(len(known.place) for known in self.units) > UNITS_KEPT:
            self._forget()
        single, plain, other = (known.place for known in self.units)
        none = single[""]
        word, marks = [], []                                    # of each chunk: 4 * number + kind; number among the single
        for c in chunks:
            body = c.rstrip(self.MARKS)
            if not body.isalpha():
                word.append(4 * single[c])
                marks.append(none)
                continue
            if body.isascii():
                word.append(4 * plain[body.lower()] + 1)
            else:
                word.append(4 * other[body] + 2)
            marks.append(none if body is c else single[c[len(body):]])
        word = np.array(word, np.int64)
        for known, encode in zip(self.units, (self._singly, partial(self._joined, self.plain), partial(self._joined, self.lib))):
            known.learn(encode)
        tables = [(known.starts, known.flat) for known in self.units]
        heads = np.cumsum([0, *(len(t[0]) - 1 for t in tables)])[:-1]
        offsets = np.cumsum([0, *(t[0][-1] for t in tables)])
        units = np.stack([(word >> 2) + heads[word & 3], np.array(marks, np.int64)], axis=1)
        starts = np.concatenate([*(t[0][:-1] + o for t, o in zip(tables, offsets)), offsets[-1:]])
        ids, lengths = gather(starts, np.concatenate([t[1] for t in tables]), units.ravel())
        return np.concatenate([[0], np.cumsum(lengths.reshape(-1, 2).sum(axis=1))]), ids.astype(np.int32)


#: Per Python worker: the tokenizer of the last task with the words it knows.
_WORDS: dict[str, WordIds] = {}


def _words(model_text: str) -> WordIds:
    if model_text not in _WORDS:
        _WORDS.clear()
        _WORDS[model_text] = WordIds(model_text)
    return _WORDS[model_text]


# Fixed value: words by which a tokenizer is probed.
PROBES = ["a", "the", "word", "zebra", "qxjzkv", "abcdefghijklmnopqrstuvwxyz", "s", "t", "re", "ll", "antidisestablishment"]


NO_ID = -1.7976931348623157e308                                   # null ids come before all others


def shard_bounds(docs: DataFrame, id_col: str, shards: int) -> np.ndarray:
    """Ids at which a new shard begins (at most ``shards`` - 1); an id with many
    rows is there several times."""
    place = F.coalesce(F.col(id_col).cast("double"), F.lit(NO_ID)).alias("id")
    cuts = docs.select(place).approxQuantile("id", [i / shards for i in range(1, shards)], 0.25 / shards) if shards > 1 else []
    return np.sort(np.array(cuts, np.float64))


def shard_of(bounds: np.ndarray, ids: np.ndarray, turn: np.ndarray) -> np.ndarray:
    """Shards of ids: an id that is a bound k times is spread over k + 1 shards
    in the order of ``turn`` (31 bits, by row), so no id is more than a shard."""
    low, high = np.searchsorted(bounds, ids, "left"), np.searchsorted(bounds, ids, "right")
    return low + ((turn.astype(np.int64) * (high - low + 1)) >> 31)


def token_ids(docs: DataFrame, tokenizer_path: str, vocabulary: int, id_col: str = "doc_id", text_col: str = "text",
              end_id: int = 2, shards: int | None = None) -> DataFrame:
    """(shard, id, turn, tokens binary: little-endian ids, the end id last), 2
    bytes an id where the ``vocabulary`` allows.  ``turn`` orders rows of one id."""
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        held = spark.sparkContext.broadcast(f.read())                 # a vocabulary file: fixed size
    slim = docs.select(F.struct(F.col(id_col).alias("id"), F.shiftrightunsigned(
        F.xxhash64(F.monotonically_increasing_id()), 33).cast("int").alias("turn")).alias("key"),
        F.col(text_col).cast("string").alias("text"))
    bounds = shard_bounds(docs, id_col, shards or 4 * shuffle_partitions(spark))
    kind = _kind(vocabulary)
    id_type = slim.schema["key"].dataType["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        words = _words(held.value)
        crc = zlib.crc32(held.value.encode("utf-8"))
        for keys, ids, lengths in encode_batches(batches, words, 1 << 24, CHUNKS_KEPT, f"lib {crc}"):
            ends = np.cumsum(lengths + 1)
            flat = np.full(int(ends[-1]), end_id, kind)
            inside = np.ones(len(flat), bool)
            inside[ends - 1] = False
            flat[inside] = ids
            raw, begin, width = flat.tobytes(), np.concatenate([[0], ends[:-1]]), flat.itemsize
            for a in range(0, len(keys), 256):
                part = slice(a, a + 256)
                names, turn = [k["id"].as_py() for k in keys[part]], np.array([k["turn"].as_py() for k in keys[part]], np.int32)
                shard = shard_of(bounds, np.array([NO_ID if k is None else float(k) for k in names]), turn)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard.astype(np.int32)), pa.array(names, keys[0].type[0].type), pa.array(turn),
                     pa.array([raw[width * x:width * y] for x, y in zip(begin[part], ends[part])], pa.binary())],
                    ["shard", "id", "turn", "tokens"])

    return slim.mapInArrow(run, f"shard int, id {id_type}, turn int, tokens binary")


def _kind(vocabulary: int) -> str:
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def write_blocks(tokens: DataFrame, vocabulary: int, block_ids: int = 1 << 20) -> DataFrame:
    """Writes the blocks of (shard, id, turn, tokens); returns the file table, read back."""
    key, kind = tokens.schema["id"].dataType.simpleString(), np.dtype(_kind(vocabulary))
    dealt = tokens.repartition("shard").sortWithinPartitions("shard", "id", "turn").select("shard", "id", "tokens")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, parts, size, block, shard, id_type = [], [], 0, 0, None, None

        def out():
            lengths = np.array([len(p) // kind.itemsize for p in parts], np.int64)
            ids = np.frombuffer(b"".join(parts), kind)
            last = np.zeros(len(ids), bool)
            last[np.cumsum(lengths) - 1] = True
            seq, marks, rules, spans = repair(ids, last, vocabulary)
            starts = np.concatenate([[0], np.flatnonzero(marks) + 1])
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([block], pa.int32()), pa.array([len(ids)], pa.int64()),
                 pa.array([keys], pa.list_(id_type)), pa.array([starts.tolist()], pa.list_(pa.int32())),
                 pa.array([pack(seq, rules, spans, vocabulary)], pa.binary())],
                ["shard", "block", "n_ids", "ids", "symbol_starts", "payload"])

        for b in batches:
            id_type = b.column(1).type
            for s, k, t in zip(*(c.to_pylist() for c in b.columns)):
                if keys and (s != shard or size >= block_ids):
                    yield out()
                    keys, parts, size, block = [], [], 0, block + 1 if s == shard else 0
                elif s != shard:
                    block = 0
                shard = s
                keys.append(k)
                parts.append(t)
                size += len(t) // kind.itemsize
        if keys:
            yield out()

    return materialize(dealt.mapInArrow(
        run, f"shard int, block int, n_ids long, ids array<{key}>, symbol_starts array<int>, payload binary"))


def read_documents(blocks: DataFrame, with_tokens: bool = True) -> DataFrame:
    """The file table -> one row per document: id, start (ids of all documents
    before it), n_tokens, ids_crc32 and, ``with_tokens``, tokens array<int>."""
    key = blocks.schema["ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for shard, block, ids, starts, payload in zip(*(c.to_pylist() for c in b.columns)):
                first, rules, lengths, symbols = unpack(payload)
                size = _sizes(symbols, first, lengths)
                flat = expand(symbols, first, rules, lengths).astype("<u4")
                ends = np.concatenate([[0], np.cumsum(size)])[np.array(starts)]
                for a in range(0, len(ids), 1024):              # rows of ids in batches of bounded size
                    part = ends[a:a + 1025]
                    n = len(part) - 1
                    crc = [zlib.crc32(flat[x:y].tobytes()) for x, y in zip(part[:-1], part[1:])]
                    columns = [pa.array([shard] * n, pa.int32()), pa.array([block] * n, pa.int32()),
                               pa.array(ids[a:a + n], b.column(2).type.value_type), pa.array(part[:-1].astype(np.int64)),
                               pa.array(crc, pa.int64()), pa.array(np.diff(part).astype(np.int64))]
                    if with_tokens:
                        columns.append(pa.ListArray.from_arrays(pa.array((part - part[0]).astype(np.int32)),
                                                                pa.array(flat[part[0]:part[-1]].astype(np.int32))))
                    yield pa.RecordBatch.from_arrays(columns, names)

    kinds = {"shard": "int", "block": "int", "id": key, "inside": "long", "ids_crc32": "long", "n_tokens": "long"}
    if with_tokens:
        kinds["tokens"] = "array<int>"
    names = list(kinds)
    rows = blocks.select("shard", "block", "ids", "symbol_starts", "payload").mapInArrow(
        run, ", ".join(f"{n} {k}" for n, k in kinds.items()))
    # where a block starts: sums per shard (one row a shard), then inside the shard
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    sizes = blocks.select("shard", "block", "n_ids")
    shard = sizes.groupBy("shard").agg(F.sum("n_ids").alias("n")).select(
        "shard", F.coalesce(F.sum("n").over(before(Window.orderBy("shard"))), F.lit(0)).alias("shard_start"))
    inner = sizes.select("shard", "block", F.coalesce(F.sum("n_ids").over(
        before(Window.partitionBy("shard").orderBy("block"))), F.lit(0)).alias("block_start"))
    heads = inner.join(shard, "shard")
    return rows.join(heads, ["shard", "block"]).select(
        "id", (F.col("shard_start") + F.col("block_start") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32",
        *(["tokens"] if with_tokens else []))
