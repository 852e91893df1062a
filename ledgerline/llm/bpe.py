"""BPE encoding and decoding with a pair occurrence index.

The distinct words (pre-tokens) of a partition lie one after another in arrays
of symbols with links to their neighbours.  An index maps the rank of each
adjacent pair to all its positions in the partition.  The active ranks are
taken in ascending order from a heap: all live occurrences of the lowest rank
are merged together, and the lists of the pairs that arise beside them are
extended.  Where a merge can bring up a pair of a lower rank, only the
leftmost occurrence of each word is merged before the heap is asked again, so
every word sees exactly the merges, and the order, that it would see alone.

The tokenizer file (vocabulary and merges) is read on the driver and broadcast;
its size is fixed.  Ids agree with the tokenizers library for files whose
normalizer is NFC, white space to a space, lower case, and whose
pre-tokenizer splits by a pattern that drops white space and maps bytes to
characters; its normalizer and pre-tokenizer are used for chunks that are not
plain ASCII.  Special tokens written out in a text become their ids.

Defined results: null and empty texts have no ids and decode to the empty
text; null ids stay null, rows that repeat an id are each encoded; very long
texts are whole (a row's ids are one array); an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .chunks import encode_batches, gather, ragged

PLAIN = re.compile(r"[\x21-\x7e]+")
# The file's split pattern, on lower-cased plain ASCII.
PLAIN_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+")


class PairMerger:
    """The merge table of a tokenizer file."""

    def __init__(self, text: str):
        model = json.loads(text)
        self.added = {t["content"]: t["id"] for t in model["added_tokens"]}
        self.vocab = model["model"]["vocab"]
        self.suffix = model["model"]["end_of_word_suffix"] or ""
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["model"]["merges"]]
        self.left = np.array([self.vocab[a] for a, _ in pairs], np.int64)
        self.right = np.array([self.vocab[b] for _, b in pairs], np.int64)
        self.to = np.array([self.vocab[a + b] for a, b in pairs], np.int64)
        keys = self.left << 32 | self.right
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]
        # lowest rank of any pair that a symbol is part of: tells whether a merge can bring up a lower rank
        lowest = np.full(max(self.vocab.values()) + 1, len(pairs), np.int64)
        rank = np.arange(len(pairs))
        np.minimum.at(lowest, self.left, rank)
        np.minimum.at(lowest, self.right, rank)
        self.safe = lowest[self.to] > rank

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 if it has none."""
        key = a.astype(np.int64) << 32 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.order[at], -1)

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each word, as (starts, flat)."""
        vocab, suffix = self.vocab, self.suffix
        starts, flat = ragged([[*(vocab[c] for c in w[:-1]), vocab[w[-1] + suffix]] for w in words])
        sym = flat.copy()
        n = len(sym)
        word = np.repeat(np.arange(len(words), dtype=np.int32), starts[1:] - starts[:-1])
        after, before = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
        after[starts[1:] - 1] = -1
        before[starts[:-1]] = -1
        occurrences: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def index(pos: np.ndarray) -> None:
            r = self.ranks(sym[pos], sym[after[pos]])
            pos, r = pos[r >= 0], r[r >= 0]
            if not len(r):
                return
            by = np.argsort(r, kind="stable")
            pos, r = pos[by], r[by]
            cut = np.flatnonzero(np.diff(r)) + 1
            for part, rank in zip(np.split(pos, cut), r[np.concatenate([[0], cut])].tolist()):
                if rank in occurrences:
                    occurrences[rank].append(part)
                else:
                    occurrences[rank] = [part]
                    heapq.heappush(heap, rank)

        index(np.flatnonzero(after >= 0).astype(np.int32))
        while heap:
            r = heapq.heappop(heap)
            lists = occurrences.pop(r)
            pos = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
            a, b = self.left[r], self.right[r]
            pos = pos[(sym[pos] == a) & (after[pos] >= 0)]
            pos = pos[sym[after[pos]] == b]
            if not len(pos):
                continue
            if not self.safe[r]:                      # one occurrence a word, the rest comes up again
                first = np.concatenate([[True], word[pos[1:]] != word[pos[:-1]]])
                if not first.all():
                    occurrences[r] = [pos[~first]]
                    heapq.heappush(heap, r)
                    pos = pos[first]
            elif a == b and len(pos) > 1:             # runs of one symbol: every other position, from the left
                new = np.concatenate([[True], after[pos[:-1]] != pos[1:]])
                k = np.arange(len(pos))
                pos = pos[(k - np.maximum.accumulate(np.where(new, k, 0))) % 2 == 0]
            gone = after[pos]
            nxt = after[gone]
            sym[pos], sym[gone] = self.to[r], -1
            after[pos] = nxt
            has = nxt >= 0
            before[nxt[has]] = pos[has]
            prev = before[pos]
            index(np.unique(np.concatenate([prev[prev >= 0], pos[has]])))
        live = sym >= 0
        ends = np.concatenate([[0], np.cumsum(np.bincount(word[live], minlength=len(words)))])
        return ends, sym[live]


class BpeCodec:
    """Encoder of chunks for one tokenizer file's text."""

    def __init__(self, text: str):
        self.merger = PairMerger(text)
        lib = Tokenizer.from_str(text)
        self.normalise, self.split = lib.normalizer.normalize_str, lib.pre_tokenizer.pre_tokenize_str
        self.specials = re.compile("(" + "|".join(map(re.escape, sorted(self.merger.added, key=len, reverse=True))) + ")")

    def words(self, chunk: str) -> list[str]:
        if PLAIN.fullmatch(chunk):
            return PLAIN_WORDS.findall(chunk.lower())
        return [w for w, _ in self.split(self.normalise(chunk))]

    def encode_chunks(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each chunk, as (starts, flat)."""
        added, place, rows = self.merger.added, {}, []
        n_added = len(added)
        special = {t: i for i, t in enumerate(added)}        # the first word numbers stand for the special tokens
        for c in chunks:
            row = []
            for part in self.specials.split(c) if added and "<|" in c or added and self.specials.search(c) else (c,):
                if part in special:
                    row.append(special[part])
                elif part:
                    row += [n_added + place.setdefault(w, len(place)) for w in self.words(part)]
            rows.append(row)
        starts, flat = self.merger.merge(list(place))
        starts = np.concatenate([np.arange(n_added), starts + n_added])
        flat = np.concatenate([np.array(list(added.values()), np.int32), flat])
        row_starts, refs = ragged(rows)
        ids, lengths = gather(starts, flat, refs)
        ends = np.concatenate([[0], np.cumsum(lengths)])
        return ends[row_starts], ids


class BpeDecoder:
    """Texts of ids: the library's decode for files without a decoder, tokens joined by a space."""

    def __init__(self, text: str):
        model = json.loads(text)
        names = {i: t for t, i in model["model"]["vocab"].items()} | {t["id"]: t["content"] for t in model["added_tokens"]}
        self.names = [names.get(i) for i in range(max(names) + 1)]

    def decode(self, ids) -> str:
        names = self.names
        return " ".join([names[i] for i in ids if i < len(names) and names[i] is not None])


def _codec(docs: DataFrame, tokenizer_path: str):
    with open(tokenizer_path, encoding="utf-8") as f:
        return docs.sparkSession.sparkContext.broadcast(f.read())       # a vocabulary file: fixed size


def encode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id_col, ids array<int>."""
    held = _codec(docs, tokenizer_path)
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    key = slim.schema["id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = BpeCodec(held.value)
        for keys, ids, lengths in encode_batches(batches, codec.encode_chunks):
            yield from id_batches(keys, ids, lengths)

    return slim.mapInArrow(run, f"id {key.simpleString()}, ids array<int>").withColumnRenamed("id", id_col)


def round_trip(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
               with_ids: bool = False) -> DataFrame:
    """One row per input row: id_col, n_tokens, ids_sha256 (of the decimal ids
    joined by one space), decoded_sha256 (of the text decoded from them), and
    ids ``with_ids``.  Encoding, decoding and digests share one Python worker
    and one vocabulary a task; a group of rows is bounded by its ids."""
    held = _codec(docs, tokenizer_path)
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    key = slim.schema["id"].dataType
    sha = lambda text: hashlib.sha256(text.encode("utf-8")).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, decoder = BpeCodec(held.value), BpeDecoder(held.value)
        decimal = [str(i) for i in range(len(decoder.names))]
        for keys, ids, lengths in encode_batches(batches, codec.encode_chunks, chars_at_once=1 << 21):
            for b in id_batches(keys, ids, lengths, 1 << 18):
                rows = b.column(1)
                ends, flat = rows.offsets.to_numpy(), rows.values.to_numpy()
                own = [flat[x:y].tolist() for x, y in zip(ends[:-1], ends[1:])]
                out = [b.column(0), pa.array(np.diff(ends).astype(np.int64)),
                       pa.array([sha(" ".join([decimal[i] for i in r])) for r in own], pa.string()),
                       pa.array([sha(decoder.decode(r)) for r in own], pa.string())]
                names = ["id", "n_tokens", "ids_sha256", "decoded_sha256"]
                yield pa.RecordBatch.from_arrays([*out, rows] if with_ids else out, [*names, "ids"] if with_ids else names)

    more = ", ids array<int>" if with_ids else ""
    return slim.mapInArrow(run, f"id {key.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string{more}").withColumnRenamed(
        "id", id_col)


def id_batches(keys: list, ids: np.ndarray, lengths: np.ndarray, ids_at_once: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Rows of (id, ids) in batches of bounded size."""
    ends = np.concatenate([[0], np.cumsum(lengths)])
    a = 0
    while a < len(keys):
        b = max(a + 1, int(np.searchsorted(ends, ends[a] + ids_at_once, "right")) - 1)
        offsets = (ends[a:b + 1] - ends[a]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids[ends[a]:ends[b]].astype(np.int32)))
        yield pa.RecordBatch.from_arrays([pa.array([k.as_py() for k in keys[a:b]], keys[a].type), lists], ["id", "ids"])
        a = b


def decode(encoded: DataFrame, tokenizer_path: str, ids_col: str = "ids", to_col: str = "decoded") -> DataFrame:
    """``encoded`` with one more column, the decoded text of its ids."""
    held = _codec(encoded, tokenizer_path)

    @F.pandas_udf("string")
    def text(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = BpeDecoder(held.value)
        for ids in parts:
            yield ids.map(lambda x: "" if x is None else codec.decode(x.tolist()))

    return encoded.withColumn(to_col, text(F.col(ids_col)))
