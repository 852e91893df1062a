"""Token ids of whole texts by way of their distinct white-space chunks.

For tokenizers whose pre-tokenizer drops white space, a text's ids are the ids
of its ASCII-white-space chunks one after another.  A group of texts is split
once (in Arrow), every distinct chunk is encoded once, and the ids are gathered.
Groups are bounded by their characters, so memory is too.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def gather(starts: np.ndarray, flat: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenated rows ``which`` of a ragged table, and their lengths."""
    lengths = (starts[1:] - starts[:-1])[which]
    ends = np.cumsum(lengths)
    n = int(ends[-1]) if len(ends) else 0
    at = np.arange(n) + np.repeat(starts[which] - ends + lengths, lengths)
    return flat[at], lengths


def ragged(rows: list) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ids as (starts, flat)."""
    starts = np.zeros(len(rows) + 1, np.int64)
    np.cumsum([len(r) for r in rows], out=starts[1:])
    flat = np.fromiter((x for r in rows for x in r), np.int32, int(starts[-1]))
    return starts, flat


class _Places(dict):
    """Numbers of chunks in the order they are first asked for."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, chunk: str) -> int:
        self.new.append(chunk)
        self[chunk] = at = len(self)
        return at


class Known:
    """Distinct chunks with their ids, as (starts, flat)."""

    def __init__(self):
        self.place = _Places()
        self.starts, self.flat = np.zeros(1, np.int64), np.empty(0, np.int32)

    def learn(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]) -> None:
        """Encodes the chunks asked for since the last time."""
        if self.place.new:
            starts, flat = encode(self.place.new)
            self.starts = np.concatenate([self.starts, starts[1:] + self.starts[-1]])
            self.flat = np.concatenate([self.flat, flat])
            self.place.new = []


#: Per Python worker, by name: chunks known from earlier tasks.
_KNOWN: dict[str, Known] = {}


def split_words(texts: list) -> tuple[pa.Array, np.ndarray]:
    """Words between ASCII white space, texts one after another, and the number of each text's."""
    lists = pc.ascii_split_whitespace(pa.array([t or "" for t in texts], pa.large_string()))
    words, owner = lists.flatten(), pc.list_parent_indices(lists).to_numpy()
    real = pc.greater(pc.binary_length(words), 0)              # white space at an end gives empty words
    if not pc.all(real).as_py():
        words, owner = words.filter(real), owner[real.to_numpy(zero_copy_only=False)]
    return words, np.bincount(owner, minlength=len(texts))


class ChunkedTexts:
    """Collects texts; a flush turns them into references to distinct chunks.
    The ids of chunks met before are kept, so each flush encodes new chunks
    only, also across the tasks of a worker (under ``name``); beyond
    ``chunks_kept`` the table starts anew."""

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], chunks_kept: int = 300_000,
                 name: str | None = None):
        self.encode, self.chunks_kept, self.name = encode, chunks_kept, name
        self.known = _KNOWN.setdefault(name, Known()) if name else Known()
        self.texts: list[str | None] = []
        self.size = 0

    def add(self, text: str | None) -> None:
        self.texts.append(text)
        self.size += len(text or "")

    def flush(self, refs_at_once: int = 1 << 18) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(ids one after another, number of ids of each text) for runs of the
        texts added since the last flush, in order."""
        known = self.known
        words, counts = split_words(self.texts)
        self.texts, self.size = [], 0
        told = words.dictionary_encode()
        distinct = told.dictionary.to_numpy(zero_copy_only=False).tolist()
        places = np.fromiter(map(known.place.__getitem__, distinct), np.int32, len(distinct))
        refs = places[told.indices.to_numpy()]
        del words, told, distinct
        known.learn(self.encode)
        cut = np.concatenate([[0], np.cumsum(counts)])
        a = 0
        while a < len(counts):
            b = max(a + 1, int(np.searchsorted(cut, cut[a] + refs_at_once, "right")) - 1)
            ids, lengths = gather(known.starts, known.flat, refs[cut[a]:cut[b]])
            ends = np.concatenate([[0], np.cumsum(lengths)])
            yield ids, np.diff(ends[cut[a:b + 1] - cut[a]])
            a = b
        if len(known.place) > self.chunks_kept:
            self.known = Known()
            if self.name:
                _KNOWN[self.name] = self.known


def encode_batches(batches: Iterator[pa.RecordBatch], encode, chars_at_once: int = 1 << 23, chunks_kept: int = 300_000,
                   name: str | None = None) -> Iterator[tuple]:
    """Batches of (key, text) -> (keys, ids, lengths) for bounded groups of rows."""
    held, keys = ChunkedTexts(encode, chunks_kept, name), []

    def out():
        at = 0
        for ids, lengths in held.flush():
            yield keys[at:at + len(lengths)], ids, lengths
            at += len(lengths)

    for batch in batches:
        for key, text in zip(batch.column(0), batch.column(1)):
            keys.append(key)
            held.add(text.as_py())
            if held.size >= chars_at_once:
                yield from out()
                keys = []
    if keys:
        yield from out()
