"""Language ID of whole texts, with spans of mixed-language text.

The script of a word (by Unicode ranges) narrows the candidates to the
languages seen with it in training.  Each word gets a score per candidate, the
log-probability of its letter trigrams and bigrams (naive Bayes).  Viterbi over
the words of a text, with a penalty for switching, labels every word; equal
neighbours form spans.  The text's language is the one with most letters.  A
very long text is cut into pieces that are joined by the best scores at their
ends, which gives a best path of the whole text.

Training counts letter n-grams of about ``docs_per_language`` documents of each
language, chosen by a hash of their id (a parameter; the rate comes from the
language's full count); the counts are aggregated by Spark into a table of
2^15 cells a language, the only thing that comes to the driver.

Defined results: a text that is null or has no letter is "und" with score 0
and has no spans; so is every text if nothing was learned; words without
letters follow their neighbours; ties go to the first language by name; rows
that repeat an id, or have none, are each labelled; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import functools
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CELLS = 1 << 15
WORDS_AT_ONCE = 1 << 20
CACHED_WORDS = 1 << 18
PIECE_WORDS = 1 << 12
UNDECIDED = "und"

# Scripts by their main Unicode ranges; other letters are "other".
SCRIPTS = {
    "latin": [(0x41, 0x24F), (0x1E00, 0x1EFF)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F)],
    "devanagari": [(0x900, 0x97F)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF)],
    "kana": [(0x3040, 0x30FF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF)],
    "hangul": [(0x1100, 0x11FF), (0xAC00, 0xD7AF)],
}
_STARTS = sorted((a, b, i) for i, ranges in enumerate(SCRIPTS.values()) for a, b in ranges)
OTHER = len(SCRIPTS)


@functools.lru_cache(1 << 16)
def script(letter: str) -> int:
    c = ord(letter)
    for a, b, i in _STARTS:
        if a <= c <= b:
            return i
    return OTHER


def letters(word: str) -> str:
    return word.lower() if word.isalpha() else "".join(c for c in word.lower() if c.isalpha())


def gram_cells(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Cells of the bigrams and trigrams of every word's letters, its ends
    marked: (cells, number of the word of each)."""
    text = "".join([f"<{w}>" for w in words])
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    sizes = np.array([len(w) + 2 for w in words], np.int64)
    owner = np.repeat(np.arange(len(words)), sizes)
    left = np.cumsum(sizes)[owner] - np.arange(len(c))              # letters up to the word's end
    two = c[:-1] * np.uint64(0x9E3779B97F4A7C15) + c[1:] * np.uint64(0xC2B2AE3D27D4EB4F)
    three = two[:-1] * np.uint64(0xBF58476D1CE4E5B9) + c[2:] * np.uint64(0x165667B19E3779F9)
    cell = lambda h: ((h ^ (h >> np.uint64(31))) * np.uint64(0x94D049BB133111EB) >> np.uint64(49)).astype(np.int64)
    has2, has3 = np.flatnonzero(left >= 2), np.flatnonzero(left >= 3)
    return np.concatenate([cell(two[has2]), cell(three[has3])]), np.concatenate([owner[has2], owner[has3]])


@dataclass
class Model:
    names: list[str]
    logp: np.ndarray            # CELLS x languages
    allowed: np.ndarray         # scripts x languages: the language was seen with the script
    switch: float = 8.0
    floor: float = 12.0         # most that one word can speak against a language

    def word_scores(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(scores by word and language, number of letters of each word)."""
        found = [letters(w) for w in words]
        size = np.array([len(w) for w in found], np.int64)
        out = np.zeros((len(words), len(self.names)), np.float32)
        with_letters = np.flatnonzero(size)
        for a in range(0, len(with_letters), 1 << 15):
            part = with_letters[a:a + (1 << 15)]
            cells, owner = gram_cells([found[i] for i in part])
            s = np.stack([np.bincount(owner, self.logp[cells, k], len(part)) for k in range(len(self.names))], axis=1) / 2
            may = self.allowed[[script(found[i][0]) for i in part]]
            s = np.where(may | ~may.any(axis=1, keepdims=True), s, -np.inf)
            out[part] = np.maximum(s - s.max(axis=1, keepdims=True), -self.floor)
        return out, size


def viterbi(scores: np.ndarray, lengths: np.ndarray, switch: float, first: np.ndarray | None = None,
            end: np.ndarray | None = None) -> np.ndarray:
    """Best language number of each word, texts one after another; all texts
    of the group step together, longest first.  ``first`` and ``end`` fix the
    languages a text begins and ends with (-1: free)."""
    begin = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    order = np.argsort(-lengths, kind="stable")
    begin, size = begin[order], lengths[order]
    n_words, n_langs = scores.shape
    stay = np.zeros((n_words, n_langs), bool)
    jump = np.zeros(n_words, np.int32)
    label = np.zeros(n_words, np.int32)
    active = int((size > 0).sum())
    best = scores[begin[:active]].astype(np.float64)
    if first is not None:
        fixed = first[order][:active]
        best[(fixed >= 0)[:, None] & (np.arange(n_langs) != fixed[:, None])] = -np.inf
    final = np.zeros(len(size), np.int32)
    for t in range(1, int(size.max(initial=0)) + 1):
        still = int(np.searchsorted(-size, -t))                  # texts with more than t words
        if still < active:                                       # the others end here
            final[still:active] = best[still:active].argmax(axis=1)
            best, active = best[:still], still
        if not active:
            break
        at = begin[:active] + t
        top = best.argmax(axis=1)
        other = best[np.arange(active), top][:, None] - switch
        keep = best >= other
        stay[at], jump[at] = keep, top
        best = np.where(keep, best, other) + scores[at]
    now = final.copy()
    if end is not None:
        now = np.where(end[order] >= 0, end[order], now).astype(np.int32)
    for t in range(int(size.max(initial=0)) - 1, -1, -1):
        n = int(np.searchsorted(-size, -t))
        at = begin[:n] + t
        label[at] = now[:n]
        if t:
            now[:n] = np.where(stay[at, now[:n]], now[:n], jump[at])
    return label


def piece_ends(scores: np.ndarray, begin: np.ndarray, size: np.ndarray, switch: float) -> np.ndarray:
    """Best score of each piece by the languages it begins and ends with
    (pieces, first language, last language); sizes in descending order."""
    n_langs = scores.shape[1]
    ends = np.full((len(begin), n_langs, n_langs), -np.inf)
    ends[:, np.arange(n_langs), np.arange(n_langs)] = scores[begin]
    for t in range(1, int(size.max(initial=0))):
        n = int(np.searchsorted(-size, -t))                      # pieces with more than t words
        now = ends[:n]
        ends[:n] = np.maximum(now, now.max(axis=2, keepdims=True) - switch) + scores[begin[:n] + t][:, None, :]
    return ends


def label_words(scores: np.ndarray, lengths: np.ndarray, switch: float, piece: int = PIECE_WORDS) -> np.ndarray:
    """:func:`viterbi` of texts of any length.  A text of more than ``piece``
    words is cut into pieces that step together: the best scores of each by the
    languages at its ends (a max-plus product) give the best languages at all
    cuts, and between fixed ends the pieces are independent."""
    lengths = np.asarray(lengths, np.int64)
    if not (lengths > piece).any():
        return viterbi(scores, lengths, switch)
    number = np.maximum(-(-lengths // piece), 1)
    text = np.repeat(np.arange(len(lengths)), number)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(number) - number, number)
    size = np.minimum(lengths[text] - nth * piece, piece)
    begin = (np.cumsum(lengths) - lengths)[text] + nth * piece
    cut = np.flatnonzero(number[text] > 1)
    order = cut[np.argsort(-size[cut], kind="stable")]
    ends = np.empty((len(cut), scores.shape[1], scores.shape[1]))
    ends[np.searchsorted(cut, order)] = piece_ends(scores, begin[order], size[order], switch)
    first, last = np.full(len(text), -1, np.int32), np.full(len(text), -1, np.int32)
    at = 0
    for k in number[number > 1]:
        back, total = [], None
        for m in ends[at:at + k]:
            if total is None:
                come, total = np.arange(len(m)), np.zeros(len(m))
            else:                                                # a word's language: stay, or switch from the best one
                top, jump = int(total.argmax()), total.max() - switch
                come, total = np.where(total >= jump, np.arange(len(m)), top), np.maximum(total, jump)
            reach = total[:, None] + m
            back.append((come, reach.argmax(axis=0)))
            total = reach.max(axis=0)
        e = int(total.argmax())
        for i, (come, best) in zip(cut[at:at + k][::-1], back[::-1]):
            last[i], first[i] = e, best[e]
            e = int(come[first[i]])
        at += k
    return viterbi(scores, size, switch, first, last)


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          train_rows: Column | None = None, docs_per_language: int = 2000) -> Model:
    """A model from documents with a language for which ``train_rows`` holds."""
    known = docs.where(F.col(lang_col).isNotNull()) if train_rows is None else docs.where(
        F.col(lang_col).isNotNull() & train_rows)
    known = known.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"),
                         F.col(text_col).cast("string").alias("text"))
    totals = {r.lang: r.n for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}   # a row a language
    names = sorted(totals)
    if not names:
        return Model([], np.zeros((CELLS, 0)), np.zeros((OTHER + 1, 0), bool))
    place = {n: i for i, n in enumerate(names)}
    share = F.create_map(*[x for n in names for x in (F.lit(n), F.lit(min(1.0, docs_per_language / totals[n])))])
    draw = F.pmod(F.xxhash64(F.col("id"), F.lit("language")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = known.where(draw < share[F.col("lang")]).select("lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, seen = {}, {}
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if not text:
                    continue
                counts = grams.setdefault(lang, np.zeros(CELLS, np.int64))
                scripts = seen.setdefault(lang, np.zeros(OTHER + 1, np.int64))
                words = Counter(map(letters, text.split()))
                words.pop("", None)
                if words:
                    at, owner = gram_cells(list(words))
                    n = np.array(list(words.values()), np.int64)
                    counts += np.bincount(at, n[owner], CELLS).astype(np.int64)
                    for w, k in words.items():
                        scripts[script(w[0])] += k
        for lang in grams:
            for kind, table in ((0, grams[lang]), (1, seen[lang])):
                at = np.flatnonzero(table)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array([kind] * len(at), pa.int32()),
                                                  pa.array(at.astype(np.int32)), pa.array(table[at])], ["lang", "kind", "cell", "n"])

    grams, seen = np.zeros((CELLS, len(names))), np.zeros((OTHER + 1, len(names)))
    rows = sample.mapInArrow(run, "lang string, kind int, cell int, n long").groupBy("lang", "kind", "cell").agg(
        F.sum("n").alias("n")).toArrow()                                    # at most CELLS + scripts rows a language
    at = np.array([place[x] for x in rows.column("lang").to_pylist()], np.int64)
    kind, cell, n = (rows.column(c).to_numpy() for c in ("kind", "cell", "n"))
    for k, table in ((0, grams), (1, seen)):
        table[cell[kind == k], at[kind == k]] = n[kind == k]
    logp = np.log((grams + 0.5) / (grams.sum(axis=0) + 0.5 * CELLS))
    total = np.maximum(seen.sum(axis=0), 1)
    return Model(names, logp, seen / total >= 0.01)


def label(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id_col, lang_pred, score (share of the letters in
    spans of that language), spans array<struct<lang, first word, last word>>."""
    held = docs.sparkSession.sparkContext.broadcast(model)         # CELLS rows of a column a language
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    span = pa.struct([("lang", pa.string()), ("first", pa.int32()), ("last", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        names, n_langs = m.names, len(m.names)
        place, new, table, weight = {}, [], np.zeros((0, n_langs), np.float32), np.zeros(0, np.int64)

        def out(keys, refs):
            nonlocal table, weight
            if new:
                s, n = m.word_scores(new) if n_langs else (np.zeros((len(new), 0), np.float32), np.zeros(len(new), np.int64))
                table, weight = np.concatenate([table, s]), np.concatenate([weight, n])
                new.clear()
            lengths = np.array([len(r) for r in refs], np.int64)
            which = np.concatenate([*refs, np.empty(0, np.int32)])
            letters_ = weight[which]
            best = label_words(table[which], lengths, m.switch) if len(which) and n_langs else np.zeros(
                len(which), np.int32)
            langs, scores, spans = [], [], []
            for a, n in zip(np.cumsum(lengths) - lengths, lengths):
                mass = np.bincount(best[a:a + n], letters_[a:a + n], max(n_langs, 1)) if n else np.zeros(1)
                if not n_langs or not mass.sum():
                    langs.append(UNDECIDED), scores.append(0.0), spans.append([])
                    continue
                k = int(mass.argmax())
                langs.append(names[k]), scores.append(float(mass[k] / mass.sum()))
                cut = np.concatenate([[0], np.flatnonzero(np.diff(best[a:a + n])) + 1, [n]])
                spans.append([{"lang": names[best[a + x]], "first": int(x), "last": int(y) - 1} for x, y in zip(cut[:-1], cut[1:])])
            return pa.RecordBatch.from_arrays(
                [pa.array([k.as_py() for k in keys], keys[0].type), pa.array(langs, pa.string()), pa.array(scores, pa.float64()),
                 pa.array(spans, pa.list_(span))], ["id", "lang_pred", "score", "spans"])

        keys, refs, size = [], [], 0
        for b in batches:
            for key, text in zip(b.column(0), b.column(1)):
                words = (text.as_py() or "").split()
                for w in words:
                    if w not in place:
                        place[w] = len(place)
                        new.append(w)
                keys.append(key)
                refs.append(np.fromiter(map(place.__getitem__, words), np.int32, len(words)))
                size += len(words)
                if size >= WORDS_AT_ONCE:
                    yield out(keys, refs)
                    keys, refs, size = [], [], 0
                    if len(place) > CACHED_WORDS:
                        place, table, weight = {}, table[:0], weight[:0]
        if keys:
            yield out(keys, refs)

    return slim.mapInArrow(run, f"id {slim.schema['id'].dataType.simpleString()}, lang_pred string, score double, "
                                "spans array<struct<lang:string,first:int,last:int>>").withColumnRenamed("id", id_col)
