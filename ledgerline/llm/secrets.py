"""Secret scans: fixed patterns, and character Markov models for the rest.

Two models of character pairs are trained on labelled samples of the corpus
itself, over all documents: "random" from the strings that the base patterns
mark as secrets, "ordinary" from everything else but the long runs with digits
that the models are to decide.  A further run of token
characters is a secret if its log-likelihood ratio between the two, in total
and per character, is over a threshold.  Only the two tables of pair counts
(a fixed number of cells) come to the driver.

Base spans are always reported; the models only add spans, of kind "markov",
that touch no base span.  Offsets count code points of the whole text, end
exclusive.

Defined results: null and empty texts have no spans; without any labelled
sample the random model is uniform; rows that repeat an id are each scanned;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The base patterns, the part that counts and its least length.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")          # 18 characters with AKIA: a shorter run has no longer one in it
HEX = re.compile(r"[0-9a-f]{16,}")                 # as above: runs are maximal
ASSIGN_LEAST = 12
KINDS = ("assign", "access", "hex", "markov")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

TOKEN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}(?![A-Za-z0-9+/_=-])")
TOKEN_LEAST = 16
SYMBOLS = 95                                       # 0: boundary; 1..94: "!" to "~"
SLICE = 1 << 22


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind number, end, secret part), in order."""
    out = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        out += [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(out)


def ordinary(text: str) -> str:
    """``text`` without the long runs of token characters that hold a digit."""
    if not any(len(w) >= TOKEN_LEAST for w in text.split()):
        return text
    return TOKEN.sub(lambda m: " " if any(c.isdigit() for c in m[0]) else m[0], text)


def pair_counts(raw: bytes) -> np.ndarray:
    """Counts of adjacent symbols, boundaries included, as a SYMBOLS x SYMBOLS table."""
    b = np.frombuffer(raw, np.uint8)
    s = np.where((b >= 0x21) & (b <= 0x7E), b - 0x20, 0).astype(np.int32)
    s = np.concatenate([[0], s, [0]])
    return np.bincount(s[:-1] * SYMBOLS + s[1:], minlength=SYMBOLS * SYMBOLS)


class Markov:
    """Log-likelihood ratios of character pairs, random against ordinary."""

    def __init__(self, random: np.ndarray, ordinary: np.ndarray, total: float = 16.0, per_char: float = 1.0):
        def log_rows(counts):
            c = counts.reshape(SYMBOLS, SYMBOLS)[:, 1:]                # what follows inside a token: no boundary
            alone = (c.sum(axis=0) + 0.5) / (c.sum() + 0.5 * (SYMBOLS - 1))
            return np.log((c + 5 * alone) / (c.sum(axis=1, keepdims=True) + 5))     # rare rows lean on single counts
        self.ratio = log_rows(random) - log_rows(ordinary)
        self.total, self.per_char = total, per_char

    def score(self, token: str) -> float:
        s = np.frombuffer(token.encode("ascii"), np.uint8).astype(np.int64) - 0x20
        return float(self.ratio[np.concatenate([[0], s[:-1]]), s - 1].sum())

    def is_secret(self, token: str) -> bool:
        g = self.score(token)
        return g >= self.total and g >= self.per_char * len(token)

    def spans(self, text: str | None) -> list[tuple[int, int, int]]:
        """All spans as (start, kind number, end)."""
        if not text:
            return []
        base = [(a, k, b) for a, k, b, _ in base_spans(text)]
        if not any(len(w) >= TOKEN_LEAST for w in text.split()):
            return base
        more, i = [], 0
        by_end = sorted((b, a) for a, _, b in base)
        starts = np.array([a for a, _, _ in base]), np.array([b for b, _ in by_end])
        for m in TOKEN.finditer(text):
            # spans that begin before the token's end, less those that end by its start, touch it
            if base and np.searchsorted(starts[0], m.end()) > np.searchsorted(starts[1], m.start(), "right"):
                continue
            if self.is_secret(m[0]):
                more.append((m.start(), 3, m.end()))
        return sorted(base + more)


def train(docs: DataFrame, text_col: str = "text", total: float = 16.0, per_char: float = 1.0) -> Markov:
    """Models from all documents."""
    slim = docs.select(F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = np.zeros((2, SYMBOLS * SYMBOLS), np.int64)
        for b in batches:
            for t in b.column(0):
                text = t.as_py()
                if not text:
                    continue
                at, rest = 0, []
                for a, _, z, part in base_spans(text):
                    tables[0] += pair_counts(part.encode("ascii"))
                    if a >= at:
                        rest.append(text[at:a])
                    at = max(at, z)
                rest.append(text[at:])
                raw = ordinary(" ".join(rest)).encode("utf-8")
                for k in range(0, len(raw), SLICE):
                    tables[1] += pair_counts(raw[k:k + SLICE])
        kind, cell = np.nonzero(tables)
        yield pa.RecordBatch.from_arrays([pa.array(kind.astype(np.int32)), pa.array(cell.astype(np.int32)),
                                          pa.array(tables[kind, cell])], ["kind", "cell", "n"])

    tables = np.zeros((2, SYMBOLS * SYMBOLS))
    for r in slim.mapInArrow(run, "kind int, cell int, n long").groupBy("kind", "cell").agg(F.sum("n").alias("n")).collect():
        tables[r.kind, r.cell] = r.n                          # at most 2 * 95 * 95 rows
    return Markov(tables[0], tables[1], total, per_char)


def scan(docs: DataFrame, model: Markov, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id_col, spans array<struct<kind, start, end>> in order."""
    held = docs.sparkSession.sparkContext.broadcast(model)            # a table of fixed size
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [[{"kind": KINDS[k], "start": a, "end": z} for a, k, z in held.value.spans(t.as_py())] for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.list_(span))], ["id", "spans"])

    return slim.mapInArrow(run, f"id {slim.schema['id'].dataType.simpleString()}, "
                                "spans array<struct<kind:string,start:int,end:int>>").withColumnRenamed("id", id_col)
