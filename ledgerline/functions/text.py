"""String predicates and concatenation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def contains_any(c: Column | str, needles, lower: bool = True) -> Column:
    """True when the text contains any needle; NULL text gives false.

    One OR-chain of ``contains`` calls: no Python UDF, so the predicate is
    code-generated and, without ``lower``, reaches Parquet as StringContains.
    """
    text = _c(c).cast("string")
    if lower:
        text = F.lower(text)
    needles = [n.lower() if lower else n for n in needles]
    if not needles:
        return F.lit(False)
    hit = reduce(lambda a, b: a | b, [text.contains(n) for n in needles])
    return F.coalesce(hit, F.lit(False))


def oracle_concat(*parts: Column | str) -> Column:
    """Oracle ``a || b``: NULL behaves as the empty string (Spark's ``||``
    would return NULL).  All NULL gives NULL, as Oracle's '' is NULL."""
    cols = [_c(p).cast("string") for p in parts]
    joined = F.concat(*[F.coalesce(p, F.lit("")) for p in cols])
    return F.when(joined == "", F.lit(None).cast("string")).otherwise(joined)


def indent(level: Column | str, width: int = 4) -> Column:
    """``LPAD(' ', (level-1)*width)``; level 1 gives '' (Oracle NULL, which
    ``||`` then treats as empty)."""
    n = (_c(level) - 1) * width
    return F.lpad(F.lit(" "), n.cast("int"), " ")
