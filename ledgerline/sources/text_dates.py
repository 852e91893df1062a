"""Dates that arrive as text (F1, F2): YYYY.MM.DD or DD.MM.YYYY."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import try_dots
from ..session import materialize


def with_dates(df: DataFrame, text: str, out: str) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects): ``df`` with ``text`` parsed to the date ``out`` in
    either form, and the rows whose text is neither (NULL included), as they
    were.  The input is read once, into a written table that both are read from."""
    parsed = materialize(df.withColumn(out, try_dots(F.col(text))))
    return parsed.where(F.col(out).isNotNull()), parsed.where(F.col(out).isNull()).drop(out)
