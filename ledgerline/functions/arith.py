"""Arithmetic with the reference's NULL / zero behaviour (F15-F17); NVL and COALESCE are
plain ``F.coalesce`` in the reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_ratio(num: Column | str, den: Column | str) -> Column:
    """num / den as DOUBLE; a zero or NULL denominator gives NULL.

    Inputs are cast to double first so the quotient does not depend on
    decimal scale rules (they differ between engines)."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))
