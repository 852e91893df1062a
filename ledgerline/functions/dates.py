"""Date helpers with the reference's semantics.

All built-in column expressions: they stay inside whole-stage codegen and
literal dates fold to constants that reach the Parquet scan as pushed filters.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(value) -> _dt.date:
    """Accept a ``date`` or an ISO ``yyyy-mm-dd`` string."""
    if isinstance(value, _dt.datetime):
        return value.date()
    if isinstance(value, _dt.date):
        return value
    return _dt.date.fromisoformat(str(value))


def ts_lit(value) -> Column:
    """Midnight of a date as a TIMESTAMP_NTZ literal.  Built from text, so it
    does not depend on the session or Python time zone (a Python datetime
    literal is a zoned TIMESTAMP and would shift against NTZ columns under a
    non-UTC session zone); it folds to a constant and reaches the scan as a
    pushed filter."""
    d = as_date(value)
    return F.lit(f"{d.isoformat()} 00:00:00").cast("timestamp_ntz")


def parse_ymd_dots(s: Column | str) -> Column:
    """Oracle ``to_date(s, 'YYYY.MM.DD')``."""
    return F.to_date(s, "yyyy.MM.dd")


def parse_dmy_dots(s: Column | str) -> Column:
    """Oracle ``to_date(s, 'DD.MM.YYYY')``."""
    return F.to_date(s, "dd.MM.yyyy")


def try_dots(s: Column | str) -> Column:
    """A date of either dotted form, NULL where the text is neither."""
    at = lambda form: F.try_to_timestamp(s, F.lit(form))
    return F.coalesce(at("yyyy.MM.dd"), at("dd.MM.yyyy")).cast("date")


def trunc_day(c: Column | str) -> Column:
    """Oracle ``trunc(d, 'DD')``: the date part (Spark's ``trunc`` has no day unit)."""
    return F.to_date(c)


def trunc_month(c: Column | str) -> Column:
    return F.trunc(F.col(c) if isinstance(c, str) else c, "MM")


def trunc_quarter(c: Column | str) -> Column:
    # 'Q' is not a Spark unit (it silently gives NULL); QUARTER is.
    return F.trunc(F.col(c) if isinstance(c, str) else c, "QUARTER")


def trunc_year(c: Column | str) -> Column:
    return F.trunc(F.col(c) if isinstance(c, str) else c, "YYYY")


def month_index(c: Column | str) -> Column:
    """12*year + month: a dense integer for month-grain RANGE frames, so
    ``rangeBetween(-3, -1)`` equals RANGE INTERVAL '3' MONTH .. '1' MONTH PRECEDING
    on month-truncated dates."""
    c = F.col(c) if isinstance(c, str) else c
    return F.year(c) * 12 + F.month(c)


def month_series(start, n_months: int) -> Column:
    """Array of ``n_months`` month starts from ``start`` (S14: ``connect by level``)."""
    d = as_date(start)
    return F.sequence(F.lit(d), F.add_months(F.lit(d), n_months - 1), F.expr("INTERVAL 1 MONTH"))
