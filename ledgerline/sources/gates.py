"""Declared constraints as gates of a load.

A table is written to its place first, not yet part of a committed load.  The
writing job itself counts rows, NULLs in NOT NULL columns and texts beyond
their declared length (``observe`` metrics, no pass of their own).  One
aggregation tells repeated or missing keys, one anti-join a foreign key tells
orphans.  The counts are the rows of a report; a load commits only if all are 0.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .checks import foreign_key_violations, key_violations

REPORT = "table_name string, rule string, n_rows long, n_bad long"


class LoadRejected(ValueError):
    """A load broke its declared constraints; ``report`` has the rows of :data:`REPORT`."""

    def __init__(self, report: list[tuple]):
        super().__init__("load rejected: " + ", ".join(f"{t} {r} ({bad} of {n})" for t, r, n, bad in report if bad))
        self.report = report


@dataclass(frozen=True)
class Rules:
    """What a table declares: its schema (NOT NULL columns), text lengths, the
    primary key, further unique keys, and foreign keys as column -> (parent, its key)."""
    table: str
    schema: StructType
    key: str | None = None
    lengths: dict[str, int] = field(default_factory=dict)
    unique: tuple[str, ...] = ()
    foreign: dict[str, tuple[DataFrame, str]] = field(default_factory=dict)

    def row_rules(self) -> dict[str, Column]:
        """name -> whether a row breaks the rule."""
        found = {f"not null {f.name}": F.col(f.name).isNull() for f in self.schema.fields if not f.nullable}
        for name, most in self.lengths.items():
            found[f"length {name}"] = F.coalesce(F.length(name) > most, F.lit(False))
        return found


def watched(df: DataFrame, rules: Rules) -> tuple[DataFrame, Observation]:
    """``df`` whose next action also counts the rows that break a row rule."""
    seen = Observation(f"rules of {rules.table}")
    counts = [F.coalesce(F.sum(bad.cast("long")), F.lit(0)).alias(name) for name, bad in rules.row_rules().items()]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *counts), seen


def report(rules: Rules, written: DataFrame, seen: Observation) -> list[tuple]:
    """The rows of the report for a table that was written under :func:`watched`."""
    got = seen.get
    n = got["rows"]
    out = [(rules.table, name, n, got[name]) for name in rules.row_rules()]
    if rules.key:
        out.append((rules.table, f"key {rules.key}", n, key_violations(written, [rules.key]).count()))
    out += [(rules.table, f"unique {c}", n, key_violations(written.where(F.col(c).isNotNull()), [c]).count()) for c in rules.unique]
    for column, (parent, parent_key) in rules.foreign.items():
        out.append((rules.table, f"foreign {column}", n, foreign_key_violations(written, column, parent, parent_key).count()))
    return out


def gate(found: list[tuple]) -> None:
    """Raises :class:`LoadRejected` if any rule is broken."""
    if any(bad for *_, bad in found):
        raise LoadRejected(found)


def as_table(spark, reports: list[list[tuple]]) -> DataFrame:
    """Reports as one DataFrame."""
    return spark.createDataFrame(reduce(list.__add__, reports, []), REPORT)
