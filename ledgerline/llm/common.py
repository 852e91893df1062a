"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shuffle_partitions


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have yet (case-insensitively)."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name = "_" + name
    return name


def same_columns(df: DataFrame) -> list:
    """Every column of ``df`` by its quoted name (names may hold dots)."""
    return [df["`" + c.replace("`", "``") + "`"] for c in df.columns]


def spread_lookup(rows: DataFrame, values: DataFrame, key: str, spread_by: str) -> DataFrame:
    """``rows`` left-joined with ``values`` (one row per ``key``) where a key
    may hold a large share of the rows: the distinct (key, slot) pairs of the
    rows meet the values first, at most one per slot and key, and the rows
    then join on (key, slot), so a hot key is dealt over all slots."""
    slots = max(8, shuffle_partitions(rows.sparkSession))
    slotted = rows.withColumn("slot", F.pmod(F.xxhash64(spread_by), F.lit(slots)))
    pairs = slotted.groupBy(key, "slot").agg(F.count(F.lit(1)).alias("_n")).drop("_n").join(values, key)
    return slotted.join(pairs, [key, "slot"], "left").drop("slot")
