"""Declared-constraint checks (S8, S10, S11).  Spark enforces no keys, so the
primary- and foreign-key rules of the reference's DDL become queries whose
result must be empty."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that are NULL or occur more than once, with their row count."""
    nulls = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
              .filter(nulls | (F.col("n_rows") > 1)))


def foreign_key_violations(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose non-NULL foreign key has no parent (NULL is legal)."""
    parents = parent.select(F.col(pk).alias("_pk")).distinct()
    return (child.filter(F.col(fk).isNotNull())
                 .join(parents, F.col(fk) == F.col("_pk"), "left_anti"))


def checked(df: DataFrame, schema: StructType, lengths: dict[str, int] | None = None) -> DataFrame:
    """``df`` as it may be written: a NULL in a column declared NOT NULL, or a
    text longer than its declared length, fails the write (S8).  Evaluated
    row by row in the writing job itself, without a pass of its own."""
    out = df
    for field in schema.fields:
        bad = F.lit(False) if field.nullable else F.col(field.name).isNull()
        if field.name in (lengths or {}):
            bad = bad | F.coalesce(F.length(field.name) > lengths[field.name], F.lit(False))
        if not field.nullable or field.name in (lengths or {}):
            out = out.withColumn(field.name, F.when(bad, F.raise_error(F.lit(f"column {field.name}: NULL or too long")))
                                 .otherwise(F.col(field.name)))
    return out
