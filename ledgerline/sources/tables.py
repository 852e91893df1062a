"""Parquet tables in and out."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, base_dir: str, name: str) -> DataFrame:
    """One Parquet table.  Column pruning and filter pushdown are left to
    Catalyst: later ``select``/``filter`` calls narrow the scan's ReadSchema
    and become PushedFilters."""
    return spark.read.parquet(os.path.join(base_dir, f"{name}.parquet"))


def write_table(df: DataFrame, path: str, mode: str = "errorifexists",
                partition_by: list[str] | None = None) -> None:
    """CREATE TABLE AS / INSERT INTO ... SELECT.

    ``errorifexists`` is the reference's default save mode (S3); ``append``
    is INSERT (S7).  Columns are written by name, never by position.
    """
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
