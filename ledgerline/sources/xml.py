"""XML source and sink (S1, S2) on Spark's built-in ``xml`` format."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..session import materialize


def read_rows_xml(spark: SparkSession, path: str, schema: StructType,
                  row_tag: str = "row") -> DataFrame:
    """Each ``<row .../>`` element is a record; attributes become ``_Name``
    columns.  The schema is explicit: inference would cost a full extra pass
    and drop attributes that happen to be absent from the sampled slice."""
    return spark.read.schema(schema).format("xml").option("rowTag", row_tag).load(path)


def read_rows_xml_checked(spark: SparkSession, path: str, schema: StructType,
                          row_tag: str = "row") -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of files that may hold malformed records: a wrong type,
    a repeated or unquoted attribute, a record cut off.  ``rejects`` has the
    record's text as ``record``.  The files are parsed once, into a written
    table that both are read from.  The stream parser is used that finds the
    next record after a broken one (the default one gives up the file)."""
    corrupt = "_corrupt_record"
    parsed = materialize(
        spark.read.schema(StructType([*schema.fields, StructField(corrupt, StringType())])).format("xml")
        .option("rowTag", row_tag).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt)
        .option("useLegacyXMLParser", "true").load(path))
    return parsed.where(F.col(corrupt).isNull()).drop(corrupt), parsed.where(F.col(corrupt).isNotNull()).select(
        F.col(corrupt).alias("record"))


def write_rows_xml(df: DataFrame, path: str, root_tag: str = "users", row_tag: str = "row",
                   mode: str = "errorifexists") -> None:
    """One file per partition under ``path``; ``_x`` columns become attributes,
    other columns child elements.  Column names must be legal XML names, so
    aggregates are aliased before writing (``sum(_Score)`` is rejected)."""
    (df.write.mode(mode).format("xml")
       .option("rootTag", root_tag).option("rowTag", row_tag)
       .save(path))
