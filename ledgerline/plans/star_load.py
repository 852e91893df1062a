"""The star schema as a load that can be repeated and resumed.

Every table is partitioned by ``load_version``, a digest of the input
snapshot; the fact also by ``row_kind``.  A step overwrites its own partition
only (dynamic partition overwrite), passes its gates, and is then recorded in
``_commits`` as one appended row.  So

* a second run of the same inputs finds every step recorded and writes nothing;
* a run that was killed is resumed at the first step without a record; what a
  killed step left is overwritten, not added to;
* the cube reads the recorded detail partition (the snapshot), never what it
  writes itself;
* a load that breaks its constraints records nothing and is not seen.

Readers take the version of the last recorded cube (``read_star``).  Fact keys
are numbered in a fixed order, so a repeated step gives the same rows.
"""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import DIM_DATE, DIM_TAGS, FACT_QUESTIONED
from ..session import materialize, path_exists
from ..sources import gates
from . import star

STEPS = ("dim_date", "dim_tags", "detail", "cube")
COMMIT = "seq long, load_version string, step string, n_rows long"


class Killed(RuntimeError):
    """A load ended after a step on request (tests of resuming)."""


def snapshot_version(qa: dict[str, DataFrame]) -> str:
    """A digest of the rows of all inputs, whatever their order."""
    told = []
    for name, df in sorted(qa.items()):
        row = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))).first()
        told.append(f"{name}:{row[0]}:{row[1]}")
    return hashlib.sha256("\n".join(told).encode()).hexdigest()[:16]


def commits(spark: SparkSession, out_dir: str) -> list:
    """The recorded steps, oldest first."""
    path = os.path.join(out_dir, "_commits")
    if not path_exists(spark, path):
        return []
    return sorted(spark.read.schema(COMMIT).parquet(path).distinct().collect())


def _stored(spark: SparkSession, out_dir: str, table: str, version: str, kind: str | None = None) -> DataFrame:
    df = spark.read.parquet(os.path.join(out_dir, table)).where(F.col("load_version") == version)
    return df.where(F.col("row_kind") == kind).drop("load_version", "row_kind") if kind else df.drop("load_version")


def load_star(qa: dict[str, DataFrame], out_dir: str, stop_after: str | None = None) -> str:
    """Loads the star schema of ``qa`` under ``out_dir`` as far as it is not
    recorded yet; returns the load's version.  ``stop_after`` names a step
    after which the load ends with :class:`Killed`, before its record."""
    spark = qa["posts"].sparkSession
    version = snapshot_version(qa)
    past = commits(spark, out_dir)
    done = {r.step for r in past if r.load_version == version}
    seq = 1 + max((r.seq for r in past), default=0)
    if done >= set(STEPS):
        return version
    stored = lambda table, kind=None: _stored(spark, out_dir, table, version, kind)

    def put(step: str, df: DataFrame, table: str, rules: gates.Rules, kind: str | None = None) -> None:
        nonlocal seq
        seen_df, seen = gates.watched(df, rules)
        whole = seen_df.withColumn("load_version", F.lit(version))
        parts = ["load_version"]
        if kind:
            whole, parts = whole.withColumn("row_kind", F.lit(kind)), [*parts, "row_kind"]
        (whole.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts)
         .parquet(os.path.join(out_dir, table)))
        if stop_after == step:
            raise Killed(step)
        found = gates.report(rules, stored(table, kind), seen)
        gates.gate(found)
        spark.createDataFrame([(seq, version, step, seen.get["rows"])], COMMIT).coalesce(1).write.mode("append").parquet(
            os.path.join(out_dir, "_commits"))
        seq += 1

    questions = None if {"dim_tags", "detail"} <= done else materialize(star.question_tags(qa))
    if "dim_date" not in done:
        put("dim_date", star.date_dimension(qa), "dim_date", gates.Rules("dim_date", DIM_DATE, "dim_date_id"))
    if "dim_tags" not in done:
        put("dim_tags", star.tag_dimension(questions), "dim_tags",
            gates.Rules("dim_tags", DIM_TAGS, "dim_tag_id", {"tag_name": star.TAG_NAME_LENGTH}, ("tag_name",)))
    foreign = {"d_date_id": (stored("dim_date"), "dim_date_id"), "d_tag_id": (stored("dim_tags"), "dim_tag_id")}
    if "detail" not in done:
        put("detail", star.fact_detail(questions, stored("dim_date"), stored("dim_tags")), "fact_questioned",
            gates.Rules("fact_questioned", FACT_QUESTIONED, "fact_id", foreign=foreign), "detail")
    if "cube" not in done:
        put("cube", star.fact_cube(stored("fact_questioned", "detail")).drop("grouping_id"), "fact_questioned",
            gates.Rules("fact_questioned cube", FACT_QUESTIONED, foreign=foreign), "cube")
    return version


def read_star(spark: SparkSession, out_dir: str) -> dict[str, DataFrame]:
    """The tables of the last load whose cube is recorded; the fact with its ``row_kind``."""
    whole = [r for r in commits(spark, out_dir) if r.step == "cube"]
    if not whole:
        raise LookupError(f"no committed load under {out_dir}")
    version = whole[-1].load_version
    return {n: _stored(spark, out_dir, n, version) for n in ("dim_date", "dim_tags", "fact_questioned")}
