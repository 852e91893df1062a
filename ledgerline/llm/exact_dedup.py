"""Exact dedup: tree-merge of sorted digest runs, DataFrame functions only.

Every document becomes a digest record in one of ``fan_in ** rounds`` leaf
runs (a hash of its id, so the copies of one text are spread over all runs).
Runs are exchanged in binomial rounds, generalised to ``fan_in`` partners: in
round r the runs that differ only in their r-th digit swap records so that
each afterwards holds one slice of the digest space, and are merged there
(sort by digest, streaming aggregate).  A merge keeps one record per digest:
the retained identifier and the number of rows.  After the last round each
digest is in one run.  No task ever sees more than ``fan_in`` records per
digest after the map-side combine, however many copies a text has.

A digest is verified at every level: records merge only if the SHA-256, an
independent 64-bit hash and the byte length agree.

The way back is salted too: the winners join the first-round records (at most
``leaves / fan_in`` per digest), and these join the documents' own records on
(node, digest).

Defined results: a null text counts as empty; all empty texts form one group;
rows that repeat both id and text count separately in ``group_size`` and one
of them is kept; a null id is retained only if its whole group has null ids;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.repeat import repeat_rows
from ..session import materialize, shuffle_partitions
from .common import fresh, same_columns

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
KEYS = ["digest", "check", "n_bytes"]


def normalised(text: Column) -> Column:
    """Null as empty, A-Z lower-cased, everything else unchanged."""
    return F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER)


def _with_digest(docs: DataFrame, text_col: str) -> DataFrame:
    norm = normalised(F.col(text_col))
    return docs.select("*", F.unhex(F.sha2(norm, 256)).alias("digest"), F.xxhash64(norm).alias("check"),
                       F.octet_length(norm).alias("n_bytes"))


def _node(level: int, rounds: int, fan_in: int) -> Column:
    """The run that holds a record after ``level`` rounds: the high digits
    come from the digest, the rest still from the leaf run."""
    low = fan_in ** (rounds - level)
    bucket = F.pmod(F.xxhash64("digest"), F.lit(fan_in ** rounds))
    slot = F.pmod(F.xxhash64("id", F.lit("leaf")), F.lit(fan_in ** rounds)) if level == 0 else F.col("node")
    return (bucket - F.pmod(bucket, F.lit(low)) + F.pmod(slot, F.lit(low))).alias("node")


def tree_rounds(spark, fan_in: int) -> int:
    """Rounds that give at least one leaf run per shuffle partition; two at
    least, so that a hot digest is always spread on the way back."""
    rounds = 2
    while fan_in ** rounds < shuffle_partitions(spark):
        rounds += 1
    return rounds


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 keep: str = "smallest", fan_in: int = 8) -> DataFrame:
    """One row per input row: id_col, keep_id, group_size, kept, text_sha256.

    ``keep`` names the identifier retained per text: "smallest" or "largest".
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep must be 'smallest' or 'largest'")
    best = F.min if keep == "smallest" else F.max
    rounds = tree_rounds(docs.sparkSession, fan_in)
    slim = _with_digest(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("_text")), "_text").drop("_text")
    # one record per (id, text); written once, so that the texts are read and hashed once
    records = materialize(slim.groupBy("id", *KEYS).agg(F.count(F.lit(1)).alias("copies")))
    leaf = records.select("*", _node(0, rounds, fan_in))

    def merge(runs: DataFrame, level: int) -> DataFrame:
        placed = runs.select(_node(level, rounds, fan_in), *KEYS, "best", "n_rows")
        return placed.groupBy("node", *KEYS).agg(best("best").alias("best"), F.sum("n_rows").alias("n_rows"))

    # a struct of the id: merged by a sort aggregate, so runs stay sorted and spill; null ids lose
    run = leaf.withColumn("best", F.when(F.col("id").isNotNull(), F.struct("id"))).withColumnRenamed("copies", "n_rows")
    first = run = merge(run, 1)
    for level in range(2, rounds + 1):
        run = merge(run, level)
    groups = run.where("n_rows > 1").select(*KEYS, F.col("best.id").alias("keep_id"), F.col("n_rows").alias("group_size"))
    spread = first.select("node", *KEYS).join(groups, KEYS)

    # the node of the first round, as the documents' own records see it
    low = F.lit(fan_in ** (rounds - 1))
    bucket = F.pmod(F.xxhash64("digest"), F.lit(fan_in ** rounds))
    own = leaf.withColumn("node", bucket - F.pmod(bucket, low) + F.pmod(F.col("node"), low))
    decided = own.join(spread, ["node", *KEYS], "left")
    grouped = F.col("group_size").isNotNull()
    kept_id = F.when(grouped, F.col("keep_id")).otherwise(F.col("id"))
    told = decided.select(
        F.col("id").alias(id_col), kept_id.alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.col("id").eqNullSafe(kept_id).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"), "copies")
    # the first of the rows that repeat id and text may be kept; the others are dealt out in bounded pieces
    others = told.where("copies > 1").withColumn("kept", F.lit(False)).withColumn("copies", F.col("copies") - 1)
    return told.drop("copies").union(repeat_rows(others, "copies"))


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      keep: str = "smallest", fan_in: int = 8) -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns as they were."""
    w_id, w_digest, digest = (fresh(docs, c) for c in ("w_id", "w_digest", "text_digest"))
    winners = (exact_groups(docs, id_col, text_col, keep, fan_in).where("kept")
               .select(F.col(id_col).alias(w_id), F.unhex("text_sha256").alias(w_digest)))
    tagged = docs.select(*same_columns(docs), F.unhex(F.sha2(normalised(F.col(text_col)), 256)).alias(digest))
    hit = tagged.join(winners, F.col(id_col).eqNullSafe(F.col(w_id)) & (F.col(digest) == F.col(w_digest)), "left_semi")
    # repeated rows (same id and text): one of them, reduced in the map tasks already
    return hit.dropDuplicates([id_col, digest]).drop(digest)
