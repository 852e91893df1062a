"""Session construction and written intermediates (shared checkpoint folder)."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

# Settings every report relies on.  AQE re-plans joins from runtime sizes
# (this is the size check behind every broadcast we do not force) and splits
# skewed shuffle partitions of sort-merge joins.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    "spark.ui.enabled": "false",
    # checkpoints and cached RDD blocks are written with this serializer
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}


def build_session(master: str = "local[*]", app: str = "ledgerline",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """A session with the settings above.  ``shuffle_partitions`` is left to
    the cluster's configuration unless given: AQE merges partitions, it never
    adds any, and the prefix sums and salts size themselves by it."""
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Point the SparkContext at the shared checkpoint folder named by
    ``spark.checkpoint.dir``.  Only a session with one local JVM and without
    that setting (tests) gets a private folder; a cluster session without it
    is an error, because a machine-local folder would not survive executor
    loss."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="ledgerline-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


#: Session -> table path -> weak references (in the JVM) to the file listings that
#: plans read it by; an empty list: nobody told who reads it.
_TABLES: dict[str, dict[str, list]] = {}
_SESSION_KEY = "spark.ledgerline.session"
#: Called with every DataFrame that is written and read back (plan checks look at it).
ON_WRITE: list[Callable[[DataFrame], None]] = []


def written_tables(spark: SparkSession) -> dict[str, list]:
    """The tables that this session wrote and that are still there."""
    key = spark.conf.get(_SESSION_KEY, None)
    if key is None:
        key = uuid.uuid4().hex
        spark.conf.set(_SESSION_KEY, key)
        atexit.register(_drop_at_exit, spark, key)
    return _TABLES.setdefault(key, {})


def new_table_path(spark: SparkSession) -> str:
    """A path under the shared checkpoint folder that no table uses yet.
    :func:`held_by` says which DataFrame reads it; without that it is kept to
    the end of the session."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/ledgerline-table-{uuid.uuid4().hex}"
    written_tables(spark)[path] = []
    return path


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` as a Parquet table under the shared checkpoint folder and
    read it back.  Cuts the lineage, fixes nondeterministic columns, and lets
    several readers share one computation: Spark shares a shuffle between two
    uses of a DataFrame only if their plans are identical after pruning.

    The table lives as long as a plan reads it: it is deleted by the first
    write after the last DataFrame over it has been collected as garbage, and
    at the end of the session at the latest (see also :class:`TableScope`)."""
    spark = df.sparkSession
    drop_unread(spark)
    path = new_table_path(spark)
    for look in ON_WRITE:
        look(df)
    _shuffles_end_with_the_write(df).write.mode("errorifexists").option("compression", "zstd").parquet(path)
    return held_by(spark.read.parquet(path), path)


def _shuffles_end_with_the_write(df: DataFrame) -> DataFrame:
    """``df`` with its shuffle files deleted once it is written: the table
    holds the result, and steps of many writes would keep all their shuffles on
    the executors' disks until the driver happens to collect its garbage."""
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key, "false")
    conf.set(key, "true")
    try:
        return df.select("*")
    finally:
        conf.set(key, before)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in any store Spark reaches."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def _listings(df: DataFrame) -> list:
    """The file listings (JVM objects) that the plan of ``df`` and its subqueries
    read.  Plans derived from it share them."""
    top = df._jdf.queryExecution().analyzed()
    inner = top.subqueriesAll()
    found = []
    for plan in [top, *[inner.apply(i) for i in range(inner.size())]]:
        leaves = plan.collectLeaves()
        for leaf in (leaves.apply(i) for i in range(leaves.size())):
            if leaf.getClass().getSimpleName() == "LogicalRelation" and leaf.relation().getClass().getSimpleName() == "HadoopFsRelation":
                found.append(leaf.relation().location())
    return found


def held_by(df: DataFrame, path: str) -> DataFrame:
    """``df``, after noting that the table at ``path`` (from :func:`new_table_path`) is
    needed as long as a plan over ``df``'s files lives."""
    weak = df.sparkSession.sparkContext._jvm.java.lang.ref.WeakReference
    written_tables(df.sparkSession)[path] += [weak(x) for x in _listings(df)]
    return df


def _delete(spark: SparkSession, paths) -> int:
    tables, n = written_tables(spark), 0
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for name in list(paths):
        tables.pop(name, None)
        at = jvm.org.apache.hadoop.fs.Path(name)
        n += bool(at.getFileSystem(conf).delete(at, True))
    return n


def drop_unread(spark: SparkSession) -> int:
    """Delete the tables whose last reader is gone; returns their number."""
    return _delete(spark, [p for p, readers in written_tables(spark).items() if readers and all(r.get() is None for r in readers)])


def drop_written(spark: SparkSession) -> int:
    """Delete all tables of the session, read or not, at once (a returned
    DataFrame may still need one).  Returns the number of tables deleted."""
    return _delete(spark, written_tables(spark))


def _drop_at_exit(spark: SparkSession, key: str) -> None:
    try:
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for name in _TABLES.pop(key, {}):
            at = jvm.org.apache.hadoop.fs.Path(name)
            at.getFileSystem(conf).delete(at, True)
    except Exception:       # noqa: BLE001  the session has been stopped: its folder is out of reach
        return


class TableScope:
    """A scope that owns the tables written in it: at its end those that its
    result does not read are deleted.

        with TableScope(spark) as scope:
            docs = scope.result(step(docs))
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.kept = spark, []

    def __enter__(self) -> TableScope:
        self.before = set(written_tables(self.spark))
        return self

    def result(self, df: DataFrame) -> DataFrame:
        self.kept.append(df)
        return df

    def __exit__(self, *_) -> None:
        read = set()
        for listing in (x for df in self.kept for x in _listings(df)):
            roots = listing.rootPaths()
            read |= {roots.apply(i).toString() for i in range(roots.size())}
        plain = lambda p: p.removeprefix("file:").replace("///", "/")
        read = {plain(p) for p in read}
        _delete(self.spark, [p for p in written_tables(self.spark) if p not in self.before
                             and not any(r == plain(p) or r.startswith(plain(p) + "/") for r in read)])
