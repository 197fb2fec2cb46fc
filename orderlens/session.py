"""Session construction and the shared scratch folder.

On a cluster the shared folder is whatever ``spark.checkpoint.dir`` names; it is read
from the running session, and a cluster session without it is refused: each executor would
write to a disk of its own. Only a ``local`` master gets a fresh folder under /tmp.
``release`` removes a session's scratch tables, catalogue entries of bucketed ones included.
"""

from __future__ import annotations

import contextlib
import os
import re
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app: str = "orderlens",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Session for tests and the bench. On a cluster, the cluster's own session is used."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    b = (SparkSession.builder.master(master or f"local[{cpus}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", "16g")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def _conf_checkpoint_dir(spark: SparkSession) -> str | None:
    try:
        return spark.conf.get("spark.checkpoint.dir", None) or None
    except Exception:  # noqa: BLE001 - unset key raises in some versions
        return None


def _local_folder(spark: SparkSession) -> str:
    master = spark.conf.get("spark.master", "") or ""
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise RuntimeError(f"spark.checkpoint.dir is not set and the master is {master!r}: "
                           "name a folder that the driver and all executors share")
    return tempfile.mkdtemp(prefix="orderlens-ckpt-", dir="/tmp")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session (set here only for a ``local`` master)."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote (Connect) sessions have no SparkContext
        sc = None
    if sc is None:
        configured = _conf_checkpoint_dir(spark)
        if not configured:
            configured = _local_folder(spark)
            spark.conf.set("spark.checkpoint.dir", configured)
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) or _conf_checkpoint_dir(spark)
    if not configured:
        configured = _local_folder(spark)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def session_key(spark: SparkSession) -> str:
    """Identifies a running application (memo keys for tables written once per session)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001
        return f"session-{id(spark)}"


_SCRATCH: dict[str, list[str]] = {}
_BUCKETED: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared checkpoint folder; ``release`` removes it."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    _SCRATCH.setdefault(session_key(spark), []).append(path)
    return path


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def release(spark: SparkSession) -> int:
    """Removes the scratch tables of this session and drops its cached ones; results that
    still read them must be consumed before. Returns how many tables there were."""
    spark.catalog.clearCache()
    for name in _BUCKETED.pop(session_key(spark), []):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    paths = _SCRATCH.pop(session_key(spark), [])
    for path in paths:
        fs, where = _file_system(spark, path)
        fs.delete(where, True)
    return len(paths)


def input_stamp(spark: SparkSession, paths: list[str]) -> tuple:
    """Names, sizes and modification times of the files at ``paths``: changes when the data does."""
    out = []
    for path in paths:
        fs, where = _file_system(spark, path)
        if fs.exists(where):
            files = fs.listFiles(where, True)
            while files.hasNext():
                f = files.next()
                out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(out))


INPUT_SHARE = 4 * 2 ** 20  # bytes of input files for each shuffle partition
TASK_SHARE = 16 * 2 ** 20  # shuffled bytes of one task


@contextlib.contextmanager
def spread(spark: SparkSession, input_bytes: int) -> Iterator[int]:
    """Within it, jobs shuffle into a number of partitions that grows with the input (never fewer than configured), and
    adaptive execution joins small ones up to ``TASK_SHARE`` only: what a task sorts and aggregates stays the same at any
    size and fits its memory. Only for jobs that end inside, such as writes; the settings are put back."""
    parts, share = "spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = {k: spark.conf.get(k, None) for k in (parts, share)}  # None: not set, Spark's default holds
    wanted = max(int(spark.conf.get(parts)), -(-input_bytes // INPUT_SHARE))
    spark.conf.set(parts, str(wanted))
    spark.conf.set(share, str(TASK_SHARE))
    try:
        yield wanted
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def apart(df: DataFrame) -> DataFrame:
    """``df`` in a session of its own with the same settings, for observed metrics: a session that has observed any holds an
    object that cannot be serialized, and MLlib models whose training summary refers to that session fail in every task."""
    spark = df.sparkSession
    own = spark.newSession()
    for k, v in spark.conf.getAll.items():
        if own.conf.isModifiable(k):
            own.conf.set(k, v)
    plan = df._jdf.queryExecution().analyzed()
    return DataFrame(spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(own._jsparkSession, plan), own)


def materialize(df: DataFrame, name: str, partition_by: list[str] | None = None, reader: SparkSession | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back (in the session ``reader`` if given).

    Cuts lineage (a lost executor re-reads files instead of recomputing the plan) and,
    unlike ``checkpoint()``, keeps column pruning and filter pushdown for readers (and
    partition pruning with ``partition_by``).
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return (reader or spark).read.parquet(path)


def materialize_bucketed(df: DataFrame, name: str, key: str, buckets: int | None = None) -> DataFrame:
    """Write ``df`` in the shared folder bucketed and sorted by ``key`` and read it back.

    The scan then counts as hash-partitioned by ``key`` into ``buckets`` parts (default:
    ``spark.sql.shuffle.partitions``), so joins of tables with the same key and bucket count,
    and aggregates by the key, need no exchange. Rows are shuffled by the key first, so a
    bucket is one file. The table is external, under a catalogue name of its own.
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, name)
    table = f"orderlens_{re.sub(r'[^a-z0-9]+', '_', name.lower())}_{uuid.uuid4().hex}"
    (df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
     .option("path", path).format("parquet").saveAsTable(table))
    _BUCKETED.setdefault(session_key(spark), []).append(table)
    return spark.table(table)
