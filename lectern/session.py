"""Session-level helpers: the shared scratch folder, lineage cuts, input spreading.

On a cluster the shared folder is whatever ``spark.checkpoint.dir`` names
(a distributed file system path).  Only when a local session leaves it unset
(tests, the smoke driver) do we pick a local folder ourselves; on a cluster
that is an error.
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

_CKPT_KEY = "spark.checkpoint.dir"
# Whether a query's shuffle files go when it is done (Spark 4.1; earlier versions do not know it).
_CLEAN_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Scratch paths given out, by application.
_WRITTEN: dict[str, list[str]] = {}


def scratch_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get(_CKPT_KEY, None) or sc.getConf().get(_CKPT_KEY, None)
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError(f"set {_CKPT_KEY} to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="lectern-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-path of the shared folder for one written table."""
    base = scratch_dir(spark)
    path = os.path.join(base, f"{name}-{uuid.uuid4().hex}")
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder of any file system that Spark reaches; one that is not there is no error."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def is_folder(spark: SparkSession, path: str) -> bool:
    """Whether a path of any file system that Spark reaches is a folder; one that is not there is none."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.exists(at) and files.getFileStatus(at).isDirectory()


@contextlib.contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete the scratch tables that are written inside, at the end.

    For the owner of whole queries: what they return must have been stored or collected before the scope ends, since a
    table returned by an operator reads its scratch tables when it is used.
    """
    written = _WRITTEN.setdefault(spark.sparkContext.applicationId, [])
    before = len(written)
    try:
        yield
    finally:
        for path in written[before:]:
            delete_path(spark, path)
        del written[before:]


def cut_lineage(df: DataFrame, name: str = "cut") -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    This survives executor loss like a reliable ``checkpoint()``, but costs
    one job instead of two (an eager RDD checkpoint counts the rows and then
    computes them again to write them), and the table read back keeps
    column pruning, filter pushdown and real size statistics for the
    optimizer.  Values computed before the cut (ids, model answers) are
    stored, so later reads see the same values.

    The write's shuffle files go when it is done: else they stay until the
    driver happens to collect its garbage, and those of all cuts add up.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with shuffles_removed(spark):
        df.write.mode("errorifexists").parquet(path)
    out = spark.read.parquet(path)
    out._scratch_path = path
    return out


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of queries that are made and run inside go when each is done; what is collected again needs a frame of its own."""
    before = spark.conf.get(_CLEAN_KEY, None)
    spark.conf.set(_CLEAN_KEY, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEAN_KEY)
        else:
            spark.conf.set(_CLEAN_KEY, before)


def discard(*tables: DataFrame) -> None:
    """Delete the files of tables that :func:`cut_lineage` returned, for their owner, once nothing reads them any more."""
    for table in tables:
        path = table._scratch_path
        delete_path(table.sparkSession, path)
        written = _WRITTEN.get(table.sparkSession.sparkContext.applicationId, [])
        if path in written:
            written.remove(path)


def spread(df: DataFrame, *keys: str, min_partitions: int | None = None) -> DataFrame:
    """Hash-partition ``df`` by ``keys`` only when it has fewer partitions than
    the cluster has task slots.

    A small or unsplittable input (one Parquet row group, one gzip file) gives
    a scan of a single task, and CPU-heavy text work after it would run on one
    core.  A large input is already split many ways by the scan, so this is a
    no-op there and adds no shuffle.  Hashing on a key (not round-robin) keeps
    the placement deterministic when a task is retried.

    An input that itself comes out of a shuffle is not asked for its
    partitions, which would run that shuffle once more: it is already spread.
    """
    want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    shuffled = "Exchange" in df._jdf.queryExecution().executedPlan().toString()
    if shuffled or df.rdd.getNumPartitions() >= want:
        return df
    return df.repartition(want, *keys) if keys else df.repartition(want)


def measured_bytes(df: DataFrame) -> int:
    """Size of a table as its files tell the optimizer; for tables read from files, such as lineage cuts."""
    raw = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(raw if isinstance(raw, int) else raw.toString())


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
