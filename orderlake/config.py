"""Session helpers: shared scratch storage and size limits.

Scratch data (checkpoints, event logs written by tests, snapshots) always lives
under the folder the cluster names in ``spark.checkpoint.dir``.  Only when that
is unset *and* Spark runs in local mode (tests, benches) do we create one.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Largest row count we broadcast without a shuffle fallback.  Dimension rows are
# narrow (a key and a few attributes), so 2M rows stays well under ~200 MB.
BROADCAST_MAX_ROWS = 2_000_000


def shared_root(spark: SparkSession) -> str:
    """The cluster-wide folder for checkpoints and intermediate tables."""
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: name a shared folder (HDFS/S3/...) "
            "for checkpoints and intermediate tables"
        )
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="orderlake-"))
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder under the shared root."""
    return f"{shared_root(spark)}/orderlake/{name}-{uuid.uuid4().hex[:12]}"


def _fs_path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_path(spark, path)
    return fs.exists(p)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in ``path`` (none if it doesn't exist)."""
    fs, p = _fs_path(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table of our own (shared file system, recursive)."""
    fs, p = _fs_path(spark, path)
    fs.delete(p, True)


def materialize_at(df, name: str):
    """Write ``df`` as Parquet under the shared root; return (re-read frame, path).

    Cuts lineage (a lost executor recomputes from files, not from the whole
    upstream plan) and lets every later reader prune columns.  The path lets
    the caller drop the files once nothing reads them.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path), path


def materialize(df, name: str):
    """``materialize_at`` without the path."""
    return materialize_at(df, name)[0]
