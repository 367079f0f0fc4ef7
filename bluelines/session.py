"""Spark session helpers: sane defaults for the engine and a shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the engine relies on. They are only applied when the session does not
# set them already, so a cluster configuration always wins.
ENGINE_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Hash joins on equality keys; the upstream rewrite never needs a nested loop.
    "spark.sql.join.preferSortMergeJoin": "true",
}


def build_session(master: str | None = None, app: str = "bluelines", shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the engine defaults. The UI stays off."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = b.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    b = b.config("spark.driver.memory", os.environ.get("BLUELINES_DRIVER_MEMORY", "16g"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in ENGINE_DEFAULTS.items():
        b = b.config(k, v)
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_defaults(spark: SparkSession) -> None:
    """Apply engine defaults to an existing session where they are unset."""
    for k, v in ENGINE_DEFAULTS.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)


def _is_local(spark: SparkSession) -> bool:
    """One process on one machine (a ``local-cluster`` has executors with folders of their own)."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the session.

    On a cluster it must be configured (``spark.checkpoint.dir``, a shared file
    system or object store). Only a local session without one gets a fresh
    folder of its own, as in tests.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not _is_local(spark):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="bluelines-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def work_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder for written intermediate or output tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/bluelines-{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str = "stage", written: list[str] | None = None, bucket: str | None = None) -> DataFrame:
    """Cut lineage: write ``df`` once as Parquet below the shared checkpoint folder and read it back.

    The written table survives the loss of executors, is computed exactly once (an RDD checkpoint
    of an uncached plan computes it twice), and later reads get column pruning, filter pushdown
    and real size statistics. The folder is appended to ``written`` (for ``remove_paths``).

    ``bucket`` names a column whose equal values stay together (a bucketed table, as many buckets as shuffle
    partitions): joins and groups on that column alone then read the rows where they are, without a shuffle.
    """
    spark = df.sparkSession
    path = work_path(spark, name)
    writer = df.write.mode("overwrite").option("compression", "zstd")
    if written is not None:
        written.append(path)
    if bucket is None:
        writer.parquet(path)
        return spark.read.parquet(path)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer.format("parquet").bucketBy(buckets, bucket).option("path", path).saveAsTable(_table_name(path))
    return spark.table(_table_name(path))


def _table_name(path: str) -> str:
    """Name of a bucketed table in the session's catalog, from its folder."""
    return path.rstrip("/").rsplit("/", 1)[-1].replace("-", "_")


def remove_paths(spark: SparkSession, paths: list[str]) -> int:
    """Delete written folders through the Hadoop file system of each path (shared storage on a
    cluster); returns how many existed. DataFrames that read them must not be used afterwards."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    n = 0
    for p in paths:
        if "/bluelines-" in p:  # a bucketed table has an entry in the catalog, too
            spark.sql(f"DROP TABLE IF EXISTS `{_table_name(p)}`")
        hp = jvm.org.apache.hadoop.fs.Path(p)
        fs = hp.getFileSystem(conf)
        if fs.exists(hp):
            fs.delete(hp, True)
            n += 1
    return n
