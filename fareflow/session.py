"""Session construction and shared-storage helpers.

Everything that needs durable intermediate storage (lineage cuts, staged
tables, streaming checkpoints) goes under the directory the cluster names in
``spark.checkpoint.dir``.  Without that setting a cluster job fails with a
clear message: a local default would put each executor's part on its own
disk.  Only a ``local`` master (tests, a laptop) gets a temporary folder.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Defaults for the whole library.  AQE stays on: it coalesces small shuffle
# partitions, splits skewed join partitions and switches joins to broadcast
# at runtime once real sizes are known.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(
    app: str = "fareflow",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    ``master`` is only set when given; on a cluster the launcher supplies it.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint root; on a ``local`` master a temporary one if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        master = sc.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: name a folder that the driver and all "
                f"executors share (master {master})")
        configured = tempfile.mkdtemp(prefix="fareflow-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint root."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the shared root and read it back: for a frame
    that several branches of a plan use."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably (checkpoint to shared storage).

    Used where a plan is read back after an overwrite of its own source, or
    where a long lineage would make task retries expensive.  Never uses
    ``localCheckpoint``: executor loss would lose the data.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for os-level checks in tests."""
    return path[5:] if path.startswith("file:") else path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop FileSystem of the path (any scheme)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def delete_path(spark: SparkSession, path: str) -> None:
    """Recursive delete through the Hadoop FileSystem (used to swap directories)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(hpath):
        fs.delete(hpath, True)


def touch(spark: SparkSession, path: str) -> None:
    """An empty file at ``path`` (its folder is made)."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.create(hpath, True).close()


def rename_path(spark: SparkSession, src: str, dst: str) -> bool:
    """Atomic-on-HDFS directory rename used for the write-then-swap pattern."""
    jvm = spark.sparkContext._jvm
    s = jvm.org.apache.hadoop.fs.Path(src)
    d = jvm.org.apache.hadoop.fs.Path(dst)
    fs = s.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    parent = d.getParent()
    if parent is not None and not fs.exists(parent):
        fs.mkdirs(parent)
    return bool(fs.rename(s, d))


__all__ = [
    "DEFAULT_CONF",
    "get_session",
    "ensure_checkpoint_dir",
    "scratch_path",
    "cut_lineage",
    "staged",
    "path_exists",
    "touch",
    "delete_path",
    "rename_path",
    "local_path",
]
