"""Session construction and shared-storage helpers."""

from __future__ import annotations

import atexit
import contextlib
import os
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def get_spark(app: str = "tallyspark", master: str | None = None,
              shuffle_partitions: int | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE on and the UI off."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = (builder
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true")
               .config("spark.sql.session.timeZone", "UTC"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must point at shared storage: it's only read here,
    and a cluster without it is refused, since executors don't see each other's
    disks. A private folder is made for a local master only (tests).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None)
    if not conf_dir:
        conf_dir = private_folder(sc.master)
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def private_folder(master: str) -> str:
    """A folder of this machine, for a local master only."""
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError(f"spark.checkpoint.dir must name a shared folder on {master}")
    return tempfile.mkdtemp(prefix="tallyspark-ckpt-")


def workers_import(spark: SparkSession) -> None:
    """Let Python workers import this package where they see the driver's copy (a cluster has it installed or as ``--py-files``)."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH")) if x)


_made: dict[str, SparkSession] = {}


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder (for written tables), removed when the program ends."""
    path = os.path.join(ensure_checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")
    if not _made:
        atexit.register(remove_written)
    _made[path] = spark
    return path


def remove_written() -> None:
    """Remove the tables written under the shared folder by this program; results that read them are then gone."""
    for path, spark in list(_made.items()):
        _made.pop(path)
        if spark.sparkContext._jsc is not None:
            jvm = spark.sparkContext._jvm
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a table of :func:`shared_path` that nothing reads any more."""
    if _made.pop(path, None) is not None:
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written inside go once it is written (else they stay until the driver collects its garbage)."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write a table once to the shared folder and read it back, whatever its size.

    Cuts the lineage; the files survive lost executors, and their sizes tell the
    planner whether a side may be broadcast (``autoBroadcastJoinThreshold``).
    """
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
