"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def local_session(cores: str = "*", app: str = "roomtide", **extra: str) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.driver.host", "127.0.0.1")
    )
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> None:
    """Readings carry naive timestamps; UTC keeps day and hour arithmetic free of DST jumps."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local-mode session without the setting gets a temporary folder; on a
    cluster a machine-local folder would be lost with its executor.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="roomtide-")
    spark.conf.set(CHECKPOINT_DIR, folder)
    return folder


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/roomtide/{label}-{uuid.uuid4().hex}"


_WRITTEN: list[str] = []


def release(spark: SparkSession) -> int:
    """Delete the intermediate tables this process has written so far; results read from them must be written before."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    gone = 0
    while _WRITTEN:
        path = jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        gone += path.getFileSystem(conf).delete(path, True)
    return gone


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Cut lineage: write ``df`` to the shared folder and read it back.

    A parquet table rather than an RDD checkpoint, so that later passes still
    prune columns and push filters.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    _WRITTEN.append(path)
    return spark.read.schema(df.schema).parquet(path)
