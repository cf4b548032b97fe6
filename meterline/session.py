"""Session settings and shared-folder helpers."""
from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.ui.enabled": "false",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(app: str, cores: int | str = 8, **extra: str) -> SparkSession:
    """A session for tests and benchmarks; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = SETTINGS | {
        "spark.sql.shuffle.partitions": str(cores),
        "spark.driver.memory": "12g",
        "spark.ui.showConsoleProgress": "false",
    } | extra
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The shared folder of the cluster: its checkpoint directory.

    Only a local session may fall back to a temporary folder; on a cluster
    executors on other machines could not read it.
    """
    context = spark.sparkContext
    folder = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="meterline-"))
    return context.getCheckpointDir()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library has written, through Spark's file systems."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def settle(df: DataFrame, label: str, folder: str | None = None) -> DataFrame:
    """Write `df` once to `folder`, or the shared folder, and read it back.

    For a result with several consumers: each of them starts from columnar
    files instead of repeating the joins behind `df`, lost executors cost only
    a re-read, and the file sizes let Spark choose join strategies.
    """
    spark = df.sparkSession
    path = f"{folder or shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
