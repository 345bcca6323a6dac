"""Session for tests and benchmarks, and the shared folder for written tables."""

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores="*", app_name="tractscope", **conf):
    """A single-machine session. On a cluster, use the session it provides."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        # Keeps Python call sites out of error messages; building plans is twice as fast.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "8g"))
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark):
    """Folder all executors can reach: the checkpoint folder the session names.

    Only a local session without one may fall back to a folder of its own machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tractscope-"))
    return spark.sparkContext.getCheckpointDir()


def new_table_path(spark, label):
    """A path under the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/tractscope/{label}-{uuid.uuid4().hex}"


def write_once(df, label):
    """Write a frame that several branches read, and return the written table."""
    spark = df.sparkSession
    path = new_table_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
