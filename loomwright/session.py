"""Session helpers shared by every operator."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def build_session(cores: int | str = "*", **conf: str) -> SparkSession:
    """A local session for tests and benches; clusters bring their own."""
    builder = SparkSession.builder.master(f"local[{cores}]")
    defaults = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
    }
    return builder.config(map=defaults | conf).getOrCreate()


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is something at a path of any file system that Spark knows."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share; a temporary one only where none is set on one machine (tests)."""
    path = spark.conf.get(CHECKPOINT_SETTING, None)
    if not path:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError(f"{CHECKPOINT_SETTING} must name a folder that all executors share")
        path = "file://" + os.path.join(tempfile.gettempdir(), f"loomwright-{os.getpid()}")
        spark.conf.set(CHECKPOINT_SETTING, path)
    return path.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame once to the shared folder and read it back: lineage is cut, a lost executor costs nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.mode("error").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Use all cores where a small input comes in fewer splits than there are cores; larger inputs stay as they are.

    Frames that already shuffle are left alone: asking for their partitions would run them.
    """
    if "Exchange" in df._jdf.queryExecution().executedPlan().toString():
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() * 2 <= cores else df
