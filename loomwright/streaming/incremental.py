"""Structured Streaming: records that land in a folder go through once, keyed by id and input fingerprint."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, types as T

from ..session import exists


def landing(spark: SparkSession, path: str, schema: T.StructType | str, files_per_trigger: int = 100) -> DataFrame:
    """A stream of JSON lines files that appear in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).json(path)


def only_new(stream: DataFrame, keys: list[str], out: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame] = lambda d: d):
    """Appends rows whose key isn't in ``out`` yet; a replayed batch adds nothing. Returns the running query (all that is there, then stop)."""

    def take(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        fresh = batch.dropDuplicates(keys)
        if exists(spark, out):  # a read that fails is an error, not an empty folder
            fresh = fresh.join(spark.read.parquet(out).select(*keys), keys, "left_anti")
        transform(fresh).write.mode("append").parquet(out)

    return stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(stream: DataFrame, time: str, label: str, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts per label and event-time window; rows later than the watermark are left out."""
    from pyspark.sql import functions as F

    return stream.withWatermark(time, late).groupBy(F.window(time, width), label).agg(F.count("*").alias("n"))
