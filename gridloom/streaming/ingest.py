"""Structured Streaming: dedupe on arrival, hourly windows, touched days rolled again, idempotent landing."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.localtime import TZ, local_date
from ..operators.dedupe import dedupe
from ..operators.rollup import hourly_rollup
from ..schemas import CHANNEL, DEDUPE_KEY
from ..storage import new_path, with_days, write_days


def stream_of(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def first_wins(stream: DataFrame, late: str = "1 hour") -> DataFrame:
    """One row per key among those that arrive within the watermark; state is dropped after it."""
    return stream.withColumn("event_time", F.col("ts_utc").cast("timestamp")).withWatermark("event_time", late).dropDuplicatesWithinWatermark(DEDUPE_KEY)


def hourly_windows(stream: DataFrame, poll_interval_s: float, late: str = "1 hour") -> DataFrame:
    """Tumbling UTC hours, emitted once the watermark has passed: the closed-hour gate."""
    timed = stream.withColumn("event_time", F.col("ts_utc").cast("timestamp")).withWatermark("event_time", late)
    out = timed.groupBy(F.window("event_time", "1 hour").alias("w"), *CHANNEL, "metric").agg(F.avg("value").alias("mean"), F.min("value").alias("min"), F.max("value").alias("max"), F.count("*").alias("sample_count"))
    kwh = F.when(F.col("metric") == "watts", F.col("mean") * F.col("sample_count") * poll_interval_s / 3.6e6)
    return out.select(F.col("w.start").cast("timestamp_ntz").alias("hour_start_utc"), *CHANNEL, "metric", "mean", "min", "max", "sample_count", kwh.alias("kwh"))


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def state_store(spark: SparkSession, provider: str | None) -> Iterator[None]:
    """Queries started meanwhile keep their state with ``provider``; the session's own setting holds again afterwards."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    if provider:
        spark.conf.set(name, provider)
    try:
        yield
    finally:
        if provider and before is None:
            spark.conf.unset(name)
        elif provider:
            spark.conf.set(name, before)


def run_to_table(stream: DataFrame, name: str, mode: str = "append", checkpoint: str | None = None, path: str | None = None, store: str | None = None) -> str:
    """Process what is there and stop; the checkpoint makes a restart neither lose nor repeat rows."""
    spark = stream.sparkSession
    path, checkpoint = path or new_path(spark, name), checkpoint or new_path(spark, f"{name}-checkpoint")
    with state_store(spark, store):
        stream.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", checkpoint).option("path", path).trigger(availableNow=True).start().awaitTermination()
    return path


def reroll_touched_days(stream: DataFrame, raw_path: str, hourly_path: str, checkpoint: str, poll_interval_s: float, tz: str = TZ) -> None:
    """Land each batch, then roll again every local day it touched, from all that is landed.

    Writes are keyed by batch or replace whole days, so a batch that is run again changes nothing. Of samples of one key the first
    batch's counts, and in a batch the least by its other columns: as :func:`dedupe` has it, whatever the order of files and rows.
    """

    def batch(df: DataFrame, number: int) -> None:
        spark = df.sparkSession
        with_days(df).withColumn("batch", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("local_date", "batch").parquet(raw_path)
        touched = df.select(local_date("ts_utc", tz).alias("local_date")).distinct()
        schema = T.StructType([*df.schema.fields, T.StructField("local_date", T.DateType()), T.StructField("batch", T.LongType())])
        landed = dedupe(spark.read.schema(schema).parquet(raw_path).join(touched, "local_date", "left_semi"), DEDUPE_KEY, ["batch"]).drop("batch")
        write_days(hourly_rollup(landed, poll_interval_s, tz).withColumn("local_date", F.to_date("local_hour_start")), hourly_path)

    stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
