"""Alarms over a ledger of stage runs: a missing section is unknown, not fine."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .coverage import islands


def watch(ledger: DataFrame, stages: DataFrame, now: str, stale_s: int = 7200, streak: int = 2) -> DataFrame:
    """(stage, age_s, streak, state) for every expected stage; ``ledger`` has stage, at, ok."""
    last = ledger.groupBy("stage").agg(F.max("at").alias("last_at"))
    w = Window.partitionBy("stage").orderBy("at")
    rows = ledger.withColumn("_n", F.row_number().over(w))
    tail = rows.groupBy("stage").agg((F.max("_n") - F.coalesce(F.max(F.when(F.col("ok"), F.col("_n"))), F.lit(0))).alias("failures"))
    out = stages.select("stage").distinct().join(last, "stage", "left").join(tail, "stage", "left").withColumn("age_s", F.expr(f"timestampdiff(SECOND, last_at, TIMESTAMP_NTZ'{now}')"))
    state = F.when(F.col("last_at").isNull(), "unknown").when(F.col("failures") >= streak, "failing").when(F.col("age_s") > stale_s, "stale").otherwise("fine")
    return out.select("stage", "age_s", F.coalesce("failures", F.lit(0)).alias("failures"), state.alias("state"))


def failure_runs(ledger: DataFrame) -> DataFrame:
    w = Window.partitionBy("stage").orderBy("at")
    rows = ledger.withColumn("_n", F.row_number().over(w)).where("NOT ok")
    return islands(rows, ["stage"], F.col("_n"), {"first_at": F.min("at"), "last_at": F.max("at")})


def meter_alarms(meter: DataFrame, expected: DataFrame, now: str, stale_s: int = 3 * 86_400) -> DataFrame:
    """(device_id, age_s, state) for every meter that should report, by its newest interval; one without any is unknown, not fine."""
    newest = meter.groupBy("device_id").agg(F.max("ts_utc").alias("newest"))
    out = expected.select("device_id").distinct().join(newest, "device_id", "left").withColumn("age_s", F.expr(f"timestampdiff(SECOND, newest, TIMESTAMP_NTZ'{now}')"))
    return out.select("device_id", "age_s", F.when(F.col("age_s").isNull(), "unknown").when(F.col("age_s") > stale_s, "stale").otherwise("fine").alias("state"))


def alarms(stages: DataFrame, meters: DataFrame) -> DataFrame:
    """(check, state) of every check that is not fine, of :func:`watch` and :func:`meter_alarms`."""
    rows = stages.select(F.concat(F.lit("stage "), "stage").alias("check"), "state").unionByName(meters.select(F.concat(F.lit("meter "), "device_id").alias("check"), "state"))
    return rows.where("state <> 'fine'")
