"""Utility meters: never sum two interval series of one meter; identical series under several ids are one meter."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.localtime import TZ, day_table, hour, local_date
from .aggregates import panel_hours, with_coverage


def day_totals(meter: DataFrame, interval_s: int) -> DataFrame:
    """Sum and interval count per meter and local day, for one pinned interval length."""
    return meter.where(F.col("interval_s") == interval_s).groupBy("device_id", local_date("ts_utc").alias("local_day")).agg(F.sum("value").alias("kwh"), F.count("*").alias("intervals"))


def finest_interval(meter: DataFrame) -> DataFrame:
    return meter.groupBy("device_id").agg(F.min("interval_s").alias("interval_s"))


def finest(meter: DataFrame) -> DataFrame:
    """The rows of each meter's finest interval."""
    return meter.join(finest_interval(meter), ["device_id", "interval_s"], "left_semi")


def hours(meter: DataFrame) -> DataFrame:
    """Finest readings summed to the UTC hour of the interval's start."""
    return finest(meter).groupBy("device_id", hour("ts_utc").alias("hour_start_utc")).agg(F.sum("value").alias("meter_kwh"), F.count("*").alias("intervals"))


def census(meter: DataFrame) -> DataFrame:
    """Per meter and interval: readings, energy and a fingerprint of the series.

    The fingerprint sums hashes, so a series is never brought together in one place.
    """
    mark = F.sum(F.pmod(F.xxhash64("ts_utc", F.round("value", 6)), F.lit(1 << 40)).cast("decimal(38,0)"))
    return meter.groupBy("device_id", "interval_s").agg(F.count("*").alias("readings"), F.sum("value").alias("kwh"), mark.alias("fingerprint"))


def groups(meter: DataFrame) -> DataFrame:
    """Meters whose finest series are identical, as one group under the smallest id. One pass: the finest series is picked from the census."""
    c = census(meter).withColumn("_least", F.min("interval_s").over(Window.partitionBy("device_id"))).where("interval_s = _least").drop("_least")
    w = Window.partitionBy("interval_s", "readings", "fingerprint")
    return c.withColumn("meter", F.min("device_id").over(w)).withColumn("aliases", F.count("*").over(w) - 1)


def interval_census(meter: DataFrame) -> DataFrame:
    return meter.groupBy("interval_s").agg(F.count("*").alias("readings"), F.countDistinct("device_id").alias("meters"))


def infer_interval(meter: DataFrame) -> DataFrame:
    """The commonest spacing per meter of its finest series; ties go to the smaller."""
    w = Window.partitionBy("device_id").orderBy("ts_utc")
    d = finest(meter).withColumn("_p", F.lag("ts_utc").over(w)).where("_p IS NOT NULL").groupBy("device_id", F.expr("timestampdiff(SECOND, _p, ts_utc)").alias("spacing_s")).agg(F.count("*").alias("n"))
    return d.groupBy("device_id").agg(F.max(F.struct("n", -F.col("spacing_s"))).alias("x")).select("device_id", (-F.col("x.col2")).alias("interval_s"), F.col("x.n").alias("n"))


def cycle(meter: DataFrame, cycles: DataFrame, tz: str = TZ) -> DataFrame:
    """Per cycle: kWh, intervals and what ``(start, end]`` should have, and days that are incomplete.

    Billed days are exploded from the cycles and equi-joined to meter days.
    """
    days = day_totals_finest(meter)
    billed = cycles.select("meter", "cycle_start", "cycle_end", F.explode(F.expr("sequence(date_add(cycle_start, 1), cycle_end, INTERVAL 1 DAY)")).alias("local_day"))
    lengths = day_table(billed.select("local_day"), tz).select("local_day", "hours")
    rows = billed.join(lengths, "local_day").join(days.withColumnRenamed("device_id", "meter"), ["meter", "local_day"], "left")
    want = F.col("hours") * 3600 / F.coalesce("interval_s", F.lit(900))
    return rows.groupBy("meter", "cycle_start", "cycle_end").agg(
        F.sum("kwh").alias("kwh"), F.coalesce(F.sum("intervals"), F.lit(0)).alias("intervals"), F.sum(want).cast("long").alias("expected"), F.count_if(F.coalesce("intervals", F.lit(0)) < want).alias("incomplete_days"), F.count("*").alias("days")
    )


def day_coverage(meter: DataFrame, interval_s: int, device: str, tz: str = TZ) -> DataFrame:
    """(local_day, kwh, coverage) of one meter: its intervals against those of the day's own 23, 24 or 25 hours."""
    days = day_totals(meter.where(F.col("device_id") == device), interval_s)
    return with_coverage(days, F.col("intervals") * interval_s, tz).select("local_day", "kwh", "coverage")


def day_totals_finest(meter: DataFrame) -> DataFrame:
    return finest(meter).groupBy("device_id", "interval_s", local_date("ts_utc").alias("local_day")).agg(F.sum("value").alias("kwh"), F.count("*").alias("intervals"))


def compare(hourly: DataFrame, meter: DataFrame, channels: list[str], device_id: str, expected_series: int, expected_samples: float, expected_intervals: int, least: float = 0.9) -> DataFrame:
    """Hours of panel and meter side by side; ``reason`` names why an hour is not compared, null where it is."""
    panel = panel_hours(hourly, channels)
    side = hours(meter).where(F.col("device_id") == device_id).drop("device_id")
    both = panel.join(side, "hour_start_utc", "full_outer")
    reason = (
        F.when(F.col("panel_kwh").isNull(), "no panel")
        .when(F.col("meter_kwh").isNull(), "no meter")
        .when(F.col("series") < expected_series, "panel series missing")
        .when(F.col("worst_samples") < least * expected_samples, "panel short")
        .when(F.col("intervals") < expected_intervals, "meter short")
    )
    return both.withColumn("reason", reason).withColumn("delta_kwh", F.when(reason.isNull(), F.col("panel_kwh") - F.col("meter_kwh")))


def compare_totals(compared: DataFrame) -> DataFrame:
    """Totals over usable hours, and how many were left out for each reason."""
    return compared.groupBy(F.coalesce("reason", F.lit("usable")).alias("reason")).agg(F.count("*").alias("hours"), F.sum("panel_kwh").alias("panel_kwh"), F.sum("meter_kwh").alias("meter_kwh"))


def card(meter: DataFrame, today: str, stale_h: int = 36) -> DataFrame:
    """Per meter: yesterday's and today's energy from its finest series, its last reading and whether that is stale."""
    days = finest(meter).withColumn("local_day", local_date("ts_utc"))
    day = F.lit(today).cast("date")
    out = days.groupBy("device_id").agg(
        F.sum(F.when(F.col("local_day") == F.date_sub(day, 1), F.col("value"))).alias("yesterday_kwh"), F.sum(F.when(F.col("local_day") == day, F.col("value"))).alias("today_kwh"), F.max("ts_utc").alias("last_ts_utc")
    )
    return out.withColumn("stale", F.col("last_ts_utc") < F.expr(f"TIMESTAMP_NTZ'{today} 00:00:00' - INTERVAL {stale_h} HOUR")).orderBy(F.col("yesterday_kwh").desc_nulls_last(), "device_id")
