"""The hourly rollup and what guards it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.localtime import TZ, hour, local, local_date
from ..functions.scalar import coverage_class
from ..schemas import CHANNEL, HOURLY
from ..vocab import DAY_GRAIN
from .coverage import previous_sample


def hourly_rollup(raw: DataFrame, poll_interval_s: float = 30, tz: str = TZ) -> DataFrame:
    """One row per (hour, channel, metric) that has samples: statistics, and observed-time energy for watts only.

    Day-grain metrics are left out; an hour without samples has no row. kwh = mean * samples * interval / 3.6e6, null for other
    metrics. The percentile is interpolated.
    """
    watts, n = F.col("metric") == "watts", F.count("*")
    rows = raw.where(~F.col("metric").isin(*DAY_GRAIN)).withColumn("hour_start_utc", hour("ts_utc"))
    out = rows.groupBy("hour_start_utc", *CHANNEL, "metric").agg(
        F.min("unit").alias("unit"), F.avg("value").alias("mean"), F.min("value").alias("min"), F.max("value").alias("max"), F.percentile("value", F.lit(0.95)).alias("p95"), n.alias("sample_count"),
        F.min("ts_utc").alias("first_ts_utc"), F.max("ts_utc").alias("last_ts_utc"),
    )
    out = out.withColumn("local_hour_start", local("hour_start_utc", tz)).withColumn("kwh", F.when(watts, F.col("mean") * F.col("sample_count") * poll_interval_s / 3.6e6))
    out = out.withColumn("observed_seconds", F.when(watts, (F.col("sample_count") * poll_interval_s).cast("long")))
    return out.select(*HOURLY.fieldNames())


def in_spine(raw: DataFrame, spine: DataFrame) -> DataFrame:
    """Samples with their hour of the spine: an equi join on the truncated hour, in place of a range join."""
    return raw.withColumn("hour_start_utc", hour("ts_utc")).join(spine, "hour_start_utc")


def recent_rollup(raw: DataFrame, now: Column, poll_interval_s: float) -> DataFrame:
    """Hours with the one in progress: what could have been sampled by ``now``, and a coverage class."""
    hours = hourly_rollup(raw.where(F.col("ts_utc") <= now), poll_interval_s)
    end = F.least(F.expr("hour_start_utc + INTERVAL 1 HOUR"), now)
    expected = F.greatest(F.bround(F.timestamp_diff("SECOND", F.col("hour_start_utc"), end) / poll_interval_s), F.lit(1)).cast("long")
    hours = hours.withColumn("expected", expected)
    pct = F.least(F.col("sample_count") / F.col("expected") * 100, F.lit(100.0))
    return hours.withColumn("coverage_pct", pct).withColumn("status", coverage_class(pct))


def deltas(raw: DataFrame) -> DataFrame:
    """Seconds since the channel's previous sample of the metric; the first has none."""
    return previous_sample(raw).withColumn("delta_s", F.expr("timestampdiff(SECOND, previous, ts_utc)"))


def cadence(raw: DataFrame, expected_s: float, least: int = 20, tolerance: float = 0.25, tz: str = TZ) -> DataFrame:
    """Observed interval per local day and whether it agrees with the configured one; too few deltas are no verdict (null)."""
    d = deltas(raw).where("delta_s >= 1").groupBy(local_date("ts_utc", tz).alias("local_day")).agg(F.median("delta_s").alias("observed_s"), F.count("*").alias("n"))
    ok = F.when(F.col("n") >= least, F.abs(F.col("observed_s") - expected_s) <= tolerance * expected_s)
    return d.withColumn("agrees", ok)


class CadenceError(ValueError):
    """The samples' own interval is not the configured one, so energy would be wrong by their ratio."""


def checked_rollup(raw: DataFrame, poll_interval_s: float = 30, tz: str = TZ, allow_mismatch: bool = False) -> DataFrame:
    """The hourly rollup behind the cadence check: days that contradict ``poll_interval_s`` are an error that names the first of them, or, with
    ``allow_mismatch``, rows whose ``cadence_agrees`` is false. Days with too few samples for a verdict pass, as null. Runs the check at once."""
    days = cadence(raw, poll_interval_s, tz=tz)
    hourly = hourly_rollup(raw, poll_interval_s, tz)
    if not allow_mismatch:
        off = days.where("NOT agrees").orderBy("local_day").limit(5).collect()  # for the message
        if off:
            raise CadenceError(f"configured {poll_interval_s} s; observed " + ", ".join(f"{r.local_day}: {r.observed_s:g} s" for r in off))
    verdicts = days.select("local_day", F.col("agrees").alias("cadence_agrees"))
    return hourly.withColumn("local_day", F.to_date("local_hour_start")).join(verdicts, "local_day", "left").drop("local_day")


def reconcile(raw: DataFrame, hourly: DataFrame) -> DataFrame:
    """(raw_rows, rolled_rows): equal, or samples were lost."""
    a = raw.where(~F.col("metric").isin(*DAY_GRAIN)).agg(F.count("*").alias("raw_rows"))
    return a.crossJoin(hourly.agg(F.coalesce(F.sum("sample_count"), F.lit(0)).alias("rolled_rows")))  # two single rows
