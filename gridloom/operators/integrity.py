"""Instrument findings. Every judgement is gated on how much was observed; what was not looked at is named, never passed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import is_child, level
from ..schemas import CHANNEL
from ..storage import cut
from ..vocab import RULES
from .aggregates import local_day, panel_coverage
from .coverage import islands


def finding(df: DataFrame, rule: str, key: Column, day: Column, headline: Column, kwh: Column | None = None) -> DataFrame:
    return df.select(F.lit(rule).alias("rule"), key.alias("key"), day.alias("local_day"), headline.alias("headline"), (F.lit(None).cast("double") if kwh is None else kwh).alias("kwh"))


def _key(*cols: str) -> Column:
    return F.concat_ws("/", *cols)


def frozen_runs(hourly: DataFrame, least_samples: int = 100, least_hours: int = 2) -> DataFrame:
    """Runs of consecutive UTC hours in which a CT's samples were one non-zero value. An hour unwatched breaks a run."""
    still = hourly.where("metric = 'watts' AND channel_id LIKE 'ct%'").where((F.col("min") == F.col("max")) & (F.col("min") != 0) & (F.col("sample_count") >= least_samples))
    hour = F.expr("timestampdiff(HOUR, TIMESTAMP_NTZ'1970-01-01 00:00:00', hour_start_utc)")
    runs = islands(still, [*CHANNEL, "min"], hour, {"first_hour": F.min("hour_start_utc"), "last_hour": F.max("hour_start_utc")})
    return runs.where(F.col("length") >= least_hours)


def negative(hourly: DataFrame) -> DataFrame:
    days = hourly.where("metric = 'watts' AND min < 0").groupBy(*CHANNEL, local_day().alias("day")).agg(F.min("min").alias("low"), F.count("*").alias("n"))
    return finding(days, "negative_reading", _key(*CHANNEL), F.col("day"), F.concat(F.col("n").cast("string"), F.lit(" hours below zero")))


def corrupt(hourly: DataFrame, limit_w: float = 100_000) -> DataFrame:
    days = hourly.where("metric = 'watts'").where(F.greatest(F.abs("min"), F.abs("max")) >= limit_w).groupBy(*CHANNEL, local_day().alias("day")).agg(F.count("*").alias("n"))
    return finding(days, "corrupt_reading", _key(*CHANNEL), F.col("day"), F.concat(F.col("n").cast("string"), F.lit(" hours beyond the limit")))


def feed_against_children(hourly: DataFrame, least_children: int = 3, share: float = 0.05, floor_w: float = 100.0) -> DataFrame:
    """(device, hour) where the children together exceed the feeds by more than the tolerance."""
    rows = hourly.where("metric = 'watts'")
    hours = rows.groupBy("device_id", "hour_start_utc", local_day().alias("local_day")).agg(
        F.sum(F.when(level() == "feed", F.col("mean"))).alias("feed_w"), F.sum(F.when(is_child(), F.col("mean"))).alias("children_w"), F.count_if(is_child()).alias("children")
    )
    excess = F.col("children_w") - F.col("feed_w")
    return hours.where("feed_w IS NOT NULL").where(F.col("children") >= least_children).withColumn("excess_w", excess).where(excess > F.greatest(share * F.col("feed_w"), F.lit(floor_w)))


def worst_hours(excess: DataFrame) -> DataFrame:
    """One row per device and day: its worst hour and how many there were."""
    worst = F.max(F.struct("excess_w", "hour_start_utc"))
    return excess.groupBy("device_id", "local_day").agg(worst.alias("w"), F.count("*").alias("hours")).select("device_id", "local_day", F.col("w.excess_w").alias("excess_w"), F.col("w.hour_start_utc").alias("hour_start_utc"), "hours")


def meter_disagreement(panel_days: DataFrame, meter_days: DataFrame, most_pct: float = 10.0) -> DataFrame:
    """Days on which panel and meter differ; both frames have local_day, kwh and coverage (0 to 1)."""
    m = meter_days.select("local_day", F.col("kwh").alias("meter_kwh"), F.col("coverage").alias("meter_coverage"))
    both = panel_days.join(m, "local_day", "full_outer").withColumn("off_pct", F.try_divide(F.abs(F.col("kwh") - F.col("meter_kwh")), F.col("meter_kwh")) * 100)
    reason = F.when(F.col("kwh").isNull(), "no panel").when(F.col("meter_kwh").isNull(), "no meter").when(F.col("coverage") < 0.9, "panel short").when(F.col("meter_coverage") < 0.9, "meter short")
    return both.withColumn("skipped", reason).withColumn("disagrees", F.when(reason.isNull(), F.col("off_pct") > most_pct))


def report(parts: list[DataFrame]) -> DataFrame:
    """All findings in rule order, instruments first."""
    order = F.array_position(F.array(*(F.lit(r) for r in RULES)), F.col("rule"))
    return reduce(DataFrame.unionByName, parts).orderBy(order, "local_day", "key")


def check_channels(hourly: DataFrame, meter_days: DataFrame, least_samples: int = 100, limit_w: float = 100_000, least_hours: int = 2) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(findings, skipped, untrusted channels). The rollup's watts and the findings are written to the shared folder once, as several rules and
    all three results read them."""
    hourly = cut(hourly.where("metric = 'watts'").select(*CHANNEL, "metric", "hour_start_utc", "local_hour_start", "mean", "min", "max", "sample_count", "kwh", "observed_seconds"))
    frozen = frozen_runs(hourly, least_samples, least_hours)
    excess = worst_hours(feed_against_children(hourly))
    metered = meter_disagreement(panel_coverage(hourly), meter_days)
    found = report([
        corrupt(hourly, limit_w), negative(hourly),
        finding(frozen, "frozen_channel", _key(*CHANNEL), F.to_date("first_hour"), F.concat(F.col("length").cast("string"), F.lit(" hours at one value"))),
        finding(excess, "feed_below_children", F.col("device_id"), F.col("local_day"), F.concat(F.col("hours").cast("string"), F.lit(" hours with children above the feed"))),
        finding(metered.where("disagrees"), "meter_disagreement", F.lit("meter"), F.col("local_day"), F.lit("panel and meter differ"), F.col("kwh") - F.col("meter_kwh")),
    ])
    short = hourly.where("metric = 'watts' AND channel_id LIKE 'ct%'").where(F.col("sample_count") < least_samples).groupBy(*CHANNEL).agg(F.count("*").alias("n"))
    skipped = short.select(_key(*CHANNEL).alias("key"), F.lit("hours with too few samples to call frozen").alias("reason"), "n").unionByName(metered.where("skipped IS NOT NULL").groupBy(F.col("skipped").alias("reason")).agg(F.count("*").alias("n")).select(F.lit("meter").alias("key"), "reason", "n"))
    untrusted = found.where(F.col("rule").isin("corrupt_reading", "negative_reading", "frozen_channel")).select("key").distinct()
    return found, skipped, untrusted
