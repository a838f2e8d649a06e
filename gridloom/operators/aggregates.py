"""Energy aggregations over the hourly table, the observations and the day-grain table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.localtime import TZ, local_date, midnight_utc, seconds
from ..functions.scalar import level
from ..schemas import CHANNEL


def local_day() -> Column:
    """The local day of an hourly row."""
    return F.to_date("local_hour_start")


def daily_kwh(hourly: DataFrame, busy_watts: float = 100.0) -> DataFrame:
    """Per channel and local day: energy, observed seconds, hours, peak, and hours whose mean reached ``busy_watts``."""
    return hourly.where("metric = 'watts'").groupBy(*CHANNEL, local_day().alias("local_day")).agg(
        F.sum("kwh").alias("kwh"), F.sum("observed_seconds").alias("observed_seconds"), F.count("*").alias("hours"), F.max("max").alias("peak_w"), F.count_if(F.col("mean") >= busy_watts).alias("busy_hours")
    )


def label(facts: DataFrame, dim: DataFrame, how: str = "left") -> DataFrame:
    """Facts with their channel's dimension row; unmapped channels are kept. The dimension is a channel list and is broadcast
    only below Spark's own size threshold."""
    return facts.join(dim, CHANNEL, how)


def circuits(hourly: DataFrame, dim: DataFrame, poll_interval_s: float, first: str, last: str, tz: str = TZ) -> DataFrame:
    """Channels of local days ``first`` to ``last`` ranked by energy, with coverage of the range's real hours."""
    day = local_day()
    rows = hourly.where("metric = 'watts'").where(day.between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    out = rows.groupBy(*CHANNEL).agg(
        F.sum("kwh").alias("kwh"), F.max("max").alias("peak_w"), F.sum("sample_count").alias("samples"), F.count("*").alias("hours"), F.countDistinct(day).alias("days"), F.min(day).alias("first_day"), F.max(day).alias("last_day")
    )
    # From midnight to midnight on the local clock: days of 23 and 25 hours count as they are.
    span = (seconds(midnight_utc(F.date_add(F.lit(last).cast("date"), 1), tz)) - seconds(midnight_utc(F.lit(first).cast("date"), tz))) / poll_interval_s
    out = label(out, dim.select(*CHANNEL, "label", "category")).withColumn("level", level()).withColumn("coverage_pct", F.col("samples") / span * 100)
    return out.orderBy(F.col("kwh").desc_nulls_last(), *CHANNEL)


def circuit_days(hourly: DataFrame) -> DataFrame:
    return hourly.where("metric = 'watts'").groupBy(local_day().alias("local_day"), F.concat_ws("/", "device_id", "channel_id").alias("series"), level().alias("level")).agg(F.sum("kwh").alias("kwh"))


def level_totals(hourly: DataFrame) -> DataFrame:
    """Energy per level: a total for each, never across, as levels nest."""
    return hourly.where("metric = 'watts'").groupBy(level().alias("level")).agg(F.sum("kwh").alias("kwh"), F.countDistinct(F.struct("device_id", "channel_id")).alias("channels"))


def panel_days(hourly: DataFrame) -> DataFrame:
    """Feeds per local day in two steps: each series' day, then their sum, their number and the worst one's samples."""
    series = hourly.where("metric = 'watts'").where(level() == "feed").groupBy(local_day().alias("local_day"), *CHANNEL).agg(F.sum("kwh").alias("kwh"), F.sum("sample_count").alias("n"))
    return series.groupBy("local_day").agg(F.sum("kwh").alias("kwh"), F.count("*").alias("series"), F.min("n").alias("worst_samples"))


def panel_daily(hourly: DataFrame) -> DataFrame:
    """Feeds per local day with the number of channels, the divisor of coverage."""
    return hourly.where("metric = 'watts'").where(level() == "feed").groupBy(local_day().alias("local_day")).agg(F.sum("kwh").alias("kwh"), F.sum("observed_seconds").alias("observed_seconds"), F.countDistinct(F.struct("device_id", "channel_id")).alias("channels"))


def with_coverage(days: DataFrame, observed_s: Column, tz: str = TZ) -> DataFrame:
    """``coverage``: observed seconds as a share of the local day's own 23, 24 or 25 hours."""
    length = seconds(midnight_utc(F.date_add("local_day", 1), tz)) - seconds(midnight_utc("local_day", tz))
    return days.withColumn("coverage", observed_s / length)


def panel_coverage(hourly: DataFrame, tz: str = TZ) -> DataFrame:
    """(local_day, kwh, coverage) of the feeds together."""
    days = panel_daily(hourly)
    return with_coverage(days, F.col("observed_seconds") / F.col("channels"), tz).select("local_day", "kwh", "coverage")


def feed_coverage(hourly: DataFrame, tz: str = TZ) -> DataFrame:
    """(local_day, panel_kwh, channels, coverage): the feeds' energy, how many reported, and the coverage of the worst."""
    series = hourly.where("metric = 'watts'").where(level() == "feed").groupBy(local_day().alias("local_day"), *CHANNEL).agg(F.sum("kwh").alias("kwh"), F.sum("observed_seconds").alias("seconds"))
    days = series.groupBy("local_day").agg(F.sum("kwh").alias("panel_kwh"), F.count("*").alias("channels"), F.min("seconds").alias("seconds"))
    return with_coverage(days, F.col("seconds"), tz).drop("seconds")


def panel_hours(hourly: DataFrame, channels: list[str]) -> DataFrame:
    """Energy of the named channels per hour, the worst channel's samples, and how many series reported."""
    return hourly.where("metric = 'watts'").where(F.col("channel_id").isin(*channels)).groupBy("hour_start_utc").agg(F.sum("kwh").alias("panel_kwh"), F.min("sample_count").alias("worst_samples"), F.countDistinct(F.struct("device_id", "channel_id")).alias("series"))


def component_months(daily: DataFrame) -> DataFrame:
    """Energy and cost by month and component; ``always_zero`` marks components that never used any."""
    months = daily.groupBy(F.date_format("local_day", "yyyy-MM").alias("month"), "channel_id").agg(F.sum("kwh").alias("kwh"), F.sum("usd").alias("usd"), F.count("*").alias("days"))
    zero = daily.groupBy(F.col("channel_id").alias("c")).agg((F.max(F.abs("kwh")) == 0).alias("always_zero"))
    return months.join(zero, F.expr("channel_id = c")).drop("c")


def component_history(daily: DataFrame) -> DataFrame:
    """Day rows pivoted to a column each of kWh, with the number of components that reported."""
    top = ["low", "medium", "high", "urgent", "not_specified"]
    return daily.groupBy("local_day").agg(*(F.max(F.when(F.col("channel_id") == c, F.col("kwh"))).alias(f"kwh_{c}") for c in top), F.sum("usd").alias("usd"), F.count("*").alias("components"))


def pivoted(obs: DataFrame, key: list[Column], metrics: dict[str, Column]) -> DataFrame:
    """Conditional aggregates by key: one pass, one shuffle."""
    return obs.groupBy(*key).agg(*(c.alias(n) for n, c in metrics.items()))


def instant_sum_mean(obs: DataFrame, bucket: Column) -> DataFrame:
    """Sum over channels at an instant first, then the bucket's mean of those sums: the order matters."""
    instants = obs.where("metric = 'watts'").groupBy(bucket.alias("bucket"), "device_id", "ts_utc").agg(F.sum("value").alias("w"))
    return instants.groupBy("bucket", "device_id").agg(F.avg("w").alias("mean_w"), F.count("*").alias("instants"))


def leg_mean_sum(obs: DataFrame, bucket: Column, channels: list[str]) -> DataFrame:
    """Mean per leg first, then the sum of legs, so a leg that misses samples does not halve the result."""
    legs = obs.where(F.col("channel_id").isin(*channels)).groupBy(bucket.alias("bucket"), "device_id", "channel_id").agg(F.avg("value").alias("w"), F.count("*").alias("n"))
    return legs.groupBy("bucket", "device_id").agg(F.sum("w").alias("watts"), F.count("*").alias("legs"), F.min("n").alias("worst_samples"))


def extremes(hourly: DataFrame, metric: str) -> DataFrame:
    """Lowest and highest of a metric per local day."""
    return hourly.where(F.col("metric") == metric).groupBy(local_day().alias("local_day")).agg(F.min("min").alias("low"), F.max("max").alias("high"))


def modulation(hourly: DataFrame) -> DataFrame:
    """Spread of hourly means per channel and local day."""
    return hourly.groupBy(*CHANNEL, local_day().alias("local_day")).agg((F.max("mean") - F.min("mean")).alias("span"))


def night_floor(hourly: DataFrame, first_hour: int = 1, last_hour: int = 4) -> DataFrame:
    """Lowest night hour of the summed feeds per local day; hours are UTC hours, so the two 01:00 of autumn stay apart."""
    rows = hourly.where("metric = 'watts'").where(level() == "feed").where(F.hour("local_hour_start").between(first_hour, last_hour))
    hours = rows.groupBy("hour_start_utc", local_day().alias("local_day")).agg(F.sum("mean").alias("w"), F.count("*").alias("feeds"))
    return hours.groupBy("local_day").agg(F.min("w").alias("floor_w"), F.count("*").alias("night_hours"))


def kpi(hourly: DataFrame) -> DataFrame:
    """One row: house energy at feed level, the top branch, days with data."""
    days = daily_kwh(hourly)
    branch = days.where(level() == "branch").groupBy("device_id", "channel_id").agg(F.sum("kwh").alias("kwh"))
    top = branch.agg(F.max_by(F.concat_ws("/", "device_id", "channel_id"), F.struct("kwh", "device_id", "channel_id")).alias("top_branch"), F.max("kwh").alias("top_kwh"))
    house = days.agg(F.sum(F.when(level() == "feed", F.col("kwh"))).alias("house_kwh"), F.countDistinct("local_day").alias("days"))
    return house.crossJoin(top)  # two single rows


def observed_energy(obs: DataFrame, bucket: Column, bucket_s: int, poll_s: float) -> DataFrame:
    """Energy per channel over buckets, an observed sample standing for the poll interval, a bucket for no more than itself."""
    b = obs.where("metric = 'watts'").groupBy(bucket.alias("bucket"), *CHANNEL).agg(F.avg("value").alias("w"), F.count("*").alias("n"))
    seconds = F.least(F.lit(float(bucket_s)), F.col("n") * float(poll_s))
    return b.groupBy(*CHANNEL).agg((F.sum(F.col("w") * seconds) / 3.6e6).alias("kwh"), F.sum(seconds).alias("observed_s"))


def latest(obs: DataFrame) -> DataFrame:
    """The newest value of each channel and metric, silent channels included; ties go to the larger value."""
    return obs.groupBy(*CHANNEL, "metric").agg(F.max(F.struct("ts_utc", "value")).alias("x")).select(*CHANNEL, "metric", F.col("x.ts_utc").alias("ts_utc"), F.col("x.value").alias("value"))


def extent(obs: DataFrame) -> DataFrame:
    return obs.agg(F.min("ts_utc").alias("oldest"), F.max("ts_utc").alias("newest"))


def top_channels(obs: DataFrame, k: int = 3) -> tuple[DataFrame, DataFrame]:
    """The k channels of highest peak, and those omitted."""
    peaks = obs.where("metric = 'watts'").groupBy(*CHANNEL).agg(F.max("value").alias("peak_w"))
    top = peaks.orderBy(F.col("peak_w").desc(), *CHANNEL).limit(k)  # a top-k report
    return top, peaks.join(top.select(*CHANNEL), CHANNEL, "left_anti")


def series_summary(obs: DataFrame, start: str, end: str, poll_s: float) -> DataFrame:
    """Per channel and metric over ``[start, end)``: samples, zeros, extremes, expected samples and coverage."""
    rows = obs.where(f"ts_utc >= TIMESTAMP_NTZ'{start}' AND ts_utc < TIMESTAMP_NTZ'{end}'")
    out = rows.groupBy(*CHANNEL, "metric").agg(F.count("*").alias("n"), F.count_if(F.col("value") == 0).alias("zeros"), F.min("value").alias("min"), F.max("value").alias("max"), F.avg("value").alias("mean"))
    expected = F.expr(f"bround(timestampdiff(SECOND, TIMESTAMP_NTZ'{start}', TIMESTAMP_NTZ'{end}') / {poll_s})")
    return out.withColumn("coverage_pct", F.col("n") / expected * 100)


def local_days(obs: DataFrame) -> DataFrame:
    return obs.select(local_date("ts_utc").alias("local_day")).distinct()
