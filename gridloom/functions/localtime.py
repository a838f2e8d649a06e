"""Exact local time: UTC instants and naive local clocks, through days of 23 and 25 hours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TZ = "America/New_York"


def local(ts_utc: Column | str, tz: str = TZ) -> Column:
    """The naive local clock of a UTC instant; the repeated hour of a fall-back night maps twice to one clock."""
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), _c(ts_utc))


def local_date(ts_utc: Column | str, tz: str = TZ) -> Column:
    return F.to_date(local(ts_utc, tz))


def utc(ts_local: Column | str, tz: str = TZ, fold: int = 0) -> Column:
    """The UTC instant of a naive local clock; ``fold`` 1 is an ambiguous clock's second occurrence."""
    first = F.convert_timezone(F.lit(tz), F.lit("UTC"), _c(ts_local))
    later = first + F.expr("INTERVAL 1 HOUR")
    return F.when(local(later, tz) == _c(ts_local), later).otherwise(first) if fold else first


def midnight_utc(day: Column | str, tz: str = TZ) -> Column:
    return utc(_c(day).cast("timestamp_ntz"), tz)


def hour(ts_utc: Column | str) -> Column:
    return F.date_trunc("hour", _c(ts_utc)).cast("timestamp_ntz")


def seconds(ts: Column | str) -> Column:
    """Whole seconds since 1970 of a naive UTC instant."""
    return F.expr(f"timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {ts})") if isinstance(ts, str) else F.timestamp_diff("SECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), ts)


def bucket(ts: str, width_s: int) -> Column:
    """The start of the epoch-aligned bucket of ``width_s`` seconds that holds ``ts``."""
    start = F.expr(f"timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {ts}) div {width_s} * {width_s}")
    return F.timestamp_add("SECOND", start, F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))


def day_table(days: DataFrame, tz: str = TZ) -> DataFrame:
    """(local_day, start_utc, end_utc, hours) for distinct ``local_day``; hours are 23, 24 or 25."""
    start, end = midnight_utc("local_day", tz), midnight_utc(F.date_add("local_day", 1), tz)
    days = days.select("local_day").distinct().select("local_day", start.alias("start_utc"), end.alias("end_utc"))
    return days.withColumn("hours", F.expr("CAST(timestampdiff(HOUR, start_utc, end_utc) AS BIGINT)"))


def hour_spine(days: DataFrame, tz: str = TZ) -> DataFrame:
    """(local_day, hour_start_utc, hour_end_utc, local_hour_start): every physical hour of the days."""
    spine = day_table(days, tz).select("local_day", F.explode(F.expr("sequence(start_utc, end_utc - INTERVAL 1 HOUR, INTERVAL 1 HOUR)")).alias("hour_start_utc"))
    return spine.select("local_day", "hour_start_utc", F.expr("hour_start_utc + INTERVAL 1 HOUR").alias("hour_end_utc"), local("hour_start_utc", tz).alias("local_hour_start"))


def wall_hours(spine: DataFrame) -> DataFrame:
    """(local_day, wall_hour, start_utc, end_utc): 01:00 is two hours wide in autumn, 02:00 is absent in spring."""
    return spine.groupBy("local_day", F.hour("local_hour_start").alias("wall_hour")).agg(F.min("hour_start_utc").alias("start_utc"), F.max("hour_end_utc").alias("end_utc"))


def days_between(spark: SparkSession, first: str, last: str) -> DataFrame:
    return spark.sql("SELECT explode(sequence(DATE(:a), DATE(:b), INTERVAL 1 DAY)) AS local_day", args={"a": first, "b": last})


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x
