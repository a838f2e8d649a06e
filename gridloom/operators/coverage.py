"""Gaps stay gaps: coverage matrices, absent hours, gaps inside and at the edges of a window, bucketed series with holes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.localtime import TZ, bucket, day_table, local, midnight_utc
from ..functions.scalar import coverage_class
from ..schemas import CHANNEL


def matrix(hourly: DataFrame, poll_interval_s: float, tz: str = TZ) -> DataFrame:
    """Samples per series and local day against what a day of 23, 24 or 25 hours should have."""
    days = hourly.groupBy(F.to_date("local_hour_start").alias("local_day"), *CHANNEL, "metric").agg(F.sum("sample_count").alias("samples"))
    out = days.join(day_table(days.select("local_day"), tz).select("local_day", "hours"), "local_day")
    expected = F.col("hours") * 3600 / poll_interval_s
    return out.withColumn("expected", expected.cast("long")).withColumn("coverage_pct", F.col("samples") / expected * 100).withColumn("status", coverage_class("coverage_pct"))


def short_hours(hourly: DataFrame, expected: int, share: float = 0.9) -> DataFrame:
    """Hours with fewer than ``share`` of the expected samples."""
    return hourly.where(F.col("sample_count") < expected * share).select(*CHANNEL, "metric", "hour_start_utc", "sample_count", F.lit(expected).cast("long").alias("expected"))


def absent_hours(hourly: DataFrame, tz: str = TZ) -> DataFrame:
    """Hours of observed days on which a series has no row at all.

    A series' days are one row, with the hours seen on each (25 at most); every observed day's own hours are taken from the calendar, and
    what was seen is taken away: the rollup is read twice and joined with nothing but the list of days.
    """
    day = F.to_date("local_hour_start")
    days = hourly.groupBy(*CHANNEL, "metric", day.alias("local_day")).agg(F.collect_set("hour_start_utc").alias("hours"))
    series = days.groupBy(*CHANNEL, "metric").agg(F.map_from_entries(F.collect_list(F.struct("local_day", "hours"))).alias("seen"))
    calendar = hourly.agg(F.collect_set(day).alias("days"))  # one row: a few hundred days a year
    placed = series.crossJoin(F.broadcast(calendar)).select(*CHANNEL, "metric", "seen", F.explode("days").alias("local_day"))  # one row beside each
    own = F.sequence(midnight_utc("local_day", tz), midnight_utc(F.date_add("local_day", 1), tz) - F.expr("INTERVAL 1 HOUR"), F.expr("INTERVAL 1 HOUR"))
    absent = F.array_except(own, F.coalesce(F.try_element_at("seen", F.col("local_day")), F.array().cast("array<timestamp_ntz>")))
    return placed.select(*CHANNEL, "metric", F.explode(absent).alias("hour_start_utc")).withColumn("local_hour_start", local("hour_start_utc", tz))


def previous_sample(raw: DataFrame) -> DataFrame:
    """Each sample with the instant of its series' ``previous`` one; a series' first has no row.

    A series is worked on by UTC day, so a long history is many tasks; each day starts with the last sample before it, carried over.
    """
    key = [*CHANNEL, "metric"]
    days = raw.withColumn("_day", F.to_date("ts_utc"))
    following = F.lead("_day").over(Window.partitionBy(*key).orderBy("_day"))
    carried = days.groupBy(*key, "_day").agg(F.max("ts_utc").alias("ts_utc")).withColumn("_day", following).where("_day IS NOT NULL").withColumn("_carried", F.lit(True))
    rows = days.withColumn("_carried", F.lit(False)).unionByName(carried, allowMissingColumns=True)
    w = Window.partitionBy(*key, "_day").orderBy("ts_utc")
    return rows.withColumn("previous", F.lag("ts_utc").over(w)).where("NOT _carried AND previous IS NOT NULL").drop("_day", "_carried")


def gaps(obs: DataFrame, interval_s: float) -> DataFrame:
    """Stretches between consecutive samples longer than 1.5 intervals, with how many samples are missing.

    Those inside a UTC day come from the day's own samples, those between days from the days' first and last samples.
    """
    key = [*CHANNEL, "metric"]
    days = obs.select(*key, "ts_utc", F.to_date("ts_utc").alias("_day"))
    inside = days.withColumn("gap_start", F.lag("ts_utc").over(Window.partitionBy(*key, "_day").orderBy("ts_utc")))
    ends = days.groupBy(*key, "_day").agg(F.min("ts_utc").alias("ts_utc"), F.max("ts_utc").alias("_last"))
    between = ends.withColumn("gap_start", F.lag("_last").over(Window.partitionBy(*key).orderBy("_day"))).drop("_last")
    out = inside.unionByName(between).withColumn("gap_s", F.expr("timestampdiff(SECOND, gap_start, ts_utc)"))
    return out.where(F.col("gap_s") > 1.5 * interval_s).select(*CHANNEL, "metric", "gap_start", F.col("ts_utc").alias("gap_end"), "gap_s", (F.bround(F.col("gap_s") / interval_s) - 1).cast("long").alias("missing"))


def edge_gaps(obs: DataFrame, start: str, end: str, interval_s: float) -> DataFrame:
    """Leading and trailing silence of a window ``[start, end)`` longer than 1.5 intervals."""
    lo, hi = f"TIMESTAMP_NTZ'{start}'", f"TIMESTAMP_NTZ'{end}'"
    ends = obs.where(f"ts_utc >= {lo} AND ts_utc < {hi}").groupBy(*CHANNEL, "metric").agg(F.min("ts_utc").alias("first"), F.max("ts_utc").alias("last"))
    both = ends.select(*CHANNEL, "metric", F.explode(F.array(F.struct(F.lit("leading").alias("edge"), F.expr(f"timestampdiff(SECOND, {lo}, first)").alias("gap_s")), F.struct(F.lit("trailing").alias("edge"), F.expr(f"timestampdiff(SECOND, last, {hi})").alias("gap_s")))).alias("e"))
    return both.select(*CHANNEL, "metric", "e.edge", "e.gap_s").where(F.col("gap_s") > 1.5 * interval_s)


def bucket_series(obs: DataFrame, start: str, end: str, bucket_s: int) -> DataFrame:
    """Mean, least and largest per bucket of a window; buckets without samples are there with nulls: holes are explicit."""
    lo, hi = f"TIMESTAMP_NTZ'{start}'", f"TIMESTAMP_NTZ'{end}'"
    rows = obs.where(f"ts_utc >= {lo} AND ts_utc < {hi}").groupBy(*CHANNEL, "metric", bucket("ts_utc", bucket_s).alias("bucket")).agg(F.avg("value").alias("mean"), F.min("value").alias("min"), F.max("value").alias("max"), F.count("*").alias("n"))
    series = rows.select(*CHANNEL, "metric").distinct()
    spine = series.select("*", F.explode(F.expr(f"sequence({lo}, {hi} - make_dt_interval(0, 0, 0, {bucket_s}), make_dt_interval(0, 0, 0, {bucket_s}))")).alias("bucket"))
    return spine.join(rows, [*CHANNEL, "metric", "bucket"], "left")


def islands(df: DataFrame, keys: list[str], ordinal: Column, value_cols: dict[str, Column]) -> DataFrame:
    """Maximal runs of consecutive ordinals: the ordinal less its rank is constant along a run."""
    w = Window.partitionBy(*keys).orderBy("_o")
    rows = df.withColumn("_o", ordinal).withColumn("_run", F.col("_o") - F.row_number().over(w))
    return rows.groupBy(*keys, "_run").agg(F.count("*").alias("length"), *(c.alias(n) for n, c in value_cols.items())).drop("_run")


def hole_runs(series: DataFrame, bucket_s: int) -> DataFrame:
    """Runs of empty buckets of a bucketed series."""
    at = F.expr(f"timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', bucket) div {bucket_s}")
    return islands(series.where("n IS NULL"), [*CHANNEL, "metric"], at, {"hole_start": F.min("bucket"), "hole_last": F.max("bucket")})


def zero_runs(obs: DataFrame, below: float = 0.0) -> DataFrame:
    """Runs of consecutive samples at or below ``below``; a null value breaks a run.

    A run is told by how many samples of the series before it are not such: counted by UTC day, each day starting from a carried row.
    """
    key = [*CHANNEL, "metric"]
    other = (~F.coalesce(F.col("value") <= below, F.lit(False))).cast("long")
    days = obs.select(*key, "ts_utc", "value", F.to_date("ts_utc").alias("_day"), other.alias("_other"))
    before = F.sum("_other").over(Window.partitionBy(*key).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1))
    carried = days.groupBy(*key, "_day").agg(F.sum("_other").alias("_other")).withColumn("_other", before).where("_other IS NOT NULL")
    w = Window.partitionBy(*key, "_day").orderBy("ts_utc", "value").rowsBetween(Window.unboundedPreceding, 0)
    rows = days.unionByName(carried, allowMissingColumns=True).withColumn("_run", F.sum("_other").over(w)).where(F.col("value") <= below)
    return rows.groupBy(*key, "_run").agg(F.count("*").alias("length"), F.min("ts_utc").alias("run_start"), F.max("ts_utc").alias("run_end")).drop("_run")


def quiet_streaks(daily: DataFrame, floor: float) -> DataFrame:
    """Runs of consecutive days below ``floor``."""
    return islands(daily.where(F.col("kwh") < floor), ["channel_id"], F.datediff("local_day", F.lit("1970-01-01").cast("date")), {"first_day": F.min("local_day"), "last_day": F.max("local_day")})


def change_points(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """Rows whose value differs from the one before."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("previous", F.lag(value).over(w)).where(F.col("previous").isNotNull() & ~F.col("previous").eqNullSafe(F.col(value)))
