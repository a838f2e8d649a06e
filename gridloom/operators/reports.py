"""Reports of several blocks. Each returns its blocks by name, as frames of their own: one that is empty or fails leaves the others."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.localtime import bucket
from ..functions.scalar import freshness, label_or_tail, level
from ..schemas import CHANNEL
from ..storage import cut
from . import aggregates, anomalies, coverage, hvac, integrity, meters


def in_days(df: DataFrame, day: Column, first: str, last: str) -> DataFrame:
    return df.where(day.between(F.to_date(F.lit(first)), F.to_date(F.lit(last))))


def history(hourly: DataFrame, daily: DataFrame, meter: DataFrame, dim: DataFrame, first: str, last: str, poll_interval_s: float, interval_s: int = 900) -> dict[str, DataFrame]:
    """Local days ``first`` to ``last``: circuits and their days, panel against the primary meter, components, coverage, key figures.

    The meter block takes channels that the dimension marks primary, or all meters' days side by side if it knows none of them.
    """
    hours = in_days(hourly, aggregates.local_day(), first, last)
    meter_days = in_days(meters.day_totals(meter, interval_s), F.col("local_day"), first, last).select("device_id", "local_day", F.col("kwh").alias("meter_kwh"), "intervals")
    panel = aggregates.panel_days(hours).withColumnRenamed("kwh", "panel_kwh")
    return {
        "circuits": aggregates.circuits(hourly, dim, poll_interval_s, first, last),
        "circuit_days": aggregates.circuit_days(hours),
        "meter": panel.join(meter_days, "local_day", "full_outer").withColumn("delta_kwh", F.col("panel_kwh") - F.col("meter_kwh")),
        "hvac": aggregates.component_history(in_days(daily, F.col("local_day"), first, last)),
        "coverage": coverage.matrix(hours, poll_interval_s),
        "kpi": aggregates.kpi(hours),
    }


class Limits(NamedTuple):
    """What the digest judges by."""

    least_samples: int = 100
    limit_w: float = 100_000
    busy_watts: float = 100.0
    baseline_days: int = 21
    floor_kwh: float = 0.5
    quiet_kwh: float = 0.5
    quiet_days: int = 3
    stuck_hours: int = 20
    stuck_duty: float = 0.98
    usual_duty: float = 0.9
    modulated_rpm: float = 300.0
    strip_kwh: float = 3.0
    mild_f: float = 45.0
    barn_high: float = 40.0
    barn_low: float = 3.6
    barn_days: int = 4
    growth_w: float = 150.0
    usd_per_kwh: float = 0.12


def digest(hourly: DataFrame, daily: DataFrame, meter: DataFrame, day: str, primary: str, barn: str, strip: str, outdoor: DataFrame, rpm_span: DataFrame | None = None, limits: Limits = Limits(), interval_s: int = 900) -> dict[str, DataFrame]:  # noqa: B008
    """All rules over one local day: instruments first, and channels that they find fault with are in no baseline and judged by no other rule.

    ``daily`` is day-grain energy of components (``strip`` the resistance heat's), ``outdoor`` (local_day, low), ``rpm_span`` (local_day, span):
    a day on which the compressor modulated excuses loads that are on all day. Blocks: 'findings' (rule, key, local_day, headline,
    kwh, usd) in rule order, 'skipped' (key, reason, n) for what could not be judged, 'untrusted' (key). The rollup's watts are written to the
    shared folder once.
    """
    n, d = limits, F.lit(day).cast("date")
    key, on_day = F.concat_ws("/", *CHANNEL), F.col("local_day") == d
    hourly = cut(hourly.where("metric = 'watts'"))
    found, skipped, untrusted = integrity.check_channels(hourly, meters.day_coverage(meter, interval_s, primary), n.least_samples, n.limit_w)
    days = anomalies.trusted(aggregates.daily_kwh(hourly, n.busy_watts), untrusted, key)
    over = anomalies.above_band(days, day, [*CHANNEL], n.baseline_days, n.usd_per_kwh, floor_kwh=n.floor_kwh)
    quiet = anomalies.went_quiet(days.withColumn("series", key), day, n.quiet_kwh, n.quiet_days, "series")
    stuck = anomalies.stuck_loads(days, day, n.stuck_hours, n.stuck_duty, n.usual_duty, tuple(CHANNEL))
    if rpm_span is not None:
        stuck = stuck.join(rpm_span.where(F.col("span") >= n.modulated_rpm).select("local_day"), "local_day", "left_anti")
    heat = anomalies.strip_heat(daily.where(on_day), outdoor, strip, n.strip_kwh, n.mild_f)
    barn_days = anomalies.envelope(meters.day_totals(meter, interval_s).where(F.col("local_day") <= d), barn, n.barn_high, n.barn_low, n.barn_days).where(on_day)
    floors = aggregates.night_floor(anomalies.trusted(hourly, untrusted, key))
    growth = anomalies.phantom_growth(floors, day, n.baseline_days, n.growth_w)
    one = integrity.finding
    rules = [
        found.where(on_day),
        one(over, "above_band", key, F.col("local_day"), F.lit("above its band"), F.col("excess_kwh")),
        one(quiet, "circuit_went_quiet", F.col("series"), F.col("last_day"), F.concat(F.col("length").cast("string"), F.lit(" days below the floor"))),
        one(stuck, "stuck_load", key, F.col("local_day"), F.lit("on nearly all day")),
        one(heat, "strip_heat_in_mild_weather", F.col("channel_id"), F.col("local_day"), F.lit("resistance heat on a mild night"), F.col("kwh")),
        one(barn_days, "barn_envelope", F.lit(barn), F.col("local_day"), F.concat(F.col("kind"), F.lit(" for "), F.col("days").cast("string"), F.lit(" days"))),
        one(growth.where("found"), "phantom_load_growth", F.lit("house"), F.col("local_day"), F.lit("night floor grew")),
    ]
    named = lambda df, who, why: df.select(who.alias("key"), F.lit(why).alias("reason")).groupBy("key", "reason").agg(F.count("*").alias("n"))
    banded = anomalies.bands(anomalies.baseline(days, day, n.baseline_days), [*CHANNEL]).select(*CHANNEL)
    parts = [
        skipped,
        named(days.where(on_day).join(banded, CHANNEL, "left_anti"), key, "too few days for a band"),
        named(daily.where(on_day).where(F.col("channel_id") == strip).join(outdoor.where("low IS NOT NULL"), "local_day", "left_anti"), F.col("channel_id"), "no outdoor low"),
        named(untrusted, F.col("key"), "untrusted: in no baseline and judged by no other rule"),
        named(growth.where("usual_w IS NULL"), F.lit("house"), "no nights to compare with"),
    ]
    return {"findings": integrity.report(rules).withColumn("usd", F.col("kwh") * n.usd_per_kwh), "skipped": reduce(DataFrame.unionByName, parts), "untrusted": untrusted}


def hvac_report(obs: DataFrame, hourly: DataFrame, component: DataFrame, states: DataFrame, start: str, end: str, bucket_s: int, poll_interval_s: float, channels: int, least: float = 0.95) -> dict[str, DataFrame]:
    """:func:`hvac_compare` from raw inputs over ``[start, end)``, with observed energy per channel and the equipment's days against the panel's.

    ``states`` has (bucket, capacity, state, rpm, cfm) on buckets of ``bucket_s``; ``component`` (local_day, kwh).
    """
    window = obs.where(f"ts_utc >= TIMESTAMP_NTZ'{start}' AND ts_utc < TIMESTAMP_NTZ'{end}'")
    feeds = window.where("metric = 'watts'").where(level() == "feed").groupBy(bucket("ts_utc", bucket_s).alias("bucket")).agg(F.avg("value").alias("watts"))
    inside = states.where(f"bucket >= TIMESTAMP_NTZ'{start}' AND bucket < TIMESTAMP_NTZ'{end}'")
    blocks = hvac_compare(hvac.state_vs_power(inside, feeds))
    blocks["energy"] = aggregates.observed_energy(window, bucket("ts_utc", bucket_s), bucket_s, poll_interval_s)
    blocks["days"] = hvac.component_vs_panel(component, aggregates.feed_coverage(hourly), channels, least)
    return blocks


def hvac_compare(pairs: DataFrame) -> dict[str, DataFrame]:
    """Bucketed equipment states with power (:func:`hvac.state_vs_power`): the series with modelled power, and what it says of the equipment."""
    series = hvac.modelled(pairs)
    by_state = series.groupBy("state").agg(F.count("*").alias("buckets"), F.avg("watts").alias("mean_w"), F.avg(F.abs("residual_w")).alias("mean_abs_residual_w"))
    return {"series": series, "states": by_state, "agreement": hvac.agreement(pairs), "bands": hvac.capacity_bands(pairs), "off_state": hvac.off_state(pairs), "feeder": hvac.feeder_profile(pairs), "speeds": hvac.speed_bands(pairs)}


def live_panel(obs: DataFrame, dim: DataFrame, now: str, window_s: int, bucket_s: int, poll_interval_s: float, top: int = 3) -> dict[str, DataFrame]:
    """As of ``now`` (UTC): the newest value of each channel with its age, statistics of the window before, and the curves of its ``top`` channels.

    Samples after ``now`` are not looked at; a channel that is silent in the window keeps its newest value and has no statistics.
    """
    at, start = F.expr(f"TIMESTAMP_NTZ'{now}'"), F.expr(f"TIMESTAMP_NTZ'{now}' - INTERVAL {window_s} SECOND")
    known = obs.where(F.col("ts_utc") < at)
    window = known.where(F.col("ts_utc") >= start)
    newest = aggregates.label(aggregates.latest(known), dim.select(*CHANNEL, "label")).withColumn("age_s", F.timestamp_diff("SECOND", F.col("ts_utc"), at))
    stats = window.groupBy(*CHANNEL, "metric").agg(F.count("*").alias("n"), F.count_if(F.col("value") == 0).alias("zeros"), F.min("value").alias("min"), F.max("value").alias("max"), F.avg("value").alias("mean"))
    leaders = aggregates.top_channels(window, top)[0].select(*CHANNEL)  # ``top`` rows
    curves = window.where("metric = 'watts'").join(F.broadcast(leaders), CHANNEL).groupBy(*CHANNEL, bucket("ts_utc", bucket_s).alias("bucket")).agg(F.avg("value").alias("mean_w"), F.count("*").alias("n"))
    return {
        "latest": newest.select(label_or_tail("label").alias("label"), "metric", "value", "age_s", freshness("age_s", poll_interval_s).alias("freshness")),
        "stats": stats.withColumn("coverage_pct", F.col("n") / (window_s / poll_interval_s) * 100),
        "overlay": curves,
    }
