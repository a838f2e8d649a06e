"""Telemetry views of the given tables: each a DataFrame here and a DuckDB common table expression in ``CTE``.

Events become observations of 16 channels on two devices, meter intervals and poll payloads; orders become day-grain energy.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.localtime import TZ, local
from .operators import rollup

CHANNELS = ("ct_1_a", "ct_1_b", "ct_2_a", "breaker_p1", "breaker_p10", "breaker_p14", "breaker_p26", "panel_leg_a")
#: Samples arrive about hourly per channel here, so an observed sample stands for so many seconds.
POLL_S = 1800
_DIM = (
    ("hub0", "ct_1_a", "Main feed A", "feed", "panel A", True), ("hub0", "ct_1_b", "Main feed B", "feed", "panel A", False), ("hub0", "ct_2_a", "Subpanel", "subfeed", "panel A", False),
    ("hub0", "breaker_p1", "Heat pump", "hvac", "panel A", False), ("hub0", "breaker_p10", "Water heater", "water_heating", "panel A", False), ("hub0", "breaker_p14", "Range", "kitchen", "panel A", False),
    ("hub1", "ct_1_a", "Barn feed A", "feed", "panel B", False), ("hub1", "ct_1_b", "Barn feed B", "feed", "panel B", False), ("hub1", "breaker_p1", "Barn heater", "hvac", "panel B", False), ("hub1", "breaker_p26", "Well pump", "water", "panel B", False),
)
_RATES = (("m0", "2023-12-01", "0.45", "0.10838", "0.00125"), ("m0", "2024-01-10", "0.52", "0.11271", "0.00098"), ("m1", "2023-12-01", "1.13", "0.11500", "0.00210"), ("m2", "2023-12-01", "0.45", "0.10838", "0.00125"))
_CYCLES = (("m0", "2023-12-31", "2024-01-15", "0.00312", "2.41", "0.59", "0.11", "0.30"), ("m0", "2024-01-15", "2024-01-28", "-0.00118", "-1.20", "0.61", None, "0.30"), ("m1", "2023-12-31", "2024-01-15", "0.00312", "2.41", "0.59", "0.11", "0.00"), ("m2", "2023-12-31", "2024-01-28", "0.00250", "1.75", "0.60", "0.10", "0.30"))


class Views:
    """The views over one folder of tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def observations(self, shift_days: int = 0) -> DataFrame:
        e = self.table("events")
        ts = F.col("ts").cast("timestamp_ntz") + F.expr(f"INTERVAL {shift_days} DAY")
        channel = F.element_at(F.array(*(F.lit(c) for c in CHANNELS)), (F.col("user_id") % 8 + 1).cast("int"))
        volts = F.col("user_id") % 8 == 7
        return e.select(
            ts.alias("ts_utc"), local(ts).alias("ts_local"), F.lit("leviton").alias("source"), F.concat(F.lit("hub"), (F.floor(F.col("user_id") / 8) % 2).cast("string")).alias("device_id"), channel.alias("channel_id"),
            F.when(volts, "volts").otherwise("watts").alias("metric"), F.col("value"), F.when(volts, "V").otherwise("W").alias("unit"), "event_id", "user_id", "event_type", "props",
        )

    @cached_property
    def obs(self) -> DataFrame:
        return self.observations()

    @cached_property
    def obs_dst(self) -> DataFrame:
        return self.observations(60)

    @cached_property
    def obs_dup(self) -> DataFrame:
        """Observations, and a second file that repeats one in seven with another value and takes precedence."""
        return self.obs.withColumn("prec", F.lit(1)).unionByName(self.obs.where("event_id % 7 = 0").withColumn("value", F.col("value") + 1).withColumn("prec", F.lit(0)))

    @cached_property
    def hourly(self) -> DataFrame:
        return rollup.hourly_rollup(self.obs, poll_interval_s=POLL_S)

    @cached_property
    def hourly_dst(self) -> DataFrame:
        return rollup.hourly_rollup(self.obs_dst, poll_interval_s=POLL_S)

    @cached_property
    def dim(self) -> DataFrame:
        return self.spark.createDataFrame([("leviton", *r) for r in _DIM], "source string, device_id string, channel_id string, label string, category string, panel string, is_primary boolean")

    @cached_property
    def meter(self) -> DataFrame:
        return self.meters()

    @cached_property
    def meter_dst(self) -> DataFrame:
        return self.meters(60)

    def meters(self, shift_days: int = 0) -> DataFrame:
        """Three meters at 900 s, and the same energy again at 3600 s."""
        e = self.table("events").select((F.col("ts").cast("timestamp_ntz") + F.expr(f"INTERVAL {shift_days} DAY")).alias("ts"), F.concat(F.lit("m"), (F.col("user_id") % 3).cast("string")).alias("device_id"), "value")
        hour = F.expr("CAST(date_trunc('HOUR', ts) AS TIMESTAMP_NTZ)")
        quarter = F.expr("CAST(date_trunc('HOUR', ts) AS TIMESTAMP_NTZ) + make_dt_interval(0, 0, CAST(floor(minute(ts) / 15) * 15 AS INT), 0)")
        parts = [e.groupBy("device_id", at.alias("ts_utc")).agg((F.sum("value") / 1000).alias("value")).withColumn("interval_s", F.lit(s)) for at, s in ((quarter, 900), (hour, 3600))]
        both = parts[0].unionByName(parts[1])
        return both.select("ts_utc", local("ts_utc").alias("ts_local"), F.lit("lge").alias("source"), "device_id", F.lit("meter").alias("channel_id"), F.lit("kwh_interval").alias("metric"), "value", F.lit("kWh").alias("unit"), "interval_s")

    @cached_property
    def daily(self) -> DataFrame:
        """Day-grain energy of five components."""
        o = self.table("orders")
        component = F.regexp_replace(F.lower(F.regexp_extract("o_orderpriority", "^[0-9]-(.*)$", 1)), " ", "_")
        return o.groupBy(F.col("o_orderdate").cast("date").alias("local_day"), component.alias("channel_id")).agg((F.sum("o_totalprice") / 1000).alias("kwh"), (F.sum("o_totalprice") / 9000).alias("usd"))

    @cached_property
    def rates(self) -> DataFrame:
        d = "decimal(12,6)"
        raw = self.spark.createDataFrame(list(_RATES), "meter string, effective_from string, basic string, energy string, dsm string")
        return raw.select("meter", F.to_date("effective_from").alias("effective_from"), *(F.col(c).cast(d).alias(c) for c in ("basic", "energy", "dsm")))

    @cached_property
    def cycles(self) -> DataFrame:
        raw = self.spark.createDataFrame(list(_CYCLES), "meter string, cycle_start string, cycle_end string, fuel string, env_pct string, rar_pct string, pgr_pct string, hea string")
        return raw.select("meter", F.to_date("cycle_start").alias("cycle_start"), F.to_date("cycle_end").alias("cycle_end"), *(F.col(c).cast("decimal(12,6)").alias(c) for c in ("fuel", "env_pct", "rar_pct", "pgr_pct", "hea")))


def _values(rows: tuple, types: tuple) -> str:
    cell = lambda v, t: "CAST(NULL AS " + t + ")" if v is None else f"CAST('{v}' AS {t})"
    return ", ".join("(" + ", ".join(cell(v, t) for v, t in zip(r, types, strict=True)) + ")" for r in rows)


def local_sql(ts: str) -> str:
    return f"(({ts} AT TIME ZONE 'UTC') AT TIME ZONE '{TZ}')"


def utc_sql(ts: str) -> str:
    return f"(({ts} AT TIME ZONE '{TZ}') AT TIME ZONE 'UTC')"


def _obs_sql(name: str, days: int) -> str:
    ts = f"(ts + INTERVAL {days} DAY)"
    names = ", ".join(f"'{c}'" for c in CHANNELS)
    return f"""{name} AS (SELECT {ts} AS ts_utc, {local_sql(ts)} AS ts_local, 'leviton' AS source, 'hub' || CAST((user_id // 8) % 2 AS VARCHAR) AS device_id, list_element([{names}], CAST(user_id % 8 + 1 AS INTEGER)) AS channel_id,
CASE WHEN user_id % 8 = 7 THEN 'volts' ELSE 'watts' END AS metric, value, CASE WHEN user_id % 8 = 7 THEN 'V' ELSE 'W' END AS unit, event_id, user_id, event_type, props FROM events)"""


def hourly_sql(name: str, source: str, poll_s: int = POLL_S) -> str:
    """The hourly rollup of a deduplicated relation, as SQL."""
    return f"""{name} AS (SELECT hour_start_utc, {local_sql("hour_start_utc")} AS local_hour_start, source, device_id, channel_id, metric, min(unit) AS unit, avg(value) AS mean, min(value) AS min, max(value) AS max, quantile_cont(value, 0.95) AS p95,
count(*) AS sample_count, CASE WHEN metric = 'watts' THEN avg(value) * count(*) * {poll_s} / 3.6e6 END AS kwh, CASE WHEN metric = 'watts' THEN count(*) * {poll_s} END AS observed_seconds, min(ts_utc) AS first_ts_utc, max(ts_utc) AS last_ts_utc
FROM (SELECT *, date_trunc('hour', ts_utc) AS hour_start_utc FROM {source}) WHERE metric NOT IN ('kwh_day', 'cost_day_usd') GROUP BY hour_start_utc, source, device_id, channel_id, metric)"""


def _meter_sql(name: str, days: int) -> str:
    ts = f"(ts + INTERVAL {days} DAY)"
    return f"""{name} AS (SELECT ts_utc, {local_sql("ts_utc")} AS ts_local, device_id, value, interval_s FROM (
SELECT 'm' || CAST(user_id % 3 AS VARCHAR) AS device_id, date_trunc('hour', {ts}) + to_minutes(CAST(floor(minute({ts}) / 15) * 15 AS INTEGER)) AS ts_utc, sum(value) / 1000 AS value, 900 AS interval_s FROM events GROUP BY ALL
UNION ALL SELECT 'm' || CAST(user_id % 3 AS VARCHAR), date_trunc('hour', {ts}), sum(value) / 1000, 3600 FROM events GROUP BY ALL))"""


def day_hours_sql(day: str) -> str:
    """The number of hours of a local day."""
    return f"date_diff('hour', {utc_sql(f'CAST({day} AS TIMESTAMP)')}, {utc_sql(f'CAST({day} + 1 AS TIMESTAMP)')})"


CTE = {
    "obs": _obs_sql("obs", 0),
    "obs_dst": _obs_sql("obs_dst", 60),
    "obs_dup": "obs_dup AS (SELECT *, 1 AS prec FROM obs UNION ALL SELECT * REPLACE (value + 1 AS value), 0 AS prec FROM obs WHERE event_id % 7 = 0)",
    "hourly": hourly_sql("hourly", "obs"),
    "hourly_dst": hourly_sql("hourly_dst", "obs_dst"),
    "dim": "dim AS (SELECT * FROM (VALUES " + _values(tuple(("leviton", *r) for r in _DIM), ("VARCHAR",) * 6 + ("BOOLEAN",)) + ") t(source, device_id, channel_id, label, category, panel, is_primary))",
    "meter": _meter_sql("meter", 0),
    "meter_dst": _meter_sql("meter_dst", 60),
    "daily": "daily AS (SELECT CAST(o_orderdate AS DATE) AS local_day, replace(lower(regexp_extract(o_orderpriority, '^[0-9]-(.*)$', 1)), ' ', '_') AS channel_id, sum(o_totalprice) / 1000 AS kwh, sum(o_totalprice) / 9000 AS usd FROM orders GROUP BY ALL)",
    "rates": "rates AS (SELECT * FROM (VALUES " + _values(_RATES, ("VARCHAR", "DATE", *("DECIMAL(12,6)",) * 3)) + ") t(meter, effective_from, basic, energy, dsm))",
    "cycles": "cycles AS (SELECT * FROM (VALUES " + _values(_CYCLES, ("VARCHAR", "DATE", "DATE", *("DECIMAL(12,6)",) * 5)) + ") t(meter, cycle_start, cycle_end, fuel, env_pct, rar_pct, pgr_pct, hea))",
}
_NEEDS = {"obs_dup": ("obs",), "hourly": ("obs",), "hourly_dst": ("obs_dst",)}


def sql(names: str, body: str) -> str:
    """``body`` after the named views (and those they need); further expressions may be given as ``name AS (...)`` first in body."""
    order: list[str] = []
    for n in names.split():
        order += [x for x in (*_NEEDS.get(n, ()), n) if x not in order]
    head = ",\n".join(CTE[n] for n in order)
    body = body.strip()
    return f"WITH {head}{',' if body.startswith(';') else ''}\n{body.removeprefix(';').strip()}"
