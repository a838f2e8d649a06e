"""Rollup, projections, aggregates and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import storage
from ..functions import localtime as lt
from ..functions import scalar as s
from ..functions.ranges import report_range
from ..operators import aggregates as a
from ..operators import coverage as cov
from ..operators import dedupe, rollup
from ..schemas import CHANNEL, HOURLY, OBSERVATION, conform, tolerant
from ..views import POLL_S, hourly_sql, local_sql, utc_sql
from ..vocab import DAY_GRAIN, UNIT_FOR_METRIC
from .registry import Registry

REGISTRY = Registry()
q = REGISTRY.add
NOW = "2024-01-20 12:30:00"
FEED = "channel_id IN ('ct_1_a', 'ct_1_b')"
LEVEL = "CASE WHEN channel_id IN ('ct_1_a', 'ct_1_b') THEN 'feed' WHEN channel_id LIKE 'ct_2%' THEN 'subfeed' WHEN channel_id LIKE 'breaker_%' THEN 'branch' WHEN channel_id LIKE 'panel_leg_%' THEN 'reference' ELSE 'other' END"
DAY = "CAST(local_hour_start AS DATE)"
STATS = "mean min max p95 kwh"

# ------------------------------------------------------------------------------------------------- scans and projections
q("I01_read_observations", lambda v: conform(v.obs, OBSERVATION).where("ts_utc >= TIMESTAMP_NTZ'2024-01-10 05:00:00' AND ts_utc < TIMESTAMP_NTZ'2024-01-12 05:00:00'"), "obs", "SELECT ts_utc, ts_local, source, device_id, channel_id, metric, value, unit FROM obs WHERE ts_utc >= '2024-01-10 05:00:00' AND ts_utc < '2024-01-12 05:00:00'", doubles="value")
def _mixed_files(v):
    """Hourly files from before a column was added, and after, read as one table."""
    path, day = storage.new_path(v.spark, "hourly-mixed"), F.to_date("local_hour_start")
    v.hourly.where(day < F.lit("2024-01-15").cast("date")).drop("observed_seconds").write.parquet(path)
    v.hourly.where(day >= F.lit("2024-01-15").cast("date")).write.mode("append").parquet(path)
    return storage.read_tolerant(v.spark, path, HOURLY).groupBy("metric").agg(F.count("observed_seconds").alias("known"), F.count("*").alias("n"), F.sum("kwh").alias("kwh"))


def _month_files(v):
    """Day-grain energy in files by month, read back for a range of days that starts and ends within months."""
    path = storage.new_path(v.spark, "daily")
    storage.write_days(v.daily.withColumn("local_month", F.date_format("local_day", "yyyy-MM")), path, day="local_month")
    return storage.read_months(v.spark, path, v.daily.schema, "1996-01-10", "1997-02-20")


q("I02_tolerant_hourly", _mixed_files, "hourly", f"SELECT metric, count(*) FILTER (WHERE observed_seconds IS NOT NULL AND {DAY} >= DATE '2024-01-15') AS known, count(*) AS n, sum(kwh) AS kwh FROM hourly GROUP BY ALL", doubles="kwh")
q("I04_read_daily", _month_files, "daily", "SELECT * FROM daily WHERE local_day BETWEEN DATE '1996-01-10' AND DATE '1997-02-20'", doubles="kwh usd")
q("I05_contract", lambda v: conform(v.obs, OBSERVATION).groupBy("source", "metric", "unit").agg(F.count("*").alias("n"), F.sum("value").alias("total")), "obs", "SELECT source, metric, unit, count(*) AS n, sum(value) AS total FROM obs GROUP BY ALL", doubles="total", digits=4)
q("I19_window_or_predicates", lambda v: v.obs.where("ts_utc >= TIMESTAMP_NTZ'2024-01-05 00:00:00' AND ts_utc < TIMESTAMP_NTZ'2024-01-09 00:00:00'").where("(source = 'leviton' AND metric = 'watts' AND channel_id LIKE 'ct%') OR (source = 'leviton' AND metric = 'volts')").select("event_id", *CHANNEL, "metric", "value"), "obs", "SELECT event_id, source, device_id, channel_id, metric, value FROM obs WHERE ts_utc >= '2024-01-05' AND ts_utc < '2024-01-09' AND ((source = 'leviton' AND metric = 'watts' AND channel_id LIKE 'ct%') OR (source = 'leviton' AND metric = 'volts'))", doubles="value")


def _wide(v):
    """A row per instant and device bucket with a column for each metric, back to long form."""
    wide = v.obs.groupBy("device_id", "channel_id", lt.hour("ts_utc").alias("hour")).agg(F.max(F.when(F.col("metric") == "watts", F.col("value"))).alias("watts"), F.max(F.when(F.col("metric") == "volts", F.col("value"))).alias("volts"))
    return wide.unpivot(["device_id", "channel_id", "hour"], ["watts", "volts"], "metric", "value").where("value IS NOT NULL")


q("P01_wide_to_long", _wide, "obs", "SELECT device_id, channel_id, date_trunc('hour', ts_utc) AS hour, metric, max(value) AS value FROM obs GROUP BY ALL", doubles="value")
q("P02_gap_drop", lambda v: v.obs.withColumn("x", F.when(F.col("event_id") % 10 == 0, F.lit(float("nan"))).when(F.col("event_id") % 10 == 1, F.lit(float("inf"))).when(F.col("event_id") % 10 == 2, F.lit(None)).otherwise(F.col("value"))).groupBy(*CHANNEL).agg(F.count(s.finite("x")).alias("rows"), F.count_if(s.finite("x").isNull()).alias("gaps")), "obs", "SELECT source, device_id, channel_id, count(*) FILTER (WHERE event_id % 10 > 2) AS rows, count(*) FILTER (WHERE event_id % 10 <= 2) AS gaps FROM obs GROUP BY ALL")
q("P03_two_pole", lambda v: v.obs.select("event_id", s.two_pole(F.lit(1) + F.col("event_id") % 2, "value", F.when(F.col("event_id") % 5 > 0, F.col("value") * 2)).alias("watts"), s.two_pole(F.lit(1) + F.col("event_id") % 2, "value", F.when(F.col("event_id") % 5 > 0, F.col("value") * 2), "mean").alias("amps")).where("watts IS NOT NULL"), "obs", "SELECT event_id, CASE WHEN event_id % 2 = 1 THEN value * 3 ELSE value END AS watts, CASE WHEN event_id % 2 = 1 THEN value * 1.5 ELSE value END AS amps FROM obs WHERE NOT (event_id % 2 = 1 AND event_id % 5 = 0)", doubles="watts amps")
q("P05_channel_names", lambda v: v.obs.select("channel_id", s.channel_name().alias("name")).distinct(), "obs", "SELECT DISTINCT channel_id, CASE WHEN channel_id LIKE 'breaker_p%' THEN 'Breaker ' || regexp_extract(channel_id, '([0-9]+)$', 1) WHEN channel_id LIKE 'ct_%' THEN 'CT ' || regexp_extract(channel_id, '^ct_([0-9]+)', 1) || ' leg ' || upper(right(channel_id, 1)) ELSE 'Panel leg ' || upper(right(channel_id, 1)) END AS name FROM obs")
q("P06_vocabulary", lambda v: v.obs.withColumn("metric", F.when(F.col("event_id") % 11 == 0, "furlongs").otherwise(F.col("metric"))).groupBy("metric", F.col("metric").isin(*UNIT_FOR_METRIC).alias("known")).agg(F.count("*").alias("n")), "obs", "SELECT CASE WHEN event_id % 11 = 0 THEN 'furlongs' ELSE metric END AS metric, event_id % 11 <> 0 AS known, count(*) AS n FROM obs GROUP BY ALL")
q("P07_day_grain_guard", lambda v: v.obs.withColumn("metric", F.when(F.col("event_id") % 13 == 0, "kwh_day").otherwise(F.col("metric"))).groupBy(F.col("metric").isin(*DAY_GRAIN).alias("day_grain")).agg(F.count("*").alias("n")), "obs", "SELECT event_id % 13 = 0 AS day_grain, count(*) AS n FROM obs GROUP BY ALL")
q("P08_local_clock", lambda v: v.obs_dst.withColumn("claimed", F.when(F.col("event_id") % 17 == 0, F.col("ts_utc")).otherwise(F.col("ts_local"))).groupBy(F.to_date("ts_local").alias("local_day")).agg(F.count_if(F.col("claimed") != lt.local("ts_utc")).alias("mismatched"), F.count("*").alias("n")), "obs_dst", "SELECT CAST(ts_local AS DATE) AS local_day, count(*) FILTER (WHERE event_id % 17 = 0) AS mismatched, count(*) AS n FROM obs_dst GROUP BY ALL")
q("P10_enum_encode", lambda v: v.obs.groupBy("event_type").agg(F.count("*").alias("n")).withColumn("word", F.when(F.col("event_type") == "click", " Cool ").when(F.col("event_type") == "view", "heat").otherwise(F.col("event_type"))).select("word", s.encode("mode", "word").alias("code"), "n"), "obs", "SELECT CASE event_type WHEN 'click' THEN ' Cool ' WHEN 'view' THEN 'heat' ELSE event_type END AS word, CASE event_type WHEN 'click' THEN 2 WHEN 'view' THEN 1 END AS code, count(*) AS n FROM obs GROUP BY ALL")
q("P11_enum_decode", lambda v: v.obs.select((F.col("event_id") % 12).alias("code")).groupBy("code").agg(F.count("*").alias("n")).withColumn("word", s.decode("mode", "code")), "obs", "SELECT event_id % 12 AS code, count(*) AS n, coalesce(list_element(['off', 'heat', 'cool', 'auto', 'fanonly', 'hpheat', 'electric', 'gasheat', 'dehumidify'], CAST(event_id % 12 + 1 AS INTEGER)), CAST(event_id % 12 AS VARCHAR)) AS word FROM obs GROUP BY ALL")
q("P12_stage_split", lambda v: v.obs.withColumn("opstat", F.when(F.col("event_id") % 3 == 0, "low").otherwise(F.round("value", 1).cast("string"))).select("event_id", s.encode("stage", "opstat").alias("stage"), s.stage_pct("opstat").alias("stage_pct")).where("stage IS NOT NULL OR stage_pct IS NOT NULL"), "obs", "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 1 END AS stage, CASE WHEN event_id % 3 <> 0 THEN round(value, 1) END AS stage_pct FROM obs WHERE event_id % 3 = 0 OR round(value, 1) BETWEEN 0 AND 100", doubles="stage_pct")
q("P13_temperature", lambda v: v.obs.select("event_id", s.fahrenheit("value", F.element_at(F.array(F.lit("F"), F.lit("C"), F.lit("K")), (F.col("event_id") % 3 + 1).cast("int"))).alias("f")).where("f IS NOT NULL"), "obs", "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN value ELSE value * 9 / 5 + 32 END AS f FROM obs WHERE event_id % 3 < 2", doubles="f")
q("P15_lenient_number", lambda v: v.table("events").select("event_id", s.number(F.when(F.col("event_id") % 4 == 0, "None").when(F.col("event_id") % 4 == 1, " ").when(F.col("event_id") % 4 == 2, "NaN").otherwise(F.concat(F.lit(" "), F.col("event_id").cast("string")))).alias("x")), "", "SELECT event_id, CASE WHEN event_id % 4 = 3 THEN CAST(event_id AS DOUBLE) END AS x FROM events", doubles="x")
q("P16_lenient_boolean", lambda v: v.table("events").groupBy("event_type").agg(F.count("*").alias("n")).select("n", s.truth(F.when(F.col("event_type") == "click", "YES").when(F.col("event_type") == "view", " off ").otherwise(F.col("event_type"))).alias("on")), "", "SELECT count(*) AS n, CASE event_type WHEN 'click' THEN true WHEN 'view' THEN false END AS \"on\" FROM events GROUP BY event_type")
q("P18_levels", lambda v: v.obs.groupBy(s.level().alias("level")).agg(F.count("*").alias("n"), F.countDistinct("channel_id").alias("channels")), "obs", f"SELECT {LEVEL} AS level, count(*) AS n, count(DISTINCT channel_id) AS channels FROM obs GROUP BY ALL")
q("P19_feed_children", lambda v: v.obs.groupBy("device_id").agg(F.count_if(s.level() == "feed").alias("feed_rows"), F.count_if(s.is_child()).alias("child_rows")), "obs", f"SELECT device_id, count(*) FILTER (WHERE {FEED}) AS feed_rows, count(*) FILTER (WHERE channel_id LIKE 'breaker_%' OR channel_id LIKE 'ct_2%') AS child_rows FROM obs GROUP BY ALL")
q("P20_unit_conversion", lambda v: v.table("events").select("event_id", s.to_kwh("value", (F.col("event_id") % 3).cast("double"), F.when(F.col("event_id") % 5 == 0, 38).otherwise(72)).alias("kwh")).where("kwh IS NOT NULL"), "", "SELECT event_id, value * pow(10, event_id % 3) / 1000 AS kwh FROM events WHERE event_id % 5 <> 0", doubles="kwh")
q("P21_category", lambda v: v.obs.groupBy("event_type").agg(F.count("*").alias("n")).select("event_type", "n", s.category(F.when(F.col("event_type") == "error", "feed"), F.when(F.col("event_type") == "click", "HVAC - outdoor").when(F.col("event_type") == "view", "Lighting/hall")).alias("category")), "obs", "SELECT event_type, count(*) AS n, CASE event_type WHEN 'click' THEN 'hvac' WHEN 'view' THEN 'lighting' WHEN 'error' THEN 'feed' END AS category FROM obs GROUP BY ALL")
q("P23_labels", lambda v: a.label(v.obs.select(*CHANNEL).distinct(), v.dim.select(*CHANNEL, "label")).select(*CHANNEL, s.label_or_tail("label").alias("label")), "obs dim", "SELECT DISTINCT o.source, o.device_id, o.channel_id, coalesce(label, o.channel_id || ' · ' || o.device_id) AS label FROM obs o LEFT JOIN dim d ON o.source = d.source AND o.device_id = d.device_id AND o.channel_id = d.channel_id")

# ------------------------------------------------------------------------------------------------------------- local time
q("L01_local_days", lambda v: lt.day_table(a.local_days(v.obs_dst)), "obs_dst", f"SELECT local_day, start_utc, end_utc, CAST(date_diff('hour', start_utc, end_utc) AS BIGINT) AS hours FROM (SELECT local_day, {utc_sql('CAST(local_day AS TIMESTAMP)')} AS start_utc, {utc_sql('CAST(local_day + 1 AS TIMESTAMP)')} AS end_utc FROM (SELECT DISTINCT CAST(ts_local AS DATE) AS local_day FROM obs_dst))")
q("L02_wall_hours", lambda v: lt.wall_hours(lt.hour_spine(a.local_days(v.obs_dst))), "obs_dst", f"SELECT local_day, hour({local_sql('h')}) AS wall_hour, min(h) AS start_utc, max(h) + INTERVAL 1 HOUR AS end_utc FROM (SELECT local_day, unnest(generate_series({utc_sql('CAST(local_day AS TIMESTAMP)')}, {utc_sql('CAST(local_day + 1 AS TIMESTAMP)')} - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS h FROM (SELECT DISTINCT CAST(ts_local AS DATE) AS local_day FROM obs_dst)) GROUP BY ALL")

# ----------------------------------------------------------------------------------------------------------------- rollup
q("R01_hourly_rollup", lambda v: rollup.hourly_rollup(dedupe.dedupe(v.obs_dup.select("ts_utc", *CHANNEL, "metric", "prec", "value", "unit"), precedence=["prec"]), POLL_S), "obs obs_dup", "; deduped AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source, device_id, channel_id, metric, ts_utc ORDER BY prec, value, unit) AS rn FROM obs_dup) WHERE rn = 1), " + hourly_sql("rolled", "deduped") + " SELECT * FROM rolled", doubles=STATS)
q("R01_hourly_rollup_dst", lambda v: rollup.hourly_rollup(v.obs_dst, POLL_S), "obs_dst", "; " + hourly_sql("rolled", "obs_dst") + " SELECT * FROM rolled", doubles=STATS)
q("R02_recent_rollup", lambda v: rollup.recent_rollup(v.obs, F.expr(f"TIMESTAMP_NTZ'{NOW}'"), POLL_S).select(*CHANNEL, "metric", "hour_start_utc", "mean", "sample_count", "expected", "coverage_pct", "status"), "obs", f"; hours AS (SELECT source, device_id, channel_id, metric, date_trunc('hour', ts_utc) AS hour_start_utc, avg(value) AS mean, count(*) AS sample_count FROM obs WHERE ts_utc <= '{NOW}' GROUP BY ALL), e AS (SELECT *, CAST(greatest(round_even(date_diff('second', hour_start_utc, least(hour_start_utc + INTERVAL 1 HOUR, TIMESTAMP '{NOW}')) / {POLL_S}, 0), 1) AS BIGINT) AS expected FROM hours), p AS (SELECT *, least(sample_count / expected * 100, 100) AS coverage_pct FROM e) SELECT *, CASE WHEN coverage_pct >= 98 THEN 'complete' WHEN coverage_pct >= 80 THEN 'thin' WHEN coverage_pct >= 50 THEN 'sparse' ELSE 'mostly missing' END AS status FROM p", doubles="mean coverage_pct")
q("R03_cadence", lambda v: rollup.cadence(v.obs, 3600), "obs", "; d AS (SELECT ts_local, date_diff('microsecond', lag(ts_utc) OVER (PARTITION BY source, device_id, channel_id, metric ORDER BY ts_utc), ts_utc) // 1000000 AS delta_s FROM obs), m AS (SELECT CAST(ts_local AS DATE) AS local_day, median(delta_s) AS observed_s, count(*) AS n FROM d WHERE delta_s >= 1 GROUP BY ALL) SELECT *, CASE WHEN n >= 20 THEN abs(observed_s - 3600) <= 900 END AS agrees FROM m", doubles="observed_s")
q("A36_reconcile", lambda v: rollup.reconcile(v.obs, v.hourly), "obs hourly", "SELECT (SELECT count(*) FROM obs) AS raw_rows, (SELECT CAST(sum(sample_count) AS BIGINT) FROM hourly) AS rolled_rows")

# ------------------------------------------------------------------------------------------------------------------ joins
q("J01_hour_buckets", lambda v: rollup.in_spine(v.obs, lt.hour_spine(v.obs.select(F.to_date("ts_local").alias("local_day")))).groupBy("local_day", "hour_start_utc").agg(F.count("*").alias("n")), "obs", f"; days AS (SELECT DISTINCT CAST(ts_local AS DATE) AS d FROM obs), spine AS (SELECT d AS local_day, unnest(generate_series({utc_sql('CAST(d AS TIMESTAMP)')}, {utc_sql('CAST(d + 1 AS TIMESTAMP)')} - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS h FROM days) SELECT local_day, h AS hour_start_utc, count(*) AS n FROM obs JOIN spine ON ts_utc >= h AND ts_utc < h + INTERVAL 1 HOUR GROUP BY ALL")
q("J02_dim_left", lambda v: a.label(a.daily_kwh(v.hourly), v.dim.select(*CHANNEL, "label", "category")).groupBy("label", "category").agg(F.sum("kwh").alias("kwh"), F.count("*").alias("n")), "hourly dim", f"; k AS (SELECT source, device_id, channel_id, {DAY} AS d, sum(kwh) AS kwh FROM hourly WHERE metric = 'watts' GROUP BY ALL) SELECT label, category, sum(kwh) AS kwh, count(*) AS n FROM k LEFT JOIN dim USING (source, device_id, channel_id) GROUP BY ALL", doubles="kwh")
q("J03_dim_category", lambda v: a.label(v.hourly, v.dim.where("category = 'hvac'").select(*CHANNEL, "label"), "inner").groupBy("label").agg(F.sum("kwh").alias("kwh"), F.max("max").alias("peak")), "hourly dim", "SELECT label, sum(kwh) AS kwh, max(max) AS peak FROM hourly JOIN dim USING (source, device_id, channel_id) WHERE category = 'hvac' GROUP BY ALL", doubles="kwh peak")
q("J05_feed_vs_children_hours", lambda v: v.hourly.where("metric = 'watts'").where(s.level() == "feed").groupBy("device_id", "hour_start_utc").agg(F.sum("mean").alias("feed_w")).join(v.hourly.where("metric = 'watts'").where(s.is_child()).groupBy("device_id", "hour_start_utc").agg(F.sum("mean").alias("children_w")), ["device_id", "hour_start_utc"]), "hourly", f"SELECT * FROM (SELECT device_id, hour_start_utc, sum(mean) AS feed_w FROM hourly WHERE metric = 'watts' AND {FEED} GROUP BY ALL) JOIN (SELECT device_id, hour_start_utc, sum(mean) AS children_w FROM hourly WHERE metric = 'watts' AND (channel_id LIKE 'breaker_%' OR channel_id LIKE 'ct_2%') GROUP BY ALL) USING (device_id, hour_start_utc)", doubles="feed_w children_w")
q("J06_absent_hours", lambda v: cov.absent_hours(v.hourly).groupBy(*CHANNEL, "metric").agg(F.count("*").alias("absent"), F.min("hour_start_utc").alias("first"), F.max("hour_start_utc").alias("last")), "hourly", f"; days AS (SELECT DISTINCT {DAY} AS d FROM hourly), spine AS (SELECT unnest(generate_series({utc_sql('CAST(d AS TIMESTAMP)')}, {utc_sql('CAST(d + 1 AS TIMESTAMP)')} - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS hour_start_utc FROM days), series AS (SELECT DISTINCT source, device_id, channel_id, metric FROM hourly) SELECT source, device_id, channel_id, metric, count(*) AS absent, min(hour_start_utc) AS first, max(hour_start_utc) AS last FROM (SELECT * FROM spine CROSS JOIN series) x ANTI JOIN hourly USING (source, device_id, channel_id, metric, hour_start_utc) GROUP BY ALL")
q("J08_unmapped", lambda v: __import__("gridloom.operators.dimension", fromlist=["unmapped"]).unmapped(v.obs, v.dim).select(*CHANNEL), "obs dim", "SELECT DISTINCT source, device_id, channel_id FROM obs ANTI JOIN dim USING (source, device_id, channel_id)")
q("J14_expected_counts", lambda v: cov.matrix(v.hourly, POLL_S).groupBy("local_day").agg(F.max("expected").alias("expected"), F.count("*").alias("series")), "hourly", f"SELECT {DAY} AS local_day, CAST(24 * 3600 / {POLL_S} AS BIGINT) AS expected, count(DISTINCT source || device_id || channel_id || metric) AS series FROM hourly GROUP BY ALL")
q("J17_excluded_metrics", lambda v: v.obs.join(v.spark.createDataFrame([(m,) for m in (*DAY_GRAIN, "volts")], "metric string"), "metric", "left_anti").groupBy("metric").agg(F.count("*").alias("n")), "obs", "SELECT metric, count(*) AS n FROM obs WHERE metric <> 'volts' GROUP BY ALL")

# ------------------------------------------------------------------------------------------------------------- aggregates
q("A01_daily_kwh", lambda v: a.label(a.daily_kwh(rollup.hourly_rollup(dedupe.dedupe(v.obs_dup.select("ts_utc", *CHANNEL, "metric", "prec", "value", "unit"), precedence=["prec"]), POLL_S), 50.0), v.dim.select(*CHANNEL, "label")), "obs obs_dup dim", "; deduped AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source, device_id, channel_id, metric, ts_utc ORDER BY prec, value, unit) AS rn FROM obs_dup) WHERE rn = 1), " + hourly_sql("hourly", "deduped") + f" SELECT source, device_id, channel_id, {DAY} AS local_day, sum(kwh) AS kwh, CAST(sum(observed_seconds) AS BIGINT) AS observed_seconds, count(*) AS hours, max(max) AS peak_w, count(*) FILTER (WHERE mean >= 50) AS busy_hours, any_value(label) AS label FROM hourly LEFT JOIN dim USING (source, device_id, channel_id) WHERE metric = 'watts' GROUP BY source, device_id, channel_id, {DAY}", doubles="kwh peak_w")
q("A02_circuits", lambda v: a.circuits(v.hourly, v.dim, POLL_S, "2024-01-05", "2024-01-20"), "hourly dim", f"SELECT source, device_id, channel_id, sum(kwh) AS kwh, max(max) AS peak_w, CAST(sum(sample_count) AS BIGINT) AS samples, count(*) AS hours, count(DISTINCT {DAY}) AS days, min({DAY}) AS first_day, max({DAY}) AS last_day, any_value(label) AS label, any_value(category) AS category, {LEVEL} AS level, sum(sample_count) / (16 * 86400 / {POLL_S}) * 100 AS coverage_pct FROM hourly LEFT JOIN dim USING (source, device_id, channel_id) WHERE metric = 'watts' AND {DAY} BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' GROUP BY source, device_id, channel_id", doubles="kwh peak_w coverage_pct")
q("A02_circuits_dst", lambda v: a.circuits(v.hourly_dst, v.dim, POLL_S, "2024-03-05", "2024-03-20"), "hourly_dst dim", f"SELECT source, device_id, channel_id, sum(kwh) AS kwh, max(max) AS peak_w, CAST(sum(sample_count) AS BIGINT) AS samples, count(*) AS hours, count(DISTINCT {DAY}) AS days, min({DAY}) AS first_day, max({DAY}) AS last_day, any_value(label) AS label, any_value(category) AS category, {LEVEL} AS level, sum(sample_count) / ((16 * 86400 - 3600) / {POLL_S}) * 100 AS coverage_pct FROM hourly_dst LEFT JOIN dim USING (source, device_id, channel_id) WHERE metric = 'watts' AND {DAY} BETWEEN DATE '2024-03-05' AND DATE '2024-03-20' GROUP BY source, device_id, channel_id", doubles="kwh peak_w coverage_pct")
q("A03_circuit_days", lambda v: a.circuit_days(v.hourly), "hourly", f"SELECT {DAY} AS local_day, device_id || '/' || channel_id AS series, {LEVEL} AS level, sum(kwh) AS kwh FROM hourly WHERE metric = 'watts' GROUP BY ALL", doubles="kwh")
q("A04_level_totals", lambda v: a.level_totals(v.hourly), "hourly", f"SELECT {LEVEL} AS level, sum(kwh) AS kwh, count(DISTINCT device_id || '/' || channel_id) AS channels FROM hourly WHERE metric = 'watts' GROUP BY ALL", doubles="kwh")
q("A05_panel_days", lambda v: a.panel_days(v.hourly), "hourly", f"SELECT local_day, sum(kwh) AS kwh, count(*) AS series, CAST(min(n) AS BIGINT) AS worst_samples FROM (SELECT {DAY} AS local_day, source, device_id, channel_id, sum(kwh) AS kwh, sum(sample_count) AS n FROM hourly WHERE metric = 'watts' AND {FEED} GROUP BY ALL) GROUP BY ALL", doubles="kwh")
q("A07_panel_daily", lambda v: a.panel_daily(v.hourly), "hourly", f"SELECT {DAY} AS local_day, sum(kwh) AS kwh, CAST(sum(observed_seconds) AS BIGINT) AS observed_seconds, count(DISTINCT device_id || '/' || channel_id) AS channels FROM hourly WHERE metric = 'watts' AND {FEED} GROUP BY ALL", doubles="kwh")
q("A08_component_months", lambda v: a.component_months(v.daily), "daily", "SELECT strftime(local_day, '%Y-%m') AS month, channel_id, sum(kwh) AS kwh, sum(usd) AS usd, count(*) AS days, false AS always_zero FROM daily GROUP BY ALL", doubles="kwh usd")
q("A09_coverage_matrix", lambda v: cov.matrix(rollup.hourly_rollup(v.obs_dst, POLL_S), POLL_S), "obs_dst", "; " + hourly_sql("h", "obs_dst") + f", d AS (SELECT {DAY} AS local_day, source, device_id, channel_id, metric, CAST(sum(sample_count) AS BIGINT) AS samples FROM h GROUP BY ALL), e AS (SELECT *, CAST(date_diff('hour', {utc_sql('CAST(local_day AS TIMESTAMP)')}, {utc_sql('CAST(local_day + 1 AS TIMESTAMP)')}) AS BIGINT) AS hours FROM d), p AS (SELECT *, CAST(hours * 3600 / {POLL_S} AS BIGINT) AS expected, samples / (hours * 3600 / {POLL_S}) * 100 AS coverage_pct FROM e) SELECT *, CASE WHEN coverage_pct >= 98 THEN 'complete' WHEN coverage_pct >= 80 THEN 'thin' WHEN coverage_pct >= 50 THEN 'sparse' ELSE 'mostly missing' END AS status FROM p", doubles="coverage_pct")
q("A10_pivot", lambda v: a.pivoted(v.obs, [lt.bucket("ts_utc", 3600).alias("bucket"), F.col("device_id")], {"max_volts": F.max(F.when(F.col("metric") == "volts", F.col("value"))), "mean_watts": F.avg(F.when(F.col("metric") == "watts", F.col("value")))}), "obs", "SELECT date_trunc('hour', ts_utc) AS bucket, device_id, max(value) FILTER (WHERE metric = 'volts') AS max_volts, avg(value) FILTER (WHERE metric = 'watts') AS mean_watts FROM obs GROUP BY ALL", doubles="max_volts mean_watts")
q("A11_sum_then_mean", lambda v: a.instant_sum_mean(v.obs.withColumn("ts_utc", lt.bucket("ts_utc", 600)), lt.bucket("ts_utc", 7200)), "obs", "SELECT bucket, device_id, avg(w) AS mean_w, count(*) AS instants FROM (SELECT time_bucket(INTERVAL '7200 seconds', t, TIMESTAMP '1970-01-01') AS bucket, device_id, t, sum(value) AS w FROM (SELECT *, time_bucket(INTERVAL '600 seconds', ts_utc, TIMESTAMP '1970-01-01') AS t FROM obs WHERE metric = 'watts') GROUP BY ALL) GROUP BY ALL", doubles="mean_w")
q("A12_mean_then_sum", lambda v: a.leg_mean_sum(v.obs, lt.bucket("ts_utc", 7200), ["ct_1_a", "ct_1_b"]), "obs", f"SELECT bucket, device_id, sum(w) AS watts, count(*) AS legs, min(n) AS worst_samples FROM (SELECT time_bucket(INTERVAL '7200 seconds', ts_utc, TIMESTAMP '1970-01-01') AS bucket, device_id, channel_id, avg(value) AS w, count(*) AS n FROM obs WHERE {FEED} GROUP BY ALL) GROUP BY ALL", doubles="watts")
q("A13_panel_hours", lambda v: a.panel_hours(v.hourly, ["ct_1_a", "ct_1_b"]), "hourly", f"SELECT hour_start_utc, sum(kwh) AS panel_kwh, min(sample_count) AS worst_samples, count(DISTINCT device_id || '/' || channel_id) AS series FROM hourly WHERE metric = 'watts' AND {FEED} GROUP BY ALL", doubles="panel_kwh")
q("A20_extremes", lambda v: a.extremes(v.hourly, "volts"), "hourly", f"SELECT {DAY} AS local_day, min(min) AS low, max(max) AS high FROM hourly WHERE metric = 'volts' GROUP BY ALL", doubles="low high")
q("A21_modulation", lambda v: a.modulation(v.hourly.where("metric = 'volts'")), "hourly", f"SELECT source, device_id, channel_id, {DAY} AS local_day, max(mean) - min(mean) AS span FROM hourly WHERE metric = 'volts' GROUP BY ALL", doubles="span")
q("A22_night_floor", lambda v: a.night_floor(v.hourly), "hourly", f"SELECT local_day, min(w) AS floor_w, count(*) AS night_hours FROM (SELECT hour_start_utc, {DAY} AS local_day, sum(mean) AS w FROM hourly WHERE metric = 'watts' AND {FEED} AND hour(local_hour_start) BETWEEN 1 AND 4 GROUP BY ALL) GROUP BY ALL", doubles="floor_w")
q("A27_observed_energy", lambda v: a.observed_energy(v.obs, lt.bucket("ts_utc", 3600), 3600, POLL_S), "obs", f"SELECT source, device_id, channel_id, sum(w * least(3600, n * {POLL_S})) / 3.6e6 AS kwh, CAST(sum(least(3600, n * {POLL_S})) AS DOUBLE) AS observed_s FROM (SELECT source, device_id, channel_id, date_trunc('hour', ts_utc) AS b, avg(value) AS w, count(*) AS n FROM obs WHERE metric = 'watts' GROUP BY ALL) GROUP BY ALL", doubles="kwh observed_s")
q("A29_series_summary", lambda v: a.series_summary(v.obs, "2024-01-05 00:00:00", "2024-01-15 00:00:00", POLL_S), "obs", f"SELECT source, device_id, channel_id, metric, count(*) AS n, count(*) FILTER (WHERE value = 0) AS zeros, min(value) AS min, max(value) AS max, avg(value) AS mean, count(*) / (864000 / {POLL_S}) * 100 AS coverage_pct FROM obs WHERE ts_utc >= '2024-01-05' AND ts_utc < '2024-01-15' GROUP BY ALL", doubles="min max mean coverage_pct")
q("A35_kpi", lambda v: a.kpi(v.hourly), "hourly", f"; d AS (SELECT device_id, channel_id, {DAY} AS local_day, sum(kwh) AS kwh FROM hourly WHERE metric = 'watts' GROUP BY ALL), b AS (SELECT device_id || '/' || channel_id AS k, sum(kwh) AS kwh FROM d WHERE channel_id LIKE 'breaker_%' GROUP BY ALL) SELECT (SELECT sum(kwh) FROM d WHERE {FEED}) AS house_kwh, (SELECT count(DISTINCT local_day) FROM d) AS days, (SELECT arg_max(k, kwh) FROM b) AS top_branch, (SELECT max(kwh) FROM b) AS top_kwh", doubles="house_kwh top_kwh")
q("P09_exclude_day_grain", lambda v: rollup.hourly_rollup(v.obs.withColumn("metric", F.when(F.col("event_id") % 13 == 0, "kwh_day").otherwise(F.col("metric"))), POLL_S).groupBy("metric").agg(F.sum("sample_count").alias("n")), "obs", "SELECT metric, count(*) AS n FROM obs WHERE event_id % 13 <> 0 GROUP BY ALL")
q("P22_channel_display", lambda v: a.label(v.obs.select(*CHANNEL).distinct(), v.dim.select(*CHANNEL, "label")).select("device_id", "channel_id", F.coalesce("label", s.channel_name()).alias("name")), "obs dim", "SELECT DISTINCT o.device_id, o.channel_id, coalesce(label, CASE WHEN o.channel_id LIKE 'breaker_p%' THEN 'Breaker ' || regexp_extract(o.channel_id, '([0-9]+)$', 1) WHEN o.channel_id LIKE 'ct_%' THEN 'CT ' || regexp_extract(o.channel_id, '^ct_([0-9]+)', 1) || ' leg ' || upper(right(o.channel_id, 1)) ELSE 'Panel leg ' || upper(right(o.channel_id, 1)) END) AS name FROM obs o LEFT JOIN dim d ON o.source = d.source AND o.device_id = d.device_id AND o.channel_id = d.channel_id")


def _in_range(v):
    first, last = report_range("2024-01-03", "2024-01-12")
    return a.daily_kwh(v.hourly).where(F.col("local_day").between(F.lit(first), F.lit(last))).groupBy("local_day").agg(F.sum("kwh").alias("kwh"))


q("P25_report_range", _in_range, "hourly", f"SELECT {DAY} AS local_day, sum(kwh) AS kwh FROM hourly WHERE metric = 'watts' AND {DAY} BETWEEN DATE '2024-01-03' AND DATE '2024-01-12' GROUP BY ALL", doubles="kwh")
