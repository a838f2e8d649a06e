"""Meters, tariffs and bills."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import localtime as lt
from ..operators import aggregates as a
from ..operators import meters as m
from ..operators import tariffs as t
from ..schemas import CHANNEL
from ..views import POLL_S, local_sql, utc_sql
from .basic import DAY, FEED
from .registry import Registry

REGISTRY = Registry()
q = REGISTRY.add
DEVICE = "m0"
FINE = "; fine AS (SELECT *, CAST(ts_local AS DATE) AS local_day FROM meter WHERE interval_s = 900)"
_USAGE = "usage AS (SELECT device_id AS meter, local_day, sum(value) AS kwh, count(*) AS n FROM fine GROUP BY ALL)"
_DAYS = "billed AS (SELECT meter, cycle_start, cycle_end, CAST(unnest(generate_series(CAST(cycle_start + 1 AS TIMESTAMP), CAST(cycle_end AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS local_day FROM cycles)"
_PERIODS = "periods AS (SELECT *, lead(effective_from) OVER (PARTITION BY meter ORDER BY effective_from) AS effective_to FROM rates)"
_PRICED_DAYS = "priced AS (SELECT b.*, p.effective_from, p.basic, p.energy, p.dsm FROM billed b JOIN periods p ON b.meter = p.meter AND local_day >= effective_from AND (effective_to IS NULL OR local_day < effective_to))"
_SPANS = """per AS (SELECT p.meter, cycle_start, cycle_end, effective_from, any_value(basic) AS basic, any_value(energy) AS energy, any_value(dsm) AS dsm, count(*) AS days, sum(kwh) AS used, count(kwh) AS known FROM priced p LEFT JOIN usage u ON p.meter = u.meter AND p.local_day = u.local_day GROUP BY p.meter, cycle_start, cycle_end, effective_from),
tot AS (SELECT *, CAST(round(CAST(coalesce(sum(used) OVER c, 0) AS DECIMAL(20,6)), 0) AS BIGINT) AS total, sum(known) OVER c = sum(days) OVER c AS full_use, count(*) OVER c AS spans FROM per WINDOW c AS (PARTITION BY meter, cycle_start, cycle_end)),
wt AS (SELECT *, CASE WHEN spans = 1 THEN 'single_period' WHEN full_use THEN 'metered' ELSE 'day_proration' END AS method, CASE WHEN full_use THEN round(CAST(used AS DECIMAL(20,6)), 3) ELSE CAST(days AS DECIMAL(20,3)) END AS weight FROM tot),
al AS (SELECT *, CAST(round(coalesce(CAST(weight AS DOUBLE) / nullif(sum(CAST(weight AS DOUBLE)) OVER c, 0), 0) * total, 0) AS BIGINT) AS raw, lead(effective_from) OVER (PARTITION BY meter, cycle_start, cycle_end ORDER BY effective_from) IS NULL AS last FROM wt WINDOW c AS (PARTITION BY meter, cycle_start, cycle_end)),
spans AS (SELECT *, CAST(CASE WHEN last THEN total - coalesce(sum(raw) OVER (PARTITION BY meter, cycle_start, cycle_end ORDER BY effective_from ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) ELSE raw END AS BIGINT) AS part FROM al)"""
_M = "CAST(round(CAST({} AS DECIMAL(28,10)), 2) AS DECIMAL(18,2))"
_LINES = f"""lines AS (SELECT meter, cycle_start, cycle_end, CAST(sum(part) AS BIGINT) AS kwh, CAST(sum(days) AS BIGINT) AS days, max(method) AS method, sum({_M.format('basic * days')}) AS basic, sum({_M.format('energy * part')}) AS energy, sum({_M.format('dsm * part')}) AS dsm FROM spans GROUP BY ALL),
l1 AS (SELECT l.*, env_pct, rar_pct, pgr_pct, {_M.format('fuel * kwh')} AS fuel_charge, {_M.format('hea')} AS assistance FROM lines l JOIN cycles c USING (meter, cycle_start, cycle_end)),
l2 AS (SELECT *, coalesce({_M.format('env_pct / 100 * CAST(basic + energy + dsm + fuel_charge AS DOUBLE)')}, 0) AS env FROM l1),
l3 AS (SELECT *, coalesce({_M.format('rar_pct / 100 * CAST(basic + energy + dsm + fuel_charge + env AS DOUBLE)')}, 0) AS rar, coalesce({_M.format('pgr_pct / 100 * CAST(basic + energy AS DOUBLE)')}, 0) AS pgr FROM l2),
l4 AS (SELECT *, basic + energy + dsm + fuel_charge + env + rar + pgr + assistance AS electric FROM l3),
l5 AS (SELECT *, {_M.format('3.0 / 100 * CAST(electric - assistance AS DOUBLE)')} AS school_tax, CAST(0 AS DECIMAL(18,2)) AS sales_tax FROM l4)"""
_MONEY = "basic energy dsm fuel_charge env rar pgr assistance electric school_tax sales_tax total"
_ALL = ", ".join((FINE.removeprefix("; "), _USAGE, _DAYS, _PERIODS, _PRICED_DAYS, _SPANS))


def usage(v):
    return m.day_totals_finest(v.meter).select(F.col("device_id").alias("meter"), "local_day", "kwh")


def doubles(df):
    """Money as doubles for comparison; the tables themselves stay decimal."""
    return df.select(*(F.col(c).cast("double").alias(c) if k.startswith("decimal") else F.col(c) for c, k in df.dtypes))


q("J07_primary_meter", lambda v: v.meter.join(v.spark.createDataFrame([("lge", DEVICE, "meter", True)], "source string, device_id string, channel_id string, is_primary boolean").where("is_primary").select(*CHANNEL), CHANNEL, "left_semi").where("interval_s = 900").groupBy(F.to_date("ts_local").alias("local_day")).agg(F.sum("value").alias("kwh")), "meter", "SELECT CAST(ts_local AS DATE) AS local_day, sum(value) AS kwh FROM meter WHERE device_id = 'm0' AND interval_s = 900 GROUP BY ALL", doubles="kwh")
q("A06_meter_days", lambda v: m.day_totals(v.meter, 3600), "meter", "SELECT device_id, CAST(ts_local AS DATE) AS local_day, sum(value) AS kwh, count(*) AS intervals FROM meter WHERE interval_s = 3600 GROUP BY ALL", doubles="kwh")
q("A14_meter_hours", lambda v: m.hours(v.meter), "meter", "SELECT device_id, date_trunc('hour', ts_utc) AS hour_start_utc, sum(value) AS meter_kwh, count(*) AS intervals FROM meter WHERE interval_s = 900 GROUP BY ALL", doubles="meter_kwh")
q("A15_meter_groups", lambda v: m.groups(v.meter.unionByName(v.meter.where("device_id = 'm1'").withColumn("device_id", F.lit("m9")))).select("device_id", "meter", "aliases", "readings"), "meter", "SELECT d AS device_id, CASE WHEN d = 'm9' THEN 'm1' ELSE d END AS meter, CAST(CASE WHEN d IN ('m1', 'm9') THEN 1 ELSE 0 END AS BIGINT) AS aliases, count(*) AS readings FROM (SELECT device_id AS d, interval_s FROM meter UNION ALL SELECT 'm9', interval_s FROM meter WHERE device_id = 'm1') WHERE interval_s = 900 GROUP BY ALL")
q("A16_finest_interval", lambda v: m.finest_interval(v.meter), "meter", "SELECT device_id, min(interval_s) AS interval_s FROM meter GROUP BY ALL")
q("A17_inferred_interval", lambda v: m.infer_interval(v.meter), "meter", "; d AS (SELECT device_id, date_diff('second', lag(ts_utc) OVER (PARTITION BY device_id ORDER BY ts_utc), ts_utc) AS s FROM meter WHERE interval_s = 900), c AS (SELECT device_id, s, count(*) AS n FROM d WHERE s IS NOT NULL GROUP BY ALL) SELECT device_id, s AS interval_s, n FROM (SELECT *, row_number() OVER (PARTITION BY device_id ORDER BY n DESC, s) AS rn FROM c) WHERE rn = 1")
q("A18_interval_census", lambda v: m.interval_census(v.meter), "meter", "SELECT interval_s, count(*) AS readings, count(DISTINCT device_id) AS meters FROM meter GROUP BY ALL")
q("A19_meter_cycles", lambda v: m.cycle(v.meter, v.cycles), "meter cycles", FINE + f", {_USAGE}, {_DAYS}, j AS (SELECT b.*, u.kwh, u.n, CAST(date_diff('hour', {utc_sql('CAST(b.local_day AS TIMESTAMP)')}, {utc_sql('CAST(b.local_day + 1 AS TIMESTAMP)')}) * 4 AS BIGINT) AS want FROM billed b LEFT JOIN usage u ON b.meter = u.meter AND b.local_day = u.local_day) SELECT meter, cycle_start, cycle_end, sum(kwh) AS kwh, CAST(coalesce(sum(n), 0) AS BIGINT) AS intervals, CAST(sum(want) AS BIGINT) AS expected, count(*) FILTER (WHERE coalesce(n, 0) < want) AS incomplete_days, count(*) AS days FROM j GROUP BY ALL", doubles="kwh")
_HOURS = f"; p AS (SELECT hour_start_utc, sum(kwh) AS panel_kwh, min(sample_count) AS worst_samples, count(DISTINCT device_id || '/' || channel_id) AS series FROM hourly WHERE metric = 'watts' AND {FEED} GROUP BY ALL), m AS (SELECT date_trunc('hour', ts_utc) AS hour_start_utc, sum(value) AS meter_kwh, count(*) AS intervals FROM meter WHERE interval_s = 900 AND device_id = 'm0' GROUP BY ALL), j AS (SELECT * FROM p FULL JOIN m USING (hour_start_utc)), r AS (SELECT *, CASE WHEN panel_kwh IS NULL THEN 'no panel' WHEN meter_kwh IS NULL THEN 'no meter' WHEN series < 2 THEN 'panel series missing' WHEN worst_samples < 0.9 THEN 'panel short' WHEN intervals < 2 THEN 'meter short' END AS reason FROM j)"
_compare = lambda v: m.compare(v.hourly, v.meter, ["ct_1_a", "ct_1_b"], DEVICE, 2, 1.0, 2)
q("J15_panel_meter_hours", _compare, "hourly meter", _HOURS + " SELECT *, CASE WHEN reason IS NULL THEN panel_kwh - meter_kwh END AS delta_kwh FROM r", doubles="panel_kwh meter_kwh delta_kwh")
q("Q05_compare_meter", lambda v: m.compare_totals(_compare(v)), "hourly meter", _HOURS + " SELECT coalesce(reason, 'usable') AS reason, count(*) AS hours, sum(panel_kwh) AS panel_kwh, sum(meter_kwh) AS meter_kwh FROM r GROUP BY ALL", doubles="panel_kwh meter_kwh")
q("Q06_meter_card", lambda v: m.card(v.meter, "2024-01-20"), "meter", FINE + " SELECT device_id, sum(value) FILTER (WHERE local_day = DATE '2024-01-19') AS yesterday_kwh, sum(value) FILTER (WHERE local_day = DATE '2024-01-20') AS today_kwh, max(ts_utc) AS last_ts_utc, max(ts_utc) < TIMESTAMP '2024-01-20' - INTERVAL 36 HOUR AS stale FROM fine GROUP BY ALL", doubles="yesterday_kwh today_kwh")
q("T03_meters_ranked", lambda v: m.card(v.meter, "2024-01-20").select("device_id", "yesterday_kwh"), "meter", FINE + " SELECT device_id, sum(value) FILTER (WHERE local_day = DATE '2024-01-19') AS yesterday_kwh FROM fine GROUP BY ALL", doubles="yesterday_kwh")
q("J04_panel_meter_days", lambda v: a.panel_days(v.hourly).join(m.day_totals(v.meter, 900).where("device_id = 'm0'").select("local_day", F.col("kwh").alias("meter_kwh")), "local_day", "full_outer"), "hourly meter", f"; p AS (SELECT local_day, sum(kwh) AS kwh, count(*) AS series, CAST(min(n) AS BIGINT) AS worst_samples FROM (SELECT {DAY} AS local_day, device_id, channel_id, sum(kwh) AS kwh, sum(sample_count) AS n FROM hourly WHERE metric = 'watts' AND {FEED} GROUP BY ALL) GROUP BY ALL), m AS (SELECT CAST(ts_local AS DATE) AS local_day, sum(value) AS meter_kwh FROM meter WHERE interval_s = 900 AND device_id = 'm0' GROUP BY ALL) SELECT * FROM p FULL JOIN m USING (local_day)", doubles="kwh meter_kwh")
q("J12_active_periods", lambda v: doubles(t.active_period(usage(v), v.rates)), "meter rates", FINE + f", {_USAGE}, {_PERIODS} SELECT u.meter, local_day, kwh, effective_from, basic, energy, dsm FROM usage u JOIN periods p ON u.meter = p.meter AND local_day >= effective_from AND (effective_to IS NULL OR local_day < effective_to)", doubles="kwh basic energy dsm")
q("J12_unpriced_days", lambda v: t.unpriced(usage(v), v.rates.where("effective_from >= DATE'2024-01-10'")).select("meter", "local_day"), "meter rates", FINE + f", {_USAGE}, f AS (SELECT meter, min(effective_from) AS first FROM rates WHERE effective_from >= DATE '2024-01-10' GROUP BY ALL) SELECT u.meter, local_day FROM usage u LEFT JOIN f USING (meter) WHERE first IS NULL OR local_day < first")


def _wanted(v):
    return usage(v).groupBy("meter").agg(F.count("*").alias("_n")).select("meter", F.lit("2023-12-31").cast("date").alias("cycle_start"), F.lit("2024-01-15").cast("date").alias("cycle_end"))


q("J13_cycle_or_latest", lambda v: doubles(t.cycle_for(_wanted(v), v.cycles)), "meter cycles", "; w AS (SELECT DISTINCT device_id AS meter, DATE '2023-12-31' AS cycle_start, DATE '2024-01-15' AS cycle_end FROM meter), l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY meter ORDER BY cycle_end DESC) AS rn FROM cycles) WHERE rn = 1) SELECT w.meter, w.cycle_start, w.cycle_end, CASE WHEN c.meter IS NULL THEN l.fuel ELSE c.fuel END AS fuel, CASE WHEN c.meter IS NULL THEN l.env_pct ELSE c.env_pct END AS env_pct, CASE WHEN c.meter IS NULL THEN l.rar_pct ELSE c.rar_pct END AS rar_pct, CASE WHEN c.meter IS NULL THEN l.pgr_pct ELSE c.pgr_pct END AS pgr_pct, CASE WHEN c.meter IS NULL THEN l.hea ELSE c.hea END AS hea, c.meter IS NULL AS riders_estimated FROM w LEFT JOIN cycles c ON w.meter = c.meter AND w.cycle_start = c.cycle_start AND w.cycle_end = c.cycle_end LEFT JOIN l ON w.meter = l.meter", doubles="fuel env_pct rar_pct pgr_pct hea")
q("J19_near_miss_bills", lambda v: t.near_miss(_wanted(v).withColumn("cycle_end", F.lit("2024-01-14").cast("date")), v.cycles), "meter cycles", "SELECT DISTINCT device_id AS meter, DATE '2023-12-31' AS cycle_start, DATE '2024-01-14' AS cycle_end FROM meter WHERE device_id IN (SELECT meter FROM cycles WHERE (cycle_start = DATE '2023-12-31') <> (cycle_end = DATE '2024-01-14'))")
q("W10_allocation", lambda v: t.spans(v.cycles, v.rates, usage(v)).select("meter", "cycle_start", "cycle_end", "effective_from", "days", "total", "part", "method"), "meter rates cycles", "; " + _ALL + " SELECT meter, cycle_start, cycle_end, effective_from, days, total, part, method FROM spans")
q("A33_priced_lines", lambda v: doubles(t.price(v.cycles, v.rates, usage(v))), "meter rates cycles", "; " + _ALL + f", {_LINES} SELECT meter, cycle_start, cycle_end, kwh, days, method, basic, energy, dsm, fuel_charge, env, rar, pgr, assistance, electric, school_tax, sales_tax, electric + school_tax + sales_tax AS total FROM l5", doubles=_MONEY)
q("Q08_price_cycles", lambda v: doubles(t.price(v.cycles, v.rates, usage(v)).groupBy("meter").agg(F.sum("total").alias("total"), F.sum("kwh").alias("kwh"), F.count("*").alias("cycles"))), "meter rates cycles", "; " + _ALL + f", {_LINES} SELECT meter, sum(electric + school_tax + sales_tax) AS total, CAST(sum(kwh) AS BIGINT) AS kwh, count(*) AS cycles FROM l5 GROUP BY ALL", doubles="total")
q("A34_marginal_rates", lambda v: t.marginal_rates(v.rates, v.cycles, "2024-01-20").join(usage(v).groupBy("meter").agg(F.sum("kwh").alias("kwh")), "meter").withColumn("usd", F.col("kwh") * F.col("usd_per_kwh")), "meter rates cycles", FINE + f", {_USAGE}, p AS (SELECT meter, arg_max(energy, effective_from) AS energy, arg_max(dsm, effective_from) AS dsm FROM rates WHERE effective_from <= DATE '2024-01-20' GROUP BY ALL), c AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY meter ORDER BY cycle_end DESC) AS rn FROM cycles) WHERE rn = 1), x AS (SELECT meter, CAST(energy AS DOUBLE) AS e, CAST(energy + dsm + fuel AS DOUBLE) AS base, coalesce(CAST(env_pct AS DOUBLE), 0) / 100 AS env, coalesce(CAST(rar_pct AS DOUBLE), 0) / 100 AS rar, coalesce(CAST(pgr_pct AS DOUBLE), 0) / 100 AS pgr FROM p JOIN c USING (meter)), r AS (SELECT meter, round((base + env * base + rar * (base + env * base) + pgr * e) * 1.03, 5) AS usd_per_kwh FROM x) SELECT meter, usd_per_kwh, sum(kwh) AS kwh, sum(kwh * usd_per_kwh) AS usd FROM r JOIN usage USING (meter) GROUP BY meter, usd_per_kwh", doubles="usd_per_kwh kwh usd")


def _bills(v):
    priced = t.price(v.cycles, v.rates, usage(v))
    return priced.select("meter", "cycle_start", "cycle_end", F.when(F.col("meter") == "m1", F.col("total") + 50).when(F.col("meter") == "m0", F.col("total")).alias("billed_total"))


q("Q07_verify_bills", lambda v: doubles(t.verify(t.price(v.cycles, v.rates, usage(v)), _bills(v), m.cycle(v.meter, v.cycles), least=0.0)), "meter rates cycles", "; " + _ALL + f", {_LINES}, x AS (SELECT meter, cycle_start, cycle_end, electric + school_tax + sales_tax AS total FROM l5), b AS (SELECT *, CASE meter WHEN 'm1' THEN total + 50 WHEN 'm0' THEN total END AS billed_total FROM x) SELECT meter, cycle_start, cycle_end, billed_total, total, CASE WHEN billed_total IS NULL THEN 'no_bill_total' WHEN abs(total - billed_total) / billed_total * 100 <= 1 THEN 'verified' ELSE 'discrepancy' END AS verdict FROM b", doubles="billed_total total")
