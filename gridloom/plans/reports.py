"""Composite reports: integrity, digest, history, equipment against power, live panel."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import localtime as lt
from ..functions import scalar as s
from ..operators import aggregates as a
from ..operators import anomalies as an
from ..operators import coverage as cov
from ..operators import dimension, hvac, integrity, reports, rollup
from ..operators import meters as m
from ..schemas import CHANNEL
from ..views import POLL_S, day_hours_sql
from .basic import DAY, FEED, LEVEL
from .registry import Registry
from .windows import CHANGE, LAYOUT, LAYOUTS, latest_kinds

REGISTRY = Registry()
q = REGISTRY.add
TODAY = "2024-01-25"
KEY = "source || '/' || device_id || '/' || channel_id"

# -------------------------------------------------------------------------------------------------------------- integrity
def _panel(hourly: str = "hourly") -> str:
    return f"panel AS (SELECT local_day, kwh, seconds / channels / ({day_hours_sql('local_day')} * 3600) AS coverage FROM (SELECT {DAY} AS local_day, sum(kwh) AS kwh, sum(observed_seconds) AS seconds, count(DISTINCT device_id || channel_id) AS channels FROM {hourly} WHERE metric = 'watts' AND {FEED} GROUP BY ALL))"


def _disagree(hourly: str = "hourly", meter: str = "meter") -> str:
    metered = f"md AS (SELECT local_day, meter_kwh, n * 900 / ({day_hours_sql('local_day')} * 3600) AS meter_coverage FROM (SELECT CAST(ts_local AS DATE) AS local_day, sum(value) AS meter_kwh, count(*) AS n FROM {meter} WHERE interval_s = 900 AND device_id = 'm0' GROUP BY ALL))"
    return f"; {_panel(hourly)}, {metered}, j AS (SELECT *, abs(kwh - meter_kwh) / nullif(meter_kwh, 0) * 100 AS off_pct FROM panel FULL JOIN md USING (local_day)), d AS (SELECT *, CASE WHEN kwh IS NULL THEN 'no panel' WHEN meter_kwh IS NULL THEN 'no meter' WHEN coverage < 0.9 THEN 'panel short' WHEN meter_coverage < 0.9 THEN 'meter short' END AS skipped FROM j)"


def panel_days(v):
    return a.panel_coverage(v.hourly)


def meter_days(v):
    return m.day_coverage(v.meter, 900, "m0")


_DISAGREE = _disagree()
_JUDGED = " SELECT *, CASE WHEN skipped IS NULL THEN off_pct > 10 END AS disagrees FROM d"
_DOUBLES = "kwh coverage meter_kwh meter_coverage off_pct"
q("Q02_meter_disagreement", lambda v: integrity.meter_disagreement(panel_days(v), meter_days(v)), "hourly meter", _DISAGREE + _JUDGED, doubles=_DOUBLES)
q("Q02_meter_disagreement_dst", lambda v: integrity.meter_disagreement(a.panel_coverage(v.hourly_dst), m.day_coverage(v.meter_dst, 900, "m0")), "hourly_dst meter_dst", _disagree("hourly_dst", "meter_dst") + _JUDGED, doubles=_DOUBLES)
q("Q02_feed_below_children", lambda v: integrity.feed_against_children(v.hourly), "hourly", f"; h AS (SELECT device_id, hour_start_utc, {DAY} AS local_day, sum(mean) FILTER (WHERE {FEED}) AS feed_w, sum(mean) FILTER (WHERE channel_id LIKE 'breaker_%' OR channel_id LIKE 'ct_2%') AS children_w, count(*) FILTER (WHERE channel_id LIKE 'breaker_%' OR channel_id LIKE 'ct_2%') AS children FROM hourly WHERE metric = 'watts' GROUP BY ALL) SELECT *, children_w - feed_w AS excess_w FROM h WHERE feed_w IS NOT NULL AND children >= 3 AND children_w - feed_w > greatest(0.05 * feed_w, 100)", doubles="feed_w children_w excess_w")


def channel_check(v):
    shifted = v.hourly.withColumn("min", F.col("min") - 5)
    return integrity.check_channels(shifted, meter_days(v), least_samples=1, limit_w=400.0)


_FOUND = f"""; c AS (SELECT 'corrupt_reading' AS rule, {KEY} AS key, {DAY} AS local_day, count(*) || ' hours beyond the limit' AS headline, NULL AS kwh FROM hourly WHERE metric = 'watts' AND greatest(abs(min - 5), abs(max)) >= 400 GROUP BY ALL),
n AS (SELECT 'negative_reading', {KEY}, {DAY}, count(*) || ' hours below zero', NULL FROM hourly WHERE metric = 'watts' AND min - 5 < 0 GROUP BY ALL),
h AS (SELECT device_id, hour_start_utc, {DAY} AS local_day, sum(mean) FILTER (WHERE {FEED}) AS f, sum(mean) FILTER (WHERE channel_id LIKE 'breaker_%' OR channel_id LIKE 'ct_2%') AS c, count(*) FILTER (WHERE channel_id LIKE 'breaker_%' OR channel_id LIKE 'ct_2%') AS k FROM hourly WHERE metric = 'watts' GROUP BY ALL),
x AS (SELECT 'feed_below_children', device_id, local_day, count(*) || ' hours with children above the feed', NULL FROM h WHERE f IS NOT NULL AND k >= 3 AND c - f > greatest(0.05 * f, 100) GROUP BY ALL)"""
q("Q02_findings", lambda v: channel_check(v)[0], "hourly meter", _DISAGREE + ", " + _FOUND.removeprefix("; ") + " SELECT rule, key, local_day, headline, CAST(kwh AS DOUBLE) AS kwh FROM c UNION ALL SELECT * FROM n UNION ALL SELECT * FROM x UNION ALL SELECT 'meter_disagreement', 'meter', local_day, 'panel and meter differ', kwh - meter_kwh FROM d WHERE skipped IS NULL AND off_pct > 10", doubles="kwh")
q("Q02_skipped", lambda v: channel_check(v)[1], "hourly meter", _DISAGREE + " SELECT 'meter' AS key, skipped AS reason, count(*) AS n FROM d WHERE skipped IS NOT NULL GROUP BY ALL")
q("Q02_untrusted", lambda v: channel_check(v)[2], "hourly", _FOUND + " SELECT DISTINCT key FROM (SELECT key FROM c UNION ALL SELECT * FROM (SELECT key FROM (SELECT * FROM n) t(rule, key, d, h, k)))")

# ----------------------------------------------------------------------------------------------------------------- digest
_KWH = f"k AS (SELECT device_id, channel_id, {DAY} AS local_day, sum(kwh) AS kwh, count(*) AS hours, count(*) FILTER (WHERE mean >= 50) AS busy_hours FROM hourly WHERE metric = 'watts' GROUP BY ALL)"
_BAND = f"""; {_KWH}, b AS (SELECT * FROM k WHERE local_day < DATE '{TODAY}' AND local_day >= DATE '{TODAY}' - 21), mm AS (SELECT device_id, channel_id, median(kwh) AS median, count(*) AS days FROM b GROUP BY ALL HAVING count(*) >= 7),
f AS (SELECT device_id, channel_id, median(abs(kwh - median)) AS mad FROM b JOIN mm USING (device_id, channel_id) GROUP BY ALL), bands AS (SELECT device_id, channel_id, median, days, mad, greatest(mad * 1.4826 * 4, 0.05, median * 0.15) AS width FROM mm JOIN f USING (device_id, channel_id))"""
_daily = lambda v: a.daily_kwh(v.hourly, 50.0).select("device_id", "channel_id", "local_day", "kwh", "hours", "busy_hours")


def above(v):
    b = an.bands(an.baseline(_daily(v), TODAY), ["device_id", "channel_id"], floor_kwh=0.05)
    today = _daily(v).where(F.col("local_day") == F.lit(TODAY).cast("date")).join(b, ["device_id", "channel_id"])
    return today.where(F.col("kwh") > F.col("median") + 0.25 * F.col("width")).select("device_id", "channel_id", "local_day", "kwh", "median", "upper", (F.col("kwh") - F.col("median")).alias("excess_kwh"))


_ABOVE = _BAND + f", above AS (SELECT device_id, channel_id, local_day, kwh, median, median + width AS upper, kwh - median AS excess_kwh FROM k JOIN bands USING (device_id, channel_id) WHERE local_day = DATE '{TODAY}' AND kwh > median + 0.25 * width)"
q("Q03_above_band", above, "hourly", _ABOVE + " SELECT * FROM above", doubles="kwh median upper excess_kwh")
q("Q03_went_quiet", lambda v: an.went_quiet(_daily(v).withColumn("channel_id", F.concat_ws("/", "device_id", "channel_id")), TODAY, 0.5, 1).drop("first_day").select("channel_id", "length", "last_day"), "hourly", f"; {_KWH}, x AS (SELECT device_id || '/' || channel_id AS c, local_day, date_diff('day', DATE '1970-01-01', local_day) AS o FROM k WHERE kwh < 0.5 AND local_day <= DATE '{TODAY}'), y AS (SELECT *, o - row_number() OVER (PARTITION BY c ORDER BY o) AS run FROM x) SELECT c AS channel_id, count(*) AS length, max(local_day) AS last_day FROM y GROUP BY c, run HAVING max(local_day) = DATE '{TODAY}'")
q("Q03_stuck_loads", lambda v: an.stuck_loads(_daily(v), TODAY, 4, 0.5, 0.9).select("device_id", "channel_id", "duty", "usual_duty"), "hourly", f"; {_KWH}, u AS (SELECT device_id, channel_id, sum(busy_hours) / sum(hours) AS usual_duty FROM k WHERE local_day < DATE '{TODAY}' GROUP BY ALL) SELECT device_id, channel_id, busy_hours / hours AS duty, usual_duty FROM k JOIN u USING (device_id, channel_id) WHERE local_day = DATE '{TODAY}' AND hours >= 4 AND busy_hours / hours >= 0.5 AND usual_duty < 0.9", doubles="duty usual_duty")
q("Q03_strip_heat", lambda v: an.strip_heat(v.daily, v.daily.where("channel_id = 'low'").select("local_day", F.col("kwh").alias("low")), "urgent", 300.0, 200.0).select("local_day", "kwh", "low"), "daily", "SELECT d.local_day, d.kwh, o.kwh AS low FROM daily d JOIN daily o ON d.local_day = o.local_day AND o.channel_id = 'low' WHERE d.channel_id = 'urgent' AND d.kwh >= 300 AND o.kwh > 200", doubles="kwh low")
q("Q03_envelope", lambda v: an.envelope(m.day_totals(v.meter, 900), "m1", 5.5, 4.9, 2), "meter", "; d AS (SELECT CAST(ts_local AS DATE) AS local_day, sum(value) AS kwh FROM meter WHERE interval_s = 900 AND device_id = 'm1' GROUP BY ALL), y AS (SELECT *, date_diff('day', DATE '1970-01-01', local_day) - row_number() OVER (ORDER BY local_day) AS run FROM d WHERE kwh < 4.9) SELECT 'high' AS kind, local_day, kwh, CAST(1 AS BIGINT) AS days FROM d WHERE kwh > 5.5 UNION ALL SELECT 'low', max(local_day), sum(kwh), count(*) FROM y GROUP BY run HAVING count(*) >= 2", doubles="kwh")
q("Q03_phantom_growth", lambda v: an.phantom_growth(a.night_floor(v.hourly), TODAY, 21, 5.0), "hourly", f"; f AS (SELECT local_day, min(w) AS floor_w, count(*) AS night_hours FROM (SELECT hour_start_utc, {DAY} AS local_day, sum(mean) AS w FROM hourly WHERE metric = 'watts' AND {FEED} AND hour(local_hour_start) BETWEEN 1 AND 4 GROUP BY ALL) GROUP BY ALL), b AS (SELECT median(floor_w) AS usual_w, count(*) AS nights FROM f WHERE local_day < DATE '{TODAY}' AND local_day >= DATE '{TODAY}' - 21) SELECT *, floor_w - usual_w AS growth_w, floor_w - usual_w >= 5 AS found FROM f, b WHERE local_day = DATE '{TODAY}'", doubles="floor_w usual_w growth_w")
#: Findings known before, and those of a later report.
SINCE = "2024-01-15"
_early = lambda v: channel_check(v)[0].where(f"local_day < DATE'{SINCE}'")
_late = lambda v: channel_check(v)[0].where(f"local_day >= DATE'{SINCE}'")
_ALL_FOUND = _DISAGREE + ", " + _FOUND.removeprefix("; ") + ", found AS (SELECT rule, key, local_day FROM c UNION ALL SELECT rule, key, local_day FROM (SELECT * FROM n) t(rule, key, local_day, h, k) UNION ALL SELECT rule, key, local_day FROM (SELECT * FROM x) t(rule, key, local_day, h, k) UNION ALL SELECT 'meter_disagreement', 'meter', local_day FROM d WHERE skipped IS NULL AND off_pct > 10)"
_TWO = f", e AS (SELECT rule, key, max(local_day) AS day FROM found WHERE local_day < DATE '{SINCE}' GROUP BY ALL), l AS (SELECT rule, key, max(local_day) AS day, count(*) AS days FROM found WHERE local_day >= DATE '{SINCE}' GROUP BY ALL)"
q("J21_new_findings", lambda v: an.news(_late(v), _early(v)).groupBy("rule", "key").agg(F.count("*").alias("days")), "hourly meter", _ALL_FOUND + _TWO + " SELECT rule, key, days FROM l ANTI JOIN e USING (rule, key)")


def notified(v):
    """The later report's transitions, from a ledger in which the early report's feed findings could not be delivered."""
    known = an.signed(_early(v)).select("signature", "rule", "key", F.col("day").alias("since"), (F.col("rule") != "feed_below_children").alias("sent"))
    return an.transitions(known, _late(v)).select("rule", "key", "since", "change", "send")


q("ST14_notify_on_change", notified, "hourly meter", _ALL_FOUND + _TWO + ", t AS (SELECT rule, key, coalesce(e.day, l.day) AS since, CASE WHEN l.day IS NULL THEN 'cleared' WHEN e.day IS NULL THEN 'new' WHEN rule = 'feed_below_children' THEN 'undelivered' ELSE 'kept' END AS change FROM e FULL JOIN l USING (rule, key)) SELECT *, change IN ('new', 'undelivered') AS send FROM t")
q("J22_night_hours", lambda v: a.night_floor(v.hourly).select("local_day", "night_hours"), "hourly", f"SELECT {DAY} AS local_day, count(DISTINCT hour_start_utc) AS night_hours FROM hourly WHERE metric = 'watts' AND {FEED} AND hour(local_hour_start) BETWEEN 1 AND 4 GROUP BY ALL")

# ---------------------------------------------------------------------------------------------------- history and gap reports
q("Q04_history", lambda v: a.circuits(v.hourly, v.dim, POLL_S, "2024-01-02", "2024-01-29").groupBy("level").agg(F.sum("kwh").alias("kwh"), F.count("*").alias("circuits"), F.min("coverage_pct").alias("worst_pct")), "hourly", f"; c AS (SELECT {LEVEL} AS level, sum(kwh) AS kwh, sum(sample_count) / (28 * 86400 / {POLL_S}) * 100 AS pct FROM hourly WHERE metric = 'watts' AND {DAY} BETWEEN DATE '2024-01-02' AND DATE '2024-01-29' GROUP BY source, device_id, channel_id) SELECT level, sum(kwh) AS kwh, count(*) AS circuits, min(pct) AS worst_pct FROM c GROUP BY ALL", doubles="kwh worst_pct")
q("Q11_short_hours", lambda v: cov.short_hours(v.hourly, 2), "hourly", "SELECT source, device_id, channel_id, metric, hour_start_utc, sample_count, CAST(2 AS BIGINT) AS expected FROM hourly WHERE sample_count < 1.8")
q("Q13_energy_history", lambda v: a.component_history(v.daily), "daily", "SELECT local_day, " + ", ".join(f"max(kwh) FILTER (WHERE channel_id = '{c}') AS kwh_{c}" for c in ("low", "medium", "high", "urgent", "not_specified")) + ", sum(usd) AS usd, count(*) AS components FROM daily GROUP BY ALL", doubles="kwh_low kwh_medium kwh_high kwh_urgent kwh_not_specified usd")
_AFT = "ts_local >= '2024-01-10 12:00:00' AND ts_local < '2024-01-10 18:00:00' AND metric = 'watts'"
q("Q14_afternoon_draw", lambda v: a.label(v.obs.where(_AFT.replace("'2024", "TIMESTAMP_NTZ'2024")), v.dim.select(*CHANNEL, "label")).groupBy("label").agg(F.avg("value").alias("mean_w"), F.max("value").alias("peak_w"), F.count("*").alias("samples")).withColumn("expected", F.lit(6 * 3600 // POLL_S).cast("long")), "obs dim", f"SELECT label, avg(value) AS mean_w, max(value) AS peak_w, count(*) AS samples, CAST({6 * 3600 // POLL_S} AS BIGINT) AS expected FROM obs LEFT JOIN dim USING (source, device_id, channel_id) WHERE {_AFT} GROUP BY ALL", doubles="mean_w peak_w")

# ------------------------------------------------------------------------------------------------- equipment against power
_STATES = "CASE event_type WHEN 'click' THEN 'off' WHEN 'view' THEN 'low' WHEN 'error' THEN 'high' WHEN 'signup' THEN 'idle' ELSE 'dehumidify' END"


def pairs(v):
    """Capacity and state of volts samples with the same bucket's mean feed watts."""
    state = F.when(F.col("event_type") == "click", "off").when(F.col("event_type") == "view", "low").when(F.col("event_type") == "error", "high").when(F.col("event_type") == "signup", "idle").otherwise("dehumidify")
    states = v.obs.where("metric = 'volts'").groupBy(lt.bucket("ts_utc", 3600).alias("bucket")).agg(F.avg((F.col("event_id") % 101).cast("double")).alias("capacity"), F.max(state).alias("state"), F.avg((F.col("event_id") % 5000).cast("double")).alias("rpm"), F.avg((F.col("event_id") % 700).cast("double")).alias("cfm"))
    power = v.obs.where("metric = 'watts'").where(s.level() == "feed").groupBy(lt.bucket("ts_utc", 3600).alias("bucket")).agg(F.avg("value").alias("watts"))
    return hvac.state_vs_power(states, power)


_PAIRS = f"; p AS (SELECT * FROM (SELECT date_trunc('hour', ts_utc) AS bucket, avg(event_id % 101) AS capacity, max({_STATES}) AS state, avg(event_id % 5000) AS rpm, avg(event_id % 700) AS cfm FROM obs WHERE metric = 'volts' GROUP BY ALL) LEFT JOIN (SELECT date_trunc('hour', ts_utc) AS bucket, avg(value) AS watts FROM obs WHERE metric = 'watts' AND {FEED} GROUP BY ALL) USING (bucket)), c AS (SELECT *, watts / capacity AS pp FROM p WHERE capacity > 0 AND watts IS NOT NULL)"
q("Q12_state_vs_power", pairs, "obs", _PAIRS + " SELECT * FROM p", doubles="capacity rpm cfm watts")
q("A24_capacity_agreement", lambda v: hvac.agreement(pairs(v)), "obs", _PAIRS + " SELECT count(*) AS n, corr(capacity, watts) AS r, avg(pp) AS w_per_point, stddev_pop(pp) AS sd, avg(pp) * 100 AS full_load_w FROM c", doubles="r w_per_point sd full_load_w")
q("A24_capacity_bands", lambda v: hvac.capacity_bands(pairs(v)), "obs", _PAIRS + " SELECT CAST(round_even(capacity / 5, 0) * 5 AS INTEGER) AS band, count(*) AS n, avg(watts) AS mean_w, min(watts) AS min_w, max(watts) AS max_w FROM p WHERE capacity > 0 GROUP BY ALL", doubles="mean_w min_w max_w")
_RUN = "state NOT IN ('off', 'idle')"
q("A25_off_state", lambda v: hvac.off_state(pairs(v)), "obs", _PAIRS + f" SELECT count(*) FILTER (WHERE NOT {_RUN} AND watts <= 25) AS off_quiet, count(*) FILTER (WHERE NOT {_RUN} AND watts > 25) AS off_drawing, count(*) FILTER (WHERE {_RUN} AND watts > 25) AS on_drawing, count(*) FILTER (WHERE {_RUN} AND watts <= 25) AS on_quiet, max(watts) FILTER (WHERE NOT {_RUN}) AS off_max_w, avg(watts) FILTER (WHERE {_RUN}) AS on_mean_w FROM p".replace("NOT state NOT IN", "state IN"), doubles="off_max_w on_mean_w")
q("A26_feeder_profile", lambda v: hvac.feeder_profile(pairs(v)), "obs", _PAIRS + " SELECT count(*) AS n, corr(rpm, watts) AS r_speed, corr(pow(rpm, 3), watts) AS r_cube, corr(cfm, watts) AS r_cfm, corr(capacity, watts) AS r_capacity FROM p", doubles="r_speed r_cube r_cfm r_capacity")
q("A26_speed_bands", lambda v: hvac.speed_bands(pairs(v)), "obs", _PAIRS + " SELECT CAST(floor(rpm / 200) * 200 AS BIGINT) AS band, count(*) AS n, avg(watts) AS mean_w FROM p GROUP BY ALL", doubles="mean_w")
q("P27_modelled_power", lambda v: hvac.modelled(pairs(v)).select("bucket", "modelled_w", "residual_w"), "obs", _PAIRS + ", k AS (SELECT CASE WHEN count(*) >= 30 THEN avg(pp) ELSE 29.9 END AS coefficient FROM c) SELECT bucket, capacity * coefficient AS modelled_w, watts - capacity * coefficient AS residual_w FROM p, k", doubles="modelled_w residual_w")
q("Q09_hvac_compare", lambda v: hvac.modelled(pairs(v)).groupBy("state").agg(F.count("*").alias("buckets"), F.avg("watts").alias("mean_w"), F.avg(F.abs("residual_w")).alias("mean_abs_residual_w")), "obs", _PAIRS + ", k AS (SELECT CASE WHEN count(*) >= 30 THEN avg(pp) ELSE 29.9 END AS coefficient FROM c) SELECT state, count(*) AS buckets, avg(watts) AS mean_w, avg(abs(watts - capacity * coefficient)) AS mean_abs_residual_w FROM p, k GROUP BY ALL", doubles="mean_w mean_abs_residual_w")
q("P26_bucket_choice", lambda v: v.obs.groupBy(lt.bucket("ts_utc", bucket_width(30 * 86400, POLL_S)).alias("bucket")).agg(F.count("*").alias("n")), "obs", "SELECT time_bucket(INTERVAL '7200 seconds', ts_utc, TIMESTAMP '1970-01-01') AS bucket, count(*) AS n FROM obs GROUP BY ALL")


def bucket_width(window_s: int, poll_s: int, most: int = 600) -> int:
    """The narrowest of the usual widths with at most ``most`` buckets and at least two poll intervals each."""
    for width in (60, 120, 300, 600, 900, 1800, 3600, 7200, 14400, 43200, 86400):
        if window_s / width <= most and width >= 2 * poll_s:
            return width
    raise ValueError(f"no bucket width for a window of {window_s} s")


_component = lambda hourly: hourly.where("metric = 'watts' AND channel_id = 'breaker_p1'").groupBy(F.to_date("local_hour_start").alias("local_day")).agg(F.sum("kwh").alias("kwh"))


def _feeds(hourly: str = "hourly") -> str:
    return f"; g AS (SELECT {DAY} AS local_day, device_id, channel_id, sum(kwh) AS kwh, sum(observed_seconds) AS seconds FROM {hourly} WHERE metric = 'watts' AND {FEED} GROUP BY ALL), f AS (SELECT local_day, panel_kwh, channels, seconds / ({day_hours_sql('local_day')} * 3600) AS coverage FROM (SELECT local_day, sum(kwh) AS panel_kwh, count(*) AS channels, min(seconds) AS seconds FROM g GROUP BY ALL))"


_VS = ", c AS (SELECT {} AS local_day, sum(kwh) AS kwh FROM {} WHERE metric = 'watts' AND channel_id = 'breaker_p1' GROUP BY ALL) SELECT *, CASE WHEN channels = 4 AND coverage >= 0.3 THEN panel_kwh - kwh END AS delta_kwh FROM c FULL JOIN f USING (local_day)"
q("A28_feed_coverage", lambda v: a.feed_coverage(v.hourly), "hourly", _feeds() + " SELECT * FROM f", doubles="panel_kwh coverage")
q("A28_feed_coverage_dst", lambda v: a.feed_coverage(v.hourly_dst), "hourly_dst", _feeds("hourly_dst") + " SELECT * FROM f", doubles="panel_kwh coverage")
q("Q10_component_vs_panel", lambda v: hvac.component_vs_panel(_component(v.hourly), a.feed_coverage(v.hourly), 4, 0.3), "hourly", _feeds() + _VS.format(DAY, "hourly"), doubles="kwh panel_kwh coverage delta_kwh")
q("Q10_component_vs_panel_dst", lambda v: hvac.component_vs_panel(_component(v.hourly_dst), a.feed_coverage(v.hourly_dst), 4, 0.3), "hourly_dst", _feeds("hourly_dst") + _VS.format(DAY, "hourly_dst"), doubles="kwh panel_kwh coverage delta_kwh")

# ------------------------------------------------------------------------------------------------------- live panel and layout
q("Q18_live_panel", lambda v: a.label(a.latest(v.obs.where("ts_utc < TIMESTAMP_NTZ'2024-01-20 12:30:00'")), v.dim.select(*CHANNEL, "label")).withColumn("age_s", F.expr("timestampdiff(SECOND, ts_utc, TIMESTAMP_NTZ'2024-01-20 12:30:00')")).select(s.label_or_tail("label").alias("label"), "metric", "value", "age_s", s.freshness("age_s", POLL_S).alias("freshness")), "obs dim", f"; l AS (SELECT source, device_id, channel_id, metric, max(ts_utc) AS ts, arg_max(value, ts_utc) AS value, date_diff('microsecond', max(ts_utc), TIMESTAMP '2024-01-20 12:30:00') // 1000000 AS age_s FROM obs WHERE ts_utc < '2024-01-20 12:30:00' GROUP BY ALL) SELECT coalesce(label, channel_id || ' · ' || device_id) AS label, metric, value, age_s, CASE WHEN age_s <= {1.5 * POLL_S} THEN 'live' WHEN age_s <= {3 * POLL_S} THEN 'late' ELSE 'silent' END AS freshness FROM l LEFT JOIN dim USING (source, device_id, channel_id)", doubles="value")
q("P24_coverage_classes", lambda v: cov.matrix(v.hourly, 3600).groupBy("status").agg(F.count("*").alias("n")), "hourly", f"; d AS (SELECT {DAY} AS d, sum(sample_count) / 24 * 100 AS p FROM hourly GROUP BY {DAY}, source, device_id, channel_id, metric) SELECT CASE WHEN p >= 98 THEN 'complete' WHEN p >= 80 THEN 'thin' WHEN p >= 50 THEN 'sparse' ELSE 'mostly missing' END AS status, count(*) AS n FROM d GROUP BY ALL")
q("J16_decode_join", lambda v: v.obs.withColumn("code", (F.col("event_id") % 6).cast("int")).join(v.spark.createDataFrame([(0, "off"), (1, "low"), (2, "high"), (3, "idle"), (4, "dehumidify")], "code int, word string"), "code", "left").groupBy("code", "word").agg(F.count("*").alias("n")), "obs", "SELECT CAST(event_id % 6 AS INTEGER) AS code, list_element(['off', 'low', 'high', 'idle', 'dehumidify'], CAST(event_id % 6 + 1 AS INTEGER)) AS word, count(*) AS n FROM obs GROUP BY ALL")
q("Q20_layout_changes", lambda v: dimension.layout_diff(*latest_kinds(v), LAYOUT, "kind").groupBy("change").agg(F.count("*").alias("n")), "obs", f"; {LAYOUTS} SELECT {CHANGE} AS change, count(*) AS n FROM b FULL JOIN a USING (device_id, channel_id, user_id) WHERE before IS DISTINCT FROM after GROUP BY ALL")
q("Q01_rollup", lambda v: v.hourly.groupBy(F.to_date("local_hour_start").alias("local_day"), "metric").agg(F.sum("sample_count").alias("samples"), F.sum("kwh").alias("kwh"), F.max("p95").alias("p95")), "hourly", f"SELECT {DAY} AS local_day, metric, CAST(sum(sample_count) AS BIGINT) AS samples, sum(kwh) AS kwh, max(p95) AS p95 FROM hourly GROUP BY ALL", doubles="kwh p95")

# -------------------------------------------------------------------------------------------------- blocks of composite reports
FIRST, LAST, NOW = "2024-01-02", "2024-01-29", "2024-01-20 12:30:00"
_RANGE = f"{DAY} BETWEEN DATE '{FIRST}' AND DATE '{LAST}'"


def history(block: str):
    return lambda v: reports.history(v.hourly, v.daily, v.meter, v.dim, FIRST, LAST, POLL_S)[block]


q("Q04_history_circuit_days", history("circuit_days"), "hourly", f"SELECT {DAY} AS local_day, device_id || '/' || channel_id AS series, {LEVEL} AS level, sum(kwh) AS kwh FROM hourly WHERE metric = 'watts' AND {_RANGE} GROUP BY ALL", doubles="kwh")
q("Q04_history_meter", history("meter"), "hourly meter", f"; p AS (SELECT local_day, sum(kwh) AS panel_kwh, count(*) AS series, CAST(min(n) AS BIGINT) AS worst_samples FROM (SELECT {DAY} AS local_day, device_id, channel_id, sum(kwh) AS kwh, sum(sample_count) AS n FROM hourly WHERE metric = 'watts' AND {FEED} AND {_RANGE} GROUP BY ALL) GROUP BY ALL), m AS (SELECT device_id, CAST(ts_local AS DATE) AS local_day, sum(value) AS meter_kwh, count(*) AS intervals FROM meter WHERE interval_s = 900 AND CAST(ts_local AS DATE) BETWEEN DATE '{FIRST}' AND DATE '{LAST}' GROUP BY ALL) SELECT *, panel_kwh - meter_kwh AS delta_kwh FROM p FULL JOIN m USING (local_day)", doubles="panel_kwh meter_kwh delta_kwh")
# Orders lie in other years than events, so the components' block is asked for the years of the orders.
q("Q04_history_hvac", lambda v: reports.history(v.hourly, v.daily, v.meter, v.dim, "1992-01-01", "1998-12-31", POLL_S)["hvac"], "daily", "SELECT local_day, " + ", ".join(f"max(kwh) FILTER (WHERE channel_id = '{c}') AS kwh_{c}" for c in ("low", "medium", "high", "urgent", "not_specified")) + ", sum(usd) AS usd, count(*) AS components FROM daily WHERE local_day BETWEEN DATE '1992-01-01' AND DATE '1998-12-31' GROUP BY ALL", doubles="kwh_low kwh_medium kwh_high kwh_urgent kwh_not_specified usd")
q("Q04_history_coverage", history("coverage"), "hourly", f"; p AS (SELECT {DAY} AS local_day, source, device_id, channel_id, metric, CAST(sum(sample_count) AS BIGINT) AS samples, CAST({86400 // POLL_S} AS BIGINT) AS expected, sum(sample_count) / {86400 / POLL_S} * 100 AS coverage_pct FROM hourly WHERE {_RANGE} GROUP BY ALL) SELECT *, CAST(24 AS BIGINT) AS hours, CASE WHEN coverage_pct >= 98 THEN 'complete' WHEN coverage_pct >= 80 THEN 'thin' WHEN coverage_pct >= 50 THEN 'sparse' ELSE 'mostly missing' END AS status FROM p", doubles="coverage_pct")
q("Q04_history_kpi", history("kpi"), "hourly", f"; d AS (SELECT device_id, channel_id, {DAY} AS local_day, sum(kwh) AS kwh FROM hourly WHERE metric = 'watts' AND {_RANGE} GROUP BY ALL), b AS (SELECT device_id || '/' || channel_id AS k, sum(kwh) AS kwh FROM d WHERE channel_id LIKE 'breaker_%' GROUP BY ALL) SELECT (SELECT sum(kwh) FROM d WHERE {FEED}) AS house_kwh, (SELECT count(DISTINCT local_day) FROM d) AS days, (SELECT arg_max(k, kwh) FROM b) AS top_branch, (SELECT max(kwh) FROM b) AS top_kwh", doubles="house_kwh top_kwh")
q("Q09_hvac_series", lambda v: reports.hvac_compare(pairs(v))["series"].select("bucket", "state", "capacity", "watts", "modelled_w", "residual_w"), "obs", _PAIRS + ", k AS (SELECT CASE WHEN count(*) >= 30 THEN avg(pp) ELSE 29.9 END AS coefficient FROM c) SELECT bucket, state, capacity, watts, capacity * coefficient AS modelled_w, watts - capacity * coefficient AS residual_w FROM p, k", doubles="capacity watts modelled_w residual_w")
live = lambda block: lambda v: reports.live_panel(v.obs, v.dim, NOW, 2 * 86400, 7200, POLL_S)[block]
_WINDOW = f"ts_utc < '{NOW}' AND ts_utc >= TIMESTAMP '{NOW}' - INTERVAL 2 DAY"
q("Q18_series_stats", live("stats"), "obs", f"SELECT source, device_id, channel_id, metric, count(*) AS n, count(*) FILTER (WHERE value = 0) AS zeros, min(value) AS min, max(value) AS max, avg(value) AS mean, count(*) / {2 * 86400 / POLL_S} * 100 AS coverage_pct FROM obs WHERE {_WINDOW} GROUP BY ALL", doubles="min max mean coverage_pct")
q("Q18_top_overlay", live("overlay"), "obs", f"; l AS (SELECT source, device_id, channel_id, max(value) AS peak FROM obs WHERE metric = 'watts' AND {_WINDOW} GROUP BY ALL ORDER BY peak DESC, source, device_id, channel_id LIMIT 3) SELECT source, device_id, channel_id, time_bucket(INTERVAL '7200 seconds', ts_utc, TIMESTAMP '1970-01-01') AS bucket, avg(value) AS mean_w, count(*) AS n FROM obs SEMI JOIN l USING (source, device_id, channel_id) WHERE metric = 'watts' AND {_WINDOW} GROUP BY ALL", doubles="mean_w")
_CADENCE = f"; dl AS (SELECT ts_local, date_diff('microsecond', lag(ts_utc) OVER (PARTITION BY source, device_id, channel_id, metric ORDER BY ts_utc), ts_utc) // 1000000 AS delta_s FROM obs), days AS (SELECT CAST(ts_local AS DATE) AS local_day, CASE WHEN count(*) >= 20 THEN abs(median(delta_s) - {POLL_S}) <= 0.25 * {POLL_S} END AS cadence_agrees FROM dl WHERE delta_s >= 1 GROUP BY CAST(ts_local AS DATE))"
q("Q01_checked_rollup", lambda v: rollup.checked_rollup(v.obs, POLL_S, allow_mismatch=True).groupBy(F.to_date("local_hour_start").alias("local_day"), "metric", "cadence_agrees").agg(F.sum("sample_count").alias("samples"), F.sum("kwh").alias("kwh")), "obs hourly", _CADENCE + f" SELECT h.local_day, metric, cadence_agrees, CAST(sum(sample_count) AS BIGINT) AS samples, sum(kwh) AS kwh FROM (SELECT *, {DAY} AS local_day FROM hourly) h LEFT JOIN days USING (local_day) GROUP BY ALL", doubles="kwh")

# ---------------------------------------------------------------------------------------------------------------- whole reports
LIMITS = reports.Limits(least_samples=1, limit_w=400.0, busy_watts=50.0, floor_kwh=0.05, quiet_days=1, stuck_hours=4, stuck_duty=0.5, strip_kwh=3.0, mild_f=2.0, barn_high=5.5, barn_low=4.9, barn_days=2, growth_w=5.0)
#: Component energy and outdoor lows in the days of the events: two channels stand for them.
_strip = lambda v: a.daily_kwh(v.hourly).where("channel_id = 'breaker_p10' AND device_id = 'hub0'").select("local_day", "channel_id", (F.col("kwh") * 100).alias("kwh"))
_outdoor = lambda v: a.daily_kwh(v.hourly).where("channel_id = 'breaker_p14' AND device_id = 'hub0'").select("local_day", (F.col("kwh") * 100).alias("low"))


def digested(block: str):
    """The digest of a day over instruments whose even devices read a little low, so that some are found at fault and some are not."""

    def build(v):
        shifted = v.hourly.withColumn("min", F.when(F.col("device_id") == "hub0", F.col("min") - 0.5).otherwise(F.col("min")))
        return reports.digest(shifted, _strip(v), v.meter, TODAY, "m0", "m1", "breaker_p10", _outdoor(v), limits=LIMITS)[block]

    return build


_T = f"DATE '{TODAY}'"
_DIGEST = f"""; hh AS (SELECT * REPLACE (CASE WHEN device_id = 'hub0' THEN min - 0.5 ELSE min END AS min), {KEY} AS key, {DAY} AS local_day FROM hourly WHERE metric = 'watts'), {_disagree().removeprefix('; ')},
c0 AS (SELECT 'corrupt_reading' AS rule, key, local_day, NULL AS kwh FROM hh WHERE greatest(abs(min), abs(max)) >= 400 GROUP BY ALL), n0 AS (SELECT 'negative_reading' AS rule, key, local_day, NULL AS kwh FROM hh WHERE min < 0 GROUP BY ALL),
still AS (SELECT key, min, hour_start_utc, local_day, date_diff('hour', TIMESTAMP '1970-01-01', hour_start_utc) - row_number() OVER (PARTITION BY key, min ORDER BY hour_start_utc) AS run FROM hh WHERE channel_id LIKE 'ct%' AND min = max AND min <> 0),
fr AS (SELECT 'frozen_channel' AS rule, key, CAST(min(local_day) AS DATE) AS local_day, NULL AS kwh FROM (SELECT key, min, run, min(CAST(hour_start_utc AS DATE)) AS local_day, count(*) AS n FROM still GROUP BY ALL HAVING count(*) >= 2) GROUP BY key, min, run),
ex AS (SELECT 'feed_below_children' AS rule, device_id AS key, local_day, NULL AS kwh FROM (SELECT device_id, hour_start_utc, local_day, sum(mean) FILTER (WHERE {FEED}) AS f, sum(mean) FILTER (WHERE channel_id LIKE 'breaker_%' OR channel_id LIKE 'ct_2%') AS c, count(*) FILTER (WHERE channel_id LIKE 'breaker_%' OR channel_id LIKE 'ct_2%') AS k FROM hh GROUP BY ALL) WHERE f IS NOT NULL AND k >= 3 AND c - f > greatest(0.05 * f, 100) GROUP BY ALL),
bad AS (SELECT DISTINCT key FROM (SELECT key FROM c0 UNION ALL SELECT key FROM n0 UNION ALL SELECT key FROM fr)),
k AS (SELECT key, local_day, sum(kwh) AS kwh, count(*) AS hours, count(*) FILTER (WHERE mean >= 50) AS busy FROM hh ANTI JOIN bad USING (key) GROUP BY ALL),
b0 AS (SELECT * FROM k WHERE local_day < {_T} AND local_day >= {_T} - 21), mm AS (SELECT key, median(kwh) AS median FROM b0 GROUP BY ALL HAVING count(*) >= 7), ff AS (SELECT key, median(abs(kwh - median)) AS mad FROM b0 JOIN mm USING (key) GROUP BY ALL),
ov AS (SELECT 'above_band' AS rule, key, local_day, kwh - median AS kwh FROM k JOIN mm USING (key) JOIN ff USING (key) WHERE local_day = {_T} AND kwh > median + greatest(mad * 1.4826 * 4, 0.05, median * 0.15)),
qu AS (SELECT 'circuit_went_quiet' AS rule, key, local_day, NULL AS kwh FROM k WHERE local_day = {_T} AND kwh < 0.5),
us AS (SELECT key, sum(busy) / sum(hours) AS duty FROM k WHERE local_day < {_T} GROUP BY ALL), st AS (SELECT 'stuck_load' AS rule, key, local_day, NULL AS kwh FROM k JOIN us USING (key) WHERE local_day = {_T} AND hours >= 4 AND busy / hours >= 0.5 AND duty < 0.9),
dk AS (SELECT channel_id, local_day, sum(kwh) * 100 AS kwh FROM (SELECT channel_id, {DAY} AS local_day, kwh FROM hourly WHERE metric = 'watts' AND device_id = 'hub0' AND channel_id IN ('breaker_p10', 'breaker_p14')) GROUP BY ALL),
sh AS (SELECT 'strip_heat_in_mild_weather' AS rule, 'breaker_p10' AS key, a.local_day, a.kwh FROM dk a JOIN dk o ON o.local_day = a.local_day AND o.channel_id = 'breaker_p14' WHERE a.channel_id = 'breaker_p10' AND a.local_day = {_T} AND a.kwh >= 3 AND o.kwh > 2),
bd AS (SELECT CAST(ts_local AS DATE) AS local_day, sum(value) AS kwh FROM meter WHERE interval_s = 900 AND device_id = 'm1' GROUP BY ALL), low AS (SELECT *, date_diff('day', DATE '1970-01-01', local_day) - row_number() OVER (ORDER BY local_day) AS run FROM bd WHERE kwh < 4.9 AND local_day <= {_T}),
be AS (SELECT 'barn_envelope' AS rule, 'm1' AS key, local_day, NULL AS kwh FROM (SELECT local_day FROM bd WHERE kwh > 5.5 UNION ALL SELECT max(local_day) FROM low GROUP BY run HAVING count(*) >= 2) WHERE local_day = {_T}),
nf AS (SELECT local_day, min(w) AS w FROM (SELECT hour_start_utc, local_day, sum(mean) AS w FROM hh ANTI JOIN bad USING (key) WHERE {FEED} AND hour(local_hour_start) BETWEEN 1 AND 4 GROUP BY ALL) GROUP BY ALL),
ph AS (SELECT 'phantom_load_growth' AS rule, 'house' AS key, local_day, NULL AS kwh FROM nf WHERE local_day = {_T} AND w - (SELECT median(w) FROM nf WHERE local_day < {_T} AND local_day >= {_T} - 21) >= 5),
rules AS (SELECT * FROM c0 UNION ALL SELECT * FROM n0 UNION ALL SELECT * FROM fr UNION ALL SELECT * FROM ex UNION ALL SELECT 'meter_disagreement', 'meter', local_day, kwh - meter_kwh FROM d WHERE skipped IS NULL AND off_pct > 10 UNION ALL SELECT * FROM ov UNION ALL SELECT * FROM qu UNION ALL SELECT * FROM st UNION ALL SELECT * FROM sh UNION ALL SELECT * FROM be UNION ALL SELECT * FROM ph)"""
q("Q03_digest", lambda v: digested("findings")(v).select("rule", "key", "local_day", "kwh", "usd"), "hourly meter", _DIGEST + f" SELECT rule, key, local_day, CAST(kwh AS DOUBLE) AS kwh, kwh * 0.12 AS usd FROM rules WHERE local_day = {_T}", doubles="kwh usd")
q("Q03_untrusted", digested("untrusted"), "hourly meter", _DIGEST + " SELECT key FROM bad")
q("Q03_above_every_day", lambda v: an.trailing_bands(_daily(v), ["device_id", "channel_id"], floor_kwh=0.05).where(F.col("kwh") > F.col("median") + 0.25 * F.col("width")).select("device_id", "channel_id", "local_day", "kwh", "median", "upper"), "hourly", f"; {_KWH}, w AS (SELECT device_id, channel_id, local_day, kwh, median(kwh) OVER p AS median, list(kwh) OVER p AS l FROM k WINDOW p AS (PARTITION BY device_id, channel_id ORDER BY local_day RANGE BETWEEN INTERVAL 21 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING)), x AS (SELECT * EXCLUDE (l), greatest(list_median(list_transform(l, lambda x: abs(x - median))) * 1.4826 * 4, 0.05, median * 0.15) AS width FROM w WHERE len(l) >= 7) SELECT device_id, channel_id, local_day, kwh, median, median + width AS upper FROM x WHERE kwh > median + 0.25 * width", doubles="kwh median upper")


def equipment(block: str):
    def build(v):
        state = F.when(F.col("event_type") == "click", "off").when(F.col("event_type") == "view", "low").when(F.col("event_type") == "error", "high").when(F.col("event_type") == "signup", "idle").otherwise("dehumidify")
        states = v.obs.where("metric = 'volts'").groupBy(lt.bucket("ts_utc", 3600).alias("bucket")).agg(F.avg((F.col("event_id") % 101).cast("double")).alias("capacity"), F.max(state).alias("state"), F.avg((F.col("event_id") % 5000).cast("double")).alias("rpm"), F.avg((F.col("event_id") % 700).cast("double")).alias("cfm"))
        return reports.hvac_report(v.obs, v.hourly, _component(v.hourly), states, f"{FIRST} 00:00:00", f"{LAST} 00:00:00", 3600, POLL_S, 4, 0.3)[block]

    return build


q("Q09_observed_energy", equipment("energy"), "obs", f"; b AS (SELECT date_trunc('hour', ts_utc) AS bucket, source, device_id, channel_id, avg(value) AS w, least(3600, count(*) * {POLL_S}) AS s FROM obs WHERE metric = 'watts' AND ts_utc >= '{FIRST}' AND ts_utc < '{LAST}' GROUP BY ALL) SELECT source, device_id, channel_id, sum(w * s) / 3.6e6 AS kwh, CAST(sum(s) AS DOUBLE) AS observed_s FROM b GROUP BY ALL", doubles="kwh observed_s", digits=4)
q("Q09_equipment_days", equipment("days"), "hourly", _feeds() + _VS.format(DAY, "hourly"), doubles="kwh panel_kwh coverage delta_kwh")
q("Q09_states", equipment("states"), "obs", _PAIRS.replace("FROM obs WHERE metric", f"FROM obs WHERE ts_utc >= '{FIRST}' AND ts_utc < '{LAST}' AND metric") + ", k AS (SELECT CASE WHEN count(*) >= 30 THEN avg(pp) ELSE 29.9 END AS coefficient FROM c) SELECT state, count(*) AS buckets, avg(watts) AS mean_w, avg(abs(watts - capacity * coefficient)) AS mean_abs_residual_w FROM p, k GROUP BY ALL", doubles="mean_w mean_abs_residual_w")
