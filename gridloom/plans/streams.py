"""Streaming queries: each streams files that Spark derives from the given tables, until they are used up, and reads the sink."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import storage
from ..schemas import CHANNEL, OBSERVATION
from ..sources import payloads as p
from ..streaming import ingest, state
from ..views import POLL_S
from .ingest import _PANEL_SQL, panel_docs
from .registry import Registry

REGISTRY = Registry()
q = REGISTRY.add
_ID = T.StructField("event_id", T.LongType())
ROWS = T.StructType([*OBSERVATION.fields, _ID])
_NAMES = [f.name for f in ROWS]


def landed(v, df, name: str, parts: int = 4) -> str:
    path = storage.new_path(v.spark, name)
    df.repartition(parts).write.parquet(path)
    return path


def poll_stream(v):
    """Poll documents as JSON lines, mapped as they arrive."""
    path = storage.new_path(v.spark, "polls")
    panel_docs(v).select(F.to_json("p").alias("value")).repartition(4).write.text(path)
    docs = p.parse(v.spark.readStream.schema("value string").text(path), p.PANEL)
    out = ingest.run_to_table(p.panel(docs), "observations")
    return v.spark.read.parquet(out).groupBy("channel_id").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


q("ST01_poll_ingest", poll_stream, "", f"SELECT channel_id, count(*) AS n, sum(value) AS total FROM ({_PANEL_SQL}) GROUP BY ALL", doubles="total", digits=3)


def deduped_stream(v):
    path = landed(v, v.obs_dup.select(*_NAMES), "twice")
    out = ingest.run_to_table(ingest.first_wins(ingest.stream_of(v.spark, path, ROWS), "60 days"), "once")
    return v.spark.read.parquet(out).groupBy(*CHANNEL, "metric").agg(F.count("*").alias("n"))


q("ST02_dedupe_on_arrival", deduped_stream, "obs", "SELECT source, device_id, channel_id, metric, count(DISTINCT ts_utc) AS n FROM obs GROUP BY ALL")


def windowed(v, late: str):
    path = landed(v, v.obs.select(*_NAMES), "samples")
    out = ingest.run_to_table(ingest.hourly_windows(ingest.stream_of(v.spark, path, ROWS), POLL_S, late), "hours")
    return v.spark.read.parquet(out)


_CLOSED = "; h AS (SELECT date_trunc('hour', ts_utc) AS hour_start_utc, source, device_id, channel_id, metric, avg(value) AS mean, min(value) AS min, max(value) AS max, count(*) AS sample_count FROM obs GROUP BY ALL) SELECT *, CASE WHEN metric = 'watts' THEN mean * sample_count * 1800 / 3.6e6 END AS kwh FROM h WHERE hour_start_utc + INTERVAL 1 HOUR <= (SELECT max(ts_utc) FROM obs) - INTERVAL {} HOUR"
q("ST03_hourly_windows", lambda v: windowed(v, "1 hour"), "obs", _CLOSED.format(1), doubles="mean min max kwh")
q("ST04_closed_hour_gate", lambda v: windowed(v, "0 seconds").groupBy("hour_start_utc").agg(F.count("*").alias("series")), "obs", f"; x AS ({_CLOSED.format(0).removeprefix('; ').replace('h AS (', 'WITH h AS (', 1)}) SELECT hour_start_utc, count(*) AS series FROM x GROUP BY ALL")


def rerolled(v):
    """Late halves of days arrive in a second file: the days touched are rolled again from all that is landed."""
    src, raw, hourly, check = (storage.new_path(v.spark, n) for n in ("late", "raw", "hourly", "checkpoint"))
    rows = v.obs.select(*_NAMES)
    for half in ("event_id % 2 = 0", "event_id % 2 = 1"):
        rows.where(half).repartition(2).write.mode("append").parquet(src)
        ingest.reroll_touched_days(ingest.stream_of(v.spark, src, ROWS), raw, hourly, check, POLL_S)
    return storage.read_published(v.spark, hourly).groupBy("local_date").agg(F.sum("sample_count").alias("n"), F.sum("kwh").alias("kwh"))


q("ST05_touched_days", rerolled, "hourly", "SELECT CAST(local_hour_start AS DATE) AS local_date, CAST(sum(sample_count) AS BIGINT) AS n, sum(kwh) AS kwh FROM hourly GROUP BY ALL", doubles="kwh")

FRAMES = "hub string, id string, at_s long, number long, kind string, fields string"
TARGETS = 4
_P = 1_000_000_000


def frames(v):
    """Events as frames of four objects on each of two hubs: sessions, seeds, and deltas of one field of three; some are null."""
    n = F.col("event_id")
    kind = F.when(n % 211 == 0, "connect").when(n % 211 == 105, "disconnect").when(n % 17 == 0, "seed").otherwise("delta")
    at = F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', CAST(ts AS TIMESTAMP_NTZ))")
    value = F.when(n % 11 > 0, F.floor("value").cast("string"))
    fields = F.to_json(F.create_map(F.concat(F.lit("f"), (n % 3).cast("string")), value), {"ignoreNullFields": "false"})
    return v.table("events").select(F.concat(F.lit("h"), (F.col("user_id") % 2).cast("string")).alias("hub"), (F.col("user_id") % 8).cast("string").alias("id"), at.alias("at_s"), (at * _P + n).alias("number"), kind.alias("kind"), fields.alias("fields"))


#: Frames reach the collector up to an hour out of order, and those of the second hub a day and a half after the first's.
DISORDER_S, LAG_S = 3600, 129_600


def merged_stream(v, ended: bool = False):
    """Frames land as they arrive, in four stretches; the stream is started anew after each, from one checkpoint, and takes its state along.

    ``ended``: after the last frames each hub's clock goes on until all that waits is taken and the hub counts as silent; without, the
    last ``DISORDER_S`` seconds of each hub wait for frames to come.
    """
    src, check, out = (storage.new_path(v.spark, n) for n in ("frames", "checkpoint", "merged"))
    arrival = F.col("at_s") + (F.col("number") % DISORDER_S * 37) % DISORDER_S + F.when(F.col("hub") == "h1", LAG_S).otherwise(0)
    rows = frames(v).withColumn("arrival", arrival)
    first, last = rows.agg(F.min("arrival"), F.max("arrival")).first()
    stretch = F.least(F.floor((F.col("arrival") - (first or 0)) * 4 / max((last or 0) - (first or 0), 1)), F.lit(3))
    landing = [rows.where(stretch == k).drop("arrival").repartition(4) for k in range(4)]
    if ended:
        end = F.max("at_s") + state.SILENCE_S + DISORDER_S
        landing.append(rows.groupBy("hub").agg(end.alias("at_s")).select("hub", F.lit("").alias("id"), "at_s", (F.col("at_s") * _P).alias("number"), F.lit("clock").alias("kind"), F.lit("{}").alias("fields")))
    for landed_frames in landing:
        landed_frames.write.mode("append").parquet(src)
        stream = v.spark.readStream.schema(FRAMES).option("maxFilesPerTrigger", 100).parquet(src)
        ingest.run_to_table(state.merge_deltas(stream, TARGETS, DISORDER_S), "merged", checkpoint=check, path=out, store=ingest.ROCKSDB)
    return v.spark.read.schema(state.OUTPUT).parquet(out)


def samples(v, ended: bool = False):
    return merged_stream(v, ended).where("what = 'sample'")


def by_mode(v):
    taken = samples(v, ended=True)
    tick = F.ceil(F.col("at_s") / state.CADENCE_S).cast("long") * state.CADENCE_S
    seeds = frames(v).where("kind = 'seed'").select("hub", "id", tick.alias("at_s"), "number", F.explode(F.from_json("fields", "map<string,string>")).alias("field", "value")).where("value IS NOT NULL")
    polls = seeds.groupBy("hub", "id", "at_s", "field").agg(F.max_by("value", "number").alias("value"))
    modes = [state.with_polls(taken, polls, m).withColumn("mode", F.lit(m)) for m in ("ws", "hybrid")]
    return modes[0].unionByName(modes[1]).groupBy("mode", "value_source").agg(F.count("*").alias("samples"), F.countDistinct("id").alias("objects"))


# The same rules as intervals: p orders frames (second, then number), a session runs from its connect to the next mark, a write until the next
# that takes effect, and a tick sees all frames up to the end of its second. A hub's time is that of its newest frame less the disorder allowed;
# in _ENDED_SQL it goes on to SILENCE_S past that frame, and no frame waits.
_STATE_SQL = f"""WITH e0 AS (SELECT *, t * {_P} + event_id AS p, max(t) OVER (PARTITION BY hub) - {DISORDER_S} AS lim FROM (SELECT event_id, 'h' || CAST(user_id % 2 AS VARCHAR) AS hub, CAST(user_id % 8 AS VARCHAR) AS id, CAST(floor(epoch(ts)) AS BIGINT) AS t,
CASE WHEN event_id % 211 = 0 THEN 'connect' WHEN event_id % 211 = 105 THEN 'disconnect' WHEN event_id % 17 = 0 THEN 'seed' ELSE 'delta' END AS kind,
'f' || CAST(event_id % 3 AS VARCHAR) AS field, CASE WHEN event_id % 11 > 0 THEN CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) END AS v FROM events)),
e AS (SELECT * FROM e0 WHERE t <= lim), lims AS (SELECT DISTINCT hub, lim FROM e0),
marks AS (SELECT hub, p AS session, t AS since, kind AS mark, lead(p) OVER (PARTITION BY hub ORDER BY p) AS end_p FROM e WHERE kind IN ('connect', 'disconnect')),
w AS (SELECT x.*, since, end_p FROM (SELECT *, max(CASE WHEN kind IN ('connect', 'disconnect') THEN p END) OVER (PARTITION BY hub ORDER BY p) AS session FROM e) x JOIN marks USING (hub, session) WHERE mark = 'connect' AND kind IN ('delta', 'seed')),
flood AS (SELECT hub, session, max(fp) AS flood_p FROM (SELECT hub, session, id, min(p) AS fp FROM w WHERE kind = 'delta' GROUP BY ALL) GROUP BY ALL HAVING count(*) >= {TARGETS}),
late AS (SELECT hub, session, since, end_p, CASE WHEN min(t) < since + 20 THEN least(min(p) FILTER (t = since + 20), (since + 20) * {_P} + {_P - 1}) ELSE min(p) FILTER (t >= since + 20) END AS late_p FROM w GROUP BY hub, session, since, end_p),
synced AS (SELECT hub, session, end_p, least(flood_p, late_p) AS sync_p, least(flood_p, late_p) // {_P} AS sync_s, CASE WHEN flood_p <= coalesce(late_p, flood_p) THEN 'flood' ELSE 'timeout' END AS how
FROM late LEFT JOIN flood USING (hub, session) JOIN lims USING (hub) WHERE least(flood_p, late_p) < coalesce(end_p, (lim + 1) * {_P})),
g AS (SELECT *, count(*) FILTER (kind = 'delta') OVER (PARTITION BY hub, session, id, field ORDER BY p) AS grp FROM w),
g2 AS (SELECT *, max(CASE WHEN kind = 'delta' THEN v END) OVER gw AS dv, min(CASE WHEN kind = 'seed' AND v IS NOT NULL THEN p END) OVER gw AS fs FROM g WINDOW gw AS (PARTITION BY hub, session, id, field, grp)),
iv AS (SELECT *, lead(p) OVER (PARTITION BY hub, session, id, field ORDER BY p) AS next_p FROM g2 WHERE kind = 'delta' OR (dv IS NULL AND p = fs)),
heard AS (SELECT hub, t, lead(t) OVER (PARTITION BY hub ORDER BY t) AS next_t FROM (SELECT DISTINCT hub, t FROM e WHERE kind IN ('delta', 'connect'))),
ticks AS (SELECT hub, s, s * {_P} + {_P - 1} AS sp FROM (SELECT hub, t, next_t, ((t + 29) // 30 + j) * 30 AS s FROM heard, (VALUES (0), (1), (2), (3)) js(j)) JOIN lims USING (hub) WHERE s - t <= 90 AND s < coalesce(next_t, lim + 1) AND s <= lim),
samples AS (SELECT k.hub, i.id, k.s AS at_s, i.field, i.v AS value, i.t AS updated_s, i.kind AS value_source, i.session FROM ticks k JOIN synced c ON c.hub = k.hub AND sync_p <= sp AND (c.end_p IS NULL OR c.end_p > sp)
JOIN iv i ON i.hub = c.hub AND i.session = c.session AND i.p <= sp AND (next_p IS NULL OR next_p > sp) WHERE v IS NOT NULL),
ends AS (SELECT hub, session, id, field, v FROM (SELECT DISTINCT hub, session, id, field FROM w) LEFT JOIN (SELECT hub, session, id, field, v FROM iv WHERE next_p IS NULL) USING (hub, session, id, field)),
evicted AS (SELECT hub, id, field, session, at_s FROM (SELECT c.hub, l.id, l.field, c.session, c.sync_s AS at_s, c.sync_p, l.v, row_number() OVER (PARTITION BY c.hub, c.session, l.id, l.field ORDER BY l.session DESC) AS r
FROM (SELECT *, lag(session) OVER (PARTITION BY hub ORDER BY session) AS before FROM synced) c JOIN ends l ON l.hub = c.hub AND l.session < c.session AND l.session >= coalesce(c.before, 0)) z
WHERE r = 1 AND v IS NOT NULL AND NOT EXISTS (SELECT 1 FROM w WHERE w.hub = z.hub AND w.id = z.id AND w.field = z.field AND w.session = z.session AND w.p <= z.sync_p))
"""
_ENDED_SQL = _STATE_SQL.replace(f" - {DISORDER_S} AS lim", f" + {state.SILENCE_S} AS lim", 1).replace("(SELECT * FROM e0 WHERE t <= lim)", "(SELECT * FROM e0)", 1)
_BY_FIELD = "hub, id, field, count(*) AS samples, CAST(sum(CAST(value AS BIGINT)) AS BIGINT) AS total, max(at_s) AS last_s"
_SEEDED = "hub, id, field, session, updated_s, count(*) AS samples"
_GATE = "hub, session, count(DISTINCT at_s) AS ticks, min(at_s) AS first_s, max(at_s) AS last_s, max(at_s - updated_s) AS oldest_s"
_CADENCE = f"hub, at_s % {state.CADENCE_S} AS offset_s, count(*) AS samples, count(DISTINCT at_s) AS ticks"


q("ST06_merge_deltas", lambda v: samples(v).groupBy("hub", "id", "field").agg(F.count("*").alias("samples"), F.sum(F.col("value").cast("long")).alias("total"), F.max("at_s").alias("last_s")), "", f"{_STATE_SQL} SELECT {_BY_FIELD} FROM samples GROUP BY ALL")
q("ST07_seed_guard", lambda v: samples(v, ended=True).where("value_source = 'seed'").groupBy("hub", "id", "field", "session", "updated_s").agg(F.count("*").alias("samples")), "", f"{_ENDED_SQL} SELECT {_SEEDED} FROM samples WHERE value_source = 'seed' GROUP BY ALL")
q("ST08_eviction", lambda v: merged_stream(v).where("what = 'evicted'").select("hub", "id", "field", "session", "at_s"), "", f"{_STATE_SQL} SELECT * FROM evicted")
q("ST09_emission_gate", lambda v: samples(v).groupBy("hub", "session").agg(F.countDistinct("at_s").alias("ticks"), F.min("at_s").alias("first_s"), F.max("at_s").alias("last_s"), F.max(F.col("at_s") - F.col("updated_s")).alias("oldest_s")), "", f"{_STATE_SQL} SELECT {_GATE} FROM samples GROUP BY ALL")
q("ST10_sync_rule", lambda v: merged_stream(v).where("what = 'sync'").select("hub", "session", "at_s", F.col("value").alias("how")), "", f"{_STATE_SQL} SELECT hub, session, sync_s AS at_s, how FROM synced")
q("ST11_fixed_cadence", lambda v: samples(v, ended=True).groupBy("hub", (F.col("at_s") % state.CADENCE_S).alias("offset_s")).agg(F.count("*").alias("samples"), F.countDistinct("at_s").alias("ticks")), "", f"{_ENDED_SQL} SELECT {_CADENCE} FROM samples GROUP BY ALL")
q("ST12_value_sources", by_mode, "", f"""{_ENDED_SQL}, polls AS (SELECT DISTINCT hub, id, field, (t + 29) // 30 * 30 AS at_s FROM e0 WHERE kind = 'seed' AND v IS NOT NULL),
modes AS (SELECT 'ws' AS mode, value_source, id FROM samples UNION ALL SELECT 'hybrid', value_source, id FROM samples UNION ALL SELECT 'hybrid', 'rest', id FROM polls p WHERE NOT EXISTS (SELECT 1 FROM samples s WHERE s.hub = p.hub AND s.at_s = p.at_s))
SELECT mode, value_source, count(*) AS samples, count(DISTINCT id) AS objects FROM modes GROUP BY ALL""")


def restarted(v):
    """Two runs from one checkpoint over a source that grows between them: nothing lost, nothing twice."""
    src, check, out = (storage.new_path(v.spark, n) for n in ("growing", "checkpoint", "sink"))
    rows = v.obs.select(*_NAMES)
    for third in range(3):
        rows.where(f"event_id % 3 = {third}").repartition(2).write.mode("append").parquet(src)
        ingest.run_to_table(ingest.stream_of(v.spark, src, ROWS), "sink", checkpoint=check, path=out)
    return v.spark.read.parquet(out).groupBy("device_id").agg(F.count("*").alias("n"), F.countDistinct("event_id").alias("ids"))


q("ST15_restart", restarted, "obs", "SELECT device_id, count(*) AS n, count(DISTINCT event_id) AS ids FROM obs GROUP BY ALL")
