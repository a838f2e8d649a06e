"""Documents in, datasets out: payload mappings, imports, the dimension, and partitioned writes read back."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from .. import storage
from ..functions import scalar as s
from ..operators import dedupe, dimension, rollup
from ..schemas import CHANNEL, HOURLY, OBSERVATION, conform
from ..sources import exports
from ..sources import payloads as p
from ..views import POLL_S, local_sql, utc_sql
from .basic import DAY
from .registry import Registry

REGISTRY = Registry()
q = REGISTRY.add
_ID = "event_id"


def _text():
    return F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")


_landed: dict[tuple, str] = {}


def landed(v, name: str, docs):
    """Documents as a collector leaves them: JSON lines in files, written once a session for each folder of tables, and read as a source."""
    key = (v.spark.sparkContext.applicationId, v.dir, name)
    if key not in _landed:
        path = storage.new_path(v.spark, name)
        docs.select("value").repartition(int(v.spark.conf.get("spark.sql.shuffle.partitions"))).write.text(path)
        _landed[key] = path
    return v.spark.read.text(_landed[key])


def panel_docs(v):
    """A hub poll for each event, as JSON text."""
    e = v.table("events")
    breaker = F.struct((F.col("user_id") % 30).cast("int").alias("position"), (1 + F.col(_ID) % 2).cast("int").alias("poles"), F.when(F.col(_ID) % 9 == 0, "NONE-2").otherwise("LB120").alias("model"), F.col("value").alias("power"), F.when(F.col(_ID) % 5 > 0, F.col("value") * 2).alias("power2"))
    ct = F.struct((1 + F.col(_ID) % 3).cast("int").alias("channel"), F.when(F.col(_ID) % 4 == 0, "NOT_USED").otherwise("MAIN").alias("usageType"), F.col("value").alias("activePower"), F.when(F.col(_ID) % 2 > 0, F.col("value") + 1).alias("activePower2"))
    doc = F.to_json(F.struct(F.concat(F.lit("hub"), (F.col("user_id") % 2).cast("string")).alias("hub"), _text().alias("ts"), F.array(breaker).alias("breakers"), F.array(ct).alias("cts")))
    return p.parse(landed(v, "panel", e.select(doc.alias("value"))), p.PANEL)


_HEAD = f"ts AS ts_utc, {local_sql('ts')} AS ts_local"
_PANEL_SQL = f"""SELECT {_HEAD}, 'leviton' AS source, 'hub' || CAST(user_id % 2 AS VARCHAR) AS device_id, 'breaker_p' || CAST(user_id % 30 AS VARCHAR) AS channel_id, 'watts' AS metric, CASE WHEN event_id % 2 = 1 THEN value * 3 ELSE value END AS value, 'W' AS unit FROM events WHERE event_id % 9 > 0 AND user_id % 30 >= 1 AND NOT (event_id % 2 = 1 AND event_id % 5 = 0)
UNION ALL SELECT {_HEAD}, 'leviton', 'hub' || CAST(user_id % 2 AS VARCHAR), 'ct_' || CAST(1 + event_id % 3 AS VARCHAR) || '_a', 'watts', value, 'W' FROM events WHERE event_id % 4 > 0
UNION ALL SELECT {_HEAD}, 'leviton', 'hub' || CAST(user_id % 2 AS VARCHAR), 'ct_' || CAST(1 + event_id % 3 AS VARCHAR) || '_b', 'watts', value + 1, 'W' FROM events WHERE event_id % 4 > 0 AND event_id % 2 > 0"""
q("I06_panel_payload", lambda v: p.panel(panel_docs(v)), "", _PANEL_SQL, doubles="value")
q("P04_placeholders", lambda v: p.panel(panel_docs(v)).groupBy("channel_id").agg(F.count("*").alias("n")), "", f"SELECT channel_id, count(*) AS n FROM ({_PANEL_SQL}) GROUP BY ALL")


def status_docs(v):
    e = v.table("events")
    word = F.when(F.col("event_type") == "click", "cool").when(F.col("event_type") == "view", "HEAT").when(F.col("event_type") == "error", "defrost").otherwise("off")
    zones = F.array(F.struct(F.lit(1).alias("id"), F.when(F.col(_ID) % 3 > 0, "on").otherwise("off").alias("enabled"), F.round("value", 1).cast("string").alias("rt"), F.lit("low").alias("fan")), F.struct(F.lit(2).alias("id"), F.lit("off").alias("enabled"), F.lit("70").alias("rt"), F.lit("low").alias("fan")))
    doc = F.to_json(F.struct(F.lit("hp1").alias("device"), _text().alias("ts"), F.when(F.col(_ID) % 2 == 0, "F").otherwise("C").alias("cfgem"), word.alias("mode"), F.when(F.col(_ID) % 4 == 0, "low").when(F.col(_ID) % 4 == 1, "250").otherwise((F.col(_ID) % 101).cast("string")).alias("opstat"), (F.col(_ID) % 90).cast("string").alias("oat"), F.when(F.col(_ID) % 5 == 0, "None").otherwise("500").alias("cfm"), F.lit("513").alias("iducfm"), zones.alias("zones")))
    return p.parse(landed(v, "status", e.select(doc.alias("value"))), p.STATUS)


_COUNT = "SELECT channel_id, metric, unit, count(*) AS n, sum(value) AS total FROM ({}) GROUP BY ALL"
_STATUS_SQL = """SELECT 'system' AS channel_id, 'mode' AS metric, 'enum' AS unit, CAST(CASE event_type WHEN 'click' THEN 2 WHEN 'view' THEN 1 ELSE 0 END AS DOUBLE) AS value FROM events WHERE event_type <> 'error'
UNION ALL SELECT 'system', 'stage', 'enum', 1 FROM events WHERE event_id % 4 = 0 UNION ALL SELECT 'system', 'stage_pct', 'pct', event_id % 101 FROM events WHERE event_id % 4 > 1
UNION ALL SELECT 'system', 'outdoor_temp_f', 'degF', event_id % 90 FROM events WHERE event_id % 2 = 0 UNION ALL SELECT 'system', 'cfm', 'cfm', CASE WHEN event_id % 5 = 0 THEN 513 ELSE 500 END FROM events
UNION ALL SELECT 'zone_1', 'indoor_temp_f', 'degF', CASE WHEN event_id % 2 = 0 THEN round(value, 1) ELSE round(value, 1) * 9 / 5 + 32 END FROM events WHERE event_id % 3 > 0 UNION ALL SELECT 'zone_1', 'fan', 'enum', 1 FROM events WHERE event_id % 3 > 0"""
_summed = lambda df: df.groupBy("channel_id", "metric", "unit").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
q("I07_hvac_status", lambda v: _summed(p.status(status_docs(v))), "", _COUNT.format(_STATUS_SQL), doubles="total", digits=3)
q("P14_fallback_chain", lambda v: p.status(status_docs(v)).where("metric = 'cfm'").groupBy("value").agg(F.count("*").alias("n")), "", "SELECT CAST(CASE WHEN event_id % 5 = 0 THEN 513 ELSE 500 END AS DOUBLE) AS value, count(*) AS n FROM events GROUP BY ALL")
q("P10_unknown_words", lambda v: p.unknown_words(status_docs(v)), "", "SELECT 'mode' AS field, 'defrost' AS word, false AS \"numeric\", count(*) AS n FROM events WHERE event_type = 'error' UNION ALL SELECT 'opstat', '250', true, count(*) FROM events WHERE event_id % 4 = 1")


def energy_docs(v):
    e = v.table("events")
    text = lambda x: F.round(x, 2).cast("string")
    values = lambda k: F.create_map(F.lit("coolingKwh"), text(F.col("value") * k), F.lit("coolingDollars"), F.lit("None"), F.lit("hpheatKwh"), F.lit("0"), F.lit("fanKwh"), F.lit("1.5"))
    periods = F.array(F.struct(F.lit("day1").alias("type"), values(1).alias("values")), F.struct(F.lit("day2").alias("type"), values(2).alias("values")), F.struct(F.lit("month1").alias("type"), values(30).alias("values")))
    on = lambda w: F.struct(F.lit(w).alias("enabled"))
    config = F.create_map(F.lit("cooling"), on("on"), F.lit("hpheat"), on("off"), F.lit("fan"), on("maybe"))
    return p.parse(e.select(F.to_json(F.struct(F.col("user_id").cast("string").alias("serial"), F.date_format("ts", "yyyy-MM-dd").alias("today"), config.alias("config"), periods.alias("periods"))).alias("value")), p.ENERGY)


_DAYS = "SELECT CAST(user_id AS VARCHAR) AS serial, CAST(ts AS DATE) - {0} AS local_day, 'cooling' AS channel_id, 'kwh_day' AS metric, round(value * {0}, 2) AS value FROM events"
_ENERGY_SQL = f"{_DAYS.format(1)} UNION ALL {_DAYS.format(2)}"
q("I08_daily_energy", lambda v: p.daily_energy(energy_docs(v)), "", _ENERGY_SQL, doubles="value")
q("P17_enabled_components", lambda v: p.daily_energy(energy_docs(v)).groupBy("channel_id", "metric").agg(F.count("*").alias("n")), "", f"SELECT channel_id, metric, count(*) AS n FROM ({_ENERGY_SQL}) GROUP BY ALL")
q("I09_legacy_by_date", lambda v: p.dated_map(v.table("events").select(F.to_json(F.create_map(F.date_format("ts", "yyyy-MM-dd"), F.struct(F.create_map(F.lit("cooling"), F.round("value", 2).cast("string"), F.lit("gas"), F.lit(" ")).alias("data")))).alias("value")), "S1").groupBy("serial", "local_day", "field").agg(F.sum("value").alias("total"), F.count("*").alias("n")), "", "SELECT 'S1' AS serial, CAST(ts AS DATE) AS local_day, 'cooling' AS field, sum(round(value, 2)) AS total, count(*) AS n FROM events GROUP BY ALL", doubles="total", digits=3)
q("I10_key_value_export", lambda v: v.table("events").select(F.from_json(F.to_json(F.struct(F.date_format("ts", "yyyy-MM-dd").alias("date"), F.when(F.col(_ID) % 3 > 0, F.col("user_id").cast("string")).alias("serial_number"), F.col("value").cast("string").alias("cooling"))), "date string, serial_number string, cooling string").alias("i")).select(F.to_date("i.date").alias("local_day"), F.coalesce("i.serial_number", F.lit("default")).alias("serial"), s.number("i.cooling").alias("kwh")).groupBy("local_day", "serial").agg(F.sum("kwh").alias("kwh")), "", "SELECT CAST(ts AS DATE) AS local_day, CASE WHEN event_id % 3 > 0 THEN CAST(user_id AS VARCHAR) ELSE 'default' END AS serial, sum(value) AS kwh FROM events GROUP BY ALL", doubles="kwh", digits=3)


def espi_entries(v):
    """Types linked one way or the other, and a block for each event."""
    e = v.table("events").withColumn("m", (F.col("user_id") % 3).cast("string"))
    none = lambda *names: [F.lit(None).cast(t).alias(n) for n, t in names]
    link = lambda kind, key: F.concat(F.lit(f"https://x/espi/1_1/resource/{kind}/"), key)
    keys = e.select("m").distinct()
    types = keys.select(F.lit("reading_type").alias("kind"), F.lit(None).cast("string").alias("device_id"), link("ReadingType", F.col("m")).alias("href"), F.when(F.col("m") == "1", link("MeterReading", F.col("m"))).alias("up"), F.lit(None).cast("string").alias("related"), F.when(F.col("m") == "2", 38).otherwise(72).alias("uom"), F.lit(0).alias("power"), F.lit(1).alias("flow"), *none(("start_s", "long"), ("duration_s", "long"), ("raw", "double")))
    readings = keys.select(F.lit("meter_reading").alias("kind"), F.lit(None).cast("string").alias("device_id"), link("MeterReading", F.col("m")).alias("href"), F.lit(None).cast("string").alias("up"), F.when(F.col("m") != "1", link("ReadingType", F.col("m"))).alias("related"), *none(("uom", "int"), ("power", "int"), ("flow", "int"), ("start_s", "long"), ("duration_s", "long"), ("raw", "double")))
    start = F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', CAST(ts AS TIMESTAMP_NTZ))")
    blocks = e.select(F.lit("interval_block").alias("kind"), F.concat(F.lit("m"), "m").alias("device_id"), F.lit("").alias("href"), link("MeterReading", F.col("m")).alias("up"), F.lit(None).cast("string").alias("related"), *none(("uom", "int"), ("power", "int"), ("flow", "int")), start.alias("start_s"), F.lit(900).cast("long").alias("duration_s"), F.col("value").alias("raw"))
    return types.unionByName(readings).unionByName(blocks)


_ESPI_SQL = "SELECT 'm' || CAST(user_id % 3 AS VARCHAR) AS device_id, date_trunc('second', ts) AS ts_utc, CAST(900 AS INTEGER) AS interval_s, value / 1000 AS value FROM events WHERE user_id % 3 < 2"
q("I11_espi_intervals", lambda v: p.espi_readings(espi_entries(v)), "", _ESPI_SQL, doubles="value")
q("J10_link_graph", lambda v: p.espi_readings(espi_entries(v)).groupBy("device_id").agg(F.count("*").alias("n")), "", f"SELECT device_id, count(*) AS n FROM ({_ESPI_SQL}) GROUP BY ALL")
def usage_files(v, path: str) -> None:
    """Usage tables in nine layouts of their times, each with its headers: half of them have end columns, and some flows and readings are to be skipped.

    A folder for each layout: without ``partitionBy``, Spark writes a table of a header alone where the first partition has no row of a layout,
    and an import refuses that.
    """
    e = v.table("events").withColumn("k", F.col(_ID) % 9)
    layouts = ("MM/dd/yyyy hh:mm:ss a", "MM/dd/yyyy hh:mm a", "MM/dd/yyyy HH:mm:ss", "M/d/yyyy H:mm", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm", "MM/dd/yyyy", "yyyy-MM-dd")
    whole = F.floor(F.col("value") * 100)
    money = F.concat(F.lit("$"), F.format_number(whole, 0))
    usage = F.when(F.col(_ID) % 7 == 0, "").when(F.col(_ID) % 2 == 0, money).otherwise(whole.cast("string"))
    flow = F.when(F.col(_ID) % 5 == 0, "Received").when(F.col(_ID) % 5 == 1, "Delivered").when(F.col(_ID) % 5 == 2, "").otherwise("consumption")
    meter = F.concat(F.lit("Meter #"), (130000 + F.col("user_id") % 3).cast("string"), F.lit(" - Total"))
    for k, layout in enumerate(layouts):
        start, end = F.date_format("ts", layout), F.date_format(F.col("ts") + F.expr("INTERVAL 30 MINUTES"), layout)
        cells = [start.alias("Interval Start"), *([end.alias("Interval End")] if k < 7 and k % 2 else []), usage.alias("Consumption (kWh)" if k % 3 else "Usage"), flow.alias("Flow Direction"), meter.alias("Account, meter")]
        e.where(f"k = {k}").select(*cells, F.lit(k).alias("layout")).write.mode("append").partitionBy("layout").option("header", True).csv(path)


_CSV_TS = "CASE WHEN event_id % 9 IN (7, 8) THEN date_trunc('day', ts) WHEN event_id % 9 IN (1, 3, 6) THEN date_trunc('minute', ts) ELSE date_trunc('second', ts) END"
_CSV_STATUS = "CASE WHEN event_id % 5 = 0 THEN 'reverse' WHEN event_id % 7 = 0 THEN 'blank' ELSE 'ok' END"
_CSV_ALL = f"SELECT {utc_sql(_CSV_TS)} AS ts_utc, {_CSV_TS} AS ts_local, CAST(130000 + user_id % 3 AS VARCHAR) AS device_id, floor(value * 100) AS value, CAST(CASE WHEN event_id % 9 IN (1, 3, 5) THEN 1800 ELSE 900 END AS INTEGER) AS interval_s, {_CSV_STATUS} AS status FROM events"
_CSV_SQL = f"SELECT * EXCLUDE (status) FROM ({_CSV_ALL}) WHERE status = 'ok'"


#: Readings of an interval block at most: a block is an entry, and an entry is one row of the feeds' reader.
BLOCK = 1000


def feed_files(v, path: str) -> None:
    """An ESPI feed for each day, of four meters: links from either end, energy, other units, reverse flow, and lengths that only the type states.

    A feed is written line by line, a line for each reading with what opens or closes its block, meter and day around it: lines are sorted and
    streamed, so no row holds more than a reading. By day, as a partition without days would leave a file without bytes.
    """
    day = Window.partitionBy("day").orderBy("m", _ID)
    e = v.table("events").select(_ID, "ts", "value", (F.col("user_id") % 4).cast("string").alias("m"), F.to_date("ts").alias("day"))
    e = e.withColumn("n", F.row_number().over(day)).withColumn("before", F.lag("m").over(day)).withColumn("after", F.lead(F.struct("m")).over(day))
    starts, ends = (F.col("n") == 1) | ~F.col("before").eqNullSafe(F.col("m")), F.col("after").isNull() | ~F.col("after.m").eqNullSafe(F.col("m"))
    lines = e.select("day", "n", "m", _ID, "ts", "value", starts.alias("starts"), ends.alias("ends"), F.col("after").isNull().alias("last")).sortWithinPartitions("day", "n")
    start = F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', CAST(ts AS TIMESTAMP_NTZ))").cast("string")
    text = lambda *parts: F.concat_ws("", *parts)
    tag = lambda name, *parts: text(F.lit(f"<espi:{name}>"), *parts, F.lit(f"</espi:{name}>"))
    length = F.when(F.col("m") != "1", tag("duration", F.lit("900")))
    value = F.when(F.col(_ID) % 13 != 0, tag("value", F.floor(F.col("value") * 100).cast("string")))
    reading = tag("IntervalReading", tag("timePeriod", length, tag("start", start)), value)
    point = text(F.lit("https://x/espi/1_1/resource/UsagePoint/77"), F.col("m"))
    meter, kind = text(point, F.lit("/MeterReading/"), F.col("m")), text(F.lit("https://x/espi/1_1/resource/ReadingType/"), F.col("m"))
    link = lambda rel, href: text(F.lit(f'<link rel="{rel}" href="'), href, F.lit('"/>'))
    entry = lambda links, content: text(F.lit("<entry>"), *links, F.lit("<content>"), content, F.lit("</content></entry>"))
    type_ = text(tag("flowDirection", F.when(F.col("m") == "3", "19").otherwise("1")), tag("intervalLength", F.lit("1800")), tag("powerOfTenMultiplier", F.lit("1")), tag("uom", F.when(F.col("m") == "2", "38").otherwise("72")))
    other = entry([link("self", F.lit("https://x/espi/1_1/resource/ReadingType/other"))], tag("ReadingType", tag("uom", F.lit("38"))))
    entries = text(
        entry([link("self", point)], tag("UsagePoint", F.when(F.col("m") == "0", tag("name", F.lit("1308468"))))),
        entry([link("self", kind), F.when(F.col("m") == "1", link("related", meter))], tag("ReadingType", type_)),
        entry([link("self", meter), link("related", point), F.when(F.col("m") != "1", link("related", kind))], F.lit("<espi:MeterReading/>")),
    )
    head = F.lit('<?xml version="1.0"?><feed xmlns="http://www.w3.org/2005/Atom" xmlns:espi="http://naesb.org/espi">')
    block = F.floor(F.col("n") / BLOCK)
    opens, closes = F.col("starts") | (F.col("n") % BLOCK == 0), F.col("ends") | ((F.col("n") + 1) % BLOCK == 0)
    line = text(
        F.when(F.col("n") == 1, text(head, other)), F.when(F.col("starts"), entries),
        F.when(opens, text(F.lit("<entry>"), link("self", text(meter, F.lit("/IntervalBlock/"), block.cast("string"))), F.lit("<content><espi:IntervalBlock>"))),
        reading, F.when(closes, "</espi:IntervalBlock></content></entry>"), F.when(F.col("last"), "</feed>"),
    )
    lines.select("day", line.alias("value")).write.mode("append").partitionBy("day").text(path)


_FEED_STATUS = "CASE WHEN user_id % 4 = 3 THEN 'reverse' WHEN user_id % 4 = 2 THEN 'unit' WHEN event_id % 13 = 0 THEN 'blank' ELSE 'ok' END"
_FEED_TS = "date_trunc('second', ts)"
_FEED_ALL = f"SELECT CASE WHEN user_id % 4 = 0 THEN '1308468' ELSE '77' || CAST(user_id % 4 AS VARCHAR) END AS device_id, {_FEED_TS} AS ts_utc, {local_sql(_FEED_TS)} AS ts_local, CAST(CASE WHEN user_id % 4 = 1 THEN 1800 ELSE 900 END AS INTEGER) AS interval_s, floor(value * 100) / 100 AS value, {_FEED_STATUS} AS status FROM events"


def imported(v, *write):
    """The readings of files that ``write`` lands in one folder."""
    path = storage.new_path(v.spark, "exports")
    for w in write:
        w(v, path)
    return exports.checked(exports.readings(exports.open_exports(v.spark, path), 900))


def _statuses(v):
    found = imported(v, usage_files, feed_files).withColumn("how", F.when(F.col("device_id").startswith("1300"), "csv").otherwise("xml"))
    return found.groupBy("how", "device_id", "status").agg(F.count("*").alias("rows"), F.sum("value").alias("kwh"))


_STATUSES = f"SELECT 'csv' AS how, device_id, status, count(*) AS rows, sum(value) FILTER (WHERE status = 'ok') AS kwh FROM ({_CSV_ALL}) GROUP BY ALL UNION ALL SELECT 'xml', device_id, status, count(*), sum(value) FILTER (WHERE status = 'ok') FROM ({_FEED_ALL}) GROUP BY ALL"
q("I11_espi_feed_files", lambda v: exports.observations(imported(v, feed_files)), "", f"SELECT * EXCLUDE (status) FROM ({_FEED_ALL}) WHERE status = 'ok'", doubles="value")
q("I12_usage_csv", lambda v: exports.observations(imported(v, usage_files)), "", _CSV_SQL, doubles="value")


def _kinds(v):
    """Both kinds in one folder: what is told apart by content, whatever the files' names."""
    path = storage.new_path(v.spark, "mixed")
    usage_files(v, path)
    feed_files(v, path)
    found = exports.open_exports(v.spark, path)
    # Rows that stand for a file or an entry, and no reading, have no device.
    feed = F.col("kind") == "feed"
    n = exports.readings(found, 900).where("device_id IS NOT NULL").join(found.files, "file").agg(F.count_if(feed).alias("feeds"), F.count_if(~feed).alias("tables"))
    row = lambda feed, count: F.struct(F.lit(feed).alias("feed"), F.col(count).alias("readings"))
    return n.select(F.inline(F.array(row(True, "feeds"), row(False, "tables"))))


q("I13_files_sniffed", _kinds, "", "SELECT unnest([true, false]) AS feed, count(*) AS readings FROM events")
q("I13_content_sniff", lambda v: v.table("pages").groupBy(p.is_xml(F.col("html")).alias("xml")).agg(F.count("*").alias("n")), "", "SELECT ltrim(html) LIKE '<%' AS xml, count(*) AS n FROM pages GROUP BY ALL")
q("Q17_import_meter", _statuses, "", _STATUSES, doubles="kwh", digits=4)


def map_entries(v):
    """A map entry for each channel seen, with faults planted by the data."""
    seen = v.obs.groupBy(*CHANNEL).agg(F.min("event_id").alias("first"), F.max("event_type").alias("kind"))
    return seen.select(*CHANNEL, F.when(F.col("channel_id").like("ct%"), F.concat(F.lit("Feed "), "channel_id")).alias("label"), F.lit(None).cast("string").alias("room"), F.when(F.col("channel_id") != "panel_leg_a", F.col("channel_id")).alias("inventory_id"), F.col("channel_id").isin("ct_1_a").alias("is_primary"))


def inventory(v):
    return v.obs.where("channel_id LIKE 'breaker%' AND channel_id <> 'breaker_p26'").groupBy("channel_id").agg(F.count("*").alias("n")).select(F.col("channel_id").alias("id"), F.concat(F.lit("Circuit "), "channel_id").alias("label"), F.lit("branch").alias("role"), F.lit("Kitchen counter").alias("kind"), F.lit("Kitchen").alias("room"))


_MAP = "m AS (SELECT DISTINCT source, device_id, channel_id, CASE WHEN channel_id LIKE 'ct%' THEN 'Feed ' || channel_id END AS label, CASE WHEN channel_id <> 'panel_leg_a' THEN channel_id END AS inventory_id, channel_id = 'ct_1_a' AS is_primary FROM obs), inv AS (SELECT DISTINCT channel_id AS id FROM obs WHERE channel_id LIKE 'breaker%' AND channel_id <> 'breaker_p26')"
_RESOLVED = f"; {_MAP} SELECT source, device_id, channel_id, coalesce(label, CASE WHEN id IS NOT NULL THEN 'Circuit ' || id END) AS label, CASE WHEN id IS NOT NULL THEN 'Kitchen' END AS room, CASE WHEN id IS NOT NULL THEN 'kitchen' END AS category, is_primary FROM m LEFT JOIN inv ON inventory_id = id"
q("J09_map_inventory", lambda v: dimension.resolve(map_entries(v), inventory(v)), "obs", _RESOLVED)
q("Q15_build_dim", lambda v: dimension.resolve(map_entries(v), inventory(v)).where("label IS NOT NULL").groupBy("category").agg(F.count("*").alias("channels"), F.count_if("is_primary").alias("primaries")), "obs", f"SELECT category, count(*) AS channels, count(*) FILTER (WHERE is_primary) AS primaries FROM ({_RESOLVED.removeprefix('; ').replace(_MAP, 'WITH ' + _MAP, 1)}) WHERE label IS NOT NULL GROUP BY ALL")
q("I14_map_violations", lambda v: dimension.violations(map_entries(v), inventory(v)).groupBy("kind").agg(F.count("*").alias("n")), "obs", f"; {_MAP} SELECT 'several primaries' AS kind, count(*) AS n FROM (SELECT source FROM m WHERE is_primary GROUP BY source HAVING count(*) > 1) UNION ALL SELECT 'dangling inventory id', count(*) FROM m WHERE inventory_id IS NOT NULL AND inventory_id NOT IN (SELECT id FROM inv) UNION ALL SELECT 'no label', count(*) FROM m WHERE label IS NULL AND (inventory_id IS NULL OR inventory_id NOT IN (SELECT id FROM inv))")
q("I15_inventory", lambda v: inventory(v).select("id", "label", s.category("role", "kind").alias("category")), "obs", f"; {_MAP} SELECT id, 'Circuit ' || id AS label, 'kitchen' AS category FROM inv")


def live_docs(v):
    one = F.array(F.struct("source", "device_id", "channel_id"))
    o = v.obs
    shape = lambda n, k: o.where(f"event_id % 3 = {k}").select(F.to_json(F.struct(one.alias(n))).alias("value"))
    return shape("channels", 0).union(shape("live_channels", 1)).union(shape("mappings", 2))


q("I16_live_channels", lambda v: p.live_channels(live_docs(v)), "obs", "SELECT DISTINCT source, device_id, channel_id FROM obs")
q("Q21_skeleton_rows", lambda v: dimension.skeleton(p.live_channels(live_docs(v)), v.dim).drop("suggested"), "obs dim", "SELECT DISTINCT source, device_id, channel_id, CAST(NULL AS VARCHAR) AS label, CAST(NULL AS VARCHAR) AS category, CAST(NULL AS VARCHAR) AS panel, false AS is_primary FROM obs ANTI JOIN dim USING (source, device_id, channel_id)")
q("Q21_discover_unmapped", lambda v: dimension.unmapped(p.live_channels(live_docs(v)), v.dim).select(*CHANNEL), "obs dim", "SELECT DISTINCT source, device_id, channel_id FROM obs ANTI JOIN dim USING (source, device_id, channel_id)")


def _tariff(v):
    """The tariff document's rates against the usage of the meters it prices."""
    period = F.struct(F.col("effective_from").cast("string").alias("effective_from"), *(F.col(a).cast("string").alias(b) for a, b in (("basic", "basic_service_charge_per_day"), ("energy", "energy_charge_per_kwh"), ("dsm", "dsm_per_kwh"))))
    doc = v.rates.groupBy("meter").agg(F.collect_list(period).alias("rate_periods")).select(F.to_json(F.struct(F.create_map("meter", F.struct("rate_periods")).alias("tariffs"))).alias("value"))
    rates, _ = p.tariff_tables(doc)
    used = v.meter.where("interval_s = 900").groupBy(F.col("device_id").alias("meter")).agg(F.sum("value").alias("kwh"))
    return rates.join(used, "meter").select("meter", "effective_from", F.col("energy").cast("double").alias("energy"), "kwh")


q("I17_tariff_document", _tariff, "rates meter", "SELECT r.meter, effective_from, CAST(energy AS DOUBLE) AS energy, sum(value) AS kwh FROM rates r JOIN meter m ON r.meter = m.device_id AND interval_s = 900 GROUP BY ALL", doubles="energy kwh", digits=6)


def notice_docs(v):
    e = v.table("events")
    child = F.struct(F.lit("IotCt").alias("model"), F.when(F.col(_ID) % 4 > 0, F.concat(F.lit(" CT"), (F.col("user_id") % 5).cast("string"))).alias("id"), F.create_map(F.lit("activePower"), F.col("value").cast("string")).alias("data"))
    doc = F.to_json(F.struct(F.lit("IotWhem").alias("model"), F.concat(F.lit("H"), (F.col("user_id") % 2).cast("string")).alias("id"), F.create_map(F.lit("rmsVoltageA"), F.lit("120")).alias("data"), F.when(F.col(_ID) % 3 > 0, F.array(child)).alias("children")))
    return p.parse(e.select(doc.alias("value")), p.NOTICE)


q("I18_push_frames", lambda v: p.notices(notice_docs(v)).groupBy("model", "id", "field").agg(F.count("*").alias("n")), "", "SELECT 'IotWhem' AS model, 'h' || CAST(user_id % 2 AS VARCHAR) AS id, 'rmsVoltageA' AS field, count(*) AS n FROM events GROUP BY ALL UNION ALL SELECT 'IotCt', 'ct' || CAST(user_id % 5 AS VARCHAR), 'activePower', count(*) FROM events WHERE event_id % 3 > 0 AND event_id % 4 > 0 GROUP BY ALL")
q("Q16_backfill_daily", lambda v: dedupe.precedence_union({"export": v.daily.where("day(local_day) % 3 = 0"), "legacy": v.daily.where("day(local_day) % 2 = 0").withColumn("kwh", F.col("kwh") + 1), "existing": v.daily.withColumn("kwh", F.col("kwh") + 2)}, ["local_day", "channel_id"]).groupBy("origin").agg(F.count("*").alias("n"), F.sum("kwh").alias("kwh")), "daily", "SELECT CASE WHEN day(local_day) % 3 = 0 THEN 'export' WHEN day(local_day) % 2 = 0 THEN 'legacy' ELSE 'existing' END AS origin, count(*) AS n, sum(kwh + CASE WHEN day(local_day) % 3 = 0 THEN 0 WHEN day(local_day) % 2 = 0 THEN 1 ELSE 2 END) AS kwh FROM daily GROUP BY ALL", doubles="kwh", digits=3)


# ------------------------------------------------------------------------------------------------------------------ sinks
def _stored(v, df, write, name):
    path = storage.new_path(v.spark, name)
    write(df, path)
    return storage.read_published(v.spark, path)


_OBS = ["event_id", *OBSERVATION.fieldNames()]
_RAW = "SELECT event_id, ts_utc, ts_local, source, device_id, channel_id, metric, value, unit FROM obs"


def _pruned(v):
    path = storage.new_path(v.spark, "raw")
    storage.write_days(storage.with_days(conform(v.obs, OBSERVATION)), path)
    return storage.read_days(v.spark, path, OBSERVATION, "2024-01-10", "2024-01-12").drop("local_date")


q("I03_partition_pruning", _pruned, "obs", "SELECT ts_utc, ts_local, source, device_id, channel_id, metric, value, unit FROM obs WHERE CAST(ts_local AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'", doubles="value")
q("K01_closed_hours", lambda v: _stored(v, v.obs.select(*_OBS), lambda d, to: storage.land_closed_hours(d, to, F.expr("TIMESTAMP_NTZ'2024-01-20 12:30:00'")), "parts").groupBy("device_id").agg(F.count("*").alias("n"), F.max("ts_utc").alias("last")), "obs", "SELECT device_id, count(*) AS n, max(ts_utc) AS last FROM obs WHERE ts_utc < '2024-01-20 12:00:00' GROUP BY ALL")


def _compacted(v):
    rows = v.obs.select(*OBSERVATION.fieldNames(), "event_id")
    parts, existing = rows.where("event_id % 3 > 0").withColumn("value", F.col("value") + 1), rows.where("event_id % 2 = 0")
    return _stored(v, parts, lambda d, to: storage.compact(d, existing, to), "days").select("event_id", "value")


q("K02_compaction", _compacted, "", "SELECT event_id, CASE WHEN event_id % 3 > 0 THEN value + 1 ELSE value END AS value FROM events WHERE event_id % 3 > 0 OR event_id % 2 = 0", doubles="value")


def _regenerated(v):
    path = storage.new_path(v.spark, "hourly")
    storage.write_rollup(v.obs, path, POLL_S)
    storage.write_rollup(v.obs.where("to_date(ts_local) = DATE'2024-01-10'").withColumn("value", F.col("value") * 2), path, POLL_S)  # a late day
    return storage.read_published(v.spark, path).groupBy("local_date").agg(F.sum("kwh").alias("kwh"), F.sum("sample_count").alias("n"))


q("K03_regenerate_days", _regenerated, "hourly", f"SELECT {DAY} AS local_date, sum(kwh) * CASE WHEN {DAY} = DATE '2024-01-10' THEN 2 ELSE 1 END AS kwh, CAST(sum(sample_count) AS BIGINT) AS n FROM hourly GROUP BY {DAY}", doubles="kwh")
q("K04_month_upsert", lambda v: _stored(v, v.obs, lambda d, to: storage.upsert_months(d.select(*_OBS), d.where("event_id % 4 = 0").select(*_OBS).withColumn("value", F.lit(-1.0)), to), "months").groupBy("device_id").agg(F.count("*").alias("n"), F.sum("value").alias("total")), "obs", "SELECT device_id, count(*) AS n, sum(CASE WHEN event_id % 4 = 0 THEN -1 ELSE value END) AS total FROM obs GROUP BY ALL", doubles="total", digits=4)
q("K05_dimension", lambda v: _stored(v, a_dim(v), storage.write_dimension, "dim"), "obs dim", "SELECT DISTINCT o.source, o.device_id, o.channel_id, label FROM obs o JOIN dim d ON o.source = d.source AND o.device_id = d.device_id AND o.channel_id = d.channel_id")
q("K06_verified_write", lambda v: storage.verified_write(v.obs.select(*_OBS), storage.new_path(v.spark, "verified")), "", "SELECT count(*) AS expected, count(*) AS written FROM events")
q("K07_canonical_files", lambda v: _stored(v, storage.with_days(v.obs.select(*_OBS)), storage.write_days, "canonical").select(*_OBS), "obs", _RAW, doubles="value")
q("K08_retention", lambda v: storage.retention(v.obs.select(*_OBS), v.obs.where("event_id % 500 <> 3").select(*_OBS), F.expr("TIMESTAMP_NTZ'2024-01-25 00:00:00'")), "obs", "; d AS (SELECT CAST(ts_local AS DATE) AS local_date, count(*) AS rows, count(*) FILTER (WHERE event_id % 500 = 3) AS missing, max(ts_utc) AS newest FROM obs GROUP BY ALL) SELECT local_date, rows, missing, date_diff('microsecond', newest, TIMESTAMP '2024-01-25') >= 7 * 86400000000 AND missing = 0 AS deletable FROM d")
q("K10_dry_run", lambda v: rollup.hourly_rollup(v.obs.where("to_date(ts_local) = DATE'2024-01-10'"), POLL_S).agg(F.count("*").alias("rows"), F.sum("kwh").alias("kwh")), "hourly", f"SELECT count(*) AS rows, sum(kwh) AS kwh FROM hourly WHERE {DAY} = DATE '2024-01-10'", doubles="kwh")


def a_dim(v):
    return v.dim.join(v.obs.select(*CHANNEL).distinct(), CHANNEL, "left_semi").select(*CHANNEL, "label")


def _registered(v):
    """The hourly table registered over its files, and read through the catalog."""
    path, name = storage.new_path(v.spark, "registered"), "gridloom_hourly"
    storage.write_rollup(v.obs, path, POLL_S)
    v.spark.sql(f"DROP TABLE IF EXISTS {name}")
    schema = type(HOURLY)([*HOURLY.fields, storage.read_published(v.spark, path).schema["local_date"]])
    v.spark.sql(storage.create_table_sql(name, schema, {"": "Hourly statistics", "kwh": "Energy over observed time only"}, path, ["local_date"]))
    storage.register_partitions(v.spark, name, path)
    return v.spark.table(name).where("local_date = DATE'2024-01-10'").groupBy("metric").agg(F.count("*").alias("n"), F.sum("kwh").alias("kwh"))


q("K09_catalog", _registered, "hourly", f"SELECT metric, count(*) AS n, sum(kwh) AS kwh FROM hourly WHERE {DAY} = DATE '2024-01-10' GROUP BY ALL", doubles="kwh")
