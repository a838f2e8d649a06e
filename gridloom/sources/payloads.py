"""Device payloads, meter exports and configuration as DataFrames: nested documents become long observations, JVM-side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.localtime import TZ, local
from ..functions.scalar import encode, fahrenheit, finite, number, stage_pct, to_kwh, truth, two_pole

PANEL = "struct<hub:string,ts:string,breakers:array<struct<position:int,poles:int,model:string,power:double,power2:double>>,cts:array<struct<channel:int,usageType:string,activePower:double,activePower2:double>>>"
STATUS = "struct<device:string,ts:string,cfgem:string,mode:string,opstat:string,oat:string,cfm:string,iducfm:string,zones:array<struct<id:int,enabled:string,rt:string,fan:string>>>"
ENERGY = "struct<serial:string,today:string,config:map<string,struct<enabled:string>>,periods:array<struct<type:string,values:map<string,string>>>>"
NOTICE = "struct<model:string,id:string,data:map<string,string>,children:array<struct<model:string,id:string,data:map<string,string>>>>"
_OUT = ["ts_utc", "ts_local", "source", "device_id", "channel_id", "metric", "value", "unit"]


def parse(lines: DataFrame, schema: str, column: str = "value") -> DataFrame:
    """A JSON document a row as a struct ``p``; unparseable documents are null and dropped by the mappings."""
    return lines.select(F.from_json(column, F.lit(schema)).alias("p"))


def _long(rows: DataFrame, source: str, metrics: dict[str, tuple[Column, str]], tz: str) -> DataFrame:
    """One row per metric with a finite value; gaps give no row."""
    each = F.explode(F.array(*(F.struct(F.lit(m).alias("metric"), v.cast("double").alias("value"), F.lit(u).alias("unit")) for m, (v, u) in metrics.items())))
    out = rows.withColumn("_m", each).select("ts_utc", local("ts_utc", tz).alias("ts_local"), F.lit(source).alias("source"), "device_id", "channel_id", "_m.metric", finite(F.col("_m.value")).alias("value"), "_m.unit")
    return out.where("value IS NOT NULL").select(*_OUT)


def panel(docs: DataFrame, tz: str = TZ) -> DataFrame:
    """Breakers and CTs of a hub's poll. Placeholders, unpositioned breakers and unused CTs have no rows; a two-pole breaker
    sums its legs, and has no row if either is missing; a CT without leg B has no row for it."""
    head = docs.where("p IS NOT NULL").select(F.col("p.ts").cast("timestamp_ntz").alias("ts_utc"), F.col("p.hub").alias("device_id"), "p.breakers", "p.cts")
    b = head.select("ts_utc", "device_id", F.explode("breakers").alias("b")).where("NOT coalesce(b.model LIKE 'NONE%', false) AND b.position >= 1")
    b = b.withColumn("channel_id", F.concat(F.lit("breaker_p"), F.col("b.position").cast("string")))
    c = head.select("ts_utc", "device_id", F.explode("cts").alias("c")).where("coalesce(c.usageType, '') <> 'NOT_USED'")
    legs = c.select("ts_utc", "device_id", F.explode(F.array(F.struct(F.lit("a").alias("leg"), F.col("c.activePower").alias("w")), F.struct(F.lit("b").alias("leg"), F.col("c.activePower2").alias("w")))).alias("l"), F.col("c.channel").alias("n"))
    legs = legs.withColumn("channel_id", F.concat(F.lit("ct_"), F.col("n").cast("string"), F.lit("_"), F.col("l.leg")))
    return _long(b, "leviton", {"watts": (two_pole("b.poles", "b.power", "b.power2"), "W")}, tz).unionByName(_long(legs, "leviton", {"watts": (F.col("l.w"), "W")}, tz))


def status(docs: DataFrame, tz: str = TZ) -> DataFrame:
    """An HVAC status: system metrics and its enabled zones. Words are encoded, unknown ones give no row; a stage is a word or a
    percentage, never both; temperatures follow the payload's unit, outdoor ones only if it is F."""
    p = docs.where("p IS NOT NULL").select(F.col("p.ts").cast("timestamp_ntz").alias("ts_utc"), F.col("p.device").alias("device_id"), F.col("p.*")).drop("ts", "device")
    system = p.withColumn("channel_id", F.lit("system"))
    out = _long(system, "bryant", {
        "mode": (encode("mode", "mode"), "enum"), "stage": (encode("stage", "opstat"), "enum"), "stage_pct": (stage_pct("opstat"), "pct"),
        "outdoor_temp_f": (F.when(F.col("cfgem") == "F", number("oat")), "degF"), "cfm": (F.coalesce(number("cfm"), number("iducfm")), "cfm"),
    }, tz)
    zone = p.select("ts_utc", "device_id", "cfgem", F.explode("zones").alias("z")).where("z.enabled = 'on'").withColumn("channel_id", F.concat(F.lit("zone_"), F.col("z.id").cast("string")))
    return out.unionByName(_long(zone, "bryant", {"indoor_temp_f": (fahrenheit(number("z.rt"), "cfgem"), "degF"), "fan": (encode("fan", "z.fan"), "enum")}, tz))


def unknown_words(docs: DataFrame) -> DataFrame:
    """(field, word, n) that no enum table knows, numbers where a word is expected apart."""
    p = docs.where("p IS NOT NULL").select("p.mode", "p.opstat")
    rows = p.select(F.explode(F.array(F.struct(F.lit("mode").alias("field"), F.col("mode").alias("word"), encode("mode", "mode").alias("code")), F.struct(F.lit("opstat").alias("field"), F.col("opstat").alias("word"), F.coalesce(encode("stage", "opstat"), stage_pct("opstat").cast("int")).alias("code")))).alias("x"))
    return rows.where("x.word IS NOT NULL AND x.code IS NULL").groupBy("x.field", "x.word", number("x.word").isNotNull().alias("numeric")).agg(F.count("*").alias("n"))


def daily_energy(docs: DataFrame) -> DataFrame:
    """(serial, local_day, channel_id, metric, value): only day1 and day2 are dated, and only of enabled components."""
    p = docs.where("p IS NOT NULL").select("p.serial", F.to_date("p.today").alias("today"), "p.config", F.explode("p.periods").alias("e"))
    back = F.when(F.col("e.type") == "day1", 1).when(F.col("e.type") == "day2", 2)
    rows = p.withColumn("back", back).where("back IS NOT NULL").select("serial", F.date_sub("today", F.col("back")).alias("local_day"), "config", F.explode("e.values").alias("name", "text"))
    part, metric = F.regexp_replace("name", "(Kwh|Dollars)$", ""), F.when(F.col("name").endswith("Kwh"), "kwh_day").when(F.col("name").endswith("Dollars"), "cost_day_usd")
    rows = rows.withColumn("channel_id", part).withColumn("metric", metric).withColumn("value", number("text")).withColumn("on", truth(F.try_element_at("config", F.col("channel_id"))["enabled"]))
    return rows.where("on AND value IS NOT NULL AND metric IS NOT NULL").select("serial", "local_day", "channel_id", "metric", "value")


def dated_map(docs: DataFrame, serial: str | None, column: str = "value") -> DataFrame:
    """Legacy export keyed by date, ``{date: {data: {field: number}}}``: (serial, local_day, field, value)."""
    m = docs.select(F.from_json(column, F.lit("map<string,struct<serial:string,data:map<string,string>>>")).alias("m")).select(F.explode("m").alias("d", "x"))
    rows = m.select(F.coalesce("x.serial", F.lit(serial)).alias("serial"), F.col("d").try_cast("date").alias("local_day"), F.explode("x.data").alias("field", "text"))
    return rows.withColumn("value", number("text")).where("value IS NOT NULL AND local_day IS NOT NULL").drop("text")


def is_xml(text: Column) -> Column:
    """By content, not by extension."""
    return F.ltrim(F.regexp_replace(text, "^\\uFEFF", "")).startswith("<")


def espi_readings(entries: DataFrame) -> DataFrame:
    """Interval readings joined to their reading type through links in either direction.

    ``entries`` has kind (reading_type, meter_reading, interval_block), href, up and related links, and the type's uom, power and
    flow or the block's start_s, duration_s and raw value. Non-energy units and reverse flow are left out.
    """
    tail = lambda c: F.regexp_replace(c, "^.*/espi/", "")
    e = entries.withColumn("href", tail("href")).withColumn("up", tail("up")).withColumn("related", tail("related"))
    types = e.where("kind = 'reading_type'").select(F.col("href").alias("t_href"), F.col("up").alias("t_up"), "uom", "power", "flow")
    readings = e.where("kind = 'meter_reading'").select(F.col("href").alias("m_href"), F.col("related").alias("m_related"))
    linked = readings.join(types, F.col("m_related") == F.col("t_href"), "left")
    back = readings.join(types, F.col("m_href") == F.col("t_up")).select(F.col("m_href").alias("b_href"), F.struct("uom", "power", "flow").alias("b"))
    linked = linked.join(back, F.col("m_href") == F.col("b_href"), "left").select("m_href", F.coalesce(F.when(F.col("t_href").isNotNull(), F.struct("uom", "power", "flow")), "b").alias("t"))
    blocks = e.where("kind = 'interval_block'").select("device_id", F.col("up").alias("b_up"), "start_s", "duration_s", "raw")
    rows = blocks.join(linked, F.col("b_up") == F.col("m_href")).where("t.flow = 1")
    at = F.timestamp_add("SECOND", F.col("start_s"), F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))
    return rows.select("device_id", at.alias("ts_utc"), F.col("duration_s").cast("int").alias("interval_s"), to_kwh(F.col("raw"), F.col("t.power"), F.col("t.uom")).alias("value")).where("value IS NOT NULL")


def notices(docs: DataFrame) -> DataFrame:
    """(model, id, field, value): a frame's own fields and its children's; an object without id is dropped."""
    p = docs.where("p IS NOT NULL").select(F.explode(F.concat(F.array(F.struct("p.model", "p.id", "p.data")), F.coalesce("p.children", F.array().cast("array<struct<model:string,id:string,data:map<string,string>>>")))).alias("o"))
    return p.where("o.id IS NOT NULL AND o.id <> ''").select("o.model", F.lower(F.trim("o.id")).alias("id"), F.explode("o.data").alias("field", "value"))


def tariff_tables(docs: DataFrame, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """(rates, cycles) of a tariff document: meter -> periods and cycles; money becomes decimal."""
    schema = "struct<tariffs:map<string,struct<rate_periods:array<struct<effective_from:string,basic_service_charge_per_day:string,energy_charge_per_kwh:string,dsm_per_kwh:string>>,billing_cycles:array<struct<cycle_start:string,cycle_end:string,fuel_adjustment_per_kwh:string,environmental_surcharge_pct:string,retired_asset_recovery_pct:string,pilot_generation_recovery_pct:string,home_energy_assistance_charge:string>>>>>"
    m = docs.select(F.from_json(column, F.lit(schema)).alias("t")).select(F.explode("t.tariffs").alias("meter", "x"))
    d = lambda c, a: F.col(c).cast("decimal(12,6)").alias(a)
    r = m.select("meter", F.explode("x.rate_periods").alias("r")).select("meter", F.to_date("r.effective_from").alias("effective_from"), d("r.basic_service_charge_per_day", "basic"), d("r.energy_charge_per_kwh", "energy"), d("r.dsm_per_kwh", "dsm"))
    c = m.select("meter", F.explode("x.billing_cycles").alias("c")).select(
        "meter", F.to_date("c.cycle_start").alias("cycle_start"), F.to_date("c.cycle_end").alias("cycle_end"), d("c.fuel_adjustment_per_kwh", "fuel"), d("c.environmental_surcharge_pct", "env_pct"),
        d("c.retired_asset_recovery_pct", "rar_pct"), d("c.pilot_generation_recovery_pct", "pgr_pct"), d("c.home_energy_assistance_charge", "hea"),
    )
    return r, c


def live_channels(docs: DataFrame, column: str = "value") -> DataFrame:
    """A live channel list in any of three shapes: ``channels``, ``live_channels`` or ``mappings``."""
    one = "array<struct<source:string,device_id:string,channel_id:string>>"
    p = docs.select(F.from_json(column, F.lit(f"struct<channels:{one},live_channels:{one},mappings:{one}>")).alias("p"))
    return p.select(F.explode(F.coalesce("p.channels", "p.live_channels", "p.mappings")).alias("c")).select("c.*").distinct()
