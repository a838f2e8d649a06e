"""Utility meter exports read from files: Green Button (ESPI) feeds and usage tables in CSV, told apart by content.

A feed is read entry by entry: the text source splits files at the end of an element name, so a large feed is many tasks and no task holds
more than an entry. Usage tables are read by Spark's CSV reader, files of one width together; quoted cells may hold line breaks, so a
table is streamed by one task. Every reading, row and file keeps a ``status``: 'ok', or why it is left out, so an import can say
what it skipped. Nothing is guessed: units, scale and flow come from the feed's reading types, interval lengths from the file, and
a missing reading gives no row.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import storage
from ..functions.localtime import TZ, local, utc
from ..functions.scalar import to_kwh

#: What is read of a feed's entry; namespaces are ignored.
ENTRY = (
    "struct<link:array<struct<_href:string,_rel:string>>,content:struct<UsagePoint:struct<name:string>,"
    "ReadingType:struct<uom:string,powerOfTenMultiplier:string,flowDirection:string,intervalLength:string>,"
    "IntervalBlock:array<struct<interval:struct<duration:string>,IntervalReading:array<struct<timePeriod:struct<start:string,duration:string>,value:string>>>>>,_broken:string>"
)
#: Codes of the feed's own schema; fixed values.
FORWARD, WATT_HOURS = 1, 72
READING = ["file", "device_id", "ts_utc", "ts_local", "interval_s", "value", "status"]
#: Columns of a usage table, by a part of their header; earlier parts go first. Fixed values.
HEADERS = {"start": ("start", "interval", "date", "time"), "usage": ("kwh", "usage", "consumption", "value"), "end": ("end",), "flow": ("direction", "flow"), "meter": ("meter", "usage point", "account")}
#: Beginnings of a flow's name that count as energy delivered, besides none. Fixed values.
DELIVERED = ("deliver", "consum", "forward")


class ExportError(ValueError):
    """The files could not be read without guessing at what they mean."""


class Exports(NamedTuple):
    """A folder's files by kind: 'feed', 'table' or 'empty' (white space alone). ``files`` has (file, kind)."""

    spark: SparkSession
    files: DataFrame
    feeds: list[str]
    tables: list[str]


def open_exports(spark: SparkSession, path: str) -> Exports:
    """Tell files apart by the first character of their content: a feed's root element opens there, a table's header cannot.

    The driver gets one short row a file, as Spark's own file index does.
    """
    names = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).inputFiles()  # with those that have no bytes
    every = spark.createDataFrame([(n.replace("file:///", "file:/", 1),) for n in names], "file string")  # as _metadata has them
    # Pieces between two noughts are short in either kind, whatever a file's lines are.
    pieces = spark.read.option("recursiveFileLookup", True).option("lineSep", "00").text(path)
    bare = F.regexp_replace("value", r"^[\uFEFF\s]+", "")
    heads = pieces.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), F.substring(bare, 1, 1).alias("c"), F.monotonically_increasing_id().alias("n"))
    heads = heads.where("at = 0 AND c <> ''").groupBy("file").agg(F.min_by("c", "n").alias("c"))
    kind = F.when(F.col("c").isNull(), "empty").when(F.col("c") == "<", "feed").otherwise("table")
    found = every.join(heads, "file", "left").select("file", kind.alias("kind")).collect()
    of = lambda kind: sorted(unquote(r.file) for r in found if r.kind == kind)
    return Exports(spark, spark.createDataFrame([tuple(r) for r in found], "file string, kind string"), of("feed"), of("table"))


def _whole(text: Column) -> Column:
    return F.trim(text).try_cast("double").cast("long")


def entries(found: Exports) -> DataFrame:
    """(file, link, content, broken): a row per entry of the feeds. Files are split wherever ``entry>`` stands, whatever its prefix; a piece
    that ends in a closing tag is an entry's inside, behind its opening tag if that has attributes."""
    pieces = found.spark.read.option("lineSep", "entry>").text(found.feeds).select(F.col("_metadata.file_path").alias("file"), "value")
    inside = F.regexp_extract("value", r"(?s)^(?:.*<(?:[\w.-]+:)?entry\s[^>]*>)?(.*)</(?:[\w.-]+:)?$", 1)
    rows = pieces.where(F.col("value").rlike(r"</(?:[\w.-]+:)?$")).select("file", F.concat(F.lit("<entry>"), inside, F.lit("</entry>")).alias("x"))
    parsed = F.from_xml("x", ENTRY, {"ignoreNamespace": "true", "columnNameOfCorruptRecord": "_broken"})
    return rows.select("file", parsed.alias("e")).select("file", "e.link", "e.content", F.col("e._broken").isNotNull().alias("broken"))


def feed_readings(found: Exports, tz: str = TZ) -> DataFrame:
    """Readings of ESPI feeds. A block's reading type is found over links from either end, or is the feed's only one.

    Statuses besides 'ok': 'reverse' flow, 'unit' that is no energy, 'blank' time or value, 'no type', 'no duration', and 'malformed' (a row for
    each entry that is no XML).
    """
    if not found.feeds:
        return _none(found.spark)
    read = storage.cut(entries(found))  # types, links, names and blocks are all taken from it: feeds are parsed once
    e = read.where("NOT broken").select("file", "link", "content.*")
    links = lambda rel: F.transform(F.filter("link", lambda k: k["_rel"] == rel), lambda k: F.rtrim(k["_href"], F.lit("/")))
    e = e.withColumn("href", F.coalesce(F.try_element_at(links("self"), F.lit(1)), F.lit(""))).withColumn("related", links("related"))
    what = F.struct(_whole(F.col("ReadingType.uom")).alias("uom"), F.coalesce(_whole(F.col("ReadingType.powerOfTenMultiplier")), F.lit(0)).alias("power"), _whole(F.col("ReadingType.flowDirection")).alias("flow"), _whole(F.col("ReadingType.intervalLength")).alias("length"))
    types = e.where("ReadingType IS NOT NULL").select("file", F.col("href").alias("t_href"), "related", what.alias("t"))
    down = types.select("file", "t_href", F.explode("related").alias("m_href"), "t").where("contains(m_href, '/MeterReading/')").groupBy("file", "m_href").agg(F.min_by("t", "t_href").alias("down"))
    up = e.select("file", F.col("href").alias("m_href"), F.explode("related").alias("t_href")).join(types.select("file", "t_href", "t"), ["file", "t_href"]).groupBy("file", "m_href").agg(F.min_by("t", "t_href").alias("up"))
    only = types.groupBy("file").agg(F.when(F.count("*") == 1, F.first("t")).alias("only"))
    point = F.nullif(F.regexp_extract("href", "/UsagePoint/([^/]+)", 1), F.lit(""))
    names = e.where("UsagePoint IS NOT NULL").select("file", point.alias("point"), F.trim("UsagePoint.name").alias("name")).where("name <> ''").groupBy("file", "point").agg(F.min("name").alias("name"))
    blocks = e.select("file", F.regexp_replace("href", "/IntervalBlock/.*$", "").alias("m_href"), point.alias("point"), F.explode("IntervalBlock").alias("b"))
    blocks = blocks.join(down, ["file", "m_href"], "left").join(up, ["file", "m_href"], "left").join(only, "file", "left").join(names, ["file", "point"], "left")
    rows = blocks.select("file", F.coalesce("name", "point", F.lit("unknown")).alias("device_id"), F.coalesce("down", "up", "only").alias("t"), _whole(F.col("b.interval.duration")).alias("block_s"), F.explode("b.IntervalReading").alias("r"))
    start, raw = _whole(F.col("r.timePeriod.start")), F.trim("r.value").try_cast("double")
    length = F.coalesce(F.nullif(_whole(F.col("r.timePeriod.duration")), F.lit(0)), F.nullif(F.col("t.length"), F.lit(0)), "block_s")
    status = (
        F.when(F.col("t").isNull(), "no type").when(F.coalesce(F.col("t.flow") != FORWARD, F.lit(False)), "reverse").when(F.coalesce(F.col("t.uom"), F.lit(0)) != WATT_HOURS, "unit")
        .when(start.isNull() | raw.isNull(), "blank").when(F.coalesce(length, F.lit(0)) <= 0, "no duration").otherwise("ok")
    )
    rows = rows.withColumn("ts_utc", F.timestamp_add("SECOND", start, F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))).withColumn("status", status)
    rows = rows.select("file", "device_id", "ts_utc", local("ts_utc", tz).alias("ts_local"), length.cast("int").alias("interval_s"), F.when(F.col("status") == "ok", to_kwh(raw, F.col("t.power"), F.col("t.uom"))).alias("value"), "status")
    return rows.unionByName(read.where("broken").select("file", F.lit("malformed").alias("status")), allowMissingColumns=True)


def _none(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "file string, device_id string, ts_utc timestamp_ntz, ts_local timestamp_ntz, interval_s int, value double, status string")


def wall_time(text: Column) -> Column:
    """A local wall-clock time of a usage table: month first with slashes, or year first; with or without seconds or a time, and with
    a half of the day. Anything else is null. No session time zone takes part."""
    t = F.trim(text)
    american, iso = r"^(\d{1,2})/(\d{1,2})/(\d{4})(?: +(\d{1,2}):(\d{2})(?::(\d{2}))?(?: *([AaPp])[Mm])?)?$", r"^(\d{4})-(\d{1,2})-(\d{1,2})(?:[ T](\d{1,2}):(\d{2})(?::(\d{2}))?)?$"

    def build(pattern: str, y: int, mo: int, d: int, half: bool) -> Column:
        g = lambda i: F.regexp_extract(t, pattern, i)
        hour = F.coalesce(F.nullif(g(4), F.lit("")).cast("int"), F.lit(0))
        if half:
            twelve = F.when(hour.between(1, 12), F.pmod(hour, F.lit(12)) + F.when(F.lower(g(7)) == "p", 12).otherwise(0))
            hour = F.when(g(7) == "", hour).otherwise(twelve)
        two = lambda c: F.lpad(F.coalesce(F.nullif(c, F.lit("")), F.lit("0")), 2, "0")
        whole = F.concat(g(y), F.lit("-"), two(g(mo)), F.lit("-"), two(g(d)), F.lit(" "), F.lpad(hour.cast("string"), 2, "0"), F.lit(":"), two(g(5)), F.lit(":"), two(g(6)))
        return F.when(t.rlike(pattern), whole.try_cast("timestamp_ntz"))

    return F.coalesce(build(american, 3, 1, 2, True), build(iso, 1, 2, 3, False))


def _cells(line: Column) -> Column:
    """The cells of a header line; quoted cells may hold commas and doubled quotes."""
    found = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(r',("(?:[^"]|"")*"|[^,]*)'), F.lit(1))
    return F.transform(found, lambda c: F.trim(F.when(c.startswith('"'), F.replace(F.substring(c, F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"'))).otherwise(c)))


def _headers(found: Exports) -> DataFrame:
    """(file, head): the lower-case cells of each table's first line that is not blank."""
    lines = found.spark.read.text(found.tables).select(F.col("_metadata.file_path").alias("file"), F.regexp_replace("value", "^\\uFEFF", "").alias("line"), F.monotonically_increasing_id().alias("n"))
    first = lines.where("trim(line) <> ''").groupBy("file").agg(F.min_by("line", "n").alias("line"))
    return first.select("file", F.transform(_cells(F.col("line")), lambda h: F.lower(h)).alias("head"))


def _table_rows(found: Exports, headers: DataFrame) -> DataFrame:
    """(file, c, odd): cells of every row below the headers; ``odd`` rows have not as many as their header."""
    widths = headers.groupBy(F.size("head").alias("width")).agg(F.collect_list("file").alias("files")).collect()  # paths, as in the file index
    parts = []
    for w in widths:
        names = [f"c{i}" for i in range(w.width)]
        reader = found.spark.read.schema(", ".join(f"{n} string" for n in names) + ", _odd string").option("columnNameOfCorruptRecord", "_odd")
        rows = reader.option("header", True).option("multiLine", True).option("escape", '"').csv(sorted(map(unquote, w.files)))
        parts.append(rows.select(F.col("_metadata.file_path").alias("file"), F.transform(F.array(*names), lambda c: F.trim(c)).alias("c"), F.col("_odd").isNotNull().alias("odd")))
    return reduce(DataFrame.unionByName, parts)


def table_readings(found: Exports, interval_s: int | None = None, tz: str = TZ) -> DataFrame:
    """Readings of usage tables, their columns found by header. A reading's length is that to its end column, else ``interval_s``, else
    the file's commonest spacing (ties to the shorter).

    Statuses besides 'ok': 'reverse' flow (anything but blank, or what starts as ``DELIVERED`` says), 'blank' usage, 'short' (a row without a
    start or usage cell), 'unreadable' time or number, 'no duration', and 'no columns' (one row) for a file whose header has no start
    or no usage column. Lines without any character are no rows.
    """
    if not found.tables:
        return _none(found.spark)
    headers = _headers(found)

    def column(parts: tuple[str, ...]) -> Column:
        at = lambda p: F.nullif(F.array_position(F.transform("head", lambda h: F.contains(h, F.lit(p))), F.lit(True)), F.lit(0).cast("long"))
        return F.coalesce(*(at(p) for p in parts)).cast("int")

    at = headers.select("file", *(column(parts).alias(f"at_{name}") for name, parts in HEADERS.items()))
    unknown = at.where("at_start IS NULL OR at_usage IS NULL").select("file", F.lit("no columns").alias("status"))
    rows = _table_rows(found, headers).join(at.where("at_start IS NOT NULL AND at_usage IS NOT NULL"), "file")
    cell = lambda name: F.when(F.col(f"at_{name}").isNotNull(), F.try_element_at("c", F.col(f"at_{name}")))
    flow, meter, plain = F.lower(F.coalesce(cell("flow"), F.lit(""))), F.coalesce(cell("meter"), F.lit("")), F.translate(F.coalesce(cell("usage"), F.lit("")), ",$", "")
    number = F.nullif(F.regexp_extract(meter, r"(\d{4,})", 1), F.lit(""))
    rows = rows.select(
        "file", F.coalesce(number, F.nullif(meter, F.lit("")), F.lit("unknown")).alias("device_id"), wall_time(cell("start")).alias("ts_local"), wall_time(cell("end")).alias("end_local"),
        plain.try_cast("double").alias("value"), (plain == "").alias("blank"), ((flow != "") & ~flow.rlike(f"^({'|'.join(DELIVERED)})")).alias("back"),
        (F.col("odd") & (cell("usage").isNull() | cell("start").isNull())).alias("short"),
    )
    rows = rows.withColumn("ts_utc", utc("ts_local", tz)).withColumn("own_s", F.timestamp_diff("SECOND", F.col("ts_utc"), utc("end_local", tz)))
    if interval_s is None:
        w = Window.partitionBy("file").orderBy("ts_utc")
        gap = F.timestamp_diff("SECOND", F.lag("ts_utc").over(w), F.col("ts_utc"))
        gaps = rows.where("NOT back AND value IS NOT NULL AND ts_utc IS NOT NULL").select("file", gap.alias("gap")).where("gap > 0").groupBy("file", "gap").agg(F.count("*").alias("n"))
        rows = rows.join(gaps.groupBy("file").agg((-F.max(F.struct("n", (-F.col("gap")).alias("g")))["g"]).alias("usual")), "file", "left")
    else:
        rows = rows.withColumn("usual", F.lit(interval_s).cast("long"))
    length = F.coalesce(F.nullif("own_s", F.lit(0).cast("long")), "usual")
    status = F.when(F.col("short"), "short").when(F.col("back"), "reverse").when(F.col("blank"), "blank").when(F.col("ts_utc").isNull() | F.col("value").isNull(), "unreadable").when(F.coalesce(length, F.lit(0)) <= 0, "no duration").otherwise("ok")
    rows = rows.withColumn("status", status).select("file", "device_id", "ts_utc", "ts_local", length.cast("int").alias("interval_s"), F.when(F.col("status") == "ok", F.col("value")).alias("value"), "status")
    return rows.unionByName(unknown, allowMissingColumns=True)


def readings(found: Exports, interval_s: int | None = None, tz: str = TZ) -> DataFrame:
    """Readings of all files, whichever kind each is. A file that gives no row has one with the status 'empty', 'no rows' (a table of a header
    alone) or 'no readings' (a feed without any). Files are read here, and the readings kept in the shared folder."""
    rows = storage.cut(feed_readings(found, tz).unionByName(table_readings(found, interval_s, tz)))  # a census, a check and the import read it
    why = F.when(F.col("kind") == "empty", "empty").when(F.col("kind") == "table", "no rows").otherwise("no readings")
    bare = found.files.join(rows.select("file").distinct(), "file", "left_anti").select("file", why.alias("status"))
    return rows.unionByName(bare, allowMissingColumns=True)


def observations(found: DataFrame) -> DataFrame:
    """What is imported: (device_id, ts_utc, ts_local, interval_s, value in kWh)."""
    return found.where("status = 'ok'").select("device_id", "ts_utc", "ts_local", "interval_s", "value")


def census(found: DataFrame) -> DataFrame:
    """(file, status, n): what each file gave and what was skipped, and why."""
    return found.groupBy("file", "status").agg(F.count("*").alias("n"))


#: Statuses under which units, scale, times or lengths are unknown: an import stops on them.
REFUSED = ("no type", "no duration", "no columns", "unreadable", "malformed")


def checked(found: DataFrame) -> DataFrame:
    """The readings, or an error that names files which cannot be read without guessing, or without any usable row."""
    refused = F.count_if(F.col("status").isin(*REFUSED)) > 0
    nothing = F.count_if(F.col("status") == "ok") == 0
    bad = found.groupBy("file").agg(F.array_sort(F.collect_set("status")).alias("statuses"), (refused | nothing).alias("bad")).where("bad").orderBy("file").limit(5).collect()
    if bad:
        raise ExportError("; ".join(f"{r.file}: {', '.join(r.statuses)}" for r in bad))
    return found
