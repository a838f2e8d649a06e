"""Meter exports read from files, with expectations written by hand."""

from __future__ import annotations

from datetime import datetime
from xml.etree import ElementTree

import pytest
from pyspark.sql import functions as F

from gridloom.plans import ingest
from gridloom.sources import exports
from gridloom.views import Views

BASE = "https://x.example/espi/1_1/resource"


def feed(blocks, types=((1, 72, 0, 1, None),), down=True, name=None, prefix="espi:"):
    """blocks: (meter reading, [(start, duration, value)]); types: (number, uom, power, flow, length), wired to meter readings by number."""
    p = prefix
    point = f"{BASE}/UsagePoint/77"
    tag = lambda t, v: "" if v is None else f"<{p}{t}>{v}</{p}{t}>"
    entry = lambda links, content: "<entry>" + "".join(f'<link href="{h}" rel="{r}"/>' for r, h in links) + f"<content>{content}</content></entry>"
    out = [entry([("self", point)], f"<{p}UsagePoint>{tag('name', name)}</{p}UsagePoint>")]
    for n, uom, power, flow, length in types:
        links = [("self", f"{BASE}/ReadingType/{n}/")] + ([("related", f"{point}/MeterReading/{n}")] if down else [])
        out.append(entry(links, f"<{p}ReadingType>{tag('flowDirection', flow)}{tag('intervalLength', length)}{tag('powerOfTenMultiplier', power)}{tag('uom', uom)}</{p}ReadingType>"))
    for n, readings in blocks:
        out.append(entry([("self", f"{point}/MeterReading/{n}"), ("related", point)] + ([] if down else [("related", f"{BASE}/ReadingType/{n}")]), f"<{p}MeterReading/>"))
        body = "".join(f"<{p}IntervalReading><{p}timePeriod>{tag('duration', d)}{tag('start', s)}</{p}timePeriod>{tag('value', v)}</{p}IntervalReading>" for s, d, v in readings)
        out.append(entry([("self", f"{point}/MeterReading/{n}/IntervalBlock/5")], f"<{p}IntervalBlock><{p}interval><{p}duration>86400</{p}duration></{p}interval>{body}</{p}IntervalBlock>"))
    space = f' xmlns:{p[:-1]}="http://naesb.org/espi"' if p else ""
    return f'<?xml version="1.0"?>\n<feed xmlns="http://www.w3.org/2005/Atom"{space}>' + "".join(out) + "</feed>"


def land(tmp_path, **files):
    for name, text in files.items():
        (tmp_path / name).write_bytes(text.encode("utf-8-sig" if name.startswith("bom") else "utf-8"))
    return str(tmp_path)


def rows(spark, path, **options):
    found = exports.readings(exports.open_exports(spark, path), **options)
    return found.select(F.element_at(F.split("file", "/"), -1).alias("file"), "device_id", "ts_utc", "interval_s", "value", "status").collect()


@pytest.mark.parametrize("down", [True, False])
def test_feed_links_scale_and_skips(spark, tmp_path, down):
    text = feed(
        [(1, [(0, 900, 1500), (900, None, 2), (1800, 900, None)]), (2, [(0, 900, 5)]), (3, [(0, 900, 7)])],
        ((1, 72, 1, 1, 600), (2, 38, 0, 1, None), (3, 72, 0, 19, None)), down, "1308468",
    )
    got = sorted((r.ts_utc, r.interval_s, r.value, r.status, r.device_id) for r in rows(spark, land(tmp_path, **{"a.csv": text})) if r.status in ("ok", "blank"))
    t0 = datetime(1970, 1, 1)
    assert got == [(t0, 900, 15.0, "ok", "1308468"), (t0.replace(minute=15), 600, 0.02, "ok", "1308468"), (t0.replace(minute=30), 900, None, "blank", "1308468")]
    assert sorted(r.status for r in rows(spark, str(tmp_path))) == ["blank", "ok", "ok", "reverse", "unit"]


def test_feed_without_type_or_with_one(spark, tmp_path):
    one = feed([(9, [(0, None, 1000)])], ((1, 72, 0, None, None),), prefix="")
    none = feed([(9, [(0, 900, 1)])], ((1, 72, 0, 1, None), (2, 72, 3, 1, None)))
    got = {r.file: (r.status, r.value, r.interval_s, r.device_id) for r in rows(spark, land(tmp_path, one=one, none=none))}
    assert got == {"one": ("ok", 1.0, 86400, "77"), "none": ("no type", None, 900, "77")}
    with pytest.raises(exports.ExportError, match="none: no type"):
        exports.checked(exports.readings(exports.open_exports(spark, str(tmp_path))))


def test_layouts(spark):
    want = datetime(2024, 1, 5, 13, 7)
    texts = {
        "01/05/2024 01:07:09 PM": want.replace(second=9), "1/5/2024 1:07 pm": want, "01/05/2024 13:07:09": want.replace(second=9), "01/05/2024 13:07": want, "2024-01-05 13:07:09": want.replace(second=9),
        "2024-01-05T13:07:09": want.replace(second=9), "2024-01-05 13:07": want, " 1/5/2024 ": datetime(2024, 1, 5), "2024-01-05": datetime(2024, 1, 5), "12/31/2024 12:00 AM": datetime(2024, 12, 31), "1/5/2024 12:30 PM": datetime(2024, 1, 5, 12, 30),
        "13/01/2024": None, "05.01.2024": None, "1/5/2024 13:07 PM": None, "2024-02-30": None, "": None,
    }
    d = spark.createDataFrame([(t,) for t in texts], "t string")
    assert {r.t: r.x for r in d.select("t", exports.wall_time(F.col("t")).alias("x")).collect()} == texts


def test_tables(spark, tmp_path):
    plain = 'Meter,Start Date,"Usage, kWh",Flow Direction\n"Meter #1308468 - Total Energy",01/05/2024 00:00,"1,234.5",Delivered\nMeter #1308468,01/05/2024 00:15,$2.5,\n,01/05/2024 00:30,,Forward\n\nM 7,01/05/2024 00:45,3,Received\nM 7,01/05/2024 01:00,4,consumption\n'
    ends = "﻿Interval Start,Interval End,Value\r\n1/5/2024 1:00 AM,1/5/2024 2:00 AM,5\r\n3/10/2024 1:00 AM,3/10/2024 3:00 AM,6\r\nsoon,later,7\r\n"
    path = land(tmp_path, plain=plain, ends=ends, odd="Alpha,Beta\n1,2\n")
    got = sorted((r.file, r.ts_utc.isoformat() if r.ts_utc else "", r.device_id or "", r.interval_s, r.value, r.status) for r in rows(spark, path))
    assert got == [
        ("ends", "", "unknown", 5616000, None, "unreadable"), ("ends", "2024-01-05T06:00:00", "unknown", 3600, 5.0, "ok"), ("ends", "2024-03-10T06:00:00", "unknown", 3600, 6.0, "ok"), ("odd", "", "", None, None, "no columns"),
        ("plain", "2024-01-05T05:00:00", "1308468", 900, 1234.5, "ok"), ("plain", "2024-01-05T05:15:00", "1308468", 900, 2.5, "ok"), ("plain", "2024-01-05T05:30:00", "unknown", 900, None, "blank"),
        ("plain", "2024-01-05T05:45:00", "M 7", 900, None, "reverse"), ("plain", "2024-01-05T06:00:00", "M 7", 900, 4.0, "ok"),
    ]
    assert {r.interval_s for r in rows(spark, path, interval_s=1800) if r.file == "plain"} == {1800}
    assert {(r.file.rsplit("/", 1)[-1], r.status): r.n for r in exports.census(exports.readings(exports.open_exports(spark, path))).collect()}[("plain", "ok")] == 3


def test_kinds_by_content(spark, tmp_path):
    path = land(tmp_path, **{"bom.txt": feed([(1, [(0, 900, 1)])]), "feed.csv": feed([]), "table.xml": "date,kwh\n", "blank": "\n"})
    assert {r.file.rsplit("/", 1)[-1]: r.kind for r in exports.open_exports(spark, path).files.collect()} == {"bom.txt": "feed", "feed.csv": "feed", "table.xml": "table", "blank": "empty"}


def test_every_line_and_file_has_a_status(spark, tmp_path):
    """Quoted line breaks, CR endings, short and long rows, header-only and empty files; no file without a usable row is taken."""
    path = land(
        tmp_path, quoted='Date,kWh,"Note,\tmore"\n2024-01-05 00:00,1,"two\nlines"\n2024-01-05 00:15,2,"say ""hi"", x"\n', cr="Date,kWh\r2024-01-05 00:00,3\r2024-01-05 00:15,4\r", head="Date,kWh\n", zero="", **{"with space": "Date,kWh\n2024-01-05 01:00,7\n"},
        short="Date,Flow,kWh\n2024-01-05 00:00\n2024-01-05 00:15,,5\n2024-01-05 00:30,,6,extra\n\n2024-01-05 00:45,,\n", only="Date,kWh\n2024-01-05 00:00\n", bare="<feed></feed>",
    )
    found = exports.readings(exports.open_exports(spark, path), 900)
    got = {(r.file.rsplit("/", 1)[-1], r.status): r.n for r in exports.census(found).collect()}
    assert got == {("quoted", "ok"): 2, ("cr", "ok"): 2, ("with%20space", "ok"): 1, ("head", "no rows"): 1, ("zero", "empty"): 1, ("short", "short"): 1, ("short", "ok"): 2, ("short", "blank"): 1, ("only", "short"): 1, ("bare", "no readings"): 1}
    assert sorted(r.value for r in exports.observations(found).collect()) == [1, 2, 3, 4, 5, 6, 7]
    with pytest.raises(exports.ExportError) as e:
        exports.checked(found)
    assert all(f"/{n}: " in str(e.value) for n in ("head", "zero", "only", "bare")) and "quoted" not in str(e.value)


def test_a_large_feed_is_many_tasks(spark, tmp_path):
    """One file, split in the midst of entries, gives what a file for each block gives; opening tags may have prefixes and attributes."""
    blocks = [(1, [(900 * (40 * b + k), 900, b + k) for k in range(40)]) for b in range(60)]
    (tmp_path / "one").mkdir(), (tmp_path / "many").mkdir()
    text = feed(blocks)
    land(tmp_path / "one", all=text)
    for b, block in enumerate(blocks):
        land(tmp_path / "many", **{f"f{b}": feed([block]).replace("<entry>", f'<entry id="{b}">' if b % 2 else "<a:entry>").replace("</entry>", "</entry>" if b % 2 else "</a:entry>").replace("<feed ", '<feed xmlns:a="http://www.w3.org/2005/Atom" ')})
    spark.conf.set("spark.sql.files.maxPartitionBytes", 20_000)
    spark.conf.set("spark.sql.files.openCostInBytes", 1000)
    try:
        found = exports.open_exports(spark, str(tmp_path / "one"))
        assert exports.entries(found).rdd.getNumPartitions() > 10 and exports.entries(found).count() == 2 + 2 * 60
        one, many = (sorted((r.ts_utc, r.value, r.status) for r in rows(spark, str(tmp_path / d))) for d in ("one", "many"))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert one == many and len(one) == 2400 and {r[2] for r in one} == {"ok"}


def test_malformed_entries_are_refused(spark, tmp_path):
    path = land(tmp_path, bad=feed([(1, [(0, 900, 1)])]).replace("</espi:IntervalBlock>", "</espi:Other>"))
    assert ("malformed", 1) in {(r.status, r.n) for r in exports.census(exports.readings(exports.open_exports(spark, path))).collect()}
    with pytest.raises(exports.ExportError, match="malformed"):
        exports.checked(exports.readings(exports.open_exports(spark, path)))


@pytest.fixture
def sparse(spark, tmp_path):
    """Views over events whose first partition has no row: a file of one row group, read in pieces, as larger tables are."""
    e = spark.range(400).selectExpr("id AS event_id", "TIMESTAMP_NTZ'2024-01-05 00:00:00' + make_dt_interval(0, 0, CAST(7 * id AS INT), 0) AS ts", "id % 17 AS user_id", "CAST(id % 50 AS DOUBLE) AS value")
    e.coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", 1000)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    v = Views(spark, str(tmp_path))
    assert v.table("events").rdd.glom().map(len).collect()[0] == 0
    yield v
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_no_table_of_a_header_alone(sparse):
    """Of 35 events 7 are 'reverse' and 4 of the others 'blank'."""
    assert ingest.REGISTRY.queries["I12_usage_csv"](sparse.spark, sparse.dir).count() == sum(i % 5 > 0 and i % 7 > 0 for i in range(400))


def test_no_file_without_bytes(sparse):
    """Two days dealt over eight partitions that adaptive execution leaves as they are."""
    spark = sparse.spark
    shuffle = {"spark.sql.shuffle.partitions": "8", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    was = {k: spark.conf.get(k) for k in shuffle}
    try:
        for k, v in shuffle.items():
            spark.conf.set(k, v)
        got = ingest.REGISTRY.queries["Q17_import_meter"](spark, sparse.dir).collect()
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
    assert {how: sum(r["rows"] for r in got if r.how == how) for how in ("csv", "xml")} == {"csv": 400, "xml": 400}


def test_feeds_are_streamed_by_lines(sparse, tmp_path, monkeypatch):
    """A day's feed is one file of XML; its lines and blocks stay small, whatever the day holds."""
    monkeypatch.setattr(ingest, "BLOCK", 20, raising=False)
    ingest.feed_files(sparse, str(tmp_path / "feeds"))
    texts = [f.read_text() for f in sorted((tmp_path / "feeds").rglob("part-*"))]
    roots = [ElementTree.fromstring(x) for x in texts]
    name = "{http://naesb.org/espi}Interval"
    blocks = [[len(list(b.iter(f"{name}Reading"))) for b in r.iter(f"{name}Block")] for r in roots]
    assert [sum(b) for b in blocks] == [206, 194] and all(0 < n <= 20 for b in blocks for n in b)
    assert all(len(list(r.iter("{http://naesb.org/espi}ReadingType"))) == 5 for r in roots)
    assert max(len(line) for x in texts for line in x.splitlines()) < 3000


def test_feeds_are_parsed_once(spark, tmp_path, monkeypatch):
    """Census, check and import read kept readings, not the files."""
    found = exports.open_exports(spark, land(tmp_path, a=feed([(1, [(0, 900, 1)])]), b="Date,kWh\n2024-01-05 00:00,3\n"))
    kept = exports.readings(found, 900)
    (tmp_path / "a").unlink(), (tmp_path / "b").unlink()
    assert exports.checked(kept).count() == 2 and {r.status for r in exports.census(kept).collect()} == {"ok"}


def test_files_without_readings_are_no_readings(sparse, monkeypatch):
    """A header alone, another table and an empty file beside the landed ones leave the counts as they are."""
    land_tables = ingest.usage_files

    def more(v, path):
        land_tables(v, path)
        for i, text in enumerate(("Date,kWh", "Alpha,Beta\n1,2", "")):
            v.spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("append").option("lineSep", "\n" if text else " ").text(path)

    monkeypatch.setattr(ingest, "usage_files", more)
    got = ingest.REGISTRY.queries["I13_files_sniffed"](sparse.spark, sparse.dir).collect()
    assert {r.feed: r.readings for r in got} == {True: 400, False: 400}
