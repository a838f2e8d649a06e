"""Operator rules on small literal tables: days of 23 and 25 hours, gaps, dedupe, coverage gates, exact money."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from gridloom import storage
from gridloom.functions import localtime as lt
from gridloom.functions import scalar as s
from gridloom.functions.ranges import report_range
from gridloom.operators import aggregates, anomalies, coverage, dedupe, dimension, hvac, integrity, ledger, meters, rollup, tariffs
from gridloom.plans import windows
from gridloom.plans.reports import bucket_width
from gridloom.schemas import OBSERVATION, ContractError, conform
from gridloom.sources import payloads
from gridloom.streaming.state import HubState

UTC0 = datetime(2024, 1, 10, 12)


def samples(spark, rows, metric="watts"):
    data = [(t, t - timedelta(hours=5), "leviton", "hub-a", c, metric, float(v), "W") for t, c, v in rows]
    return spark.createDataFrame(data, OBSERVATION)


def every(start, n, step_s=30, channel="breaker_p11", value=1200.0):
    return [(start + timedelta(seconds=step_s * i), channel, value) for i in range(n)]


def test_day_lengths_and_folds(spark):
    days = spark.createDataFrame([(date(2024, 3, 10),), (date(2024, 3, 11),), (date(2024, 11, 3),)], "local_day date")
    assert sorted((r.local_day, r.hours) for r in lt.day_table(days).collect()) == [(date(2024, 3, 10), 23), (date(2024, 3, 11), 24), (date(2024, 11, 3), 25)]
    walls = {(r.local_day, r.wall_hour): r.end_utc - r.start_utc for r in lt.wall_hours(lt.hour_spine(days)).collect()}
    assert walls[date(2024, 11, 3), 1] == timedelta(hours=2) and (date(2024, 3, 10), 2) not in walls
    at = spark.createDataFrame([(datetime(2024, 11, 3, 1, 30),), (datetime(2024, 7, 1, 1, 30),)], "t timestamp_ntz")
    assert [(r.a, r.b) for r in at.select(lt.utc("t").alias("a"), lt.utc("t", fold=1).alias("b")).collect()] == [(datetime(2024, 11, 3, 5, 30), datetime(2024, 11, 3, 6, 30)), (datetime(2024, 7, 1, 5, 30),) * 2]


def test_half_hour_is_half_the_energy(spark):
    full = rollup.hourly_rollup(samples(spark, every(UTC0, 120)), 30).first()
    half = rollup.hourly_rollup(samples(spark, every(UTC0, 60)), 30).first()
    assert full.kwh == pytest.approx(1.2) and half.kwh == pytest.approx(0.6) and half.observed_seconds == 1800
    volts = rollup.hourly_rollup(samples(spark, every(UTC0, 3), "volts"), 30).first()
    assert volts.kwh is None and volts.observed_seconds is None


def test_percentile_is_interpolated_and_missing_hours_have_no_row(spark):
    rows = [(UTC0 + timedelta(seconds=i), "c", i + 1) for i in range(20)] + every(UTC0 + timedelta(hours=3), 2, channel="c")
    out = rollup.hourly_rollup(samples(spark, rows), 30).orderBy("hour_start_utc").collect()
    assert out[0].p95 == pytest.approx(19.05) and [r.hour_start_utc.hour for r in out] == [12, 15]


def test_repeated_autumn_hours_stay_apart(spark):
    rows = every(datetime(2024, 11, 3, 5), 2) + every(datetime(2024, 11, 3, 6), 2)
    out = rollup.hourly_rollup(samples(spark, rows), 30)
    assert out.count() == 2 and out.select("local_hour_start").distinct().count() == 1


def test_cadence_gate(spark):
    good, bad, few = (rollup.cadence(samples(spark, every(UTC0, n, st)), 30).first().agrees for n, st in ((40, 30), (40, 60), (5, 60)))
    assert (good, bad, few) == (True, False, None)


def test_dedupe_ignores_order_and_prefers_precedence(spark):
    a = samples(spark, [(UTC0, "c", 5)]).withColumn("prec", F.lit(1))
    b = samples(spark, [(UTC0, "c", 9)]).withColumn("prec", F.lit(0))
    for both in (a.unionByName(b), b.unionByName(a)):
        assert [r.value for r in dedupe.dedupe(both, precedence=["prec"]).collect()] == [9.0]
    merged = dedupe.merge_latest(a.drop("prec"), b.drop("prec"))
    assert [r.value for r in merged.collect()] == [9.0]
    assert {r.side: r.rows for r in dedupe.differences(a, a).collect()} == {"only_a": 0, "only_b": 0}


def test_contract_names_all_missing(spark):
    with pytest.raises(ContractError, match="value, unit"):
        conform(samples(spark, every(UTC0, 1)).drop("value", "unit"), OBSERVATION)


def test_frozen_runs_zero_is_off_and_gaps_break(spark):
    def hours(*items):
        return [(UTC0 + timedelta(hours=h), UTC0 + timedelta(hours=h), "leviton", "d", "ct_1_a", "watts", "W", v, v, v, v, n, 1.0, 3600, UTC0, UTC0) for h, v, n in items]

    from gridloom.schemas import HOURLY

    df = spark.createDataFrame(hours((0, 25.0, 120), (1, 25.0, 120), (2, 25.0, 50), (3, 25.0, 120), (5, 0.0, 120), (6, 0.0, 120)), HOURLY)
    assert [(r.length, r.first_hour) for r in integrity.frozen_runs(df).collect()] == [(2, UTC0)]


def test_gaps_between_days_and_series(spark):
    """Gaps inside a day, over midnight and over whole days; ties, one-sample days, and keys and times that are null."""
    rows = []
    for channel in ("a", None):
        for ts in ("2024-01-01 23:58:00", "2024-01-01 23:59:00", "2024-01-02 00:00:00", "2024-01-02 00:00:00", "2024-01-02 00:05:00", "2024-01-05 12:00:00", "2024-01-06 12:00:30", None):
            rows.append(("s", "d", channel, "watts", ts))
    rows.append(("s", "d", "b", "watts", "2024-01-03 00:00:00"))
    raw = spark.createDataFrame(rows, "source string, device_id string, channel_id string, metric string, ts_utc string").withColumn("ts_utc", F.col("ts_utc").cast("timestamp_ntz"))
    got = coverage.gaps(raw, 60).select("channel_id", F.col("gap_start").cast("string"), F.col("gap_end").cast("string"), "missing").collect()
    want = [("2024-01-02 00:00:00", "2024-01-02 00:05:00", 4), ("2024-01-02 00:05:00", "2024-01-05 12:00:00", 5034), ("2024-01-05 12:00:00", "2024-01-06 12:00:30", 1439)]
    assert sorted(map(tuple, (r for r in got if r.channel_id == "a"))) == [("a", *w) for w in want]
    assert sorted(r[1:] for r in got if r.channel_id is None) == want and len(got) == 6
    assert coverage.gaps(raw.limit(0), 60).count() == 0


def test_gaps_and_holes(spark):
    raw = samples(spark, [(UTC0 + timedelta(seconds=x), "c", 1) for x in (0, 30, 60, 180, 210)])
    g = coverage.gaps(raw, 30).collect()
    assert [(r.gap_s, r.missing) for r in g] == [(120, 3)]
    series = coverage.bucket_series(raw, "2024-01-10 12:00:00", "2024-01-10 12:04:00", 60)
    assert sorted((r.bucket.minute, r.n) for r in series.collect()) == [(0, 2), (1, 1), (2, None), (3, 2)]
    assert [(r.length, r.hole_start.minute) for r in coverage.hole_runs(series, 60).collect()] == [(1, 2)]


def test_scalars(spark):
    df = spark.createDataFrame([("None", "YES", " Cool "), ("", "off", "fly"), ("0", "what", "off"), ("nan", None, None)], "n string, b string, w string")
    got = df.select(s.number("n").alias("n"), s.truth("b").alias("b"), s.encode("mode", "w").alias("w")).collect()
    assert [tuple(r) for r in got] == [(None, True, 2), (None, False, None), (0.0, None, 0), (None, None, None)]
    names = spark.createDataFrame([("breaker_p7",), ("ct_2_b",), ("panel_leg_a",), ("zone_1",), ("odd",)], "channel_id string")
    assert [r[0] for r in names.select(s.channel_name()).collect()] == ["Breaker 7", "CT 2 leg B", "Panel leg A", "Zone 1", "odd"]


def test_flat_correlation_is_null(spark):
    flat = spark.createDataFrame([(50.0, float(w)) for w in range(5)], "capacity double, watts double")
    assert hvac.agreement(flat).first().r is None
    two = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0)], "capacity double, watts double")
    assert hvac.agreement(two).first().r is None


def test_allocation_adds_up_and_money_rounds_half_up(spark):
    spans = spark.createDataFrame([("m", 1, Decimal("1"), 10), ("m", 2, Decimal("1"), 10), ("m", 3, Decimal("1"), 10)], "k string, o int, w decimal(10,3), t int")
    assert [r.part for r in tariffs.allocate(spans, ["k"], "o", "w", "t").orderBy("o").collect()] == [3, 3, 4]
    one = spark.range(1).select(tariffs.money(F.lit(Decimal("2.345"))).alias("a"), tariffs.money(F.lit(Decimal("-2.345"))).alias("b")).first()
    assert (one.a, one.b) == (Decimal("2.35"), Decimal("-2.35"))


def test_priced_cycle_by_hand(spark):
    cycles = spark.createDataFrame([("m", date(2024, 1, 1), date(2024, 1, 11), Decimal("0.01"), Decimal("2"), Decimal("1"), None, Decimal("0.30"))], "meter string, cycle_start date, cycle_end date, fuel decimal(12,6), env_pct decimal(12,6), rar_pct decimal(12,6), pgr_pct decimal(12,6), hea decimal(12,6)")
    rates = spark.createDataFrame([("m", date(2023, 1, 1), Decimal("0.45"), Decimal("0.10838"), Decimal("0.00125"))], "meter string, effective_from date, basic decimal(12,6), energy decimal(12,6), dsm decimal(12,6)")
    usage = spark.createDataFrame([("m", date(2024, 1, 2) + timedelta(days=i), 30.0) for i in range(10)], "meter string, local_day date, kwh double")
    r = tariffs.price(cycles, rates, usage).first()
    # 4.50 + 32.51 + 0.38 + 3.00 = 40.39; 2 % = 0.81; 1 % of 41.20 = 0.41; 3 % of 41.61
    assert [str(x) for x in (r.basic, r.energy, r.dsm, r.fuel_charge, r.env, r.rar, r.pgr, r.electric, r.school_tax, r.total)] == ["4.50", "32.51", "0.38", "3.00", "0.81", "0.41", "0.00", "41.91", "1.25", "43.16"]


def test_meters_never_sum_two_series(spark):
    rows = [(UTC0 + timedelta(minutes=15 * i), d, 0.25, 900) for i in range(8) for d in ("a", "b")] + [(UTC0 + timedelta(hours=i), "a", 1.0, 3600) for i in range(2)]
    m = spark.createDataFrame(rows, "ts_utc timestamp_ntz, device_id string, value double, interval_s int")
    assert {(r.device_id, r.meter_kwh) for r in meters.hours(m).collect()} == {("a", 1.0), ("b", 1.0)}
    assert {(r.device_id, r.meter, r.aliases) for r in meters.groups(m).collect()} == {("a", "a", 1), ("b", "a", 1)}


def test_bands_need_days(spark):
    rows = [("c", date(2024, 1, 1) + timedelta(days=i), 10.0 + i % 2) for i in range(9)] + [("few", date(2024, 1, 1), 1.0)]
    got = anomalies.bands(spark.createDataFrame(rows, "channel_id string, local_day date, kwh double"), ["channel_id"]).collect()
    assert [(r.channel_id, r.median, r.upper > 11) for r in got] == [("c", 10.0, True)]


def test_dimension_violations_come_together(spark):
    e = spark.createDataFrame([("s", "d", "c", None, None, "gone", True), ("s", "d", "c", "L", None, None, True)], "source string, device_id string, channel_id string, label string, room string, inventory_id string, is_primary boolean")
    inv = spark.createDataFrame([("x", "X", "r", "k", "room")], "id string, label string, role string, kind string, room string")
    assert {r.kind for r in dimension.violations(e, inv).collect()} == {"duplicate key", "several primaries", "dangling inventory id", "no label"}


def test_watch_missing_is_unknown(spark):
    led = spark.createDataFrame([("a", UTC0, True), ("a", UTC0 + timedelta(minutes=1), False), ("a", UTC0 + timedelta(minutes=2), False)], "stage string, at timestamp_ntz, ok boolean")
    stages = spark.createDataFrame([("a",), ("b",)], "stage string")
    assert {r.stage: r.state for r in ledger.watch(led, stages, "2024-01-10 12:03:00").collect()} == {"a": "failing", "b": "unknown"}


def test_rollup_rewrite_touches_only_its_day(spark):
    raw = samples(spark, every(UTC0, 4) + every(UTC0 + timedelta(days=1), 4))
    path = storage.new_path(spark, "t")
    for df in (raw, raw.where("ts_utc < TIMESTAMP_NTZ'2024-01-11 00:00:00'").withColumn("value", F.col("value") * 2)):
        storage.write_rollup(df, path, 30)
    assert sorted(r["mean"] for r in storage.read_published(spark, path).collect()) == [1200.0, 2400.0]


def test_unpositioned_breakers_and_null_legs_have_no_rows(spark):
    doc = '{"hub":"h","ts":"2024-01-10 12:00:00","breakers":[{"position":0,"poles":1,"model":"A","power":1},{"position":3,"poles":2,"model":"A","power":5},{"position":4,"poles":2,"model":"A","power":5,"power2":6},{"position":5,"poles":1,"model":"NONE-1","power":1}],"cts":[{"channel":1,"usageType":"MAIN","activePower":7}]}'
    rows = payloads.panel(payloads.parse(spark.createDataFrame([(doc,), ("broken",)], "value string"), payloads.PANEL)).collect()
    assert sorted((r.channel_id, r.value) for r in rows) == [("breaker_p4", 11.0), ("ct_1_a", 7.0)]


def drive(hub, *frames):
    out = []
    for n, (kind, at, i, fields) in enumerate(frames):
        out.extend(hub.frame(kind, at, n + 1, i, fields))
    return out


def test_hub_merges_clears_and_guards():
    hub = HubState(1)
    out = drive(hub, ("delta", 3, "x", {"z": "0"}), ("connect", 5, "", {}), ("delta", 6, "x", {"a": "1", "b": "2"}), ("delta", 7, "x", {"a": None}), ("seed", 8, "x", {"a": "7", "b": "9", "c": "3"}), ("delta", 31, "x", {"c": "4"}))
    assert out[0][1:4] == (6, None, "flood")  # frames before a connect are dropped; the only target is touched
    assert sorted((r[1], r[2], r[3], r[5]) for r in out[1:]) == [(30, "a", "7", "seed"), (30, "b", "2", "delta"), (30, "c", "3", "seed")]


def test_hub_is_silent_unless_in_sync_and_heard():
    hub = HubState(2)
    out = drive(hub, ("connect", 0, "", {}), ("seed", 1, "y", {"a": "5"}), ("delta", 400, "x", {"a": "1"}), ("disconnect", 500, "", {}), ("delta", 501, "x", {"a": "2"}))
    assert [(r[0], r[1], r[3], r[7]) for r in out] == [(None, 20, "timeout", "sync"), *(("y", s, "5", "sample") for s in (30, 60, 90)), *((i, s, v, "sample") for s in (420, 450, 480) for i, v in (("y", "5"), ("x", "1")))]


def test_hub_evicts_by_session_never_by_age():
    hub = HubState(2)
    drive(hub, ("connect", 0, "", {}), ("delta", 1, "x", {"a": "1", "b": "2"}), ("delta", 2, "y", {"a": "1"}))
    out = list(hub.frame("connect", 10, 10, "", {})) + list(hub.frame("delta", 11, 11, "x", {"a": "3"})) + list(hub.advance(60))
    assert [(r[0], r[1], r[2], r[7]) for r in out] == [(None, 30, None, "sync"), ("x", 30, "b", "evicted"), ("y", 30, "a", "evicted"), ("x", 30, "a", "sample"), ("x", 60, "a", "sample")]
    assert set(hub.fields) == {("x", "a")} and hub.changed == {("x", "a"), ("x", "b"), ("y", "a")} and HubState(2, hub.numbers(), hub.fields, hub.touched).numbers() == hub.numbers()


def test_bucket_choice():
    assert bucket_width(30 * 86400, 1800) == 7200 and bucket_width(3600, 30) == 60
    with pytest.raises(ValueError):
        bucket_width(10**9, 30)


def test_report_range():
    assert report_range("2024-01-03", "2024-01-04") == (date(2024, 1, 3), date(2024, 1, 4))
    assert report_range(days=2, today=date(2024, 1, 4)) == (date(2024, 1, 3), date(2024, 1, 4))
    for bad in ({"start": "2024-01-01"}, {"days": 401}, {"days": 0}, {"start": "2024-01-02", "end": "2024-01-01"}):
        with pytest.raises(ValueError):
            report_range(**bad)


def test_rollup_refuses_another_cadence(spark):
    raw = samples(spark, every(UTC0, 60))
    assert rollup.checked_rollup(raw, 30).select("cadence_agrees").distinct().collect() == [(True,)]
    with pytest.raises(rollup.CadenceError, match="configured 120 s"):
        rollup.checked_rollup(raw, 120)
    assert rollup.checked_rollup(raw, 120, allow_mismatch=True).where("cadence_agrees").count() == 0


def test_series_cross_midnight(spark):
    """Previous samples, gaps and runs at zero go on over days; a null value and another channel break a run."""
    at = ["2024-01-01 10:00:00", "2024-01-01 23:00:00", "2024-01-02 00:30:00", "2024-01-04 01:00:00", "2024-01-04 02:00:00", "2024-01-05 00:00:00"]
    rows = [(t, "s", "d", "ct1", "watts", v) for t, v in zip(at, [5.0, 0.0, 0.0, 0.0, None, 0.0], strict=True)] + [(at[2], "s", "d", "ct2", "watts", 0.0)]
    obs = spark.createDataFrame(rows, "ts_utc string, source string, device_id string, channel_id string, metric string, value double").withColumn("ts_utc", F.col("ts_utc").cast("timestamp_ntz"))
    steps = coverage.previous_sample(obs).select("channel_id", F.col("previous").cast("string"), F.col("ts_utc").cast("string")).collect()
    assert sorted(map(tuple, steps)) == [("ct1", a, b) for a, b in zip(at, at[1:])]
    gaps = coverage.gaps(obs, 12 * 3600).select(F.col("gap_start").cast("string"), "missing").collect()
    assert sorted(map(tuple, gaps)) == [(at[2], 3), (at[4], 1)]
    runs = coverage.zero_runs(obs).select("channel_id", F.col("run_start").cast("string"), F.col("run_end").cast("string"), "length").collect()
    assert sorted(map(tuple, runs)) == [("ct1", at[1], at[3], 3), ("ct1", at[5], at[5], 1), ("ct2", at[2], at[2], 1)]


def test_trailing_bands_equal_day_by_day(spark):
    """A range of days in one job finds what each day by itself finds, over absent days and keys that start late."""
    import random

    rng = random.Random(2)
    rows = [(c, date(2024, 1, 1) + timedelta(days=i), 10 + rng.random() * (2 if rng.random() < 0.8 else 100)) for c in "abc" for i in range(60) if rng.random() < 0.8 and (c != "c" or i > 40)]
    daily = spark.createDataFrame(rows, "channel_id string, local_day date, kwh double").cache()
    days = [date(2024, 2, 1) + timedelta(days=i) for i in range(0, 28, 3)]
    want = {(r.channel_id, r.local_day): round(r.excess_kwh, 9) for d in days for r in anomalies.above_band(daily, str(d), ["channel_id"]).collect()}
    got = {(r.channel_id, r.local_day): round(r.excess_kwh, 9) for r in anomalies.above_trailing_band(daily, ["channel_id"], "2024-02-01", "2024-02-28").collect() if r.local_day in days}
    assert got == want and len(want) >= 3
    some = anomalies.trailing_bands(daily, ["channel_id"], usable=F.col("kwh") < 12.5).where("upper IS NOT NULL").agg(F.max("median")).first()[0]
    assert some < 13


def test_ledger_forgets_cleared_and_repeats_undelivered(spark):
    from gridloom.storage import new_path

    found = lambda *keys: spark.createDataFrame([("rule", k, date(2024, 1, 1)) for k in keys], "rule string, key string, local_day date")
    path, told = new_path(spark, "ledger"), []

    def deliver(works):
        def send(rows):
            told.append(sorted(r.key for r in rows.collect()))
            return works

        return send

    change = lambda f, works=True: {r.key: (r.change, r.send) for r in anomalies.notify(f, path, deliver(works)).collect()}
    assert change(found("a", "a")) == {"a": ("new", True)}
    assert change(found("a", "b"), works=False) == {"a": ("kept", False), "b": ("new", True)}
    assert change(found("a", "b")) == {"a": ("kept", False), "b": ("undelivered", True)}
    assert change(found("b")) == {"a": ("cleared", False), "b": ("kept", False)}
    assert change(found("a", "b")) == {"a": ("new", True), "b": ("kept", False)}
    assert change(found()) == {"a": ("cleared", False), "b": ("cleared", False)}
    assert told == [["a"], ["b"], ["b"], ["a"]]  # nothing is said where nothing is due


@pytest.mark.parametrize(("firing", "was", "want"), [([], None, (False, "still-clear")), (["x"], None, (True, "changed")), (["x"], (["x"], 1), (False, "unchanged")), (["x"], (["x"], 30), (True, "repeat")), ([], (["x"], 1), (True, "recovered")), (["y", "x"], (["x"], 1), (True, "changed"))])
def test_watch_decisions(spark, firing, was, want):
    now = datetime(2024, 1, 10, 12)
    alarms = spark.createDataFrame([(c, "stale") for c in firing], "check string, state string")
    last = spark.createDataFrame([(was[0], now - timedelta(hours=was[1]))] if was else [], "firing array<string>, notified_at timestamp_ntz")
    row = anomalies.watch_decision(alarms, last, "2024-01-10 12:00:00").first()
    assert (row.send, row.reason, row.firing) == (*want, sorted(firing))


def test_meter_age(spark):
    meter = spark.createDataFrame([("a", UTC0), ("b", UTC0 - timedelta(days=4))], "device_id string, ts_utc timestamp_ntz")
    expected = spark.createDataFrame([("a",), ("b",), ("c",)], "device_id string")
    got = ledger.meter_alarms(meter, expected, "2024-01-10 12:03:00")
    assert {r.device_id: r.state for r in got.collect()} == {"a": "fine", "b": "stale", "c": "unknown"}
    stages = spark.createDataFrame([("s", "fine"), ("t", "failing")], "stage string, state string")
    assert {r.check for r in ledger.alarms(stages, got).collect()} == {"meter b", "meter c", "stage t"}


@pytest.mark.parametrize(("day", "hours"), [("2024-03-10", 23), ("2024-03-11", 24), ("2024-11-03", 25)])
def test_coverage_by_the_days_own_length(spark, day, hours):
    """A day observed throughout has a coverage of one, whatever its length."""
    start = spark.range(1).select(lt.midnight_utc(F.lit(day).cast("date")).alias("t")).first().t
    rows = [(start + timedelta(hours=h), "ct_1_a", 1.0) for h in range(hours)]
    raw = spark.createDataFrame(rows, "ts_utc timestamp_ntz, channel_id string, value double").select("ts_utc", lt.local("ts_utc").alias("ts_local"), F.lit("s").alias("source"), F.lit("d").alias("device_id"), "channel_id", F.lit("watts").alias("metric"), "value", F.lit("W").alias("unit"))
    hourly = rollup.hourly_rollup(raw, 3600)
    assert [r.coverage for r in aggregates.feed_coverage(hourly).collect()] == [1.0] and [r.coverage for r in aggregates.panel_coverage(hourly).collect()] == [1.0]
    dim = spark.createDataFrame([], "source string, device_id string, channel_id string, label string, category string")
    assert [r.coverage_pct for r in aggregates.circuits(hourly, dim, 3600, day, day).collect()] == [100.0]
    meter = raw.select("ts_utc", "device_id", "value", F.lit(3600).alias("interval_s"))
    assert [r.coverage for r in meters.day_coverage(meter, 3600, "d").collect()] == [1.0]


def test_latch_pairs_of_any_value(spark, tmp_path):
    """A pair's class follows the event's number, also where its value is zero, missing, negative or no number."""
    odd = (0.0, -0.0, None, -3.0, float("nan"), float("inf"), 12.5)
    spark.createDataFrame([(i, odd[i // 21]) for i in range(21 * len(odd))], "event_id long, value double").write.parquet(str(tmp_path / "events.parquet"))
    got = {r.verdict: r.n for r in windows.REGISTRY.queries["A32_latch_verdicts"](spark, str(tmp_path)).collect()}
    assert got == {"one side only": 21, "equal": 42, "close": 42, "different": 42}
