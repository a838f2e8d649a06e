"""Hub state on the stream: a hub's time is its own, frames wait in state, and what comes too late is named."""

from __future__ import annotations

import json
import random
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from gridloom import catalog, storage
from gridloom.plans.streams import FRAMES
from gridloom.streaming import ingest, state


def frame(hub, at, kind="delta", i="x", number=None, **fields):
    return hub, i, at, number or at * 1000, kind, json.dumps(fields)


def run(spark, batches, targets=1, late_s=5, **options):
    """Each batch lands and is taken by a stream started anew from one checkpoint."""
    src, check, out = (storage.new_path(spark, n) for n in ("frames", "checkpoint", "merged"))
    for rows in batches:
        spark.createDataFrame(rows, FRAMES).repartition(2).write.mode("append").parquet(src)
        stream = spark.readStream.schema(FRAMES).parquet(src)
        ingest.run_to_table(state.merge_deltas(stream, targets, late_s, **options), "merged", checkpoint=check, path=out, store=ingest.ROCKSDB)
    return spark.read.schema(state.OUTPUT).parquet(out).collect()


def hub_frames(hub, shift):
    return [frame(hub, shift, "connect"), frame(hub, shift + 1, a="1"), *(frame(hub, shift + 30 * k + 1, a=str(k)) for k in range(1, 5)), frame(hub, shift + 160, "clock")]


def test_a_hub_behind_the_others_loses_nothing(spark):
    fast, slow = hub_frames("fast", 1000), hub_frames("slow", 500)
    one = run(spark, [fast + slow])
    two = run(spark, [fast, slow])
    assert sorted(map(str, one)) == sorted(map(str, two))
    assert {h: sum(r.hub == h and r.what == "sample" for r in two) for h in ("fast", "slow")} == {"fast": 5, "slow": 5}
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    assert "RocksDB" not in before  # the session's own setting holds again


def test_order_of_arrival_does_not_show(spark):
    """Frames within the lateness, cut in any batches and sent twice, give what one batch in order gives."""
    rng = random.Random(4)
    frames = []
    for hub in ("a", "b"):
        t = 100 + 5000 * (hub == "b")
        frames.append(frame(hub, t, "connect"))
        for k in range(60):
            t += rng.randint(1, 12)
            kind = rng.choice(["delta"] * 6 + ["seed", "clock"] + ["connect"] * (k % 20 == 19))
            frames.append(frame(hub, t, kind, rng.choice("xyz"), number=t * 1000 + k, **{rng.choice("fg"): rng.choice(["1", "2", None])}))
        frames.append(frame(hub, t + 200, "clock"))
    want = run(spark, [frames], targets=3, late_s=40)
    arrived = sorted(frames, key=lambda f: f[2] + rng.random() * 39 + 3000 * (f[0] == "a"))
    batches = [arrived[i : i + 35] for i in range(0, len(arrived), 35)]
    batches[1] += batches[0][-3:]
    again = {f[3] for f in batches[0][-3:]}
    got = [r for r in run(spark, batches, targets=3, late_s=40) if r.what != "late" or r.at_s * 1000 // 1000 not in {n // 1000 for n in again}]
    assert len(want) > 60 and sorted(map(str, got)) == sorted(map(str, want))


def test_late_frames_are_reported(spark):
    got = run(spark, [[frame("h", 0, "connect"), frame("h", 1, a="1"), frame("h", 100, "clock")], [frame("h", 50, a="2"), frame("h", 97, a="3"), frame("h", 200, "clock")]])
    assert [(r.at_s, r.value) for r in got if r.what == "late"] == [(50, "delta")]
    assert [(r.at_s, r.value) for r in sorted(got, key=lambda r: r.at_s) if r.what == "sample"] == [(30, "1"), (60, "1"), (90, "1"), (120, "3"), (150, "3"), (180, "3")]


def test_a_timer_takes_what_a_silent_hub_left(spark):
    src, check, out = (storage.new_path(spark, n) for n in ("frames", "checkpoint", "merged"))
    spark.createDataFrame([frame("h", 0, "connect"), frame("h", 1, a="1")], FRAMES).write.parquet(src)
    with ingest.state_store(spark, ingest.ROCKSDB):
        query = state.merge_deltas(spark.readStream.schema(FRAMES).parquet(src), 1, 60, idle_s=1).writeStream.format("parquet").option("checkpointLocation", check).option("path", out).trigger(processingTime="1 second").start()
    try:
        for _ in range(60):
            time.sleep(1)
            if spark.read.schema(state.OUTPUT).parquet(out).where("what = 'sample'").count() >= 3:
                break
    finally:
        query.stop()
    got = spark.read.schema(state.OUTPUT).parquet(out).where("what = 'sample'").collect()
    assert sorted((r.at_s, r.value) for r in got) == [(30, "1"), (60, "1"), (90, "1")]


def test_conflicting_duplicates_give_one_result(spark):
    """Touched days are rolled from the first batch's rows, and in a batch from the least, however files are ordered."""
    at = datetime(2024, 1, 10, 12)
    row = lambda v: (at, at, "s", "d", "c", "watts", v, "W")
    kinds = "ts_utc timestamp_ntz, ts_local timestamp_ntz, source string, device_id string, channel_id string, metric string, value double, unit string"
    means = set()
    for batches in ([[5.0, 3.0, 7.0], [1.0]], [[7.0, 5.0, 3.0], [1.0, 0.5]], [[3.0, 7.0, 5.0], [9.0]]):
        src, raw, hourly, check = (storage.new_path(spark, n) for n in ("late", "raw", "hourly", "checkpoint"))
        for values in batches:
            for v in values:
                spark.createDataFrame([row(v)], kinds).write.mode("append").parquet(src)
            ingest.reroll_touched_days(ingest.stream_of(spark, src, spark.createDataFrame([], kinds).schema), raw, hourly, check, 30)
        means |= {r["mean"] for r in storage.read_published(spark, hourly).collect()}
    assert means == {3.0}


def test_number_of_entries_written(spark):
    """A batch writes the fields that it changed, not the hub's whole record."""
    hub = state.HubState(1, (1, 0, 0, 0, True, True, True, 0, 0), {("x", f"f{n}"): ("1", 0, 1, "delta") for n in range(1000)})
    list(hub.take([(5, "delta", 5, "x", '{"f1": "2"}')], 10))
    assert hub.changed == {("x", "f1")} and not hub.retouched or hub.touched == {"x"}


@pytest.mark.parametrize("mode", ["ws", "hybrid"])
def test_modes(spark, mode):
    taken = spark.createDataFrame([("h", "x", 30, "a", "1", "delta")], "hub string, id string, at_s long, field string, value string, value_source string")
    polls = spark.createDataFrame([("h", "x", 30, "a", "7"), ("h", "x", 60, "a", "8")], "hub string, id string, at_s long, field string, value string")
    got = state.with_polls(taken, polls, mode).select("at_s", "value", F.col("value_source")).collect()
    assert sorted(map(tuple, got)) == [(30, "1", "delta")] + [(60, "8", "rest")] * (mode == "hybrid")


ENDED = {
    "ST07_seed_guard": [("h0", "0", "f2", 1_704_067_200 * 10**9, 1_704_067_240, 2)],
    "ST11_fixed_cadence": [("h0", 0, 14, 3)],
    "ST12_value_sources": [("hybrid", "delta", 12, 4), ("hybrid", "seed", 2, 1), ("ws", "delta", 12, 4), ("ws", "seed", 2, 1)],
}


@pytest.mark.parametrize("name", ENDED)
def test_no_frame_is_left_waiting(spark, tmp_path, name):
    """A hub whose frames all come within the last hour: every one is taken, and samples go on until it counts as silent."""
    at = lambda s: datetime(2024, 1, 1, 0, 0, s)
    rows = [(0, at(0), 0, 1.0), *((n, at(n), 2 * n - 2, float(n)) for n in range(1, 5)), (17, at(40), 0, 7.0)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, value double").write.parquet(f"{tmp_path}/events.parquet")
    assert sorted(map(tuple, catalog.QUERIES[name](spark, str(tmp_path)).collect())) == ENDED[name]
    db = pytest.importorskip("duckdb").connect()
    db.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    assert sorted(db.execute(catalog.ORACLES[name]).fetchall()) == ENDED[name]
