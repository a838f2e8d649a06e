"""Publication: readers see the old rows until all the new ones are staged, counted and pointed to."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from gridloom import storage

SCHEMA = "local_date date, source string, device_id string, channel_id string, ts_utc timestamp_ntz, value double"


def days(spark, value, *dates):
    rows = [(datetime.fromisoformat(d).date(), "s", "d", "c", datetime.fromisoformat(f"{d} 0{h}:00:00"), value) for d in dates for h in range(3)]
    return spark.createDataFrame(rows, SCHEMA)


def state(spark, path):
    return {str(r.local_date): (r.n, r.v) for r in storage.read_published(spark, path).groupBy("local_date").agg(F.count("*").alias("n"), F.max("value").alias("v")).collect()}


def test_days_are_replaced_and_others_stay(spark):
    path = storage.new_path(spark, "days")
    storage.write_days(days(spark, 1.0, "2024-01-01", "2024-01-02"), path)
    storage.write_days(days(spark, 2.0, "2024-01-02", "2024-01-03"), path)
    assert state(spark, path) == {"2024-01-01": (3, 1.0), "2024-01-02": (3, 2.0), "2024-01-03": (3, 2.0)}
    storage.write_days(days(spark, 9.0), path)  # no rows replace nothing
    assert len(state(spark, path)) == 3
    one = storage.read_published(spark, path, spark.createDataFrame([], SCHEMA).schema, ("2024-01-02", "2024-01-02"))
    assert one.count() == 3 and all("local_date=2024-01-02" in f for f in one.inputFiles())
    gone = storage.vacuum(spark, path)
    assert len(gone) == 1 and len(state(spark, path)) == 3  # the version without rows; both others still hold days


@pytest.mark.parametrize("write", [lambda df, path: storage.write_days(df, path), lambda df, path: storage.verified_write(df, path)])
def test_a_failed_count_leaves_the_old_rows(spark, monkeypatch, write):
    path = storage.new_path(spark, "failed")
    write(days(spark, 1.0, "2024-01-01"), path)
    real = storage._rows_in
    monkeypatch.setattr(storage, "_rows_in", lambda *a: real(*a) - 1)
    with pytest.raises(storage.VerificationError, match="2 rows written, 3 expected"):
        write(days(spark, 2.0, "2024-01-01"), path)
    assert state(spark, path) == {"2024-01-01": (3, 1.0)}
    assert storage.vacuum(spark, path) == []  # what was staged is gone


def test_a_crash_between_the_steps_leaves_the_old_rows(spark, monkeypatch):
    path = storage.new_path(spark, "crash")
    storage.write_days(days(spark, 1.0, "2024-01-01"), path)

    def crash(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(storage, "_point", crash)
        with pytest.raises(KeyboardInterrupt):
            storage.write_days(days(spark, 2.0, "2024-01-01"), path)
    assert state(spark, path) == {"2024-01-01": (3, 1.0)}
    # A pointer that was begun and never finished counts as none.
    _, at, fs = storage._fs(spark, f"{path}/{storage._POINTERS}/{1:012d}")
    stream = fs.create(at, False)
    stream.write(bytearray(b"local_date=2024-01-01\tv=rnowhere\n"))
    stream.close()
    assert state(spark, path) == {"2024-01-01": (3, 1.0)}


def test_two_writers_from_one_pointer(spark):
    path = storage.new_path(spark, "race")
    storage.write_days(days(spark, 1.0, "2024-01-01"), path)
    with pytest.raises(Exception, match="exist"):
        storage._point(spark, path, 0, {"local_date=2024-01-01": "v=other"})
    assert state(spark, path) == {"2024-01-01": (3, 1.0)}


def test_nothing_published(spark):
    path = storage.new_path(spark, "none")
    with pytest.raises(FileNotFoundError):
        storage.read_published(spark, path)
    schema = spark.createDataFrame([], SCHEMA).schema
    assert storage.read_published(spark, path, schema).count() == 0
    assert storage.verified_write(spark.createDataFrame([], schema), path).collect() == [(0, 0)]


@pytest.mark.parametrize(("now", "landed"), [("06:05:00", []), ("06:59:59", []), ("07:00:00", ["2024-11-03-01"])])
def test_the_repeated_hour_closes_once_both_rounds_are_over(spark, now, landed):
    """01:00 local is 05:00 to 07:00 UTC; one sample of its first round does not close it."""
    path = storage.new_path(spark, "parts")
    raw = spark.createDataFrame([(datetime(2024, 11, 3, 5, 10), "s", "d", "c", 1.0)], "ts_utc timestamp_ntz, source string, device_id string, channel_id string, value double")
    storage.land_closed_hours(raw, path, F.expr(f"TIMESTAMP_NTZ'2024-11-03 {now}'"))
    names = [n.split("=")[1] for n in storage._pointer(spark, path)[1]]
    assert names == landed


def test_hour_ends_by_the_calendar(spark):
    at = {"2024-11-03 04:59:00": "2024-11-03 05:00:00", "2024-11-03 06:30:00": "2024-11-03 07:00:00", "2024-11-03 07:00:00": "2024-11-03 08:00:00", "2024-03-10 06:59:00": "2024-03-10 07:00:00", "2024-03-10 07:00:00": "2024-03-10 08:00:00"}
    df = spark.createDataFrame([(t,) for t in at], "t string")
    assert {r.t: r.e for r in df.select("t", storage.hour_end(F.col("t").cast("timestamp_ntz")).cast("string").alias("e")).collect()} == at
