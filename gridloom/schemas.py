"""Table schemas and keys. Instants are timestamp_ntz in UTC, so no session time zone can move them; local clocks are labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ts, _s, _d, _l = T.TimestampNTZType(), T.StringType(), T.DoubleType(), T.LongType()


def _schema(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, null) for n, t, null in fields])


_IDENTITY = (("source", _s, False), ("device_id", _s, False), ("channel_id", _s, False), ("metric", _s, False))
OBSERVATION = _schema(("ts_utc", _ts, False), ("ts_local", _ts, False), *_IDENTITY, ("value", _d, False), ("unit", _s, False))
METER = T.StructType([*OBSERVATION.fields, T.StructField("interval_s", T.IntegerType(), False)])
HOURLY = _schema(
    ("hour_start_utc", _ts, False), ("local_hour_start", _ts, False), *_IDENTITY, ("unit", _s, False), ("mean", _d, False), ("min", _d, False), ("max", _d, False), ("p95", _d, False),
    ("sample_count", _l, False), ("kwh", _d, True), ("observed_seconds", _l, True), ("first_ts_utc", _ts, False), ("last_ts_utc", _ts, False),
)
DIM = _schema(*_IDENTITY[:3], ("label", _s, False), ("short_label", _s, False), ("panel", _s, True), ("slots", _s, True), ("category", _s, True), ("room", _s, True), ("priority", _s, True), ("blackstart_device_id", _s, True), ("estimated_watts", _d, True), ("is_primary", T.BooleanType(), False), ("updated_at", _ts, False))
FINDING = _schema(("rule", _s, False), ("key", _s, False), ("local_day", T.DateType(), True), ("headline", _s, False), ("kwh", _d, True))

CHANNEL = ["source", "device_id", "channel_id"]
SORT_KEY = ["source", "device_id", "channel_id", "ts_utc"]
DEDUPE_KEY = ["source", "device_id", "channel_id", "metric", "ts_utc"]
METER_DEDUPE_KEY = [*DEDUPE_KEY, "interval_s"]
HOURLY_KEY = ["source", "device_id", "channel_id", "metric", "hour_start_utc"]


class ContractError(ValueError):
    """A table lacks columns that its contract names."""


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns, cast; other columns go. Missing columns are an error, all named at once."""
    if missing := [f.name for f in schema if f.name not in df.columns]:
        raise ContractError(f"missing columns: {', '.join(missing)}")
    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in schema))


def tolerant(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Like :func:`conform`, but columns that older files lack read null."""
    return df.select(*((F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema))
