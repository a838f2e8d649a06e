"""Findings against a robust baseline, and which of them are news."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..storage import publish, read_published
from .coverage import islands
from .integrity import finding


def bands(daily: DataFrame, keys: list[str], least_days: int = 7, floor_kwh: float = 0.5, share: float = 0.15) -> DataFrame:
    """Median and spread per key: four scaled median absolute deviations, no less than a floor; too few days give no band.

    Two passes of one aggregate each, keyed alike, in place of collecting a key's history.
    """
    mid = daily.groupBy(*keys).agg(F.median("kwh").alias("median"), F.count("*").alias("days")).where(F.col("days") >= least_days)
    far = daily.join(mid, keys).groupBy(*keys).agg(F.median(F.abs(F.col("kwh") - F.col("median"))).alias("mad"))
    out = mid.join(far, keys)
    return out.withColumn("width", F.greatest(F.col("mad") * 1.4826 * 4, F.lit(floor_kwh), F.col("median") * share)).withColumn("upper", F.col("median") + F.col("width"))


def baseline(daily: DataFrame, day: str, days: int = 21, untrusted: DataFrame | None = None, key: str = "channel_id") -> DataFrame:
    """The days before ``day``, that day excluded, without untrusted channels."""
    d = F.lit(day).cast("date")
    rows = daily.where((F.col("local_day") < d) & (F.col("local_day") >= F.date_sub(d, days)))
    return rows if untrusted is None else trusted(rows, untrusted, F.col(key))


def trusted(rows: DataFrame, untrusted: DataFrame, key: Column) -> DataFrame:
    """Rows whose key the instruments' findings do not name."""
    return rows.withColumn("_key", key).join(untrusted.select(F.col("key").alias("_key")).distinct(), "_key", "left_anti").drop("_key")


def trailing_bands(daily: DataFrame, keys: list[str], days: int = 21, least_days: int = 7, floor_kwh: float = 0.5, share: float = 0.15, usable: Column | None = None) -> DataFrame:
    """Every row of ``daily`` (one per key and day) with the band of the ``days`` days before its own: all days in one job.

    The frame is a range of days, so absent days make it shorter and none is reached past it; it holds a value per day, of which the
    median and the median deviation are exact. ``usable`` days alone count towards bands. Too few give nulls.
    """
    at = F.datediff("local_day", F.lit("1970-01-01").cast("date"))
    frame = Window.partitionBy(*keys).orderBy("_at").rangeBetween(-days, -1)
    counted = F.col("kwh") if usable is None else F.when(usable, F.col("kwh"))
    mid = lambda a: (F.element_at(a, (F.size(a) / 2 + 0.5).cast("int")) + F.element_at(a, (F.size(a) / 2 + 1).cast("int"))) / 2
    rows = daily.withColumn("_at", at).withColumn("_before", F.sort_array(F.collect_list(counted).over(frame)))
    rows = rows.withColumn("days", F.size("_before").cast("long")).withColumn("median", F.when(F.col("days") >= least_days, mid(F.col("_before"))))
    far = F.sort_array(F.transform("_before", lambda x: F.abs(x - F.col("median"))))
    rows = rows.withColumn("mad", F.when(F.col("days") >= least_days, mid(far)))
    rows = rows.withColumn("width", F.when(F.col("days") >= least_days, F.greatest(F.col("mad") * 1.4826 * 4, F.lit(floor_kwh), F.col("median") * share)))
    return rows.withColumn("upper", F.col("median") + F.col("width")).drop("_at", "_before")


def above_trailing_band(daily: DataFrame, keys: list[str], first: str, last: str, days: int = 21, usd_per_kwh: float = 0.12, **band) -> DataFrame:
    """What :func:`above_band` finds on each of the days ``first`` to ``last``, in one job."""
    lo, hi = F.lit(first).cast("date"), F.lit(last).cast("date")
    near = daily.where(F.col("local_day").between(F.date_sub(lo, days), hi))
    rows = trailing_bands(near, keys, days, **band).where((F.col("local_day") >= lo) & (F.col("kwh") > F.col("upper")))
    return rows.withColumn("excess_kwh", F.col("kwh") - F.col("median")).withColumn("usd", F.col("excess_kwh") * usd_per_kwh)


def above_band(daily: DataFrame, day: str, keys: list[str], days: int = 21, usd_per_kwh: float = 0.12, **band) -> DataFrame:
    """The day's channels above their band, with the excess and its price at the marginal rate."""
    b = bands(baseline(daily, day, days), keys, **band)
    today = daily.where(F.col("local_day") == F.lit(day).cast("date")).join(b, keys)
    return today.where(F.col("kwh") > F.col("upper")).withColumn("excess_kwh", F.col("kwh") - F.col("median")).withColumn("usd", F.col("excess_kwh") * usd_per_kwh)


def went_quiet(daily: DataFrame, day: str, floor: float, least_days: int, key: str = "channel_id") -> DataFrame:
    """Keys whose run of days below the floor reaches ``day``."""
    rows = daily.where((F.col("kwh") < floor) & (F.col("local_day") <= F.lit(day).cast("date")))
    runs = islands(rows, [key], F.datediff("local_day", F.lit("1970-01-01").cast("date")), {"first_day": F.min("local_day"), "last_day": F.max("local_day")})
    return runs.where((F.col("last_day") == F.lit(day).cast("date")) & (F.col("length") >= least_days))


def stuck_loads(busy: DataFrame, day: str, least_hours: int = 20, duty: float = 0.98, usual: float = 0.9, keys: tuple[str, ...] = ("device_id", "channel_id")) -> DataFrame:
    """Channels on nearly all day that usually are not; ``busy`` has hours and busy_hours per channel and day."""
    k, d = list(keys), F.lit(day).cast("date")
    before = busy.where(F.col("local_day") < d).groupBy(*k).agg((F.sum("busy_hours") / F.sum("hours")).alias("usual_duty"))
    today = busy.where(F.col("local_day") == d).withColumn("duty", F.col("busy_hours") / F.col("hours")).join(before, k)
    return today.where((F.col("hours") >= least_hours) & (F.col("duty") >= duty) & (F.col("usual_duty") < usual))


def strip_heat(daily: DataFrame, outdoor: DataFrame, component: str, least_kwh: float = 3.0, mild_f: float = 45.0) -> DataFrame:
    """Days with resistance heat though the night stayed mild; days without an outdoor low are not judged."""
    rows = daily.where(F.col("channel_id") == component).where(F.col("kwh") >= least_kwh)
    return rows.join(outdoor, "local_day").where(F.col("low") > mild_f)


def envelope(days: DataFrame, meter: str, high: float, low: float, least_days: int) -> DataFrame:
    """A meter's days above ``high``, and its runs of ``least_days`` below ``low``."""
    rows = days.where(F.col("device_id") == meter)
    over = rows.where(F.col("kwh") > high).select(F.lit("high").alias("kind"), "local_day", "kwh", F.lit(1).cast("long").alias("days"))
    runs = islands(rows.where(F.col("kwh") < low), ["device_id"], F.datediff("local_day", F.lit("1970-01-01").cast("date")), {"last_day": F.max("local_day"), "kwh": F.sum("kwh")})
    return over.unionByName(runs.where(F.col("length") >= least_days).select(F.lit("low").alias("kind"), F.col("last_day").alias("local_day"), "kwh", F.col("length").alias("days")))


def phantom_growth(floors: DataFrame, day: str, days: int = 21, growth_w: float = 150.0) -> DataFrame:
    """The night floor of ``day`` against the median of those before it."""
    d = F.lit(day).cast("date")
    before = floors.where((F.col("local_day") < d) & (F.col("local_day") >= F.date_sub(d, days))).agg(F.median("floor_w").alias("usual_w"), F.count("*").alias("nights"))
    return floors.where(F.col("local_day") == d).crossJoin(before).withColumn("growth_w", F.col("floor_w") - F.col("usual_w")).withColumn("found", F.col("growth_w") >= growth_w)  # two single rows


LEDGER = "signature long, rule string, key string, since date, sent boolean"


def signed(findings: DataFrame) -> DataFrame:
    """(signature, rule, key, day): a row per rule and key, whatever the number of days; what a reader would call one finding."""
    return findings.groupBy("rule", "key").agg(F.max("local_day").alias("day")).withColumn("signature", F.xxhash64("rule", "key"))


def news(findings: DataFrame, last: DataFrame) -> DataFrame:
    """Findings whose signature the last report lacks."""
    mark = lambda df: df.withColumn("signature", F.xxhash64("rule", "key"))
    return mark(findings).join(mark(last).select("signature").distinct(), "signature", "left_anti")


def transitions(ledger: DataFrame, findings: DataFrame) -> DataFrame:
    """(signature, rule, key, since, change, send) for every signature that the ledger (:data:`LEDGER`) or the findings have.

    ``change``: 'new', 'kept' (told before), 'undelivered' (there before, but the message never went out), 'cleared'. New and undelivered
    ones are to be sent; a cleared one never is.
    """
    f = signed(findings).select("signature", F.col("rule").alias("_rule"), F.col("key").alias("_key"), "day")
    both = ledger.join(f, "signature", "full_outer")
    change = F.when(F.col("_rule").isNull(), "cleared").when(F.col("rule").isNull(), "new").when(F.col("sent"), "kept").otherwise("undelivered")
    rows = both.select("signature", F.coalesce("rule", "_rule").alias("rule"), F.coalesce("key", "_key").alias("key"), F.coalesce("since", "day").alias("since"), change.alias("change"))
    return rows.withColumn("send", F.col("change").isin("new", "undelivered"))


def next_ledger(changes: DataFrame, delivered: bool) -> DataFrame:
    """The ledger after a report: cleared signatures are forgotten, so their return is news; what could not be delivered stays unsent."""
    return changes.where("change <> 'cleared'").select("signature", "rule", "key", "since", (~F.col("send") | F.lit(delivered)).alias("sent"))


def notify(findings: DataFrame, path: str, deliver: Callable[[DataFrame], bool]) -> DataFrame:
    """One report against the ledger published at ``path``: ``deliver`` gets the rows to send, if there are any, and says whether they went out;
    then the next ledger is published. Returns the transitions. A run that dies before its end is made again from the old ledger."""
    spark = findings.sparkSession
    ledger = read_published(spark, path, T._parse_datatype_string(LEDGER))
    changes = transitions(ledger, findings).cache()
    due = changes.where("send")
    publish(next_ledger(changes, deliver(due) if not due.isEmpty() else True), path)
    return changes


def watch_decision(alarms: DataFrame, last: DataFrame, now: str, repeat_s: int = 86_400) -> DataFrame:
    """One row (send, reason, firing) from the alarms' ``check`` and the ``last`` message's (firing, notified_at), which may have no row.

    A set of failing checks that changed is sent, and so is its end ('recovered'); the same set is sent again after ``repeat_s``.
    """
    firing = alarms.agg(F.sort_array(F.collect_set("check")).alias("firing"))  # one row, a handful of checks
    before = last.agg(F.max_by("firing", "notified_at").alias("was"), F.max("notified_at").alias("at"))
    both = firing.crossJoin(before).withColumn("was", F.coalesce(F.sort_array("was"), F.array().cast("array<string>")))  # two single rows
    age = F.expr(f"timestampdiff(SECOND, at, TIMESTAMP_NTZ'{now}')")
    reason = (
        F.when((F.col("firing") != F.col("was")) & (F.size("firing") == 0), "recovered").when(F.col("firing") != F.col("was"), "changed").when(F.size("firing") == 0, "still-clear")
        .when(F.col("at").isNull(), "no-prior-notification").when(age >= repeat_s, "repeat").otherwise("unchanged")
    )
    return both.withColumn("reason", reason).select(F.col("reason").isin("recovered", "changed", "repeat", "no-prior-notification").alias("send"), "reason", "firing")


def as_findings(rows: DataFrame) -> DataFrame:
    return finding(rows, "above_band", F.concat_ws("/", "device_id", "channel_id"), F.col("local_day"), F.lit("above its band"), F.col("excess_kwh"))
