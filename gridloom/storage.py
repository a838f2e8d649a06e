"""Datasets partitioned on the local date: staged and counted versions, published at once by a pointer; idempotent regeneration."""

from __future__ import annotations

import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions.localtime import TZ, local, local_date, utc
from .operators.dedupe import merge_latest, new_keys, precedence_union
from .operators.rollup import hourly_rollup
from .schemas import DEDUPE_KEY, SORT_KEY


class VerificationError(RuntimeError):
    """What was written does not hold the rows expected; nothing was published."""


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir, which driver and executors share. Where it is unset, a new local folder in local mode; on a cluster an error,
    as each machine would write its own."""
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.gridloom.data.dir", None)
    if found is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.conf.set("spark.gridloom.data.dir", found := tempfile.mkdtemp(prefix="gridloom-"))
    return found


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Write the frame to the shared folder and read it back: what reads it several times computes it once, and a lost executor costs a re-read."""
    path = new_path(df.sparkSession, "cut")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# A dataset's files lie in folders of versions, ``v=<id>/<partition>=<value>/``. A pointer file, numbered upwards, says which version holds each
# partition. Writing stages a new version, counts it, and then adds a pointer: until then, and if anything fails, readers see the
# pointer before, and so all the old rows. Two writers that start from one pointer can't both add the next.
_POINTERS = "_pointers"
_WHOLE = "."


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _listed(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    _, at, fs = _fs(spark, path)
    return [f.getPath().getName() for f in fs.listStatus(at)] if fs.exists(at) else []


def _pointer(spark: SparkSession, path: str) -> tuple[int, dict[str, str]]:
    """The newest whole pointer: its number, and the version of each partition. A pointer whose last line is missing was never finished."""
    for name in sorted(_listed(spark, f"{path}/{_POINTERS}"), reverse=True):
        jvm, at, fs = _fs(spark, f"{path}/{_POINTERS}/{name}")
        stream = fs.open(at)
        try:
            lines = bytes(stream.readAllBytes()).decode().splitlines()
        finally:
            stream.close()
        if lines and lines[-1] == "end":
            return int(name), dict(line.split("\t") for line in lines[:-1])
    return -1, {}


def _point(spark: SparkSession, path: str, number: int, versions: dict[str, str]) -> None:
    """Add a pointer; an error if another writer was first."""
    jvm, at, fs = _fs(spark, f"{path}/{_POINTERS}/{number:012d}")
    stream = fs.create(at, False)
    stream.write(bytearray("".join(f"{k}\t{v}\n" for k, v in sorted(versions.items())).encode() + b"end\n"))
    stream.close()


def _rows_in(spark: SparkSession, path: str, schema: T.StructType) -> int:
    """Rows that readers find in a staged version."""
    return spark.read.schema(schema).parquet(path).count()


def publish(df: DataFrame, path: str, by: str | None = None) -> dict[str, int]:
    """Replace the partitions that ``df`` holds (``by`` None: the whole dataset), all at once, and leave the others.

    The new rows are staged, read back and counted against what was seen on the way; a difference is a :class:`VerificationError` and
    nothing is published. Returns the counts. Old versions stay until :func:`vacuum`.
    """
    spark = df.sparkSession
    number, versions = _pointer(spark, path)
    version, seen = f"v=r{uuid.uuid4().hex}", Observation()
    staged = f"{path}/{version}"
    out = df.observe(seen, F.count(F.lit(1)).alias("expected"))
    if by:
        # Rebalanced by partition: adaptive execution splits a large one into files of the advisory size, and puts small ones together.
        order = [c for c in (*SORT_KEY, "metric", "value", "unit") if c in df.columns]
        out = out.hint("rebalance", F.col(by)).sortWithinPartitions(by, *order)
    writer = out.write.mode("overwrite").option("compression", "zstd")
    (writer.partitionBy(by) if by else writer).parquet(staged)
    written = _rows_in(spark, staged, df.schema)
    try:
        expected = seen.get["expected"]
    except Py4JJavaError:  # a plan that adaptive execution found to be empty observes nothing
        if written:
            raise
        expected = 0
    if written != expected:
        _, at, fs = _fs(spark, staged)
        fs.delete(at, True)
        raise VerificationError(f"{path}: {written} rows written, {expected} expected; nothing was published")
    parts = [n for n in _listed(spark, staged) if n.startswith(f"{by}=")] if by else [_WHOLE]
    _point(spark, path, number + 1, versions | dict.fromkeys(parts, version) if by else {_WHOLE: version})
    return {"expected": expected, "written": written}


def read_published(spark: SparkSession, path: str, schema: T.StructType | None = None, between: tuple[str, str] | None = None) -> DataFrame:
    """The rows published last; ``between`` takes only partitions whose value lies there, so other folders are not even listed.

    ``schema`` includes the partition column; columns that older files lack read null. Without one, a dataset must have rows.
    """
    _, versions = _pointer(spark, path)
    lo, hi = between or ("", "")
    at = [f"{path}/{v}" if part == _WHOLE else f"{path}/{v}/{part}" for part, v in sorted(versions.items()) if between is None or lo <= part.partition("=")[2] <= hi]
    if not at:
        if schema is None:
            raise FileNotFoundError(f"{path}: nothing is published")
        return spark.createDataFrame([], schema)
    reader = spark.read.option("basePath", path)
    return (reader if schema is None else reader.schema(schema)).parquet(*at).drop("v")


def vacuum(spark: SparkSession, path: str, keep: int = 1) -> list[str]:
    """Delete versions that none of the ``keep`` newest pointers names, and older pointers: what failed writes staged goes too.

    Must not run beside a writer, whose staged version has no pointer yet.
    """
    names = sorted(_listed(spark, f"{path}/{_POINTERS}"), reverse=True)
    live: set[str] = set()
    for name in names[:keep]:
        _, at, fs = _fs(spark, f"{path}/{_POINTERS}/{name}")
        stream = fs.open(at)
        live |= {line.split("\t")[1] for line in bytes(stream.readAllBytes()).decode().splitlines() if "\t" in line}
        stream.close()
    gone = [n for n in _listed(spark, path) if n.startswith("v=") and n not in live]
    for name in (*gone, *(f"{_POINTERS}/{n}" for n in names[keep:])):
        _, at, fs = _fs(spark, f"{path}/{name}")
        fs.delete(at, True)
    return gone


def write_days(df: DataFrame, path: str, day: str = "local_date") -> None:
    """Replace the days that ``df`` holds and leave the others, in canonical order; see :func:`publish`."""
    publish(df, path, day)


def with_days(raw: DataFrame, tz: str = TZ) -> DataFrame:
    return raw.withColumn("local_date", local_date("ts_utc", tz))


def read_days(spark: SparkSession, path: str, schema: T.StructType, first: str, last: str) -> DataFrame:
    """Rows of the local days asked for: only those days' files are listed and read."""
    full = T.StructType([*schema.fields, T.StructField("local_date", T.DateType())])
    return read_published(spark, path, full, (first, last)).where(F.col("local_date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))


def read_months(spark: SparkSession, path: str, schema: T.StructType, first: str, last: str, day: str = "local_day") -> DataFrame:
    """Rows of the local days asked for out of files by month: only those months' files are read."""
    full = T.StructType([*schema.fields, T.StructField("local_month", T.StringType())])
    lo, hi = F.lit(first).cast("date"), F.lit(last).cast("date")
    rows = read_published(spark, path, full, (first[:7], last[:7]))
    return rows.where(F.col(day).between(lo, hi)).drop("local_month")


def read_tolerant(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Files written before and after columns were added, as one table: a file without a column has nulls there."""
    return spark.read.schema(schema).parquet(path)


def verified_write(df: DataFrame, path: str) -> DataFrame:
    """Replace the whole dataset and return the counts as a row; see :func:`publish`."""
    counts = publish(df, path)
    return df.sparkSession.createDataFrame([(counts["expected"], counts["written"])], "expected long, written long")


def hour_end(ts_utc: Column | str, tz: str = TZ) -> Column:
    """When the local clock's hour that holds an instant is over for good: 01:00 of a fall-back night ends with its second round."""
    return utc(F.date_trunc("hour", local(ts_utc, tz)).cast("timestamp_ntz"), tz, fold=1) + F.expr("INTERVAL 1 HOUR")


def land_closed_hours(raw: DataFrame, path: str, now: Column, tz: str = TZ) -> None:
    """Hourly parts of local hours that are over by the calendar, whatever samples have come; a re-run replaces the same hours. The repeated
    autumn hour is one part, closed only when both rounds are over."""
    rows = raw.withColumn("local_hour", F.date_format(local("ts_utc", tz), "yyyy-MM-dd-HH")).where(hour_end("ts_utc", tz) <= now)
    write_days(rows, path, day="local_hour")


def compact(parts: DataFrame, existing: DataFrame, path: str) -> None:
    """Parts and the existing day file to one file a day; parts win, and days without new rows are left alone."""
    fresh = with_days(new_keys(parts, existing)).select("local_date").distinct()
    both = with_days(precedence_union({"parts": parts, "day": existing})).drop("origin")
    write_days(both.join(fresh, "local_date", "left_semi"), path)


def write_rollup(raw: DataFrame, path: str, poll_interval_s: float, tz: str = TZ) -> None:
    """Regenerate whole local days of the hourly table: idempotent, and how late samples are taken in."""
    write_days(hourly_rollup(raw, poll_interval_s, tz).withColumn("local_date", F.to_date("local_hour_start")), path)


def upsert_months(existing: DataFrame, incoming: DataFrame, path: str, keys: list[str] = DEDUPE_KEY) -> None:
    """Incoming rows replace existing ones; the months touched are written to a new path, never over what is being read."""
    merged = merge_latest(existing, incoming, keys).withColumn("local_month", F.date_format("ts_local", "yyyy-MM"))
    write_days(merged, path, day="local_month")


def retention(archived: DataFrame, day_files: DataFrame, now: Column, least_days: int = 7) -> DataFrame:
    """(local_date, rows, missing, deletable): archived parts may go once old enough and proven to add no row."""
    a = with_days(archived)
    missing = new_keys(a, day_files).groupBy("local_date").agg(F.count("*").alias("missing"))
    days = a.groupBy("local_date").agg(F.count("*").alias("rows"), F.max("ts_utc").alias("newest")).join(missing, "local_date", "left").na.fill(0, ["missing"])
    old = F.timestamp_diff("DAY", F.col("newest"), now) >= least_days
    return days.select("local_date", "rows", "missing", (old & (F.col("missing") == 0)).alias("deletable"))


def write_dimension(dim: DataFrame, path: str) -> None:
    """The channel dimension: one small file, sorted by its key; see :func:`publish`."""
    publish(dim.coalesce(1).sortWithinPartitions("source", "device_id", "channel_id"), path)


def create_table_sql(name: str, schema: T.StructType, comments: dict[str, str], path: str, partitions: list[str]) -> str:
    """Catalog registration with a comment on the table and on each column."""
    def column(f: T.StructField) -> str:
        note = comments.get(f.name, "").replace("'", "\\'")
        return f"`{f.name}` {f.dataType.simpleString()}" + (f" COMMENT '{note}'" if note else "")

    return f"CREATE TABLE {name} ({', '.join(map(column, schema))}) USING parquet PARTITIONED BY ({', '.join(partitions)}) COMMENT '{comments.get('', '')}' LOCATION '{path}'"


def register_partitions(spark: SparkSession, name: str, path: str) -> None:
    """Point the table's partitions at the versions published last: new ones are added, replaced ones moved."""
    known = {r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    for part, version in sorted(_pointer(spark, path)[1].items()):
        column, value = part.split("=", 1)
        where = f"PARTITION ({column} = '{value}')"
        spark.sql(f"ALTER TABLE {name} {where} SET LOCATION '{path}/{version}/{part}'" if part in known else f"ALTER TABLE {name} ADD {where} LOCATION '{path}/{version}/{part}'")
