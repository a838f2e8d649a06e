"""Helpers shared by the corpus operators: shared-folder tables, running offsets, components, vectorised word hashing."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Words of the mixing, near-copy and substring operators: runs without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where that is unset, a new local one in local mode (tests); on a
    cluster an error, as each machine would write its own."""
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.gridloom.shared.dir", None)
    if found is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.conf.set("spark.gridloom.shared.dir", found := tempfile.mkdtemp(prefix="gridloom-"))
    return found


def cut(df: DataFrame) -> DataFrame:
    """Write the frame to the shared folder and read it back: a lost executor costs a re-read, not the whole lineage.

    Nothing reads the write's exchanges again, so Spark removes their files when it ends, and not at some later garbage collection.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEAN, "false")
    spark.conf.set(_CLEAN, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEAN, before)
    return spark.read.schema(df.schema).parquet(path)


def spread(spark: SparkSession) -> int:
    """Tasks for keyed exchanges; follows the session's shuffle setting."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def running_total(buckets: DataFrame, group: str, bucket: str, value: str, out: str, width: int = 1024) -> DataFrame:
    """Sum of ``value`` over the smaller buckets of the group, in two levels.

    ``buckets`` has one row per (group, bucket); buckets are whole numbers from 0. No window sees more than ``width`` rows
    of the lower level, or a ``width``-th of the buckets on the upper one.
    """
    hi = F.floor(F.col(bucket) / width)
    low = Window.partitionBy(group, "_hi").orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    top = Window.partitionBy(group).orderBy("_hi").rowsBetween(Window.unboundedPreceding, -1)
    rows = buckets.withColumn("_hi", hi)
    tops = rows.groupBy(group, "_hi").agg(F.sum(value).alias("_sum")).withColumn("_before", F.coalesce(F.sum("_sum").over(top), F.lit(0))).drop("_sum")
    inner = rows.withColumn("_within", F.coalesce(F.sum(value).over(low), F.lit(0)))
    joined = inner.withColumnRenamed(group, "_g").join(tops.withColumnRenamed("_hi", "_hi2"), F.expr(f"_g <=> {group} AND _hi = _hi2"))
    return joined.select(F.col("_g").alias(group), bucket, (F.col("_within") + F.col("_before")).alias(out))


def numbered(df: DataFrame, group: str, order: str, ties: list[str], buckets: int, out: str) -> DataFrame:
    """Number each group's rows from 0 without gaps: inside buckets of the order's hash value, plus what smaller buckets hold."""
    df = df.withColumn("_bucket", F.pmod(order, F.lit(buckets)).cast("int"))
    before = running_total(df.groupBy(group, "_bucket").agg(F.count("*").alias("_n")), group, "_bucket", "_n", "_before")
    inside = Window.partitionBy(group, "_bucket").orderBy(order, *ties)
    df = df.withColumn("_rank", F.row_number().over(inside) - 1).join(before, [group, "_bucket"])
    return df.withColumn(out, (F.col("_rank") + F.col("_before")).cast("long")).drop("_bucket", "_rank", "_before")


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable over the undirected edges, by randomised contraction.

    In each round a node takes the neighbour (or itself) that a round's hash puts first, and edges are renamed to what their
    ends took, so dense groups collapse at once and long chains by a constant share. A hub's edges are never collected: what
    a node takes comes from a partial ``min``, and the joins can be split. Rounds are cut to the shared folder. No edges: no rows.
    """
    now = cut(edges.where(F.col(a) != F.col(b)).select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v")).distinct())
    taken: list[DataFrame] = []
    while not now.isEmpty():
        rank = lambda c, seed=len(taken): F.struct(F.xxhash64(c, F.lit(seed)).alias("h"), F.col(c).alias("i"))
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        takes = cut(both.groupBy("u").agg(F.min(rank("v")).alias("x")).select(F.col("u").alias("k"), F.least("x", rank("u"))["i"].alias("m")))
        taken.append(takes)
        half = now.join(takes, F.col("u") == F.col("k")).select(F.col("m").alias("u"), "v")
        full = half.join(takes, F.col("v") == F.col("k")).select("u", F.col("m").alias("v")).where("u != v")
        now = cut(full.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())
    if not taken:
        return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = taken.pop()
    for takes in reversed(taken):
        later = roots.select(F.col("k").alias("k2"), F.col("m").alias("m2"))
        roots = takes.join(later, F.col("m") == F.col("k2"), "left").select("k", F.coalesce("m2", "m").alias("m"))
    least = roots.groupBy(F.col("m").alias("root")).agg(F.min("k").alias("component"))
    return roots.join(least, F.col("m") == F.col("root")).select(F.col("k").alias("node"), "component")


def ordered_groups(df: DataFrame, key: str) -> DataFrame:
    """Rows of one key side by side in one task, sorted by the key, for :func:`groups_of`."""
    return df.repartition(spread(df.sparkSession), key).sortWithinPartitions(key)


def groups_of(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Runs of whole groups out of batches sorted by ``key``: a table holds as many whole groups as its batch ends."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(batch.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
        change = np.flatnonzero(keys[1:] != keys[:-1])
        if held and held[-1].column(held[-1].schema.get_field_index(key))[-1].as_py() != keys[0]:
            yield pa.Table.from_batches(held)
            held = []
        if len(change):
            last = int(change[-1]) + 1
            yield pa.Table.from_batches([*held, batch.slice(0, last)])
            held = [batch.slice(last)]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First row and row after the last of each run of equal keys; no rows have no runs."""
    if not len(keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return first, np.r_[first[1:], len(keys)]


# ---------------------------------------------------------------------------------------------------------------- words

_RNG = np.random.default_rng(20240607)
_CODES = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE, _MASK = 0x9E3779B97F4A7C15, (1 << 64) - 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_MIX = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: Odd multipliers for the word at each place of a shingle or window.
PLACES = _RNG.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[str, np.ndarray] = {}

#: Separators of words: ASCII white space, or all ASCII that is neither digit nor letter.
SPACES = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
NON_ALNUM = np.array([b < 0x80 and not chr(b).isalnum() for b in range(256)])
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
SAME = np.arange(256, dtype=np.uint8)


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    h = (h ^ (h >> np.uint64(30))) * _MIX[0]
    h = (h ^ (h >> np.uint64(27))) * _MIX[1]
    return h ^ (h >> np.uint64(31))


def _power(which: str, base: int, n: int) -> np.ndarray:
    have = _powers.get(which)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        have = np.full(size, base, np.uint64)
        have[0] = 1
        _powers[which] = have = np.multiply.accumulate(have)
    return have[:n]


class Words:
    """The words of the texts of one Arrow array: ``first[d]:first[d+1]`` are document d's; ``start``/``end`` are bytes.

    A word's hash is a polynomial over its bytes modulo 2^64, mixed: equal words have equal hashes in every task.
    """

    def __init__(self, texts: pa.Array, separators: np.ndarray, lower: np.ndarray = SAME):
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = texts.buffers()[2]
        lo, hi = int(offsets[0]), int(offsets[-1])
        self.bytes = np.frombuffer(data, np.uint8)[lo:hi] if data is not None and hi > lo else np.zeros(0, np.uint8)
        self.bounds = offsets - lo
        n = len(self.bytes)
        inside = np.empty(n + 1, bool)
        inside[:n] = ~separators[self.bytes]
        inside[n] = False
        before = np.empty(n + 1, bool)
        before[0] = False
        before[1:] = inside[:-1]
        edge = self.bounds[(self.bounds > 0) & (self.bounds < n)]
        opens = inside & ~before
        opens[edge] |= inside[edge]
        closes = before & ~inside
        closes[edge] |= before[edge]
        self.start, self.end = np.flatnonzero(opens), np.flatnonzero(closes)
        self.first = np.searchsorted(self.start, self.bounds)
        s = np.zeros(n + 1, np.uint64)
        np.cumsum(_CODES[lower[self.bytes]] * _power("up", _BASE, n), out=s[1:])
        self.hash = mix((s[self.end] - s[self.start]) * _power("down", _BASE_INV, n + 1)[self.start] + (self.end - self.start).astype(np.uint64))
        self.count = np.diff(self.first)

    def docs(self) -> np.ndarray:
        """The document of each word."""
        return np.repeat(np.arange(len(self.count)), self.count)

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, hash) of every run of k words inside one document."""
        at = np.arange(max(0, len(self.hash) - k + 1))
        last = np.repeat(self.first[1:], self.count)
        at = at[at + k <= last[: len(at)]]
        h = np.zeros(len(at), np.uint64)
        for i in range(k):
            h += self.hash[at + i] * PLACES[i]
        return at, mix(h + np.uint64(k))


def slices(batches: Iterable[pa.RecordBatch], text: str, most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of about ``most`` bytes of text: at least a document each, whatever its length."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text))), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(size) // most
        for lo, hi in zip(*runs(part), strict=True):
            yield batch.slice(lo, hi - lo)


def small_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Fewer rows in an Arrow batch: texts are long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def words_of(text: Column | str) -> Column:
    """Number of words of a text; null has none. JVM-side."""
    return F.coalesce(F.regexp_count(F.col(text) if isinstance(text, str) else text, F.lit(WORD)), F.lit(0)).cast("long")
