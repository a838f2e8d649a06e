"""The channel dimension: map entries, inventory inheritance, and every violation reported together."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import category, channel_name
from ..schemas import CHANNEL


def resolve(entries: DataFrame, inventory: DataFrame) -> DataFrame:
    """Entries with what their inventory device gives; an explicit field wins."""
    inv = inventory.select(F.col("id").alias("inventory_id"), *(F.col(c).alias(f"_{c}") for c in ("label", "role", "kind", "room")))
    out = entries.join(inv, "inventory_id", "left")
    return out.select(*CHANNEL, F.coalesce("label", "_label").alias("label"), F.coalesce("room", "_room").alias("room"), category(F.col("_role"), F.col("_kind")).alias("category"), F.coalesce("is_primary", F.lit(False)).alias("is_primary"))


def violations(entries: DataFrame, inventory: DataFrame) -> DataFrame:
    """(kind, key, n): duplicate keys, several primaries of a source, dangling inventory ids, entries without any label."""
    key = F.concat_ws("/", *CHANNEL)
    inv = inventory.select(F.col("id").alias("inventory_id"), F.col("label").alias("_label"), F.lit(1).alias("_there"))
    joined = entries.join(inv, "inventory_id", "left")
    parts = [
        entries.groupBy(key.alias("key")).agg(F.count("*").alias("n")).where("n > 1").select(F.lit("duplicate key").alias("kind"), "key", "n"),
        entries.where("is_primary").groupBy(F.col("source").alias("key")).agg(F.count("*").alias("n")).where("n > 1").select(F.lit("several primaries").alias("kind"), "key", "n"),
        joined.where("inventory_id IS NOT NULL AND _there IS NULL").select(F.lit("dangling inventory id").alias("kind"), key.alias("key"), F.lit(1).cast("long").alias("n")),
        joined.where("label IS NULL AND _label IS NULL").select(F.lit("no label").alias("kind"), key.alias("key"), F.lit(1).cast("long").alias("n")),
        inventory.groupBy(F.col("id").alias("key")).agg(F.count("*").alias("n")).where("n > 1").select(F.lit("duplicate inventory id").alias("kind"), F.col("key").cast("string").alias("key"), "n"),
    ]
    return reduce(DataFrame.unionByName, parts)


def unmapped(live: DataFrame, dim: DataFrame) -> DataFrame:
    """Live channels that the dimension lacks, with a name to start from."""
    return live.select(*CHANNEL).distinct().join(dim.select(*CHANNEL), CHANNEL, "left_anti").withColumn("suggested", channel_name())


def skeleton(live: DataFrame, dim: DataFrame) -> DataFrame:
    """Map entries to fill in for live channels that the dimension lacks: what is known is set, what a person must say is null."""
    empty = [F.lit(None).cast("string").alias(c) for c in ("label", "category", "panel")]
    return unmapped(live, dim).select(*CHANNEL, "suggested", *empty, F.lit(False).alias("is_primary"))


def layout_diff(before: DataFrame, after: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Keys whose value changed, appeared or went: history under the same id would change its meaning."""
    b, a = before.select(*keys, F.col(value).alias("before")), after.select(*keys, F.col(value).alias("after"))
    both = b.join(a, keys, "full_outer").where(~F.col("before").eqNullSafe(F.col("after")))
    return both.withColumn("change", F.when(F.col("before").isNull(), "appeared").when(F.col("after").isNull(), "gone").otherwise("changed"))


def drift(a: DataFrame, b: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(compared, differing) of two snapshots."""
    both = a.select(*keys, F.col(value).alias("_a")).join(b.select(*keys, F.col(value).alias("_b")), keys, "full_outer")
    return both.agg(F.count("*").alias("compared"), F.count_if(~F.col("_a").eqNullSafe(F.col("_b"))).alias("differing"))


def vocabulary_gaps(seen: DataFrame, known: dict[str, str], metric: str = "metric") -> DataFrame:
    """Metrics in the data that the vocabulary lacks, with their rows."""
    return seen.where(~F.col(metric).isin(*known)).groupBy(metric).agg(F.count("*").alias("rows"))


