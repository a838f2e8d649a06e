"""Deterministic first-wins dedupe, precedence unions and the proofs that go with replacing a copy."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import DEDUPE_KEY


def dedupe(df: DataFrame, keys: list[str] = DEDUPE_KEY, precedence: list[Column | str] | None = None) -> DataFrame:
    """One row per key: the first by precedence, then by the remaining columns, so input order never matters."""
    rest = [c for c in df.columns if c not in keys]
    order = [*(precedence or []), *rest]
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_rn = 1").drop("_rn")


def precedence_union(parts: dict[str, DataFrame], keys: list[str] = DEDUPE_KEY) -> DataFrame:
    """Union of named parts, earlier parts winning; ``origin`` says where each row came from."""
    tagged = [df.withColumn("origin", F.lit(name)).withColumn("_prec", F.lit(i)) for i, (name, df) in enumerate(parts.items())]
    return dedupe(reduce(DataFrame.unionByName, tagged), keys, ["_prec"]).drop("_prec")


def merge_latest(existing: DataFrame, incoming: DataFrame, keys: list[str] = DEDUPE_KEY) -> DataFrame:
    """Month upsert: incoming rows replace existing ones of the same key."""
    return precedence_union({"incoming": incoming, "existing": existing}, keys).drop("origin")


def splice(base: DataFrame, tail: DataFrame, ts: str = "ts_utc") -> DataFrame:
    """``base`` and the rows of ``tail`` strictly after its last instant; the overlap is dropped, not merged."""
    cutoff = base.agg(F.max(ts).alias("_cutoff"))  # one row
    later = tail.join(F.broadcast(cutoff), (F.col(ts) > F.col("_cutoff")) | F.col("_cutoff").isNull()).drop("_cutoff")
    return base.unionByName(later)


def new_keys(candidate: DataFrame, archive: DataFrame, keys: list[str] = DEDUPE_KEY) -> DataFrame:
    """Rows of ``candidate`` whose key ``archive`` lacks: none, if the archive is a superset."""
    return candidate.join(archive.select(*keys).distinct(), keys, "left_anti")


def differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """(side, rows): how many rows each side has that the other lacks; zeros prove a copy."""
    one = lambda x, y, side: x.exceptAll(y).agg(F.count("*").alias("rows")).select(F.lit(side).alias("side"), "rows")
    return one(a, b, "only_a").unionByName(one(b, a, "only_b"))
