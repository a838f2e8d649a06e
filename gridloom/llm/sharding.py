"""Sharding by vector bin packing: groups of equal texts go where (bytes, words, rows) fit the residual capacity best.

A group's vector has its share of all bytes, words and rows. Packing has two levels, so the driver sees a bounded number of
vectors for inputs of any size. Light groups are dealt by hash to parts of about ``PART_GROUPS`` (or to ``UNITS`` parts, where that is fewer); a task packs each part's groups,
heaviest first, into the part's own bins, each group where the dot product with the bin's residual capacity is highest. The
driver then packs those bins, and heavy groups (a ``UNITS``-th of a total or more, so ``3 * UNITS`` at most) as they are, into
the shards by the same rule. A group goes whole: where some shard has room for it, or else where the room is largest. Only a group above
a whole shard (one text may hold a third of all rows) is split, and dealt row by row.

The law that holds is ``bytes``: shard sizes are near equal, because bytes weigh more than words and rows in the dot product
and the last vectors placed are the lightest.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, groups_of, numbered, ordered_groups, runs, words_of

#: Bins of all parts together, where there are few parts; a group with a share of one in so many is heavy.
UNITS = 4096
PART_GROUPS = 50_000
#: A group above a whole shard, in bytes or rows, is split into pieces of this share of a shard; all others stay whole.
PIECE = 1 / 256
#: Weights of bytes, words and rows in the dot product.
WEIGHTS = (1.0, 0.2, 0.2)


def pack(vectors: Iterable[tuple[float, float, float]], bins: int, weights: tuple[float, float, float] = WEIGHTS, rows: Iterable[int] | None = None) -> list[list[int]]:
    """For each vector the bins that it goes to, heaviest first: where its dot product with the residual capacity is highest.

    Bins whose bytes would pass an equal share take a vector only if all would. Ties go to the lowest bin. With ``rows``, a
    vector of several rows that is above an equal share by itself is split into equal pieces, which are listed each; else every list
    has one bin.
    """
    v = np.array(list(vectors), float).reshape(-1, 3)
    total = v.sum(0)
    v = v / np.where(total > 0, total, 1)
    w, left = np.array(weights), np.full((bins, 3), 1 / bins)
    count = [1] * len(v) if rows is None else list(rows)
    out: list[list[int]] = [[] for _ in v]

    def put(x: np.ndarray) -> int:
        room = left[:, 0] >= x[0]
        at = int(np.argmax(np.where(room, left @ (w * x), -np.inf))) if room.any() else int(np.argmax(left[:, 0]))
        left[at] -= x
        return at

    for i in np.lexsort((np.arange(len(v)), -(v @ w), -v[:, 0])):
        share, pieces = max(v[i, 0], v[i, 2]) * bins, 1  # in parts of a bin: of its bytes, or of its rows
        if count[i] > 1 and share > 1:
            pieces = min(count[i], math.ceil(share / PIECE))
        out[i] = [put(v[i] / pieces) for _ in range(pieces)]
    return out


def _packed(bins: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, unit, bytes, words, n): the part's bin that each of its groups goes to."""
    for table in groups_of(batches, "part"):
        part = table.column("part").to_numpy()
        vectors = np.stack([table.column(c).to_numpy() for c in ("bytes", "words", "n")], 1)
        unit = np.concatenate([part[lo:hi] * bins + np.array(pack(vectors[lo:hi], bins), np.int64)[:, 0] for lo, hi in zip(*runs(part), strict=True)])
        yield pa.RecordBatch.from_arrays([table.column("key").combine_chunks(), pa.array(unit), *(pa.array(v) for v in vectors.T.copy())], names=["key", "unit", "bytes", "words", "n"])


def shard(docs: DataFrame, shards: int = 8, text: str = "text", id_col: str = "doc_id", rows_a_bucket: int = 50_000) -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard) for every row of ``docs``.

    ``size`` is the text's UTF-8 bytes plus 1 (null text: 1; its CRC is that of the empty text). ``slot`` counts each
    shard's rows from 0 without gaps, in an order that depends on id and text alone. Equal texts share a shard unless their
    group is above an equal share of all bytes or rows. Repeated rows are kept and count one each; no rows in, no rows out; other columns are ignored.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    rows = cut(docs.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(value) + 1).cast("long").alias("size"), F.crc32(value.cast("binary")).alias("text_crc32"),
        words_of(value).alias("words"), F.unhex(F.md5(value.cast("binary"))).alias("key"),
    ))
    groups = cut(rows.groupBy("key").agg(F.sum("size").alias("bytes"), F.sum("words").alias("words"), F.count("*").alias("n")))
    total = groups.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("bytes", "words", "n"))).first()
    heavy = F.expr(" OR ".join(f"{c} * {UNITS}D >= {max(total[c], 1)}D" for c in ("bytes", "words", "n")))
    few = groups.where(heavy).collect()  # at most 3 * UNITS rows, as each holds a UNITS-th of a total
    lights = groups.where(~heavy)
    parts = min(UNITS, max(64, math.ceil(lights.count() / PART_GROUPS)))
    bins = max(shards, UNITS // parts)
    lights = ordered_groups(lights.withColumn("part", F.pmod(F.xxhash64("key"), F.lit(parts))), "part")
    lights = cut(lights.select("part", "key", "bytes", "words", "n").mapInArrow(lambda it: _packed(bins, it), "key binary, unit long, bytes long, words long, n long"))
    # At most max(UNITS, UNITS * shards) rows.
    units = lights.groupBy("unit").agg(F.sum("bytes").alias("bytes"), F.sum("words").alias("words"), F.sum("n").alias("n")).collect()
    few, units = sorted(few, key=lambda g: bytes(g.key)), sorted(units, key=lambda u: u.unit)
    placed = pack([(g.bytes, g.words, g.n) for g in (*few, *units)], shards, rows=[*(g.n for g in few), *(1 for _ in units)])
    spark = docs.sparkSession
    # Both lookups are short: 3 * UNITS groups, of which a shard's pieces are 1 / PIECE; and the units above.
    dealt = spark.createDataFrame([(g.key, p) for g, p in zip(few, placed[: len(few)], strict=True)], "key binary, shards array<int>")
    of_unit = spark.createDataFrame([(u.unit, p[0]) for u, p in zip(units, placed[len(few) :], strict=True)], "unit long, of_unit int")
    lights = lights.select("key", "unit").join(of_unit, "unit").select(F.col("key").alias("k"), "of_unit")
    at = rows.join(F.broadcast(dealt), "key", "left")
    # Light groups are short, so their rows can be dealt by key.
    some = at.where("shards IS NULL").join(lights, F.expr("key = k")).drop("k")
    at = at.where("shards IS NOT NULL").withColumn("of_unit", F.lit(None).cast("int")).unionByName(some)
    at = cut(at).withColumn("order", F.xxhash64("doc_id", "text_crc32", "size"))
    ties, buckets = ["doc_id", "text_crc32", "size"], max(1, math.ceil(total.n / rows_a_bucket))
    # Only groups in pieces need their rows numbered: piece sizes then differ by a row at most.
    parted = numbered(at.where(F.size("shards") > 1), "key", "order", ties, buckets, "row")
    at = at.where(F.coalesce(F.size("shards") <= 1, F.lit(True))).withColumn("row", F.lit(0).cast("long")).unionByName(parted.select(*at.columns, "row"))
    at = at.withColumn("shard", F.coalesce(F.element_at("shards", F.pmod("row", F.size("shards")).cast("int") + 1), "of_unit").cast("int"))
    out = numbered(at, "shard", "order", ties, max(1, math.ceil(total.n / shards / rows_a_bucket)), "slot")
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
