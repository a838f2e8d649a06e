"""Mixing sources to target weights: exact block quotas split down a multivariate-hypergeometric tree.

Each source's documents are dealt by hash into blocks of about ``BLOCK_ROWS``, and the blocks of a source are permuted (an affine
map modulo their number). A source whose target is e whole passes and a part asks for all its blocks e times and, once more,
for the permuted blocks up to the one in which the part's words are reached: that number is the source's block quota. The
quotas are the tree's population: each node draws its left half's composition by source from a multivariate hypergeometric
law, so quotas are exact at every level, and a leaf is an output shard. A shard draws the next blocks of each source, as many as
its quota says, from a second permutation of the blocks asked for, so draws are disjoint; a document is taken where, and as often
as, its block is drawn. The last block of the part is drawn as well, but of its documents only those that fit, and one that
comes nearest to what is missing. Rows are then shuffled by hash inside their shard. Every draw is seeded, so reruns agree.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, running_total, words_of

BLOCK_ROWS = 256
#: How often the last block is gone through again for documents that still fit.
FILLS = 3
CYCLE = (5.0, 2.0, 1.0)


def targets(sizes: Sequence[float], weights: Sequence[float], most: float = 3.0) -> list[float]:
    """Share the sum of all sizes by weight; no target passes ``most`` times its size, the excess being shared again."""
    size, weight = np.array(sizes, float), np.array(weights, float)
    out, free, left = np.zeros(len(size)), np.ones(len(size), bool), float(size.sum())
    while free.any():
        share = np.where(free, left * weight / weight[free].sum(), out)
        over = free & (share > most * size)
        if not over.any():
            out = share
            break
        out[over] = most * size[over]
        left -= float(out[over].sum())
        free &= ~over
    return out.tolist()


def split(quotas: Sequence[int], shards: int, seed: int) -> np.ndarray:
    """quota[source, shard]: halves the shards again and again, each half's blocks drawn without replacement."""
    out = np.zeros((len(quotas), shards), np.int64)

    def node(now: np.ndarray, lo: int, hi: int) -> None:
        if hi - lo == 1:
            out[:, lo] = now
            return
        mid, rng = (lo + hi) // 2, np.random.default_rng([seed, lo, hi])
        left, take = np.zeros(len(now), np.int64), int(now.sum()) * (mid - lo) // (hi - lo)
        rest = int(now.sum())
        for i, n in enumerate(now):  # the marginals method, a hypergeometric draw a source
            rest -= int(n)
            left[i] = rng.hypergeometric(int(n), rest, take) if take and n else 0
            take -= int(left[i])
        node(left, lo, mid)
        node(now - left, mid, hi)

    node(np.array(quotas, np.int64), 0, shards)
    return out


def taken_words(mixed: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken, out_shards): words taken of each document, and the shards that draw it."""
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"), F.array_sort("places.out_shard").alias("out_shards"))


def mix(docs: DataFrame, shards: int = 8, seed: int = 17, weights: dict[str | None, float] | None = None, most: float = 3.0, text: str = "text", id_col: str = "doc_id", source: str = "source", keep: Sequence[str] = ()) -> DataFrame:
    """(doc_id, size, source, source_size, target, copies, places) for every row of ``docs``; ``keep`` columns follow, named
    ``_k_`` and their name, so none clashes.

    ``copies`` is how often the mix takes the row (0 to ``most`` rounded up); ``places`` has an (out_shard, order) for each.
    Sources are weighed by ``weights``, or 5, 2, 1 repeating by code point with null last. Rows without words have size 0 and
    are taken only with whole passes; a source without words has target 0. Repeated rows are taken alike. Empty table: no
    rows. The plan on the driver has one row per source, not per document.
    """
    kept = [c for c in keep if c in docs.columns]
    narrow = [F.col(id_col).alias("_id"), words_of(text).alias("_size"), F.col(source).cast("string").alias("_source"), F.coalesce(F.xxhash64(text, F.lit(seed)), F.lit(0)).alias("_sum")]
    rows = cut(docs.select(*narrow))
    plan = sorted(rows.groupBy("_source").agg(F.sum("_size").alias("size"), F.count("*").alias("n")).collect(), key=lambda r: (r["_source"] is None, (r["_source"] or "").encode()))
    weight = [(weights or {}).get(r["_source"], 0.0) if weights else CYCLE[i % 3] for i, r in enumerate(plan)]
    goal = targets([r["size"] for r in plan], weight, most)
    spark = docs.sparkSession
    passes = [min(int(math.floor(most)), int(g // r["size"])) if r["size"] else 0 for g, r in zip(goal, plan, strict=True)]
    sizes = [max(1, -(-r["n"] // BLOCK_ROWS)) for r in plan]
    # Beyond ``most`` whole passes no part is taken.
    parts = [g - e * r["size"] if e + 1 <= most else 0.0 for g, e, r in zip(goal, passes, plan, strict=True)]
    permuted = [_affine(n, seed + 1000 + i) for i, n in enumerate(sizes)]
    facts = spark.createDataFrame(
        [(i, r["_source"], r["size"], g, e, part, n, *turn) for i, (r, g, e, part, n, turn) in enumerate(zip(plan, goal, passes, parts, sizes, permuted, strict=True))],
        "s int, _s string, source_size long, target double, whole int, part double, blocks int, turn long, origin long",
    )
    facts, order = small(facts, len(plan)), F.xxhash64("_id", "_sum", "_size", F.lit(seed))

    def dealt(rows: DataFrame) -> DataFrame:
        """With each row's block, known by its place in the source's permutation."""
        rows = rows.join(facts, F.expr("_source <=> _s")).drop("_s").withColumn("_order", order)
        block = F.least(F.col("blocks") - 1, F.floor((F.col("_order") / F.lit(2.0**64) + 0.5) * F.col("blocks"))).cast("long")
        return rows.withColumn("_block", F.pmod(block * F.col("turn") + F.col("origin"), F.col("blocks")).cast("int"))

    rows = dealt(rows)
    sums = cut(rows.groupBy("s", "_block").agg(F.sum("_size").alias("_words"), F.first("part").alias("part"), F.first("blocks").alias("blocks")))
    starts = cut(running_total(sums, "s", "_block", "_words", "_start").join(sums, ["s", "_block"]))
    cuts = {r["s"]: r["n"] for r in starts.where("part > 0 AND _start < part").groupBy("s").agg((F.max("_block") + 1).alias("n")).collect()}
    taken = [e * n + cuts.get(i, 0) for i, (e, n) in enumerate(zip(passes, sizes, strict=True))]
    quota = split(taken, shards, seed) if plan else np.zeros((0, shards), np.int64)
    deal = spark.createDataFrame(
        [(i, q, *_affine(q, seed + i), [int(x) for x in np.cumsum(quota[i])]) for i, q in enumerate(taken)],
        "s int, q long, step long, shift long, bounds array<long>",
    )
    deal = small(deal, len(plan))
    rows = dealt(docs.select(*narrow, *(F.col(c).alias(f"_k_{c}") for c in kept))) if kept else rows
    inside = Window.partitionBy("s", "_block").orderBy("_order", "_id", "_sum", "_size").rowsBetween(Window.unboundedPreceding, -1)
    at = rows.join(starts.select(F.col("s").alias("_s2"), F.col("_block").alias("_b2"), "_start"), F.expr("s = _s2 AND _block = _b2")).join(deal, "s")
    at = at.withColumn("_before", F.col("_start") + F.coalesce(F.sum("_size").over(inside), F.lit(0)))
    # The part's last block: what fits in hash order, again without what was too large, then the one document that comes
    # nearest to the words still missing.
    block = Window.partitionBy("s", "_block")
    at = at.withColumn("_fits", F.expr("_size > 0 AND part > 0 AND _before + _size <= part"))
    at = at.withColumn("_gap", F.expr("part - _start") - F.coalesce(F.sum(F.expr("CASE WHEN _fits THEN _size END")).over(block), F.lit(0)))
    for _ in range(FILLS):
        at = at.withColumn("_try", F.expr("CASE WHEN NOT _fits AND _size > 0 AND part > 0 AND _start < part AND _size <= _gap THEN _size ELSE 0 END"))
        at = at.withColumn("_fits", F.col("_fits") | ((F.col("_try") > 0) & (F.coalesce(F.sum("_try").over(inside), F.lit(0)) + F.col("_try") <= F.col("_gap"))))
        at = at.withColumn("_gap", F.expr("part - _start") - F.coalesce(F.sum(F.expr("CASE WHEN _fits THEN _size END")).over(block), F.lit(0)))
    at = at.withColumn("_far", F.expr("CASE WHEN NOT _fits AND _size > 0 AND part > 0 AND _start < part AND abs(_size - _gap) < _gap THEN abs(_size - _gap) END"))
    nearest = F.row_number().over(block.orderBy(F.col("_far").asc_nulls_last(), "_order", "_id", "_sum", "_size"))
    at = at.withColumn("_passes", F.col("whole") + (F.col("_fits") | (F.col("_far").isNotNull() & (nearest == 1))).cast("int"))
    drawn = "pmod((CAST(p AS BIGINT) * blocks + _block) * step + shift, greatest(q, 1))"
    places = F.expr(f"transform(sequence(0, _passes - 1), p -> named_struct('out_shard', size(filter(bounds, b -> b <= {drawn})), 'order', xxhash64(_order, p, {seed})))")
    # A block that no shard's quota reaches is not drawn.
    places = F.when(F.col("_passes") > 0, F.filter(places, lambda x: x["out_shard"] < shards)).otherwise(F.array().cast("array<struct<out_shard:int,order:bigint>>"))
    at = at.withColumn("places", places)
    return at.select(F.col("_id").alias("doc_id"), F.col("_size").alias("size"), F.col("_source").alias("source"), "source_size", "target", F.size("places").alias("copies"), "places", *(f"_k_{c}" for c in kept))


def small(df: DataFrame, rows: int, most: int = 100_000) -> DataFrame:
    """A hint to broadcast a plan of ``rows`` short rows, up to ``most``; beyond that Spark joins it by shuffle."""
    return F.broadcast(df) if rows <= most else df


def _affine(q: int, seed: int) -> tuple[int, int]:
    """(step, shift) of a permutation of 0 to q - 1; the step is small enough that index * step stays in 64 bits."""
    rng = np.random.default_rng([seed, 5])
    step = int(rng.integers(1, min(max(q, 2), 1 << 30)))
    while math.gcd(step, max(q, 1)) != 1:
        step += 1
    return step, int(rng.integers(max(q, 1)))


def draw(docs: DataFrame, columns: Sequence[str] | None = None, id_col: str = "doc_id", **options) -> DataFrame:
    """The mix itself: a row of ``docs`` for each time it is taken, in shards, shuffled inside them.

    Rows are dealt by (shard, leading bits of their order) and sorted within, so a shard is read in shuffled order.
    """
    columns = list(columns or docs.columns)
    taken = mix(docs, id_col=id_col, keep=columns, **options).select("*", F.explode("places").alias("_place"))
    spread = taken.repartition("_place.out_shard", F.shiftright("_place.order", 56)).sortWithinPartitions("_place.out_shard", "_place.order")
    return spread.select(*(F.col(f"_k_{c}").alias(c) for c in columns))
