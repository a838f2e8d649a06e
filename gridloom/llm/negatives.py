"""Hard-negative mining by Fagin's threshold algorithm over integer vectors.

A component x counts as floor(256 * x), so scores are exact integers. An anchor's positives are the best rows of its own label; for each
of them, negatives are the best rows of other labels whose score lies in a window below the positive's.

Rows are dealt to blocks by hash, and every anchor visits every block. A block keeps, per dimension, its rows sorted by component. An
anchor reads these lists from the end that its own component's sign favours (sorted access), scores each row that it meets for the
first time in full (random access), and stops once the threshold, which no unmet row's score can pass, is strictly below each
window's kth score or below the window itself; ties are met so. A block gives a few rows per anchor and window, and the best of
all blocks are the answer. Two such searches are made: for positives, and for negatives with the windows of all positives at once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, runs, spread

SCALE = 256
#: Rows of a block at most, about: what a task holds.
BLOCK_ROWS = 16_384
_NO_ID = 2**63 - 1
_HITS = "q long, anchor_id long, w int, positive_id long, positive_score long, id long, score long"


def relabelled(rows: DataFrame, every: int = 7, labels: int = 10) -> DataFrame:
    """Rows whose id is divisible by ``every`` get the next label: planted mistakes, which make negatives out of true neighbours."""
    return rows.withColumn("label", F.when(F.col("vec_id") % every == 0, (F.col("label") + 1) % labels).otherwise(F.col("label")))


def _matrix(col: pa.Array) -> np.ndarray:
    """Lists of numbers as rows of doubles, short ones filled with zeros."""
    sizes = np.diff(col.offsets.to_numpy())
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    width = int(sizes.max(initial=0))
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def integers(x: np.ndarray) -> np.ndarray:
    """floor(SCALE * x): doubles where they are exact, else Python's integers."""
    if not x.size or np.abs(x).max() * SCALE < 2**53:
        return np.floor(x * SCALE)
    return np.array([[int(c) * SCALE if abs(c) >= 2**53 else math.floor(c * SCALE) for c in row] for row in x.tolist()], object).reshape(x.shape)


class Block:
    """A block's rows in sorted lists, one per dimension."""

    def __init__(self, ids: np.ndarray, keys: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.ids, self.keys, self.labels, self.x = ids, keys, labels, integers(vectors)
        self.most = max(1, np.abs(self.x).max(initial=0))
        self.order = np.argsort(self.x, axis=0, kind="stable").T.copy()

    def search(self, anchor: np.ndarray, wanted: np.ndarray, windows: list[tuple[float, float]], k: int) -> list[list[int]]:
        """Rows among ``wanted`` with the k best scores inside each window (ends included), and their scores."""
        n, d = self.x.shape
        a = np.zeros(d)
        a[: len(anchor)] = anchor[:d]
        x = self.x
        if x.dtype == object or a.dtype == object or float(self.most) * float(np.abs(a).max(initial=0)) * max(d, 1) >= 2**53:
            x, a = x.astype(object), np.array([int(c) for c in anchor[:d]] + [0] * (d - len(anchor[:d])), object)
            if x.size and not isinstance(x.flat[0], int):
                x = np.array([[int(c) for c in r] for r in x], object).reshape(n, d)
        up, down = np.flatnonzero(a > 0), np.flatnonzero(a < 0)
        met, score = np.zeros(n, bool), np.zeros(n, x.dtype)
        depth, step = 0, 32
        while True:
            end = min(n, depth + step)
            now = np.zeros(n, bool)
            now[self.order[up, n - end : n - depth]] = True
            now[self.order[down, depth:end]] = True
            if end == n:
                now[:] = True  # nothing is left; an anchor of zeros has no lists to read
            new = np.flatnonzero(now & ~met)
            score[new] = x[new] @ a
            met[new] = True
            own = score[met & wanted]
            if end == n or met.all():
                break
            threshold = (a[up] * x[self.order[up, n - end], up]).sum() + (a[down] * x[self.order[down, end - 1], down]).sum()
            if all(threshold < low or (len(s := own[(own >= low) & (own <= high)]) >= k and threshold < np.partition(s, len(s) - k)[len(s) - k]) for low, high in windows):
                break
            depth, step = end, step * 2
        out = []
        for low, high in windows:
            at = np.flatnonzero(met & wanted & (score >= low) & (score <= high))
            if len(at) > 4 * k and x.dtype != object:
                at = at[score[at] >= np.partition(score[at], len(at) - k)[len(at) - k]]
            best = sorted(at.tolist(), key=lambda i: (-score[i], self.ids[i], self.keys[i]))[:k]
            out.append([(i, int(score[i])) for i in best])
        return out


def _searched(k: int, same: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by block, a block's own rows (no windows) before its anchors; those are streamed past the block."""
    held: list[pa.RecordBatch] = []
    block, number = None, None
    for batch in batches:
        place = batch.column(batch.schema.get_field_index("place")).to_numpy()
        for lo, hi in zip(*runs(place), strict=True):
            part = batch.slice(lo, hi - lo)
            at, anchors = divmod(int(place[lo]), 2)
            if at != number:
                held, block, number = [], None, at
            if not anchors:
                held.append(part)
                continue
            if block is None and held:
                rows = pa.Table.from_batches(held).combine_chunks()
                block = Block(*(rows.column(c).to_numpy() for c in ("id", "key", "label")), _matrix(rows.column("embedding").combine_chunks()))
                held = []
            if block is None:
                continue
            col = {c: part.column(part.schema.get_field_index(c)) for c in part.schema.names}
            vectors, found = _matrix(col["embedding"]), []
            for i, (key, own, label, windows) in enumerate(zip(col["key"].to_pylist(), col["id"].to_pylist(), col["label"].to_pylist(), col["windows"].to_pylist(), strict=True)):
                wanted = (block.labels == label) & (block.keys != key) if same else block.labels != label
                for w, best in enumerate(block.search(integers(vectors[i : i + 1])[0], wanted, [(-math.inf if x["low"] is None else x["low"], math.inf if x["high"] is None else x["high"]) for x in windows], k)):
                    found.extend((key, own, w, windows[w]["positive_id"], windows[w]["high"], int(block.ids[j]), max(-_NO_ID - 1, min(_NO_ID, s))) for j, s in best)
            names = [c.split()[0] for c in _HITS.split(", ")]
            types = [pa.int32() if c == "w" else pa.int64() for c in names]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*found) if found else [()] * len(names), types, strict=True)], names=names)


def search(rows: DataFrame, anchors: DataFrame, k: int, same: bool, blocks: int) -> DataFrame:
    """Each anchor's k best rows in each of its windows: of its own label without itself, or of other labels."""
    cols = ["place", "key", "id", "label", "embedding", "windows"]
    held = rows.select((F.pmod("key", F.lit(blocks)) * 2).alias("place"), "key", "id", "label", "embedding", F.lit(None).cast("array<struct<low:bigint,high:bigint,positive_id:bigint>>").alias("windows"))
    asked = anchors.withColumn("place", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn("place", F.col("place").cast("long") * 2 + 1).select(*cols)
    dealt = held.unionByName(asked).withColumn("block", F.shiftright("place", 1)).repartition(max(blocks, spread(rows.sparkSession)), "block").sortWithinPartitions("place").drop("block")
    hits = dealt.mapInArrow(lambda it: _searched(k, same, it), _HITS)
    best = Window.partitionBy("q", "w").orderBy(F.desc("score"), "id")
    return hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def mine(rows: DataFrame, k_positive: int = 5, k_negative: int = 5, low: int = 80, every: int = 100, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) from rows of (vec_id, label, embedding).

    Anchors are rows whose id is divisible by ``every``. Positives: the first ``k_positive`` other rows of the anchor's label. Negatives: the
    first ``k_negative`` rows of other labels with low * positive <= 100 * negative <= 100 * positive. Higher scores come first, ties by
    smaller id. Fewer are returned where there are fewer; anchors without any give no rows.

    Rows with a null label, a null vector, or a null or non-finite component take no part. Rows repeated in full count once. Rows without an
    id are no anchors and come last in ties. Vectors of unequal length are as if filled with zeros. Scores beyond a long are
    its ends. No rows in, no rows out; other columns are ignored.
    """
    usable = "label IS NOT NULL AND embedding IS NOT NULL AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))"
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "embedding").where(usable).dropDuplicates()
    rows = cut(rows.select(F.xxhash64("vec_id", "label", "embedding").alias("key"), F.coalesce("vec_id", F.lit(_NO_ID)).alias("id"), "label", "embedding", (F.coalesce(F.col("vec_id") % every, F.lit(1)) == 0).alias("anchor")))
    blocks = max(spread(rows.sparkSession), math.ceil(rows.count() / block_rows))
    anchors = rows.where("anchor").drop("anchor")
    all_scores = F.array(F.struct(F.lit(None).cast("long").alias("low"), F.lit(None).cast("long").alias("high"), F.lit(None).cast("long").alias("positive_id")))
    positives = search(rows, anchors.withColumn("windows", all_scores), k_positive, True, blocks).where("score >= 0")  # below 0 a window is empty
    window = F.struct(F.expr(f"CAST(-floor(-{low} * CAST(score AS DECIMAL(38, 0)) / 100) AS BIGINT)").alias("low"), F.col("score").alias("high"), F.col("id").alias("positive_id"))
    windows = positives.groupBy(F.col("q").alias("key")).agg(F.sort_array(F.collect_list(window)).alias("windows"))  # k_positive rows each
    found = search(rows, cut(anchors.join(windows, "key")), k_negative, False, blocks)
    id_of = lambda c: F.when(F.col(c) != _NO_ID, F.col(c))
    return found.select("anchor_id", id_of("positive_id").alias("positive_id"), F.col("rank").cast("int").alias("rank"), id_of("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def oracle() -> str:
    """The same in DuckDB's SQL, for ``embeddings`` with the mistakes of :func:`relabelled`: scores are sums of products of whole doubles."""
    return f"""WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS v FROM embeddings
WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score FROM r a JOIN r b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) QUALIFY row_number() OVER w <= 5"""
