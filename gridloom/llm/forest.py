"""Embedding near-dedup by a forest of random-projection trees with spill.

Equal vectors are one class with a weight. Each tree splits a node by a random projection; members within the spill band
round the cut go both ways. Planes are fitted on a bounded sample (``SAMPLE`` vectors, and again as many for each node that
is still too large, until none is), and every class is sent down every tree. A node whose sample is dense (a share ``DENSE`` of
its pairs is near) is not split, as a large part of its pairs links.

Trees are planted until they find all but a share ``MISS`` of pairs at the threshold, as tried on the sample and a copy of it
that is turned by just that angle; where nodes are to be fitted again, the chance of a tree is taken to fall alike with each
further split. A narrow band and more trees cost fewer copies of a vector than a wide band and few trees, and the number of
trees follows the logarithm of the input.

Leaves are compared exhaustively in double precision, those above two leaves' members in pairs of blocks, so no task holds more
than two blocks. A pair that shares several leaves is counted in the one with the smallest number only, so links are counted
without listing pairs; for components, leaves give spanning edges.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, cut, groups_of, mix, ordered_groups, runs
from .minhash import _forest

#: Chance that all trees part a pair at the threshold, at most.
MISS = 0.01
#: Where more trees than this would be needed, all pairs are compared, block by block.
MOST_TREES = 64
LEAF = 512
SAMPLE = 8192
SPILL = 0.05
#: Half of the spill band's width, in standard deviations of what a pair at the threshold spreads under a projection.
BAND = 0.25
TRIES = 8
#: A node is dense where this share of its sample's pairs has a cosine of NEAR or more.
DENSE = 0.25
NEAR = 0.8


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, vec): components as little-endian doubles; null where the vector links with nothing."""
    for batch in batches:
        col = batch.column(1)
        values = np.asarray(col.values.cast(pa.float64()).to_numpy(zero_copy_only=False), np.float64)
        offsets, valid = col.offsets.to_numpy(), col.is_valid().to_numpy(zero_copy_only=False)
        out = []
        for i in range(batch.num_rows):
            v = values[offsets[i] : offsets[i + 1]] if valid[i] else values[:0]
            top = np.abs(v).max() if len(v) else 0.0
            out.append(v.tobytes() if np.isfinite(top) and top > 0 else None)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["vec_id", "vec"])


def units(vecs: list[bytes]) -> np.ndarray:
    """Rows of length one; scaled first, so that very large and very small components survive."""
    x = np.frombuffer(b"".join(vecs), np.float64).reshape(len(vecs), -1)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def fit(x: np.ndarray, total: float, seed: list[int], leaf: int, threshold: float = 0.9) -> list[tuple]:
    """A tree over a sample of ``total`` members: (direction, low, high, left, right), or (None, dense, ...) for a leaf.

    Of ``TRIES`` random directions and the cuts between their quartiles, a node takes the one whose spill band holds fewest
    members, so that groups are rarely cut.
    """
    rng, nodes, todo = np.random.default_rng(seed), [None], [(0, np.arange(len(x)))]
    scale = total / max(len(x), 1)
    half = BAND * np.sqrt(2 * (1 - threshold) / max(x.shape[1], 1))
    while todo:
        at, rows = todo.pop()
        few = x[rows[:: max(1, len(rows) // 256)]]
        dense = len(rows) > 1 and float((few @ few.T >= NEAR).mean()) >= DENSE
        if dense or len(rows) * scale <= leaf or len(rows) <= 16:
            nodes[at] = (None, dense, 0.0, 0, 0)
            continue
        ways = rng.standard_normal((TRIES, x.shape[1]))
        ways /= np.linalg.norm(ways, axis=1, keepdims=True)
        best = (2.0, 0.0, 0.0, ways[0])
        for way in ways:
            p = np.sort(x[rows] @ way)
            cuts = np.quantile(p, np.linspace(0.25, 0.75, 21))
            held = (np.searchsorted(p, cuts + half, "right") - np.searchsorted(p, cuts - half, "left")) / len(p)
            i = int(np.argmin(held))
            best = min(best, (float(held[i]), float(cuts[i] - half), float(cuts[i] + half), way), key=lambda b: b[0])
        held, low, high, way = best
        p = x[rows] @ way
        if held > 0.3:  # the band would hold too much: spill by quantiles
            low, high = (float(q) for q in np.quantile(p, [0.5 - SPILL, 0.5 + SPILL]))
        if (p <= high).all() or (p >= low).all():  # ties: nothing to split by this plane
            nodes[at] = (None, True, 0.0, 0, 0)
            continue
        nodes[at] = (way, low, high, len(nodes), len(nodes) + 1)
        nodes += [None, None]
        todo += [(nodes[at][3], rows[p <= high]), (nodes[at][4], rows[p >= low])]
    return nodes


def send(nodes: list[tuple], x: np.ndarray) -> Iterator[tuple[int, bool, np.ndarray]]:
    """(leaf, dense, rows) for the rows of ``x`` that reach each leaf."""
    todo = [(0, np.arange(len(x)))]
    while todo:
        at, rows = todo.pop()
        way, low, high, left, right = nodes[at]
        if not len(rows):
            continue
        if way is None:
            yield at, bool(low), rows
            continue
        p = x[rows] @ way
        todo += [(left, rows[p <= high]), (right, rows[p >= low])]


def plant(x: np.ndarray, total: float, leaf: int, threshold: float, miss: float = MISS, seed: int = 0) -> list[list[tuple]]:
    """Trees over a sample of ``total`` members, as many as ``miss`` asks for; if ``MOST_TREES`` do not do, one that holds all in a leaf."""
    u = np.random.default_rng([seed, 3]).standard_normal(x.shape)
    u -= (u * x).sum(1, keepdims=True) * x
    length = np.linalg.norm(u, axis=1, keepdims=True)
    y = threshold * x + math.sqrt(max(0.0, 1 - threshold**2)) * u / np.where(length > 0, length, 1)
    trees: list[list[tuple]] = []
    met = np.zeros(len(x), np.int64)
    while len(trees) < MOST_TREES:
        tree = fit(x, total, [len(trees), seed], leaf, threshold)
        trees.append(tree)
        both = np.zeros(len(x), bool)
        mine = [(at, rows) for at, _, rows in send(tree, x)]
        theirs = {at: rows for at, _, rows in send(tree, y)}
        for at, rows in mine:
            both[np.intersect1d(rows, theirs.get(at, rows[:0]), assume_unique=True)] = True
        met += both
        top = max(1.0, math.log2(max(2, sum(n[0] is None for n in tree))))
        further = max(1.0, math.log2(max(2.0, total / leaf)) / top)  # splits in all, for each split of this tree
        chance = float(met.mean() / len(trees)) ** further
        enough = 1 if chance >= 1 else math.ceil(math.log(miss) / math.log(1 - chance)) if chance > 0 else MOST_TREES
        if float((met > 0).mean()) >= 1 - miss and len(trees) >= enough:
            return trees
    return [[(None, True, 0.0, 0, 0)]]  # one dense leaf


def _number(*parts: int | np.ndarray) -> np.ndarray:
    """A number for a leaf from its tree or parent node and its place in it."""
    h = np.zeros(1, np.uint64)
    for p in parts:
        h = mix(h + np.asarray(p).astype(np.int64).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    return h.view(np.int64)


def _sent(trees: dict[int, list[list[tuple]]], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(class, node, dense) down the trees of the vectors' dimension."""
    for batch in batches:
        if not batch.num_rows:
            continue
        vecs = batch.column(1).to_pylist()
        sizes = np.array([len(v) for v in vecs])
        cls = batch.column(0).to_numpy()
        out = []
        for size in np.unique(sizes):
            rows = np.flatnonzero(sizes == size)
            x = units([vecs[i] for i in rows])
            for t, nodes in enumerate(trees[int(size)]):
                out += [(cls[rows[got]], _number(int(size), t, leaf)[0], dense) for leaf, dense, got in send(nodes, x)]
        yield _rows(out)


def _rows(out: list[tuple]) -> pa.RecordBatch:
    n = [len(c) for c, _, _ in out]
    cols = [pa.array(np.concatenate([c for c, _, _ in out]) if out else np.zeros(0, np.int64)), pa.array(np.repeat([i for _, i, _ in out], n).astype(np.int64)), pa.array(np.repeat([d for _, _, d in out], n).astype(bool))]
    return pa.RecordBatch.from_arrays(cols, names=["class", "node", "dense"])


def _refit(leaf: int, threshold: float, pdf: pd.DataFrame) -> pd.DataFrame:
    node = int(pdf["node"].iloc[0])
    return pd.DataFrame({"node": [node], "model": [pickle.dumps(fit(units(pdf["vec"].tolist()), float(pdf["size"].iloc[0]), [node & 0xFFFFFFFF], leaf, threshold))]})


def _resent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in groups_of(batches, "node"):
        node, cls, vecs = table.column("node").to_numpy(), table.column("class").to_numpy(), table.column("vec")
        out = []
        for lo, hi in zip(*runs(node), strict=True):
            x = units(vecs.slice(lo, hi - lo).to_pylist())
            out += [(cls[lo:hi][got], _number(int(node[lo]), at)[0], dense) for at, dense, got in send(pickle.loads(table.column("model")[lo].as_py()), x)]
        yield _rows(out)


def leaves(classes: DataFrame, threshold: float, leaf: int = LEAF, sample: int = SAMPLE) -> DataFrame:
    """(node, class) of every class in the leaves of all trees; nodes above four leaves' size are fitted and split again."""
    schema, spark = "class long, node long, dense boolean", classes.sparkSession
    dims = {r.size: r.n for r in classes.groupBy(F.octet_length("vec").alias("size")).agg(F.count("*").alias("n")).collect()}
    forest: dict[int, list[list[tuple]]] = {}
    for size, n in dims.items():
        few = classes.where(F.octet_length("vec") == size).select("class", "vec").orderBy(F.xxhash64("class")).limit(sample).collect()  # at most SAMPLE vectors
        x = units([bytes(r.vec) for r in few])
        forest[size] = plant(x, float(n), leaf, threshold, seed=size)
    sent = spark.sparkContext.broadcast(forest)  # at most MOST_TREES * SAMPLE / 8 planes a dimension
    now = cut(classes.select("class", "vec").mapInArrow(lambda it: _sent(sent.value, it), schema))
    done = []
    while True:
        sizes = now.where("NOT dense").groupBy("node").agg(F.count("*").alias("size")).where(f"size > {4 * leaf}")
        big = cut(sizes)
        if big.isEmpty():
            return _all([*done, now.select("node", "class")])
        done.append(now.join(big, "node", "left_anti").select("node", "class"))
        members = now.where("NOT dense").join(big, "node").join(classes.select("class", "vec"), "class")
        picked = members.where(F.pmod(F.xxhash64("node", "class"), F.lit(1 << 30)) < F.lit(float(sample) * (1 << 30)) / F.col("size"))
        models = picked.select("node", "size", "vec").groupBy("node").applyInPandas(lambda pdf: _refit(leaf, threshold, pdf), "node long, model binary")
        with_model = members.select("node", "class", "vec").join(cut(models), "node")
        now = cut(with_model.sortWithinPartitions("node").mapInArrow(_resent, schema))


def _all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _links(least: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, n): with b null, that class a has n more links; else a spanning edge."""
    for table in groups_of(batches, "place"):
        place, node, cls = (table.column(c).to_numpy() for c in ("place", "node", "class"))
        side, weight, shared = table.column("side").to_numpy(), table.column("weight").to_numpy(), table.column("nodes")
        a, b, n = [], [], []
        for lo, hi in zip(*runs(place), strict=True):
            if hi - lo < 2:
                continue
            x = units(table.column("vec").slice(lo, hi - lo).to_pylist())
            link = x @ x.T >= least
            np.fill_diagonal(link, False)
            s = side[lo:hi]
            if (s >= 0).all() and s.min() != s.max():
                link &= s[:, None] != s[None, :]  # two blocks: pairs within one are another place's
            if not link.any():
                continue
            rows = np.flatnonzero(link.any(1))
            link = link[np.ix_(rows, rows)]
            lists = [np.asarray(shared[lo + int(r)].as_py(), np.int64) for r in rows]
            lists = [v[v < node[lo]] for v in lists]
            flat = np.concatenate(lists)
            if len(flat):
                _, at = np.unique(flat, return_inverse=True)
                m = np.zeros((len(rows), int(at.max()) + 1), np.float32)
                m[np.repeat(np.arange(len(rows)), [len(v) for v in lists]), at] = 1
                earlier = m @ m.T > 0
            else:
                earlier = np.zeros_like(link)
            c, w = cls[lo:hi][rows], weight[lo:hi][rows]
            own = (link & ~earlier) @ w
            some = np.flatnonzero(own)
            a += c[some].tolist()
            b += [None] * len(some)
            n += own[some].tolist()
            for i, j in _forest(link):
                a.append(int(c[i]))
                b.append(int(c[j]))
                n.append(0)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(n, pa.int64())], names=["a", "b", "n"])


def _places(at: DataFrame, leaf: int) -> DataFrame:
    """(place, side, node, class): a leaf is one place; a larger one is a place for each block and each pair of blocks."""
    sizes = at.groupBy("node").agg(F.count("*").alias("size")).where("size > 1")
    at = at.join(sizes, "node").withColumn("parts", F.ceil(F.col("size") / (2 * leaf)).cast("int"))
    at = at.withColumn("mine", F.pmod(F.xxhash64("class", "node"), F.col("parts")).cast("int"))
    at = at.withColumn("other", F.explode(F.expr("sequence(0, parts - 1)")))
    lo, hi = F.least("mine", "other"), F.greatest("mine", "other")
    return at.select(F.when(F.col("parts") == 1, F.col("node")).otherwise(F.xxhash64("node", lo, hi)).alias("place"), F.when(lo == hi, F.lit(-1)).otherwise(F.col("mine")).alias("side"), "node", "class")


def near_duplicates(vectors: DataFrame, threshold: float = 0.9, leaf: int = LEAF, sample: int = SAMPLE, vec: str = "embedding", id_col: str = "vec_id") -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors``.

    Null, empty and zero vectors, and those that hold null or non-finite components, link with nothing; vectors of different
    dimensions do not link. ``n_links`` counts other rows, copies included. No rows, no rows; other columns are ignored.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.when(F.exists(vec, lambda v: v.isNull()), F.lit(None)).otherwise(F.col(vec)).alias("v"))
    rows = cut(rows.mapInArrow(_vectors, "vec_id long, vec binary").withColumn("key", F.unhex(F.md5("vec"))))
    keys = cut(rows.where("vec IS NOT NULL").groupBy("key").agg(F.min("vec_id").alias("class"), F.count("*").alias("weight")))
    firsts = keys.withColumnRenamed("key", "k")
    classes = cut(rows.join(firsts, F.expr("key = k AND vec_id = class")).select("class", "weight", "vec").dropDuplicates(["class"]))
    at = cut(leaves(classes, threshold, leaf, sample))
    nodes = at.groupBy("class").agg(F.collect_set("node").alias("nodes"))
    full = _places(at, leaf).join(classes, "class").join(nodes, "class")
    found = cut(ordered_groups(full, "place").mapInArrow(lambda it: _links(threshold, it), "a long, b long, n long"))
    counts = found.where("b IS NULL").groupBy(F.col("a").alias("class")).agg(F.sum("n").alias("n"))
    parts = connected_components(found.where("b IS NOT NULL").select("a", "b")).withColumnRenamed("node", "class")
    facts = keys.join(counts, "class", "left").join(parts, "class", "left")
    facts = facts.select(F.col("key").alias("k"), (F.col("weight") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("component", "class").alias("component"))
    out = rows.select("vec_id", "key").join(facts, F.expr("key = k"), "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))


def brute(vectors: list[tuple[int, list[float] | None]], threshold: float = 0.9) -> dict[int, tuple[int, int]]:
    """{id: (links, component)} over all pairs; for tests."""
    ok = {i: np.array(v, float) for i, v in vectors if v is not None and len(v) and all(c is not None and np.isfinite(c) for c in v) and any(v)}
    comp, links, ids = {i: i for i, _ in vectors}, {i: 0 for i, _ in vectors}, sorted(ok)

    def root(i: int) -> int:
        while comp[i] != i:
            i = comp[i]
        return i

    for x, i in enumerate(ids):
        for j in ids[x + 1 :]:
            if len(ok[i]) == len(ok[j]) and ok[i] @ ok[j] / np.linalg.norm(ok[i]) / np.linalg.norm(ok[j]) >= threshold:
                links[i] += 1
                links[j] += 1
                p, q = sorted((root(i), root(j)))
                comp[q] = p
    return {i: (links[i], root(i)) for i in links}
