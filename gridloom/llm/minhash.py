"""MinHash near-dedup by a chosen-path set similarity join.

Documents become sets of word shingles; texts with one set are one class, and only a class's smallest id goes on. A class has
``HASHES`` minwise tokens. Each of ``TREES`` independent trees branches classes by the tokens at places chosen by seed: first
by ``FIRST`` places at once, then nodes above ``LEAF`` members by ``STEP`` more, into so many branches that a pair at the
threshold is in none of them with a chance of ``MISS`` at most. Nodes that this does not thin out (their branches hold more than
half as many pairs as they do), or that are large after ``DEPTH`` steps, are cut into blocks by hash, and each two blocks are compared. Nodes small enough are compared exhaustively on sketches; pairs whose
estimate could still reach the threshold form candidate groups, whose texts are brought together once and confirmed on full
sets. Groups above ``LEAF`` members are confirmed leaf by leaf, so no task holds a group of unbounded size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, PLACES, SPACES, Words, connected_components, cut, groups_of, mix, ordered_groups, runs, slices, small_batches

HASHES = 128
TREES = 12
FIRST = 3
STEP = 2
LEAF = 1024
DEPTH = 12
#: Chance that a step of a large node parts a pair at the threshold, at most.
MISS = 0.005
#: A sketch estimate may fall this far below the threshold: 4.7 standard deviations at 0.85 with 128 hashes, 4.2 at 0.8.
SLACK = 0.15

_RNG = np.random.default_rng(7)
_A = _RNG.integers(1, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RNG.integers(0, 2**63, HASHES, dtype=np.uint64)


def shingles(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(bounds, hashes): document d's distinct shingles are ``hashes[bounds[d]:bounds[d+1]]``, in ascending order."""
    w = Words(texts, SPACES, LOWER)
    at, h = w.windows(k)
    doc = w.docs()[at]
    few = np.flatnonzero((w.count > 0) & (w.count < k))
    whole = np.zeros(len(few), np.uint64)
    for i, d in enumerate(few):
        own = w.hash[w.first[d] : w.first[d + 1]]
        whole[i] = (own * PLACES[: len(own)]).sum() + np.uint64(len(own))
    doc, h = np.concatenate([doc, few]), np.concatenate([h, mix(whole)])
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.r_[True, (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])] if len(h) else np.zeros(0, bool)
    doc, h = doc[new], h[new]
    return np.searchsorted(doc, np.arange(len(w.count) + 1)), h


def _signatures(k: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        bounds, h = shingles(batch.column(1), k)
        n = np.diff(bounds)
        some = np.flatnonzero(n)
        sig = np.zeros((len(some), HASHES), np.uint32)
        digest = np.zeros((len(some), 2), np.uint64)
        if len(some):
            starts = bounds[some]
            for i in range(HASHES):
                sig[:, i] = np.minimum.reduceat(((h * _A[i] + _B[i]) >> np.uint64(32)).astype(np.uint32), starts)
            digest[:, 0] = np.add.reduceat(mix(h), starts)
            digest[:, 1] = np.add.reduceat(mix(h ^ _B[0]), starts)
        put = lambda rows: pa.array([None if j < 0 else rows[j].tobytes() for j in where.tolist()], pa.binary())
        where = np.full(batch.num_rows, -1)
        where[some] = np.arange(len(some))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n.astype(np.int64)), put(digest), put(sig), put((sig & np.uint32(255)).astype(np.uint8))], names=["doc_id", "n_shingles", "digest", "sig", "sketch"])


def _token(place: int) -> Column:
    """The four bytes of a minwise token."""
    return F.substring("sig", place * 4 + 1, 4)


def _roots(classes: DataFrame, trees: int) -> DataFrame:
    """(node, doc_id) of every class in every tree."""
    rng = np.random.default_rng(11)
    nodes = [F.xxhash64(F.lit(t), *(_token(int(c)) for c in rng.choice(HASHES, FIRST, replace=False))) for t in range(trees)]
    return classes.select("doc_id", F.explode(F.array(*nodes)).alias("node"))


def _grown(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(small, large) members of nodes with company: up to LEAF, and above."""
    sizes = members.groupBy("node").agg(F.count("*").alias("size")).where("size > 1")
    both = cut(members.join(sizes, "node"))
    return both.where(f"size <= {LEAF}").select("node", "doc_id"), both.where(f"size > {LEAF}").select("node", "doc_id")


def _branched(large: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """(parent, node, doc_id): the next level of large nodes, in as many branches as ``MISS`` asks for."""
    lost = 1 - threshold**STEP
    branches = max(1, math.ceil(math.log(MISS) / math.log(lost))) if lost > 0 else 1
    at = large.join(classes.select("doc_id", "sig"), "doc_id").withColumn("branch", F.explode(F.expr(f"sequence(0, {branches - 1})")))
    parts = []
    for i in range(STEP):
        parts.append(F.expr(f"substring(sig, CAST(pmod(xxhash64(node, branch, {i}), {HASHES}) AS INT) * 4 + 1, 4)"))
    return at.select(F.col("node").alias("parent"), F.xxhash64("node", "branch", *parts).alias("node"), "doc_id")


def _thinned(large: DataFrame, branched: DataFrame) -> DataFrame:
    """(parent) of the large nodes whose branches hold at most half as many pairs as they do."""
    own = large.groupBy("node").agg(F.count("*").cast("double").alias("size")).withColumnRenamed("node", "parent")
    theirs = branched.groupBy("parent", "node").agg(F.count("*").cast("double").alias("n")).groupBy("parent").agg(F.sum(F.col("n") * F.col("n")).alias("pairs"))
    return own.join(theirs, "parent").where("2 * pairs <= size * size").select("parent")


def _blocked(large: DataFrame) -> DataFrame:
    """A node for each two blocks of a large node, about LEAF members: any two members are in one of them."""
    sizes = large.groupBy("node").agg(F.count("*").alias("size"))
    at = large.join(sizes, "node").withColumn("parts", F.ceil(F.col("size") / (LEAF // 2)).cast("int"))
    at = at.withColumn("mine", F.pmod(F.xxhash64("doc_id", "node"), F.col("parts")).cast("int")).withColumn("other", F.explode(F.expr("sequence(0, parts - 1)")))
    return at.where("mine <> other").select(F.xxhash64("node", F.least("mine", "other"), F.greatest("mine", "other")).alias("node"), "doc_id")


def leaves(classes: DataFrame, threshold: float, trees: int = TREES) -> DataFrame:
    """(node, doc_id): the small nodes of all trees. The loop runs once a level, on members of large nodes only."""
    small, large = _grown(_roots(classes, trees))
    found = [small]
    for _ in range(DEPTH):
        if large.isEmpty():
            return _union(found)
        branched = cut(_branched(large, classes, threshold))
        thinned = cut(_thinned(large, branched))
        found.append(cut(_blocked(large.join(thinned.withColumnRenamed("parent", "node"), "node", "left_anti"))))
        small, large = _grown(branched.join(thinned, "parent", "left_semi").select("node", "doc_id"))
        found.append(small)
    return _union([*found, cut(_blocked(large))])


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _forest(link: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of a symmetric boolean matrix: each node to the first seen of its component."""
    left, edges = np.ones(len(link), bool), []
    for root in range(len(link)):
        if not left[root]:
            continue
        left[root] = False
        reach = link[root] & left
        while reach.any():
            new = np.flatnonzero(reach)
            edges += [(root, int(j)) for j in new]
            left[new] = False
            reach = link[new].any(0) & left
    return edges


def _candidates(least: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spanning edges of each leaf's pairs whose sketches agree on a share of ``least``."""
    for group in groups_of(batches, "node"):
        node, ids = group.column("node").to_numpy(), group.column("doc_id").to_numpy()
        sketch = np.frombuffer(b"".join(group.column("sketch").to_pylist()), np.uint8).reshape(-1, HASHES)
        a, b = [], []
        lo, hi = runs(node)
        pairs = lo[hi - lo == 2]
        ok = pairs[(sketch[pairs] == sketch[pairs + 1]).mean(1) >= least]
        a.append(ids[ok])
        b.append(ids[ok + 1])
        for i, j in zip(lo[hi - lo > 2], hi[hi - lo > 2], strict=True):
            s = sketch[i:j]
            for x, y in _forest(np.stack([(s == r).sum(1) for r in s]) >= least * HASHES):
                a.append(ids[i + x : i + x + 1])
                b.append(ids[i + y : i + y + 1])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])


def confirmed(sets: list[np.ndarray], threshold: float) -> list[tuple[int, int]]:
    """Spanning edges of the pairs whose sets reach the Jaccard threshold: 100 * shared >= percent * union, in whole numbers."""
    percent, n = round(100 * threshold), np.array([len(s) for s in sets], np.int64)
    if len(sets) == 2:
        shared = np.array([[n[0], c := len(np.intersect1d(*sets, assume_unique=True))], [c, n[1]]], np.int64)
    else:
        shared = np.zeros((len(sets), len(sets)), np.int64)
        _, at = np.unique(np.concatenate(sets), return_inverse=True)
        row = np.repeat(np.arange(len(sets)), n)
        count = np.bincount(at)
        many = count[at] > 1  # a shingle of one set is shared by none
        at, row = at[many], row[many]
        _, at = np.unique(at, return_inverse=True)
        order = np.argsort(at, kind="stable")
        at, row = at[order], row[order]
        width = max(1, 4_000_000 // len(sets))
        for lo in range(0, int(at[-1]) + 1 if len(at) else 0, width):
            i, j = np.searchsorted(at, [lo, lo + width])
            m = np.zeros((len(sets), min(width, int(at[-1]) + 1 - lo)), np.float32)
            m[row[i:j], at[i:j] - lo] = 1
            shared += np.rint(m @ m.T).astype(np.int64)
        shared[np.diag_indices(len(sets))] = n
    union = n[:, None] + n[None, :] - shared
    return _forest((100 * shared >= percent * union) & (n[:, None] > 0) & (n[None, :] > 0))


def _confirm(k: int, threshold: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in groups_of(batches, "place"):
        lo, hi = runs(table.column("place").to_numpy())
        ids, texts = table.column("doc_id").to_numpy(), table.column("text")
        size = pc.fill_null(pc.binary_length(texts), 0).to_numpy()
        a, b = [], []
        start = 0
        while start < len(lo):  # whole groups together, up to some MB of text
            stop, total = start, 0
            while stop < len(lo) and (stop == start or total + size[lo[stop] : hi[stop]].sum() < 4 << 20):
                total += size[lo[stop] : hi[stop]].sum()
                stop += 1
            base = int(lo[start])
            bounds, h = shingles(texts.slice(base, int(hi[stop - 1]) - base).combine_chunks(), k)
            for g in range(start, stop):
                sets = [h[bounds[d - base] : bounds[d - base + 1]] for d in range(int(lo[g]), int(hi[g]))]
                for x, y in confirmed(sets, threshold) if len(sets) > 1 else ():
                    a.append(ids[lo[g] + x])
                    b.append(ids[lo[g] + y])
            start = stop
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def near_duplicates(docs: DataFrame, k: int = 5, threshold: float = 0.8, trees: int = TREES, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``.

    Texts with fewer than ``k`` words are one shingle, the whole sequence; null, empty and wordless texts have none and link
    with nothing. Rows of one id are one document; rows without an id link with nothing. Ties do not arise: the smallest id of a
    component is kept. No rows, no rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    signed = cut(named.mapInArrow(lambda it: _signatures(k, it), "doc_id long, n_shingles long, digest binary, sig binary, sketch binary").withColumn("digest", F.when(F.col("doc_id").isNotNull(), F.col("digest"))))
    firsts = cut(signed.where("digest IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("first")))
    classes = cut(signed.join(firsts.withColumnRenamed("digest", "d"), F.expr("digest = d AND doc_id = first"), "left_semi").select("doc_id", "sig", "sketch"))
    leaf = cut(leaves(classes, threshold, trees))
    least = threshold - SLACK
    sketched = ordered_groups(leaf.join(classes.select("doc_id", "sketch"), "doc_id").select("node", "doc_id", "sketch"), "node")
    pairs = cut(sketched.mapInArrow(lambda it: _candidates(least, it), "a long, b long").where("a != b").distinct())
    groups = cut(connected_components(pairs))
    sizes = groups.groupBy("component").agg(F.count("*").alias("size"))
    sized = cut(groups.join(sizes, "component").select(F.col("node").alias("doc_id"), F.col("component"), "size"))
    small = sized.where(f"size <= {LEAF}").select("doc_id", F.xxhash64("component", F.lit("group")).alias("place"))
    large = sized.where(f"size > {LEAF}").select("doc_id", "component").join(leaf, "doc_id").select("doc_id", F.xxhash64("node", "component").alias("place"))
    places = small.unionByName(large.distinct())
    # Only classes in candidate groups have places; the short side is hashed, so texts are exchanged once and not sorted here.
    texts = named.join(places.withColumnRenamed("doc_id", "_id").hint("shuffle_hash"), F.expr("doc_id = _id")).select("place", "doc_id", "text")
    links = ordered_groups(texts, "place").mapInArrow(lambda it: _confirm(k, threshold, it), "a long, b long").where("a != b").distinct()
    parts = connected_components(links).withColumnRenamed("node", "first")
    firsts = firsts.join(parts, "first", "left").select(F.col("digest").alias("d"), F.coalesce("component", "first").alias("component"))
    out = signed.select("doc_id", "n_shingles", "digest").join(firsts, F.expr("digest = d"), "left")
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def kept_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its component."""
    keep = near_duplicates(docs, **options).where("kept").select(F.col("doc_id").alias("_keep")).distinct()
    return docs.join(keep.hint("shuffle_hash"), F.expr("doc_id <=> _keep"), "left_semi")


def brute(docs: list[tuple[int, str | None]], k: int, threshold: float) -> dict[int, tuple[int, int]]:
    """{id: (set size, component)} by comparing all pairs; for tests."""
    import re

    low = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
    sets = {}
    for i, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(low))
        sets[i] = {tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()
    comp = {i: i for i in sets}

    def root(i: int) -> int:
        while comp[i] != i:
            i = comp[i]
        return i

    ids = sorted(sets)
    for x, i in enumerate(ids):
        for j in ids[x + 1 :]:
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= round(100 * threshold) * len(sets[i] | sets[j]):
                p, q = sorted((root(i), root(j)))
                comp[q] = p
    return {i: (len(s), root(i)) for i, s in sets.items()}
