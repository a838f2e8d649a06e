"""Benchmark decontamination: a prefix-filtered join of item windows with documents.

An item's windows are its runs of ``WINDOW`` words (or all its words, if fewer). Containment of a window is exact, so a prefix of one
shingle is enough: of the window's runs of ``SHINGLE`` words (or the whole window, if shorter), the one that is rarest over all
documents. Documents are passed twice. The first pass counts the benchmark's shingles; the second picks out the prefixes with
the words around them. Both know the shingles by a bitmap of bounded size: what passes it by chance finds no partner in the join. Windows and
occurrences are joined on the prefix, the prefix's place bounds where the window may start (it must lie inside the document), and
every word of the window is compared. Neither windows nor documents pass through the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, NON_ALNUM, Words, cut, slices, small_batches

WINDOW = 13
SHINGLE = 5
#: Bits of the bitmap for each shingle, and of the largest bitmap (16 MB).
BITS = 16
MOST_BITS = 1 << 27


def _words(texts: pa.Array) -> Words:
    return Words(texts, NON_ALNUM, LOWER)


def _binary(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> pa.Array:
    """The 64-bit values from lo to hi of each row, as bytes."""
    n = hi - lo
    ends = np.cumsum(n)
    at = np.repeat(lo - (ends - n), n) + np.arange(int(n.sum()))
    return pa.Array.from_buffers(pa.large_binary(), len(lo), [None, pa.py_buffer(np.r_[0, 8 * ends].astype(np.int64)), pa.py_buffer(values[at].astype("<u8"))]).cast(pa.binary())


def _item_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item_id, words, size, shingles): the hashes of each window's words, little-endian, and of its shingles in order."""
    for batch in slices(batches, "text"):
        w = _words(batch.column(1))
        ids = batch.column(0)
        item = np.flatnonzero(w.count)
        n = np.maximum(w.count[item] - WINDOW + 1, 1)
        item = np.repeat(item, n)
        lo = w.first[item] + np.arange(len(item)) - np.repeat(np.cumsum(n) - n, n)
        size = np.minimum(w.count[item], WINDOW)
        hashes = {}
        for k in range(1, SHINGLE + 1):
            hashes[k] = np.zeros(len(w.hash) + 1, np.uint64)
            at, h = w.windows(k)
            hashes[k][at] = h
        shingles = [hashes[k][i : i + m - k + 1].view(np.int64).tolist() for i, m, k in zip(lo.tolist(), size.tolist(), np.minimum(size, SHINGLE).tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([ids.take(pa.array(item)), _binary(w.hash, lo, lo + size), pa.array(size.astype(np.int32)), pa.array(shingles, pa.list_(pa.int64()))], names=["item_id", "words", "size", "shingles"])


def _bitmap(shingles: DataFrame) -> np.ndarray:
    """A bitmap with two bits for each of the distinct ``shingle``s: at most MOST_BITS, whatever their number."""
    bits = min(MOST_BITS, 1 << max(12, (BITS * shingles.count()).bit_length()))
    place = F.explode(F.array(F.col("shingle"), F.shiftrightunsigned("shingle", 32))).alias("h")
    word = F.shiftrightunsigned("h", 6).bitwiseAND(F.lit(bits // 64 - 1)).alias("word")
    bit = F.expr("shiftleft(1L, CAST(h & 63 AS INT))").alias("bit")
    found = shingles.select(place).select(word, bit).groupBy("word").agg(F.bit_or("bit").alias("bit")).toArrow()  # MOST_BITS / 64 rows at most
    out = np.zeros(bits // 64, np.uint64)
    out[found.column("word").to_numpy()] = found.column("bit").to_numpy().view(np.uint64)
    return out


def _has(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Places in ``h`` that pass the bitmap."""
    last = np.uint64(64 * len(bits) - 1)
    test = lambda i: (bits[i >> np.uint64(6)] >> (i & np.uint64(63))) & np.uint64(1) > 0
    some = np.flatnonzero(test(h & last))
    return some[test((h[some] >> np.uint64(32)) & last)]


def _count(bits: np.ndarray, sizes: list[int], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(shingle, n): how often each passing shingle occurs in a piece of the input."""
    for batch in slices(batches, "text"):
        w = _words(batch.column(0))
        for k in sizes:
            _, h = w.windows(k)
            u, n = np.unique(h[_has(bits, h)], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(n.astype(np.int64))], names=["shingle", "n"])


def _occurrences(bits: np.ndarray, sizes: list[int], batches: Iterator[pa.RecordBatch], most: int = 50_000) -> Iterator[pa.RecordBatch]:
    """A row for each document (with n_words), and for each passing shingle (with its hash, its place, and the words around it).

    ``context`` has the hashes of the words that a window around the shingle may hold, ``before`` of them before it.
    """
    names = ["doc_id", "key", "n_words", "shingle", "at", "before", "context"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
    for batch in slices(batches, "text"):
        w = _words(batch.column(2))
        ids, keys = batch.column(0), batch.column(1)
        none = [pa.nulls(batch.num_rows, t) for t in types[3:]]
        yield pa.RecordBatch.from_arrays([ids, keys, pa.array(w.count.astype(np.int64)), *none], names=names)
        owner = w.docs()
        for k in sizes:
            place, h = w.windows(k)
            some = _has(bits, h)
            for i in range(0, len(some), most):
                at, own = place[some[i : i + most]], h[some[i : i + most]]
                doc = owner[at]
                lo = np.maximum(w.first[doc], at - (WINDOW - SHINGLE)) if k == SHINGLE else at  # a shorter shingle is its window
                hi = np.minimum(w.first[doc + 1], at + WINDOW) if k == SHINGLE else at + k
                take = pa.array(doc)
                yield pa.RecordBatch.from_arrays([ids.take(take), keys.take(take), pa.nulls(len(at), pa.int64()), pa.array(own.view(np.int64)), pa.array(at - w.first[doc]), pa.array((at - lo).astype(np.int32)), _binary(w.hash, lo, hi)], names=names)


def _covered(spans: str) -> Column:
    """Words in the union of sorted (start, size) spans."""
    step = f"named_struct('end', greatest(a.end, s.start + s.size), 'n', a.n + greatest(0L, s.start + s.size - greatest(a.end, s.start)))"
    return F.expr(f"aggregate({spans}, named_struct('end', 0L, 'n', 0L), (a, s) -> {step}, a -> a.n)")


def overlaps(docs: DataFrame, benchmark: DataFrame, text: str = "text", id_col: str = "doc_id", item_text: str = "text", item_id: str = "item_id") -> DataFrame:
    """(doc_id, n_words, n_hit, items) for every row of ``docs``: words inside any item window, and the items.

    Null and empty texts have no words and no items; items without words have no window; an empty benchmark hits nothing; an
    item without an id hits words and is not listed. Repeated documents each have their row, repeated items count once per
    id. Other columns are ignored. A hot prefix is split by adaptive execution, as a join of two large sides.
    """
    spark = docs.sparkSession
    small_batches(spark)
    items = benchmark.select(F.col(item_id).cast("string").alias("item_id"), F.col(item_text).alias("text"))
    of_item = cut(items.mapInArrow(_item_windows, "item_id string, words binary, size int, shingles array<long>"))
    windows = of_item.groupBy("words").agg(F.first("size").alias("size"), F.first("shingles").alias("shingles"))
    places = cut(windows.select("words", "size", F.posexplode("shingles").alias("place", "shingle")))
    sizes = sorted(r.k for r in places.select(F.least("size", F.lit(SHINGLE)).alias("k")).distinct().collect())  # SHINGLE rows at most
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("key"), F.col(text).alias("text"))

    known = spark.sparkContext.broadcast(_bitmap(places.select("shingle").distinct()))  # MOST_BITS at most
    counts = rows.select("text").mapInArrow(lambda it: _count(known.value, sizes, it), "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    rarest = F.min(F.struct("n", "shingle", "place")).alias("prefix")
    # A window with a shingle that no document holds occurs in none.
    prefixes = places.join(cut(counts), "shingle", "left").groupBy("words", "size").agg(rarest, F.count("n").alias("seen"), F.count("*").alias("all"))
    prefixes = cut(prefixes.where("seen = all").select("words", "size", F.col("prefix.shingle").alias("shingle"), F.col("prefix.place").alias("place")))

    picked = spark.sparkContext.broadcast(_bitmap(prefixes.select("shingle").distinct()))  # MOST_BITS at most
    schema = "doc_id long, key long, n_words long, shingle long, at long, before int, context binary"
    found = cut(rows.select("doc_id", "key", "text").mapInArrow(lambda it: _occurrences(picked.value, sizes, it), schema))
    fits = "o.shingle = p.shingle AND p.place <= o.before AND substring(o.context, 8 * (o.before - p.place) + 1, 8 * p.size) = p.words"
    hits = found.where("shingle IS NOT NULL").alias("o").join(prefixes.alias("p"), F.expr(fits))
    hits = cut(hits.select("doc_id", "key", F.expr("o.at - p.place").alias("start"), F.expr("CAST(p.size AS BIGINT)").alias("size"), "words"))
    spans = hits.groupBy("doc_id", "key").agg(F.array_sort(F.collect_set(F.struct("start", "size"))).alias("spans")).select("doc_id", "key", _covered("spans").alias("n_hit"))
    named = hits.select("doc_id", "key", "words").distinct().join(of_item.select("item_id", "words").distinct(), "words")
    named = named.groupBy("doc_id", "key").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    facts = spans.alias("a").join(named.alias("b"), F.expr("a.key = b.key AND a.doc_id <=> b.doc_id")).select(F.col("a.key").alias("k"), F.col("a.doc_id").alias("d"), "n_hit", "items")
    out = found.where("n_words IS NOT NULL").select("doc_id", "key", "n_words").join(facts, F.expr("key = k AND doc_id <=> d"), "left")
    return out.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def judged(found: DataFrame, share: float = 0.05) -> DataFrame:
    """Contaminated where some word is hit and hit words make up ``share`` of all."""
    per = round(1 / share)
    return found.withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * per >= F.col("n_words")))


def kept_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are not contaminated; rows of one id with several texts go if any of them is."""
    gone = judged(overlaps(docs, benchmark, **options)).where("contaminated").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone.hint("shuffle_hash"), F.expr("doc_id <=> _gone"), "left_anti")


def digest(found: DataFrame) -> DataFrame:
    """The counts, and the SHA-256 of the item ids sorted as strings."""
    joined = F.array_join("items", ",")
    return judged(found).select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(joined, 256).alias("items_sha256"), "contaminated")


def brute(docs: list[tuple[int, str | None]], items: list[tuple[int, str | None]]) -> list[tuple]:
    """The digest by comparing every window with every document; for tests."""
    import re

    low = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(low))
    out = []
    for doc, text in docs:
        w, hit, names = words(text), set(), set()
        for item, body in items:
            x = words(body)
            for i in range(max(1, len(x) - WINDOW + 1) if x else 0):
                run = x[i : i + WINDOW]
                for at in range(len(w) - len(run) + 1):
                    if w[at : at + len(run)] == run:
                        names.add(str(item))
                        hit.update(range(at, at + len(run)))
        joined = ",".join(sorted(names))
        out.append((doc, len(w), len(hit), len(names), hashlib.sha256(joined.encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return out
