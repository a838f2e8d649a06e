"""Substring dedup with a compressed FM-index per shard.

A window is ``WINDOW`` consecutive words. Only windows that could occur in two documents are indexed: a window is known by its
smallest ``GRAM``-word gram (leftmost of equals), and grams that one document alone selects are left out. Consecutive windows with
one gram make a segment; equal segments are one, with the smallest id that holds it. Segments are dealt to shards by gram, so
equal windows meet in a shard and each shard's size follows the number of shards, not the input. Segments of a gram that too
many segments share are dealt by single windows instead.

A shard sorts its segments' suffixes and keeps their Burrows-Wheeler transform in a wavelet matrix of packed bits, with the
smallest id of any interval of suffixes beside it. Its segments are streamed through backward search, which takes their matching
statistics: for each word, how far back a match that ends there reaches in documents of a smaller id than the segment's first
holder. Stretches where it reaches ``WINDOW`` words are reported as intervals; that document loses their words, and every later
holder loses the segment.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import PLACES, SPACES, Words, cut, groups_of, mix, ordered_groups, runs, slices, small_batches, spread

WINDOW = 13
GRAM = 7
#: Segments in a shard, about; and of one gram, before it is dealt by windows.
SHARD = 20_000
HOT = 2_000
#: Parts that the holders of a window of such a gram are merged in; its index tells the smallest of them.
PARTS = 4
#: Bytes of text for each bucket of grams, at most; a bucket is sorted in a task's memory.
BUCKET = 16 << 20
_CODEC = "zstd"


def _selected(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window start, gram, gram's place) of every window of the documents of ``w``, in order."""
    at, _ = w.windows(WINDOW)
    grams = np.zeros(len(w.hash), np.uint64)
    where, h = w.windows(GRAM)
    grams[where] = h
    best, place = grams[at], at.copy()
    for j in range(1, WINDOW - GRAM + 1):
        less = grams[at + j] < best
        best = np.where(less, grams[at + j], best)
        place = np.where(less, at + j, place)
    return at, best, place


def _message(bucket: int, gram: np.ndarray, row: np.ndarray) -> tuple[int, bytes, bytes, bytes]:
    """Upper halves of grams by row, and how many each row has: the bucket tells most of the lower half."""
    order = np.argsort(row, kind="stable")
    gram, row = gram[order], row[order]
    lo, hi = runs(row)
    return bucket, (gram >> np.uint64(32)).astype(np.uint32).tobytes(), row[lo].tobytes(), (hi - lo).astype(np.uint32).tobytes()


def _prints(buckets: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, grams, rows, counts): what each piece of the input asks of each bucket of grams.

    Buckets below 0 need no answer: grams that several rows of the piece select. Elsewhere a gram stands for one row (its id), or
    for several (id 0), so a gram that all documents hold is asked once a piece.
    """
    for batch in slices(batches, "text"):
        w = Words(batch.column(1), SPACES)
        at, gram, _ = _selected(w)
        doc = w.docs()[at] if len(at) else at
        ids = batch.column(0).to_numpy()
        order = np.lexsort((doc, gram))
        gram, doc = gram[order], doc[order]
        new = np.r_[True, (gram[1:] != gram[:-1]) | (doc[1:] != doc[:-1])] if len(gram) else np.zeros(0, bool)
        gram, doc = gram[new], doc[new]
        lo, hi = runs(gram)
        alone = hi - lo == 1
        several = np.repeat(~alone, hi - lo)
        out = [_message(-1, gram[several], ids[doc[several]])] if several.any() else []
        asked, row = gram[lo], np.where(alone, ids[doc[lo]], 0)
        bucket = (asked % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        asked, row, bucket = asked[order], row[order], bucket[order]
        out += [_message(int(bucket[i]), asked[i:j], row[i:j]) for i, j in zip(*runs(bucket), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), *(pa.array([o[i] for o in out], pa.binary()) for i in (1, 2, 3))], names=["bucket", "grams", "rows", "counts"])


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, gram) of grams that several rows select, each by its upper half. Two grams of one bucket and upper half pass for one: more
    segments are then held, and none is lost."""
    for table in groups_of(batches, "bucket"):
        for lo, hi in zip(*runs(table.column("bucket").to_numpy()), strict=True):
            part = table.slice(lo, hi - lo)
            joined = lambda c, t: np.frombuffer(b"".join(part.column(c).to_pylist()), t)  # noqa: B023, E731
            gram, row = joined("grams", np.uint32), np.repeat(joined("rows", np.int64), joined("counts", np.uint32))
            if part.column("bucket")[0].as_py() >= 0:
                order = np.argsort(gram, kind="stable")
                gram, row = gram[order], row[order]
                a, b = runs(gram)
                several = np.repeat(b - a > 1, b - a) & (row != 0)
                gram, row = gram[several], row[several]
            for i in range(0, len(gram), 1 << 18):
                yield pa.RecordBatch.from_arrays([pa.array(row[i : i + (1 << 18)]), pa.array(gram[i : i + (1 << 18)].view(np.int32))], names=["row", "gram"])


def _digests(w: Words, keep: np.ndarray) -> list[str]:
    """SHA-256 of each document's words in ``keep``, joined by one space."""
    start, end, doc = w.start[keep], w.end[keep], w.docs()[keep]
    data, n = w.bytes.copy(), len(w.bytes)
    edge = np.zeros(n + 1, np.int8)
    edge[start] += 1
    edge[end] -= 1
    taken = np.cumsum(edge, dtype=np.int8)[:n].astype(bool)
    between = end[:-1][doc[1:] == doc[:-1]]
    data[between], taken[between] = 0x20, True
    flat = data[taken].tobytes()
    at = np.concatenate([[0], np.cumsum(taken)])[w.bounds].tolist()
    return [hashlib.sha256(flat[a:b]).hexdigest() for a, b in zip(at[:-1], at[1:], strict=True)]


def _lists(offsets: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values))


def _sorted_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents without repeated grams are done; the others keep their text, packed, and the segments whose gram is repeated.

    ``sha`` is null where there are such grams. Of a segment: its first word's place in the document, its words, its gram, and a hash of
    its words, which tells it from others of its gram.
    """
    for batch in slices(batches, "text"):
        texts, lists = batch.column(2), batch.column(3)
        w = Words(texts, SPACES)
        data = w.bytes.tobytes()
        busy = lists.is_valid().to_numpy(zero_copy_only=False)
        doc_of = w.docs()
        digests = _digests(w, ~busy[doc_of])
        raw = [data[w.bounds[d] : w.bounds[d + 1]] for d in range(batch.num_rows)]
        packed = [pa.compress(r, codec=_CODEC, asbytes=True) if some else None for r, some in zip(raw, busy.tolist(), strict=True)]
        at, gram, place = _selected(w)
        lo, hi = runs(place)
        start, gram, size = at[lo], gram[lo], hi - lo + WINDOW - 1
        doc = doc_of[start]
        offsets = lists.offsets.to_numpy()
        flat = lists.values.to_numpy()[offsets[0] : offsets[-1]].view(np.uint32).astype(np.uint64)
        owner = np.repeat(np.arange(batch.num_rows, dtype=np.uint64), np.diff(offsets))
        most = np.uint64(32)
        ok = np.isin(doc.astype(np.uint64) << most | gram >> most, owner << most | flat)
        start, gram, size, doc = start[ok], gram[ok], size[ok], doc[ok]
        key = size.astype(np.uint64)
        for i in range(int(size.max()) if len(size) else 0):
            more = size > i
            key[more] += w.hash[start[more] + i] * PLACES[i]
        bounds = np.searchsorted(doc, np.arange(batch.num_rows + 1))
        segments = [_lists(bounds, (start - w.first[doc]).astype(np.int32)), _lists(bounds, size.astype(np.int32)), _lists(bounds, gram.view(np.int64)), _lists(bounds, mix(key).view(np.int64))]
        sha = [None if some else s for s, some in zip(digests, busy.tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(w.count.astype(np.int64)), pa.array(sha, pa.string()), pa.array(packed, pa.binary()), pa.array(np.diff(w.bounds)), *segments], names=["row", "doc_id", "n_words", "sha", "packed", "size", "ats", "sizes", "grams", "keys"])


def _texts(packed: pa.Array, sizes: pa.Array) -> pa.Array:
    raw = [pa.decompress(p, decompressed_size=n, codec=_CODEC, asbytes=True) if n else b"" for p, n in zip(packed.to_pylist(), sizes.to_pylist(), strict=True)]
    return pa.array(raw, pa.binary()).cast(pa.large_binary()).view(pa.large_string())


def _pieces(batches: Iterator[pa.RecordBatch], most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Batches in pieces by the size of their unpacked texts."""
    for batch in batches:
        if batch.num_rows:
            for lo, hi in zip(*runs(np.cumsum(batch.column(batch.schema.get_field_index("size")).to_numpy()) // most), strict=True):
                yield batch.slice(lo, hi - lo)


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(gram, key, words, doc_id): the documents' segments."""
    for batch in _pieces(batches):
        w = Words(_texts(batch.column(1), batch.column(2)), SPACES)
        count = np.diff(batch.column(3).offsets.to_numpy())
        ats, sizes, grams, keys = (batch.column(i).flatten().to_numpy() for i in (3, 4, 5, 6))
        start = np.repeat(w.first[:-1], count) + ats
        words = [w.hash[i : i + n].tobytes() for i, n in zip(start.tolist(), sizes.tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(grams), pa.array(keys), pa.array(words, pa.binary()), pa.array(np.repeat(batch.column(0).to_numpy(), count))], names=["gram", "key", "words", "doc_id"])


class FMIndex:
    """Backward search over a word sequence, by a Burrows-Wheeler transform of suffixes ordered by 16 words.

    The transform is held as a wavelet matrix: per bit of a word's number, packed bits with counts at every 64th.
    """

    def __init__(self, text: np.ndarray):
        self.n, top = len(text), int(text.max()) + 1 if len(text) else 1
        rank, k = text.astype(np.int64), 1
        while k < 16:
            after = np.zeros(self.n, np.int64)
            after[: self.n - k] = rank[k:] + 1
            _, rank = np.unique(rank * (int(rank.max()) + 2) + after, return_inverse=True)
            k *= 2
        self.sa = np.argsort(rank, kind="stable").astype(np.int32)
        bwt = text[self.sa - 1].astype(np.int64)  # the first suffix is preceded by the last word: a separator
        self.levels = max(1, (top - 1).bit_length())
        self.bits, self.counts, self.zeros = [], [], []
        for level in range(self.levels - 1, -1, -1):
            bit = ((bwt >> level) & 1).astype(np.uint8)
            padded = np.zeros(-(-(self.n + 1) // 64) * 64, np.uint8)
            padded[: self.n] = bit
            words = np.packbits(padded, bitorder="little").view(np.uint64)
            self.bits.append(words)
            self.counts.append(np.concatenate([[0], np.cumsum(np.bitwise_count(words).astype(np.int64))[:-1]]).astype(np.int32))
            self.zeros.append(self.n - int(bit.sum()))
            bwt = np.concatenate([bwt[bit == 0], bwt[bit == 1]])
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=top))])
        self.base = self._down(np.arange(top), np.zeros(top, np.int64))

    def _down(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        for j in range(self.levels):
            block = i >> 6
            ones = self.counts[j][block] + np.bitwise_count(self.bits[j][block] & ((np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)))
            i = np.where((c >> (self.levels - 1 - j)) & 1, self.zeros[j] + ones, i - ones)
        return i

    def find(self, text: np.ndarray, start: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """The suffix intervals of the patterns ``text[start:start+size]``."""
        c = text[start + size - 1]
        lo, hi = self.first[c], self.first[c + 1]
        for i in range(size - 2, -1, -1):
            lo, hi = self.step(text[start + i], lo, hi)
        return lo, hi

    def step(self, c: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of the words ``c`` before the patterns of the intervals given."""
        return self.first[c] + self._down(c, lo) - self.base[c], self.first[c] + self._down(c, hi) - self.base[c]

    def matching(self, holder: np.ndarray, text: np.ndarray, ends: np.ndarray, own: np.ndarray, most: int = WINDOW) -> np.ndarray:
        """Matching statistics: the length, up to ``most``, of the longest match that ends at each of ``ends`` and starts at a place
        whose ``holder`` is below ``own``. A longer match contains a shorter one, so one that finds no such place goes no further.
        """
        least = [holder[self.sa]]  # smallest holders of 1, 2, 4, ... suffixes
        while 2 << len(least) <= 2 * int(np.diff(self.first)[1:].max(initial=1)):
            half = 1 << (len(least) - 1)
            least.append(np.append(np.minimum(least[-1][:-half], least[-1][half:]), least[-1][-half:]))
        least, length, alive = np.stack(least), np.zeros(len(ends), np.int64), np.arange(len(ends))
        lo, hi = np.zeros(len(ends), np.int64), np.full(len(ends), self.n)
        for i in range(most):
            c = text[ends[alive] - i]
            lo, hi = self.step(c, lo, hi) if i else (self.first[c], self.first[c + 1])
            k = np.frexp(hi - lo)[1] - 1
            less = np.minimum(least[k, lo], least[k, hi - (1 << k)]) < own[alive]
            alive, lo, hi = alive[less], lo[less], hi[less]
            length[alive] = i + 1
        return length


def repeats(segments: list[bytes], ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Intervals of each segment whose every window a smaller id holds in these segments, by one index over all: where the
    intervals of each segment begin and end in the two lists that follow, of first words and of ends (exclusive)."""
    sizes = np.array([len(s) // 8 for s in segments], np.int64)
    _, number = np.unique(np.frombuffer(b"".join(segments), np.uint64), return_inverse=True)
    begin = np.cumsum(sizes + 1) - sizes - 1  # a separator, word 0, ends each segment
    text = np.zeros(int((sizes + 1).sum()), np.int64)
    owner = np.repeat(np.arange(len(sizes)), sizes + 1)
    text[np.arange(len(text)) < begin[owner] + sizes[owner]] = number + 1
    holder = np.unique(ids, return_inverse=True)[1].astype(np.int32)
    n = sizes - WINDOW + 1
    start = np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    segment = owner[start]
    length = FMIndex(text).matching(holder[owner], text, start + WINDOW - 1, holder[segment])
    start, segment = start[length == WINDOW], segment[length == WINDOW]
    lo, hi = runs(start - np.arange(len(start)) + segment * WINDOW)  # consecutive windows of one segment
    start, last, segment = start[lo], start[hi - 1], segment[lo]
    return np.searchsorted(segment, np.arange(len(sizes) + 1)), start - begin[segment], last - begin[segment] + WINDOW


def _indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(gram, key, first, words, froms, tos) of each segment of each shard."""
    for table in groups_of(batches, "shard"):
        for lo, hi in zip(*runs(table.column("shard").to_numpy()), strict=True):
            part = table.slice(lo, hi - lo).combine_chunks().to_batches()[0]
            segments = part.column(3).to_pylist()
            bounds, froms, tos = repeats(segments, part.column(4).to_numpy())
            words = pa.array([len(s) // 8 for s in segments], pa.int32())
            yield pa.RecordBatch.from_arrays([part.column(1), part.column(2), part.column(4), words, _lists(bounds, froms.astype(np.int32)), _lists(bounds, tos.astype(np.int32))], names=["gram", "key", "first", "words", "froms", "tos"])


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _pieces(batches):
        w = Words(_texts(batch.column(1), batch.column(2)), SPACES)
        n = len(w.hash)
        at = lambda c: np.bincount(c.flatten().to_numpy() + np.repeat(w.first[:-1], np.diff(c.offsets.to_numpy())), minlength=n + 1)  # noqa: B023, E731
        keep = np.cumsum(at(batch.column(3)) - at(batch.column(4)))[:n] == 0  # an interval ends inside its document
        kept = np.diff(np.concatenate([[0], np.cumsum(keep)])[w.first])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(w.count.astype(np.int64)), pa.array((w.count - kept).astype(np.int64)), pa.array(_digests(w, keep), pa.string())], names=["doc_id", "n_words", "n_removed", "kept_sha256"])


def dedup(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) for every row of ``docs``.

    Null and empty texts have no words; texts of fewer than ``WINDOW`` words lose none. Rows of one id never remove each
    other's words; rows without an id take none and lose none. No rows, no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    small_batches(spark)
    value = F.coalesce(F.col(text), F.lit(""))
    row = F.xxhash64(F.col(id_col), value)
    rows = docs.select(F.when(row == 0, F.lit(1).cast("long")).otherwise(row).alias("row"), F.col(id_col).cast("long").alias("doc_id"), value.alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(spread(spark), size // BUCKET)
    asked = rows.where("doc_id IS NOT NULL").select("row", "text").mapInArrow(lambda it: _prints(buckets, it), "bucket long, grams binary, rows binary, counts binary")
    own = F.when(F.col("bucket") < 0, -1 - F.pmod(F.xxhash64("rows"), F.lit(1 << 40))).otherwise(F.col("bucket"))  # answered pieces go anywhere, each alone
    hits = asked.withColumn("bucket", own).repartition(spread(spark), "bucket").sortWithinPartitions("bucket").mapInArrow(_repeated, "row long, gram int")
    hits = cut(hits.groupBy(F.col("row").alias("r")).agg(F.collect_set("gram").alias("halves")))
    held = rows.join(hits.hint("shuffle_hash"), F.expr("row = r"), "left").select("row", "doc_id", "text", "halves")
    state = cut(held.mapInArrow(_sorted_out, "row long, doc_id long, n_words long, sha string, packed binary, size long, ats array<int>, sizes array<int>, grams array<long>, keys array<long>"))
    busy = state.where("sha IS NULL")
    segments = busy.select("doc_id", "packed", "size", "ats", "sizes", "grams", "keys").mapInArrow(_segments, "gram long, key long, words binary, doc_id long")
    distinct = cut(segments.groupBy("gram", "key", "words").agg(F.min("doc_id").alias("first")))
    hot = cut(distinct.groupBy("gram").agg(F.count("*").alias("n")).where(f"n > {HOT}").select(F.col("gram").alias("g")))
    shards = max(2 * spread(spark), math.ceil(distinct.count() / SHARD))
    each = F.expr(f"transform(sequence(0, CAST(length(words) / 8 AS INT) - {WINDOW}), i -> named_struct('i', i, 'w', substring(words, 8 * i + 1, {8 * WINDOW})))")
    windows = distinct.join(hot, F.expr("gram = g"), "left_semi").select("gram", "key", "first", F.explode(each).alias("e"))
    units = distinct.join(hot, F.expr("gram = g"), "left_anti").select(F.pmod(F.xxhash64("gram"), F.lit(shards)).alias("shard"), "gram", "key", "words", "first")
    # A hot gram's windows are units of their own, told by two hashes; a window's few units differ in their holder, and the smallest has no match.
    once = windows.groupBy(F.col("e.w").alias("words"), F.pmod(F.xxhash64("first"), F.lit(PARTS)).alias("part")).agg(F.min("first").alias("first"))
    single = once.select(F.pmod(F.xxhash64("words"), F.lit(shards)).alias("shard"), F.xxhash64("words").alias("gram"), F.xxhash64("words", F.lit(1)).alias("key"), "words", "first")
    index = lambda u: ordered_groups(u, "shard").mapInArrow(_indexed, "gram long, key long, first long, words int, froms array<int>, tos array<int>")
    answers = index(single).where("size(froms) = 0").select(F.col("gram").alias("w1"), F.col("key").alias("w2"), F.col("first").alias("f"))
    of_windows = windows.select("gram", "key", "first", "e.i", "e.w").join(answers, F.expr("xxhash64(w) = w1 AND xxhash64(w, 1) = w2"))
    of_windows = of_windows.groupBy("gram", "key").agg(F.min("first").alias("first"), (F.count("*") + WINDOW - 1).cast("int").alias("words"), F.collect_list(F.when(F.col("f") < F.col("first"), F.col("i"))).alias("froms"))
    # A gram and a hash of all words stand for a segment's words from here.
    found = cut(index(units).unionByName(of_windows.withColumn("tos", F.transform("froms", lambda i: i + WINDOW))))
    of_rows = busy.select("row", "doc_id", F.explode(F.arrays_zip("ats", "grams", "keys")).alias("s")).select("row", "doc_id", "s.ats", F.col("s.grams").alias("gram"), F.col("s.keys").alias("key"))
    whole = "transform(IF(doc_id > first, array({0}), {1}), x -> x + ats)"  # a later holder loses the segment
    gone = of_rows.join(found, ["gram", "key"]).select("row", F.expr(whole.format("0", "froms")).alias("froms"), F.expr(whole.format("words", "tos")).alias("tos")).where("size(froms) > 0")
    gone = gone.groupBy(F.col("row").alias("r")).agg(*(F.flatten(F.collect_list(c)).alias(c) for c in ("froms", "tos")))
    none = F.expr("CAST(array() AS array<int>)")
    last = busy.select("row", "doc_id", "packed", "size").join(gone.hint("shuffle_hash"), F.expr("row = r"), "left").select("doc_id", "packed", "size", F.coalesce("froms", none).alias("froms"), F.coalesce("tos", none).alias("tos"))
    done = last.mapInArrow(_removed, "doc_id long, n_words long, n_removed long, kept_sha256 string")
    return state.where("sha IS NOT NULL").select("doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), F.col("sha").alias("kept_sha256")).unionByName(done)


def brute(docs: list[tuple[int, str | None]]) -> dict[int, tuple[int, int, str]]:
    """{id: (words, removed, digest)} with every window in a dictionary; for tests, with one row an id."""
    import re

    words = {i: re.findall(r"[^\x20\x09-\x0D]+", t or "") for i, t in docs}
    first: dict[tuple, int] = {}
    for i in sorted(words):
        for j in range(len(words[i]) - WINDOW + 1):
            first.setdefault(tuple(words[i][j : j + WINDOW]), i)
    out = {}
    for i, w in words.items():
        keep = [True] * len(w)
        for j in range(len(w) - WINDOW + 1):
            if first[tuple(w[j : j + WINDOW])] < i:
                keep[j : j + WINDOW] = [False] * WINDOW
        out[i] = (len(w), keep.count(False), hashlib.sha256(" ".join(x for x, k in zip(w, keep, strict=True) if k).encode()).hexdigest())
    return out
