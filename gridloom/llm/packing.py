"""Packing by power-of-two decomposition: every document becomes pieces of binary lengths, and pieces of one length make a bucket.

A document is its token ids and an end id. It is cut, in order, into pieces of ``most`` ids and then of the powers of two that its
remainder is the sum of, largest first. A piece is a sequence by itself, so no sequence crosses documents and none needs padding;
a training loop draws its batches from one bucket at a time.

Tokens come from a public tokenizer, whose file's text is sent to the tasks. A tokenizer that splits text into words first encodes each
different word once a task process, not once an occurrence: :class:`WordEncoder`.
"""

from __future__ import annotations

import functools
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, cut, numbered, slices

MOST = 2048
END = 1
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
#: Words whose ids a task process keeps at most; beyond it they are forgotten and encoded anew.
KEPT = 1 << 20

_SPACE, _LETTER, _DIGIT, _OTHER, _HIGH = range(5)
_CLASS = np.array([_HIGH if b >= 0x80 else _SPACE if b == 0x20 or 9 <= b <= 13 else _LETTER if chr(b).isalpha() else _DIGIT if chr(b).isdigit() else _OTHER for b in range(256)], np.uint8)


class WordEncoder:
    """Ids of texts by a tokenizer that splits at white space, and between letters, single digits and other characters.

    Texts are taken apart there, at borders between two ASCII characters only and not behind an apostrophe (``'s`` may be one word), and
    different parts are encoded once. ASCII letters are lowered in parts without other letters, as the tokenizer lowers them. Texts that
    hold a special token's string are encoded as they are. A tokenizer of another kind than this must not be given.
    """

    def __init__(self, text: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(text)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.forget()

    def forget(self) -> None:
        self.known = pa.array([], pa.large_binary())
        self.first, self.ids = np.zeros(1, np.int64), np.zeros(0, np.uint32)

    def learn(self, words: pa.Array) -> None:
        """Encode words that are not known, in lists of a thousand: the tokenizer says which word each id is of."""
        given = words.cast(pa.large_string()).to_pylist()
        lists = [given[i : i + 1000] for i in range(0, len(given), 1000)]
        ids, counts = [self.ids], []
        for part, got in zip(lists, self.tokenizer.encode_batch(lists, is_pretokenized=True, add_special_tokens=False), strict=True):
            ids.append(np.array(got.ids, np.uint32))
            counts.append(np.bincount(np.array(got.word_ids, np.int64), minlength=len(part)))
        self.known = pa.concat_arrays([self.known, words])
        self.ids = np.concatenate(ids)
        self.first = np.r_[self.first, self.first[-1] + np.cumsum(np.concatenate(counts))]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, first id of each text and the end); null texts are empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        odd = functools.reduce(pc.or_, (pc.match_substring(texts, s) for s in self.special), pa.array(np.zeros(len(texts), bool)))
        words, bounds = self._parts(pc.if_else(odd, "", texts))
        if len(self.known) > KEPT:
            self.forget()
        coded = words.dictionary_encode()
        row = pc.index_in(coded.dictionary, value_set=self.known)
        new, row = row.is_null(), pc.fill_null(row, 0).to_numpy().astype(np.int64)
        if pc.any(new).as_py():
            row[new.to_numpy(zero_copy_only=False)] = np.arange(len(self.known), len(self.known) + pc.sum(new).as_py())
            self.learn(coded.dictionary.filter(new))
        row = row[coded.indices.to_numpy()]
        count = self.first[row + 1] - self.first[row]
        ends = np.r_[0, np.cumsum(count)]
        ids = self.ids[np.arange(ends[-1]) + np.repeat(self.first[row] - ends[:-1], count)]
        first = ends[bounds]
        if pc.any(odd).as_py():
            ids, first = self._with_plain(texts, odd.to_numpy(zero_copy_only=False), ids, first)
        return ids, first

    def _with_plain(self, texts: pa.Array, odd: np.ndarray, ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        own = [np.array(self.tokenizer.encode(texts[i].as_py(), add_special_tokens=False).ids, np.uint32) if odd[i] else ids[first[i] : first[i + 1]] for i in range(len(texts))]
        return np.concatenate(own), np.r_[0, np.cumsum([len(x) for x in own])]

    @staticmethod
    def _parts(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The texts' parts as bytes, and the first part of each text and the end."""
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = texts.buffers()[2]
        raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
        offsets = offsets - offsets[0]
        kind = _CLASS[raw]
        inside = kind != _SPACE
        opens = inside.copy()
        before, after = kind[:-1], kind[1:]
        border = (before != after) | (after == _DIGIT)
        border &= (before != _HIGH) & (after != _HIGH) & (raw[:-1] != ord("'"))
        opens[1:] &= border | (before == _SPACE)
        edge = offsets[:-1][offsets[:-1] < len(raw)]
        opens[edge] |= inside[edge]
        # What is not white space moves together; a part ends where the next begins.
        at = np.flatnonzero(opens)
        start = (np.cumsum(inside, dtype=np.int32)[at] - 1).astype(np.int64)
        own, kind = raw[inside], kind[inside]
        if len(at):
            high = np.logical_or.reduceat(kind == _HIGH, start)
            own = np.where(np.repeat(high, np.diff(np.r_[start, len(own)])), own, LOWER[own])
        words = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(np.r_[start, len(own)].astype(np.int64)), pa.py_buffer(own)])
        return words, np.searchsorted(at, offsets)


@functools.lru_cache(maxsize=1)
def encoder(text: str) -> WordEncoder:
    """One a task process."""
    return WordEncoder(text)


def lengths(tokens: int, most: int = MOST) -> list[int]:
    """The pieces of a document of so many ids: ``most`` (a power of two) as often as it goes, then the binary digits of the rest."""
    whole, rest = divmod(tokens, most)
    return [most] * whole + [1 << b for b in reversed(range(most.bit_length())) if rest >> b & 1]


def _pieces(tokenizer: str, end: int, most: int, with_ids: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = encoder(tokenizer)
    for batch in slices(batches, "text", 8 << 20):
        ids, first = words.encode(batch.column(1))
        rows, own = [], []
        for d, (lo, hi) in enumerate(zip(first[:-1].tolist(), first[1:].tolist(), strict=True)):
            doc, start = np.append(ids[lo:hi], np.uint32(end)).astype("<u4"), 0
            for n in lengths(len(doc), most):
                rows.append((d, start, n, zlib.crc32(doc[start : start + n]), len(doc)))
                own.append(doc[start : start + n])
                start += n
        at = np.array(rows, np.int64).reshape(-1, 5).T
        columns = {"doc_id": batch.column(0).take(pa.array(at[0])), "start": at[1], "length": at[2], "ids_crc32": at[3], "doc_tokens": at[4]}
        if with_ids:
            columns["ids"] = pa.ListArray.from_arrays(np.r_[0, np.cumsum(at[2])].astype(np.int32), np.concatenate(own).astype(np.int32))
        yield pa.RecordBatch.from_pydict({k: pa.array(v) if isinstance(v, np.ndarray) else v for k, v in columns.items()})


def pieces(docs: DataFrame, tokenizer: str, most: int = MOST, end: int = END, text: str = "text", id_col: str = "doc_id", with_ids: bool = True) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens[, ids]): a row per piece, in one pass over the texts without an exchange.

    ``tokenizer`` is the path of a tokenizer's file, which the driver reads; ``most`` is a power of two. Null and empty texts are the end id
    alone, and so one piece of length 1. Repeated rows are cut one by one; rows without an id keep a null; other columns are ignored.
    """
    if most & (most - 1):
        raise ValueError(f"{most} is no power of two")
    with open(tokenizer, encoding="utf-8") as f:
        file = f.read()
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(lambda it: _pieces(file, end, most, with_ids, it), PIECES + ", ids array<int>" * with_ids)


def pack(cut_pieces: DataFrame, rows_a_bucket: int = 50_000) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``: each piece is a sequence, so the offset is 0; sequences are numbered from 0 without
    gaps, longest first, so that a bucket is a range of numbers. Inside a bucket the order is a hash's: neighbours are of any documents.

    The pieces are written to the shared folder once and numbered inside small parts of a bucket, which may hold most of all pieces.
    """
    rows = cut(cut_pieces.withColumn("order", F.xxhash64("doc_id", "start", "ids_crc32")))
    buckets = rows.groupBy("length").agg(F.count("*").alias("n")).collect()  # a row per power of two
    before, total = {}, 0
    for b in sorted(buckets, key=lambda b: -b["length"]):
        before[b["length"]], total = total, total + b["n"]
    parts = max(1, math.ceil(max((b["n"] for b in buckets), default=0) / rows_a_bucket))
    out = numbered(rows, "length", "order", ["doc_id", "start", "ids_crc32", "doc_tokens"], parts, "in_bucket")
    base = F.coalesce(*(F.when(F.col("length") == n, F.lit(b)) for n, b in before.items()), F.lit(0))
    return out.withColumn("sequence_id", (F.col("in_bucket") + base).cast("long")).withColumn("offset", F.lit(0).cast("long")).drop("in_bucket", "order")


def digest(packed: DataFrame) -> DataFrame:
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def write_buckets(packed: DataFrame, path: str) -> None:
    """A folder per length, to be read by a training loop: ``packed`` with its ids; large buckets are many files."""
    packed.hint("rebalance", "length").write.mode("overwrite").partitionBy("length").parquet(path)
