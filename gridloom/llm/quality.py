"""Quality classifier: an interpolated modified Kneser-Ney model of characters, trained on trusted text, one for each language.

Training takes every trusted row. Rows are dealt to ``FOLDS`` folds by their id, and a language has a model for each: it counts the trusted rows
of the other folds and scores the documents of its own, so that each trusted row is counted, and each is held out of the model that scores it.
With ``whole``, as in the pipeline, one more model counts all trusted rows of the language and scores the documents that are not trusted.
N-gram counts are tables keyed by (fold and lang, gram) and every order is estimated by joins on them: counts, continuation counts, discounts,
weights.
Scoring is sharded: documents are dealt to batches by language and hash; a batch asks once for each distinct gram it
holds, the asked grams join the tables order by order, and the answers come back to their batch, where each document's
perplexity is summed. A document is rejected above the threshold of its language, the quantile ``QUANTILE`` of the perplexities of its
trusted rows. A language with fewer than ``LEAST`` of them takes its own median, times that quantile of all trusted rows' ratios
to their languages' medians.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, groups_of, mix, ordered_groups, running_total, runs, small_batches, spread

ORDER = 4
#: Models of a language (one digit): each leaves the trusted rows of its own fold out.
FOLDS = 5
#: A document is rejected above this quantile of its language's trusted rows' perplexities.
QUANTILE = 0.98
#: Fewer trusted rows give a language no quantile of their own.
LEAST = 100
#: Buckets of perplexities for a factor of e, in which ranks are counted.
BUCKETS = 1 << 14
#: Bytes of text in a batch, about: a language has as many batches as its text asks for.
BATCH_BYTES = 12 << 20
PAD = "\n" * (ORDER - 1)
_KEYS = np.random.default_rng(5).integers(1, 2**63, ORDER, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def _grams(texts: list[str]) -> tuple[str, np.ndarray, np.ndarray, np.ndarray]:
    """The padded texts as one string; each gram's key, document and first character."""
    whole = "".join(PAD + t for t in texts)
    codes, sizes = _codes(whole), np.array([len(t) for t in texts])
    h = np.zeros(max(0, len(codes) - ORDER + 1), np.uint64)
    for i in range(ORDER):
        h += codes[i : i + len(h)] * _KEYS[i]
    at = np.arange(int(sizes.sum())) + np.repeat(np.arange(len(texts)) * (ORDER - 1), sizes)
    return whole, mix(h[at]), np.repeat(np.arange(len(texts)), sizes), at


def _pieces(texts: list[str], most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    part = np.cumsum([len(t) for t in texts]) // most
    yield from zip(*runs(part), strict=True)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(batch, pack): the rows of each batch among those read, compressed together."""
    how = pa.ipc.IpcWriteOptions(compression="zstd")
    for batch in batches:
        table = batch.sort_by("batch")
        keys = table.column("batch").to_numpy()
        lo, hi = runs(keys)
        packs = []
        for i, j in zip(lo, hi, strict=True):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema, options=how) as out:
                out.write(table.slice(i, j - i))
            packs.append(sink.getvalue().to_pybytes())
        yield pa.RecordBatch.from_arrays([pa.array(keys[lo]), pa.array(packs, pa.binary())], names=["batch", "pack"])


def _unpacked(packs: list[bytes]) -> pa.Table:
    return pa.concat_tables([pa.ipc.open_stream(p).read_all() for p in packs])


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(batch, lang, gram, n) of every distinct gram of a batch."""
    for table in groups_of(batches, "batch"):
        for lo, hi in zip(*runs(table.column("batch").to_numpy()), strict=True):
            rows = _unpacked(table.column("pack").slice(lo, hi - lo).to_pylist())
            texts, keys, codes, counts = rows.column("text").to_pylist(), [], [], []
            for a, b in _pieces(texts):
                whole, key, _, at = _grams(texts[a:b])
                if not len(key):
                    continue
                u, first, n = np.unique(key, return_index=True, return_counts=True)
                keys.append(u)
                counts.append(n)
                codes.append(_codes(whole)[at[first][:, None] + np.arange(ORDER)].astype("<u4"))
            if not keys:
                continue
            _, first, back = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
            grams = np.concatenate(codes)[first].tobytes().decode("utf-32-le", "surrogatepass")
            size, total = len(first), np.bincount(back, np.concatenate(counts)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([table.column("batch")[lo].as_py()] * size, pa.int64()), pa.array([rows.column("lang")[0].as_py()] * size, pa.string()), pa.array([grams[i : i + ORDER] for i in range(0, ORDER * size, ORDER)], pa.string()), pa.array(total)], names=["batch", "lang", "gram", "n"])


def _scored(docs: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
    """(doc_id, lang, perplexity, size in characters) of a batch's documents; perplexity is not a number without text or model."""
    rows = _unpacked(docs["pack"].tolist()) if len(docs) else pa.table({"doc_id": [], "lang": [], "text": []})
    texts = rows.column("text").to_pylist()
    n, total = np.array([len(t) for t in texts], np.int64), np.full(len(texts), np.nan)
    if len(answers) and len(texts):
        codes = _codes("".join(answers["gram"])).reshape(-1, ORDER)
        keys = mix((codes * _KEYS).sum(1, dtype=np.uint64))
        order = np.argsort(keys)
        keys, loss = keys[order], answers["loss"].to_numpy()[order]
        for a, b in _pieces(texts):
            _, key, doc, _ = _grams(texts[a:b])
            total[a:b] = np.bincount(doc, loss[np.searchsorted(keys, key)], minlength=b - a)
    perplexity = np.exp(total / np.where(n > 0, n, 1))
    return pd.DataFrame({"doc_id": pd.Series(rows.column("doc_id").to_pylist(), dtype="Int64"), "lang": rows.column("lang").to_pandas().astype("str"), "perplexity": pd.Series(np.where(n > 0, perplexity, np.nan)), "size": n})


class Model:
    """p[n]: (lang, gram, p) of seen grams; back[n]: (lang, gram, weight), by context of n - 1 characters; floor: (lang, p)."""

    def __init__(self, counts: DataFrame):
        self.p, self.back = {}, {}
        level = {ORDER: counts}
        for n in range(ORDER - 1, 0, -1):  # how many different characters come before the gram
            level[n] = level[n + 1].groupBy("lang", F.substring("gram", 2, n).alias("gram")).agg(F.count("*").alias("n"))
        for n in range(1, ORDER + 1):
            now = level[n].withColumn("h", F.substring("gram", 1, n - 1))
            of = lambda k: F.sum((F.col("n") == k).cast("double"))
            d = now.groupBy("lang").agg(*(of(k).alias(f"n{k}") for k in (1, 2, 3, 4)), F.count("*").alias("kinds"))
            y = F.coalesce(F.try_divide(F.col("n1"), F.col("n1") + 2 * F.col("n2")), F.lit(0.5))
            cap = lambda k, x: F.least(F.greatest(F.coalesce(k - (k + 1) * y * x, F.lit(0.5 * k)), F.lit(0.1)), F.lit(0.95 * k))
            rate = lambda a, b: F.try_divide(F.col(a), F.col(b))
            d = d.select("lang", "kinds", cap(1, rate("n2", "n1")).alias("d1"), cap(2, rate("n3", "n2")).alias("d2"), cap(3, rate("n4", "n3")).alias("d3"))
            now = now.join(F.broadcast(d), "lang")  # a row for each language
            cut_off = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
            heads = cut(now.groupBy("lang", "h").agg(F.sum("n").alias("total"), (F.sum(cut_off) / F.sum("n")).alias("weight"), F.first("kinds").alias("kinds")))
            if n == 1:
                self.floor = heads.select("lang", (F.col("weight") / (F.col("kinds") + 1)).alias("floor"))
            else:
                self.back[n] = heads.select("lang", F.col("h").alias("gram"), "weight")
            p = now.join(heads.drop("kinds"), ["lang", "h"])
            if n == 1:
                p = p.withColumn("lower", 1 / (F.col("kinds") + 1))
            else:
                p = p.withColumn("tail", F.substring("gram", 2, n - 1)).join(self.p[n - 1].select("lang", F.col("gram").alias("tail"), F.col("p").alias("lower")), ["lang", "tail"])
            self.p[n] = cut(p.select("lang", "gram", (F.greatest(F.col("n") - cut_off, F.lit(0)) / F.col("total") + F.col("weight") * F.col("lower")).alias("p")))

    def losses(self, grams: DataFrame) -> DataFrame:
        """(lang, gram, loss) for every (lang, gram) of a language with a model: the highest order seen, times the weights above."""
        now = grams.join(F.broadcast(self.floor), "lang").withColumn("scale", F.lit(1.0)).withColumn("p", F.lit(None).cast("double"))
        for n in range(ORDER, 0, -1):
            tail = F.substring("gram", ORDER - n + 1, n)
            now = now.withColumn("_t", tail).join(self.p[n].select(F.col("lang").alias("_l"), F.col("gram").alias("_g"), F.col("p").alias("_p")), F.expr("lang = _l AND _t = _g"), "left")
            now = now.withColumn("p", F.coalesce("p", F.col("scale") * F.col("_p"))).drop("_l", "_g", "_p", "_t")
            if n > 1:
                head = F.substring("gram", ORDER - n + 1, n - 1)
                now = now.withColumn("_h", head).join(self.back[n].select(F.col("lang").alias("_l"), F.col("gram").alias("_g"), "weight"), F.expr("lang = _l AND _h = _g"), "left")
                now = now.withColumn("scale", F.col("scale") * F.coalesce("weight", F.lit(1.0))).drop("_l", "_g", "weight", "_h")
        return now.select("lang", "gram", (-F.log(F.coalesce("p", F.col("scale") * F.col("floor")))).alias("loss"))


def _other_folds(seen: DataFrame, folds: int = FOLDS) -> DataFrame:
    """(lang, gram, n) of each fold's model from the counts of all folds: what the other folds have; everything, for a fold that
    counts none. ``lang`` is fold:lang on both sides."""
    fold = F.substring("lang", 1, 1)
    left = [F.sum("n") - F.sum(F.when(fold == str(k), F.col("n")).otherwise(0)) for k in range(folds)]
    every = seen.groupBy(F.expr("substring(lang, 3)").alias("lang"), "gram").agg(F.array(*left).alias("left"))
    each = every.select("lang", "gram", F.posexplode("left").alias("fold", "n")).where("n > 0")
    return each.select(F.concat(F.col("fold").cast("string"), F.lit(":"), F.col("lang")).alias("lang"), "gram", "n")


def quantiles(rows: DataFrame, **shares: float) -> DataFrame:
    """(lang, n, a column for each share): exact interpolated quantiles of ``perplexity``. Ranks are counted in buckets of near values, so
    that no task holds a language."""
    values = cut(rows.groupBy("lang", "perplexity").agg(F.count("*").alias("n")).withColumn("bucket", F.floor(F.log("perplexity") * BUCKETS)))
    before = running_total(values.groupBy("lang", "bucket").agg(F.sum("n").alias("n")), "lang", "bucket", "n", "before")
    inside = Window.partitionBy("lang", "bucket").orderBy("perplexity").rowsBetween(Window.unboundedPreceding, 0)
    total = values.groupBy("lang").agg(F.sum("n").alias("total"))  # a row for each language
    ranked = values.withColumn("inside", F.sum("n").over(inside)).join(before, ["lang", "bucket"]).join(F.broadcast(total), "lang")

    def at(share: float):
        place = (F.col("total") - 1) * share
        value = lambda rank: F.min(F.when(F.col("before") + F.col("inside") > rank, F.col("perplexity")))
        low, high = value(F.floor(place)), value(F.ceil(place))
        return low + (high - low) * F.max(place - F.floor(place))

    return ranked.groupBy("lang").agg(F.max("total").alias("n"), *(at(share).alias(name) for name, share in shares.items()))


def _drawn(rows: DataFrame, good: DataFrame, trusted: int) -> DataFrame:
    """The ids of about ``trusted`` trusted rows of each language."""
    known = cut(rows.select(F.col("doc_id").alias("t_id"), F.col("lang").alias("t_lang")).join(good, "t_id", "left_semi").distinct())
    counts = known.groupBy("t_lang").agg(F.count("*").alias("n"))
    return cut(known.join(F.broadcast(counts), "t_lang").where(F.pmod(F.xxhash64("t_id", F.lit("trusted")), F.col("n")) < trusted).select("t_id").distinct())


def classify(docs: DataFrame, labels: DataFrame, trusted: int | None = None, whole: bool = False, text: str = "text", id_col: str = "doc_id", lang: str = "lang") -> DataFrame:
    """(doc_id, lang, perplexity, threshold, kept) for every row of ``docs``.

    ``labels`` has doc_id, quality (1: trusted, unless toxic is 1 too); the models count all trusted rows, or about ``trusted``
    of each language if that is given; thresholds are over all of them. With ``whole`` only trusted rows are scored by their folds'
    models, and all others by one that leaves none out. Null and empty texts have no perplexity and are rejected. Languages without a trusted row that has a
    perplexity (null language included) have a null threshold and keep all text they have. Repeated rows each have their row; with
    empty labels all text is kept; no rows, no rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    good = labels.where("quality = 1" + (" AND coalesce(toxic, 0) = 0" if "toxic" in labels.columns else "")).select(F.col("doc_id").alias("t_id"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(lang), F.lit("")).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    counted = good if trusted is None else _drawn(rows, good, trusted)
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS))
    if whole:  # texts meet the labels once, for the folds and for what is counted
        rows = cut(rows.join(good.distinct().hint("shuffle_hash"), F.expr("doc_id = t_id"), "left").withColumn("known", F.col("t_id").isNotNull()).drop("t_id"))
        fold = F.when(F.col("known"), fold).otherwise(FOLDS)
    rows = rows.withColumn("lang", F.concat(fold.cast("string"), F.lit(":"), F.col("lang")))
    sizes = cut(rows.groupBy(F.col("lang").alias("s_lang")).agg(F.ceil(F.sum(F.octet_length("text")) / BATCH_BYTES + F.lit(0.001)).alias("parts")))
    tasks = max(spread(spark), math.ceil((sizes.agg(F.sum("parts")).first()[0] or 0) / 4))

    def packed(some: DataFrame) -> DataFrame:
        sized = some.join(F.broadcast(sizes), F.expr("lang = s_lang"))  # a row for each language and fold
        batch = F.xxhash64("lang", F.pmod(F.xxhash64("doc_id", "text"), F.col("parts")))
        return sized.select(batch.alias("batch"), "doc_id", "lang", "text").mapInArrow(_packed, "batch long, pack binary")

    schema = "batch long, lang string, gram string, n long"
    taught = rows.where("known") if whole and trusted is None else rows.join(counted.hint("shuffle_hash"), F.expr("doc_id = t_id"), "left_semi")
    model = Model(cut(_other_folds(ordered_groups(packed(taught), "batch").mapInArrow(_asked, schema), FOLDS + whole)))
    # One exchange of the texts serves both what batches ask and what they score.
    dealt = packed(rows).repartition(tasks, "batch")
    # And one of what they ask serves both the distinct grams and the answers: both sides read the same columns, without nulls.
    asked = dealt.sortWithinPartitions("batch").mapInArrow(_asked, schema).select("batch", "lang", "gram").where("lang IS NOT NULL AND gram IS NOT NULL").repartition("lang", "gram")
    losses = model.losses(asked.groupBy("lang", "gram").agg(F.max("batch").alias("last")).where("last IS NOT NULL").select("lang", "gram"))
    answers = asked.join(losses, ["lang", "gram"]).select("batch", "gram", "loss")
    scored = dealt.groupBy("batch").cogroup(answers.groupBy("batch")).applyInPandas(_scored, "doc_id long, lang string, perplexity double, size long")
    scored = cut(scored.withColumn("lang", F.expr("substring(lang, 3)")).withColumn("perplexity", F.when(~F.isnan("perplexity"), F.col("perplexity"))))
    held = scored.join(good, F.expr("doc_id = t_id"), "left_semi").where("perplexity IS NOT NULL")
    own = cut(quantiles(held, high=QUANTILE, middle=0.5).select("lang", F.when(F.col("n") >= LEAST, F.col("high")).alias("own"), "middle"))  # a row for each language
    ratios = held.join(F.broadcast(own), "lang").select(F.lit("").alias("lang"), (F.col("perplexity") / F.col("middle")).alias("perplexity"))
    limits = own.crossJoin(F.broadcast(quantiles(ratios, ratio=QUANTILE).select("ratio"))).select("lang", F.coalesce("own", F.col("middle") * F.col("ratio")).alias("threshold"))  # one row beside each
    out = scored.join(F.broadcast(limits), "lang", "left")
    kept = (F.col("size") > 0) & F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True))
    return out.select("doc_id", F.when(F.col("lang") != "", F.col("lang")).alias("lang"), "perplexity", "threshold", kept.alias("kept"))


def kept_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not rejected by models of all trusted rows; rows of one id with several texts go if any of them is."""
    gone = classify(docs, labels, whole=True).where("NOT kept").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone.hint("shuffle_hash"), F.expr("doc_id <=> _gone"), "left_anti")
