"""The quality classifier is fitted on all trusted rows: each is counted, and each is held out of the model that scores it."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gridloom.llm import quality

from .test_operators import frame, kneser_ney


def test_folds_against_dictionaries(spark):
    """Every perplexity is that of the trusted texts of the other folds, and a threshold is the quantile over all trusted rows."""
    rng = random.Random(5)
    text = {i: "".join(rng.choice("aaabbc d") for _ in range(rng.randint(5, 30))) for i in range(130)}
    docs = frame(spark, [(i, t, "en", "a") for i, t in text.items()])
    got = {r.doc_id: r for r in quality.classify(docs, spark.createDataFrame([(i, 1, 0) for i in range(120)], "doc_id long, quality int, toxic int")).collect()}
    fold = {r.doc_id: r.f for r in docs.select("doc_id", F.pmod(F.xxhash64("doc_id"), F.lit(quality.FOLDS)).alias("f")).collect()}
    want = {}
    for f in range(quality.FOLDS):
        p, _ = kneser_ney([text[i] for i in range(120) if fold[i] != f])
        for i in (i for i in text if fold[i] == f):
            padded = quality.PAD + text[i]
            want[i] = np.exp(-np.mean([np.log(p(padded[k : k + quality.ORDER])) for k in range(len(text[i]))]))
    assert {i: r.perplexity for i, r in got.items()} == pytest.approx(want)
    limit = np.quantile([want[i] for i in range(120)], quality.QUANTILE)
    assert [r.threshold for r in got.values()] == pytest.approx([limit] * len(got))
    assert {i for i, r in got.items() if not r.kept} == {i for i in want if want[i] > limit}


def test_counts_of_the_other_folds(spark):
    seen = Counter({(f"{f}:{g}", gram): n for f, g, gram, n in ((0, "en", "aaaa", 2), (1, "en", "aaaa", 3), (4, "en", "bbbb", 1), (2, "", "aaaa", 5))})
    got = {(r.lang, r.gram): r.n for r in quality._other_folds(spark.createDataFrame([(*k, n) for k, n in seen.items()], "lang string, gram string, n long")).collect()}
    want = {(f"{f}:{g}", gram): sum(n for (k, x), n in seen.items() if x == gram and k[2:] == g and k[0] != str(f)) for f in range(quality.FOLDS) for g, gram in (("en", "aaaa"), ("en", "bbbb"), ("", "aaaa"))}
    assert got == {k: n for k, n in want.items() if n}


def test_quantiles(spark):
    rng = random.Random(6)
    values = {"en": [rng.choice([1.0, 2.5, rng.uniform(0.5, 30)]) for _ in range(501)], "fr": [3.0], "de": [4.0, 1.0]}
    got = {r.lang: (r.n, r.high, r.middle) for r in quality.quantiles(spark.createDataFrame([(g, x) for g, v in values.items() for x in v], "lang string, perplexity double"), high=0.98, middle=0.5).collect()}
    assert got == {g: (len(v), pytest.approx(np.quantile(v, 0.98)), pytest.approx(np.median(v))) for g, v in values.items()}


def test_pipeline_takes_all_trusted_rows(spark, tmp_path):
    """The pipeline's first stage drops what lies above the quantile over all trusted rows."""
    rng = random.Random(7)
    docs = frame(spark, [(i, "".join(rng.choice("aaabbc d") for _ in range(rng.randint(5, 30))), "en", "a") for i in range(110)])
    labels = spark.createDataFrame([(i, 1, 0) for i in range(110)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    at = {r.doc_id: r.perplexity for r in quality.classify(docs, labels).collect()}
    kept = {r.doc_id for r in corpus_pipeline.quality_filter(spark, docs, str(tmp_path)).collect()}
    assert kept == {i for i, p in at.items() if p <= np.quantile(list(at.values()), quality.QUANTILE)} and len(kept) == 107


def test_pipeline_models_leave_no_trusted_row_out(spark, tmp_path):
    """A document that is not trusted is judged by a model of all trusted rows, also of those of its own fold."""
    rng = random.Random(8)
    text = {i: "".join(rng.choice("aaabbc d") for _ in range(rng.randint(5, 30))) for i in range(140)}
    text[3] = "zyxwv utsrq " * 8
    text |= {i: text[3] for i in range(200, 230)} | {i: "QX#%" * 9 for i in (230, 231)}
    docs = frame(spark, [(i, t, "en", "a") for i, t in text.items()])
    labels = spark.createDataFrame([(i, 1, 0) for i in range(120)] * 2 + [(None, 1, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    fold = {r.doc_id: r.f for r in docs.select("doc_id", F.pmod(F.xxhash64("doc_id"), F.lit(quality.FOLDS)).alias("f")).collect()}
    models = {f: kneser_ney([text[i] for i in range(120) if fold[i] != f])[0] for f in range(quality.FOLDS)} | {None: kneser_ney([text[i] for i in range(120)])[0]}

    def perplexity(i, f):
        padded = quality.PAD + text[i]
        return np.exp(-np.mean([np.log(models[f](padded[k : k + quality.ORDER])) for k in range(len(text[i]))]))

    by_fold = {i: perplexity(i, fold[i]) for i in text}
    want = {i: by_fold[i] if i < 120 else perplexity(i, None) for i in text}
    limit = np.quantile([want[i] for i in range(120)], quality.QUANTILE)
    kept = {r.doc_id for r in corpus_pipeline.quality_filter(spark, docs, str(tmp_path)).collect()}
    assert kept == {i for i, p in want.items() if p <= limit} and not kept & {230, 231}
    assert set(range(200, 230)) <= kept and any(by_fold[i] > limit for i in range(200, 230))  # their text is a trusted one of one fold
    assert {r.doc_id: r.perplexity for r in quality.classify(docs, labels, whole=True).collect()} == pytest.approx(want)
