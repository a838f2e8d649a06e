"""Edge rows of every corpus operator and pipeline stage: very long texts, repeated rows, ties, nulls in every column, empty tables, clashing columns."""

from __future__ import annotations

import random

import corpus_pipeline
import numpy as np
from pyspark.sql import functions as F

from gridloom.llm import decontaminate, forest, licenses, minhash, mixing, quality, secrets, sharding, substrings, templates
from gridloom.llm.common import cut

from .test_operators import corpus, frame

LONG = " ".join(f"w{i}" for i in range(60_000))


def test_very_long_texts(spark):
    """What stands at the far end of a text of a megabyte counts, and its length changes nothing for others."""
    tail = "password = abcdef123 "
    item = " ".join(f"w{i}" for i in range(59_980, 60_000))
    texts = [(1, f"{LONG}\nReleased under the MIT License.\n{tail}"), (2, f"{tail}\n{item}"), (3, LONG), (4, None)]
    d = frame(spark, [(i, t, None, None) for i, t in texts])
    assert {r.doc_id: tuple(r.notices) for r in licenses.scan(d).collect()} == {1: ("MIT",), 2: (), 3: (), 4: ()}
    assert {r.doc_id: tuple(r)[1:] for r in secrets.digest(secrets.findings(d, secrets.scan_new(d))).collect()} == {i: secrets.brute(t) for i, t in texts}
    bench = [(1, item), (2, "password abcdef123")]
    got = sorted(tuple(r) for r in decontaminate.digest(decontaminate.overlaps(d, spark.createDataFrame(bench, "item_id long, text string"))).collect())
    assert got == sorted(decontaminate.brute(texts, bench))
    assert {r.doc_id: tuple(r)[1:] for r in substrings.dedup(d).collect()} == substrings.brute(texts)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(d, 3, 0.85).collect()} == minhash.brute(texts, 3, 0.85)
    page = f"<body><nav>menu</nav><article><h1>t</h1><p>{LONG}</p><p>end</p></article></body>"
    assert [r.text for r in templates.extract(spark.createDataFrame([(1, "http://a/", page)], "page_id long, url string, html string")).collect()] == [f"t {LONG} end"]


def test_repeated_rows(spark):
    """Whole rows that repeat, and rows of one id with different texts, each have their row."""
    rows = corpus(40, 5)
    text = dict((i, t) for i, t, *_ in rows)
    d = frame(spark, rows + rows[:20] + rows[:5])
    ids = sorted([i for i, *_ in rows + rows[:20] + rows[:5]])
    want = minhash.brute(list(text.items()), 3, 0.85)
    got = minhash.near_duplicates(d, 3, 0.85).collect()
    assert sorted(r.doc_id for r in got) == ids and all((r.n_shingles, r.component_id) == want[r.doc_id] for r in got)
    items = [(0, " ".join(rows[9][1].split()[40:75])), (0, " ".join(rows[9][1].split()[40:75])), (5, rows[1][1] or "x")]
    want = {r[0]: r for r in decontaminate.brute(list(text.items()), items[1:])}
    got = [tuple(r) for r in decontaminate.digest(decontaminate.overlaps(d, spark.createDataFrame(items[1:], "item_id long, text string"))).collect()]
    assert sorted(r[0] for r in got) == ids and all(r == want[r[0]] for r in got)
    twice = [tuple(r) for r in decontaminate.digest(decontaminate.overlaps(d, spark.createDataFrame(items, "item_id long, text string"))).collect()]
    assert sorted(r[0] for r in twice) == ids and all(r[2] == want[r[0]][2] for r in twice)
    want = substrings.brute(list(text.items()))
    got = substrings.dedup(d).collect()
    assert sorted(r.doc_id for r in got) == ids and all(tuple(r)[1:] == want[r.doc_id] for r in got)
    found = secrets.digest(secrets.findings(d, secrets.scan_new(d))).collect()
    assert sorted(r.doc_id for r in found) == ids and sorted(r.doc_id for r in licenses.scan(d).collect()) == ids
    shards = sharding.shard(d, shards=3).collect()
    assert sorted(r.doc_id for r in shards) == ids
    for s in range(3):
        slots = sorted(r.slot for r in shards if r.shard == s)
        assert slots == list(range(len(slots)))
    assert mixing.taken_words(mixing.mix(d)).count() == len(ids)
    two = frame(spark, [(1, "a b c d e f", "en", "a"), (1, "v w x y z", "en", "a"), (2, "a b c d e f", "en", "a")])
    assert sorted((r.doc_id, r.component_id) for r in minhash.near_duplicates(two, 3, 0.85).collect()) == [(1, 1), (1, 1), (2, 1)]


def test_pages_and_vectors(spark):
    """Repeated pages, null urls and clashing columns; repeated vectors, null ids, ties of the smallest id."""
    page = "<body><nav>menu</nav><article><h1>t</h1><p>one  two &amp; three</p></article><div class='ad'>buy</div></body>"
    rows = [(1, "http://a/1", page), (1, "http://a/1", page), (2, None, page), (None, None, page), (3, "http://a/1", None), (4, "no url", ""), (5, "http://a/2", "plain"), (6, "http://a/3", "<p>" * 3000 + "deep")]
    d = spark.createDataFrame([(*r, "x", "x", "x", 1) for r in rows], "page_id long, url string, html string, host string, text string, template string, salt int")
    got = sorted((r.page_id or 0, r.text, r.n_chars) for r in templates.extract(d).collect())
    assert got == sorted([(1, "t one two & three", 17), (1, "t one two & three", 17), (2, "t one two & three", 17), (0, "t one two & three", 17), (3, "", 0), (4, "", 0), (5, "plain", 5), (6, "deep", 4)])
    rng = np.random.default_rng(2)
    a, b = (rng.normal(size=16).tolist() for _ in range(2))
    vectors = [(1, a), (2, [2 * x for x in a]), (3, b), (4, None), (5, []), (6, [0.0] * 16), (7, [float("nan"), *a[1:]]), (8, [None, *a[1:]]), (9, [float("inf"), *a[1:]]), (10, b), (11, [-x for x in a])]
    v = spark.createDataFrame([(i, e, 1, 1, 1.0) for i, e in vectors], "vec_id long, embedding array<double>, label int, node long, n_links double")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in forest.near_duplicates(v).collect()}
    alone = {i: (0, i, True) for i in (4, 5, 6, 7, 8, 9, 11)}
    assert got == {1: (1, 1, True), 2: (1, 1, False), 3: (1, 3, True), 10: (1, 3, False), **alone}


def test_rows_of_nulls(spark):
    """Rows that are null in every column, beside others and alone."""
    none = [(None, None, None, None)] * 3
    for rows in (none, [*none, *corpus(20, 2)]):
        d = frame(spark, rows)
        n = len(rows)
        labels = spark.createDataFrame([(i, 1, 0) for i in range(10)] + [(None, None, None)], "doc_id long, quality int, toxic int")
        bench = spark.createDataFrame([(None, None), (None, "w x y"), (1, None)], "item_id long, text string")
        assert [r.license for r in licenses.report(licenses.scan(d)).collect()] == [None] * n and secrets.digest(secrets.findings(d, secrets.scan_new(d))).count() == n
        assert minhash.near_duplicates(d).count() == n and substrings.dedup(d).count() == n
        assert decontaminate.digest(decontaminate.overlaps(d, bench)).count() == n
        assert sharding.shard(d).count() == n and mixing.taken_words(mixing.mix(d)).count() == n
        assert quality.classify(d, labels).count() == n


def test_stages_on_edge_tables(spark, tmp_path):
    """Each stage on no rows, and on repeated rows and nulls: columns stay, and nothing crashes."""
    rows = corpus(40, 7)
    docs = frame(spark, rows + rows[:10] + [(None, None, None, None)] * 2)
    spark.createDataFrame([(0, " ".join(rows[9][1].split()[:1500]))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for d in (docs.limit(0), docs):
        now = cut(d)
        for name, stage in corpus_pipeline.STAGES:
            now = cut(stage(spark, now, str(tmp_path)))
            assert name == "sharding" or now.columns == docs.columns
        n = now.count()
        assert (n > 10) == (d is docs) and now.where(F.col("shard").isNull()).count() == 0


def test_ties_and_long_texts(spark):
    """Ties: many equal texts and equal sizes give the same result on each run."""
    rng = random.Random(3)
    rows = [(i, rng.choice(["a b c", "d e f", None]), "en", rng.choice(["s", None])) for i in range(200)] + [(200 + i, f"{i} " + "long " * 100_000, "en", "s") for i in range(3)]
    runs = [sorted(map(tuple, sharding.shard(frame(spark, some), shards=4).collect())) for some in (rows, rows[::-1])]
    assert runs[0] == runs[1] and {r[0]: r[1] for r in runs[0]}[201] == 500_003
    assert {r[0] for r in runs[0]} == {r[0] for r in rows} and len({r[4] for r in runs[0] if r[0] >= 200}) == 3
    taken = [sorted(map(tuple, mixing.taken_words(mixing.mix(frame(spark, some))).collect())) for some in (rows, rows[::-1])]
    assert taken[0] == taken[1]
