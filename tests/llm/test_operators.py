"""Each corpus operator against brute force on small fixtures, with nulls, empty texts, ties, repeats and clashing columns."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.llm import decontaminate, forest, licenses, minhash, mixing, quality, secrets, sharding, substrings, templates

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, node long, row long, words long"


def frame(spark, rows):
    """Documents with extra columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, lang, src, len(t or ""), 7, 7, 7, 7) for i, t, lang, src in rows], DOCS)


def corpus(n=120, seed=1):
    """Random prose with exact copies, near copies, shared passages, null, empty and very long texts."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 90))) for _ in range(n)]
    base = " ".join(rng.choice(vocabulary) for _ in range(120))
    for i in range(0, n, 6):
        words = base.split()
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        texts[i] = " ".join(words)
    for i in range(3, n, 9):
        texts[i] += " " + " ".join(passage[rng.randrange(20) :]) + "\n tail"
    for i in range(5, n, 11):
        texts[i] = texts[1]
    texts[2], texts[4], texts[7], texts[8] = None, "", "one", " \t\n"
    texts[9] = " ".join(rng.choice(vocabulary) for _ in range(20000))
    return [(i, t, "en" if i % 3 else None, None if i % 17 == 0 else f"s{i % 4}") for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs():
    return corpus()


def test_licenses(spark):
    rows = [(1, "Copyright (c) 2020 Jo\n" + licenses.TEXTS[0][1].upper(), "en", "a"), (2, "prose\nReleased under the MIT Licence!", "en", "a"), (3, None, None, None), (4, "", "en", "a"), (5, "no licence here", "en", "a"), (2, "prose\nReleased under the MIT Licence!", "en", "a")]
    found = sorted((r.doc_id, r.license, tuple(r.notices)) for r in licenses.scan(frame(spark, rows)).collect())
    assert found == [(1, "MIT", ()), (2, None, ("MIT",)), (2, None, ("MIT",)), (3, None, ()), (4, None, ()), (5, None, ())]
    assert licenses.scan(frame(spark, [])).count() == 0


def test_license_texts(spark):
    """Whole texts under their titles, holders and spellings; a line that reserves rights takes no other line with it."""
    texts = dict(licenses.TEXTS)
    rows = [
        (1, "All rights reserved.\nReleased under the MIT License.", ("MIT",)),
        (2, "(c) Jo\nAll Rights Reserved\n\nLicensed under the Apache License, Version 2.0.\nmore", ()),
        (3, "The MIT License\n\nCopyright (c) 2024 Jo & Co\n\n" + texts["MIT"].replace(" ", "\n", 9), ("MIT",)),
        (4, "BSD 3-Clause Licence\n\nCopyright 2020 A\nCopyright 2021 B\nAll rights reserved.\n" + texts["BSD-3-Clause"].replace(".", ". "), ("BSD-3-Clause",)),
        (5, texts["ISC"] + "\nand a clause of my own", ()),
        (6, texts["Zlib"].replace("acknowledgment", "acknowledgement"), ("Zlib",)),
        (7, "prose " * 200_000 + "\nISC", ()),
        (8, "no rights. All rights reserved. Released under the MIT License.", ()),
    ]
    got = {r.doc_id: (r.license, tuple(r.notices)) for r in licenses.scan(frame(spark, [(i, t, "en", "a") for i, t, _ in rows])).collect()}
    notices = {1: ("MIT",), 2: ("Apache-2.0",), 4: ("BSD-3-Clause",), 7: ("ISC",)}
    assert got == {i: (want[0] if want else None, notices.get(i, ())) for i, _, want in rows}


def test_secrets_and_ledger(spark):
    texts = ["password = 'abc123+/' x", 'API_KEY":"short" token: abcdefgh', "AKIA" + "A1" * 8, "é 0123456789abcdef0123456789 AKIAB", None, "", "secret=ab token=secret=abcdefgh", "paſſword=abcdefgh"]
    d = frame(spark, [(i, t, "en", "a") for i, t in enumerate([*texts, texts[0]])])
    ledger = secrets.scan_new(d)
    got = {r.doc_id: tuple(r)[1:] for r in secrets.digest(secrets.findings(d, ledger)).collect()}
    assert got == {i: secrets.brute(t) for i, t in enumerate([*texts, texts[0]])}
    assert ledger.count() == len({t or "" for t in texts})
    assert secrets.scan_new(d, ledger).count() == 0 and secrets.scan_new(d, ledger, rules="next").count() == ledger.count()


@pytest.mark.parametrize("k,threshold", [(3, 0.85), (5, 0.8)])
def test_minhash(spark, docs, k, threshold):
    want = minhash.brute([(i, t) for i, t, *_ in docs], k, threshold)
    got = {r.doc_id: r for r in minhash.near_duplicates(frame(spark, docs), k, threshold).collect()}
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.values())


def test_minhash_large_nodes(spark, monkeypatch):
    """Groups far above a leaf's size go through branching, blocks and leaf-wise confirmation."""
    monkeypatch.setattr(minhash, "LEAF", 8)
    monkeypatch.setattr(minhash, "DEPTH", 2)
    rows = corpus(150, 4)
    want = minhash.brute([(i, t) for i, t, *_ in rows], 3, 0.85)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(frame(spark, rows), 3, 0.85).collect()}
    assert sum(got[i] == w for i, w in want.items()) >= 0.97 * len(want)


def test_minhash_pairs_in_a_crowd(spark, monkeypatch):
    """Isolated pairs among many documents with one long boilerplate, in nodes far above a leaf's size."""
    monkeypatch.setattr(minhash, "LEAF", 8)
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(9))
    boilerplate = [word() for _ in range(170)]
    texts = [boilerplate + [word() for _ in range(30)] for _ in range(300)]
    texts += [t[:-8] + [word() for _ in range(8)] for t in texts[:40]]
    rows = [(i, " ".join(t), "en", "a") for i, t in enumerate(texts)]
    want = minhash.brute([(i, t) for i, t, *_ in rows], 3, 0.85)
    assert len({c for _, c in want.values()}) == 300
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(frame(spark, rows), 3, 0.85).collect()}
    assert got == want


def test_minhash_blocks_meet(spark, monkeypatch):
    """Any two members of a node that does not split are compared."""
    monkeypatch.setattr(minhash, "LEAF", 8)
    blocks = defaultdict(set)
    for r in minhash._blocked(spark.createDataFrame([(1, i) for i in range(40)], "node long, doc_id long")).collect():
        blocks[r.node].add(r.doc_id)
    met = {(i, j) for b in blocks.values() for i in b for j in b if i < j}
    assert len(met) == 40 * 39 // 2


def test_decontamination(spark, docs):
    items = [(0, " ".join(docs[9][1].split()[40:75])), (1, "one"), (2, None), (3, "  "), (4, "never seen here at all"), (5, docs[1][1] or "x"), (10, " ".join(docs[9][1].split()[40:53]).upper())]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(tuple(r) for r in decontaminate.digest(decontaminate.overlaps(frame(spark, docs), bench)).collect())
    assert got == sorted(decontaminate.brute([(i, t) for i, t, *_ in docs], items))
    assert decontaminate.overlaps(frame(spark, docs), bench.limit(0)).agg(F.sum("n_hit")).first()[0] == 0
    assert decontaminate.overlaps(frame(spark, []), bench).count() == 0


def test_decontamination_full_bitmap(spark, docs, monkeypatch):
    """A bitmap too small for its shingles lets more pass and changes nothing; ids may be int or null, rows repeat."""
    monkeypatch.setattr(decontaminate, "MOST_BITS", 1 << 8)
    base = [(i, t) for i, t, *_ in docs if t][:60] + [docs[9][:2]]
    items = [(i, " ".join((t or "").split()[5:45])) for i, t in base] + [(900, "one"), (901, "a b")]
    items += [(None, items[0][1])]
    bench = spark.createDataFrame(items, "item_id int, text string")
    d = spark.createDataFrame([(i, t, 1) for i, t in [*base, base[3], (None, base[4][1])]], "doc_id int, text string, key int")
    got = sorted(map(repr, (tuple(r) for r in decontaminate.digest(decontaminate.overlaps(d, bench)).collect())))
    assert got == sorted(map(repr, decontaminate.brute([*base, base[3], (None, base[4][1])], items[:-1])))


def test_html(spark):
    page = lambda body: f"<html><head><title>t</title><script>var x='</p>'</script></head><body><nav><a href='/'>Menu</a></nav><div class='side sidebar'>S</div><article><h1>H&amp;1</h1>{body}<aside>no</aside><div id=comments>c</div></article><footer>f</footer></body></html>"
    rows = [(1, "http://a.x/1", page("<p>one <b>bo</b>ld<br>next<p>two")), (2, "http://a.x/2", page("<p>three\n  four</p><!-- gone --><form>f</form>")), (3, None, None), (4, "http://b.x/", ""), (5, "http://a.x/3", page("&lt;x&gt;"))]
    d = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, salt int")
    got = {r.page_id: (r.text, r.n_chars) for r in templates.extract(d).collect()}
    want = {1: "H&1 one bold next two", 2: "H&1 three four", 3: "", 4: "", 5: "H&1 <x>"}
    assert got == {i: (t, len(t)) for i, t in want.items()}


def pages_of(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_html_keeps_what_articles_repeat(spark):
    """Text that a host repeats in its articles is main text; elements with furniture's words go where the template has them."""
    page = lambda i, extra="": f"<html><body><div class='top'>Site {i}</div><article><h1>T{i}</h1><p>Mix well and serve.</p><p>own {i}, of some length</p>{extra}</article></body></html>"
    share = "<div class='share'>Tell a friend</div>"
    rows = [(i, "http://a.x/", page(i, share)) for i in range(4)] + [(10, "http://b.x/", page(10, share))] + [(20 + i, "http://c.x/", page(20 + i, "<section class='search'><p>How search works</p></section>" if i == 2 else "")) for i in range(5)]
    got = {r.page_id: r.text for r in templates.extract(pages_of(spark, rows)).collect()}
    own = lambda i: f"T{i} Mix well and serve. own {i}, of some length"
    assert got == {i: own(i) for i in (0, 1, 2, 3, 20, 21, 23, 24)} | {10: own(10) + " Tell a friend", 22: own(22) + " How search works"}


def test_html_equivalence_classes_equal_brute_force(spark):
    """Elements grouped by the vector of their occurrences on every page of a host, spelled out."""
    rng = random.Random(6)
    part = ["<nav><a>m</a></nav>", "<div class='a'><p>x</p></div>", "<div class='b'>y</div>", "<article><h1>t</h1><p>z</p></article>", "<section><h2>s</h2></section>", "<p>q</p>"]
    rows = [(i, f"http://{'abc'[i % 3]}.x/", "<body>" + "".join(p * rng.choice([0, 1, 1, 1, 2]) for p in part) + "</body>") for i in range(30)] + [(100, "http://d.x/", "<body><p>one</p></body>")]
    pages = pages_of(spark, rows).select(templates.host_of().alias("host"), "html")
    want = set()
    for host in "abcd":
        distinct = sorted({h for _, u, h in rows if u == f"http://{host}.x/"})
        found = [templates.elements(h) for h in distinct]
        vectors = {p: tuple(f.get(p, [0])[0] for f in found) for f in found for p in f}
        members = Counter(vectors.values())
        for p, v in vectors.items():
            on = sum(n > 0 for n in v)
            if members[v] >= 2 and 2 * on >= len(distinct):
                want.add((f"{host}.x", templates.token(p), on, sum(f.get(p, [0, 0])[1] for f in found)))
    got = {(r.host, r.token, r.on, r.volume) for r in templates.classes(pages).collect()}
    assert got == want and len(want) > 15


def test_html_without_classes_is_another_result(spark, monkeypatch):
    """The template decides: without it a page gives its body, adverts and all."""
    page = "<html><body><div class='ad'>Buy this</div><article><h1>T</h1><p>own text</p></article></body></html>"
    d = pages_of(spark, [(1, "http://a.x/", page), (2, "http://b.x/", page.replace("article>", "div>"))])
    assert {r.text for r in templates.extract(d).collect()} == {"T own text"}
    real = templates.templates
    monkeypatch.setattr(templates, "templates", lambda pages: real(pages).limit(0))
    assert {r.text for r in templates.extract(d).collect()} == {"Buy this T own text"}


@pytest.mark.parametrize(
    "page,want",
    [
        ("<body class='no-sidebar'><article><h1>T</h1><p>own</p></article></body>", "T own"),
        ("<body class='comments-open'><p>own text</p><div class='sidebar'>side</div></body>", "own text"),
        ("<body><div class='search-page'><article class='post has-comments'><p>own</p><div class='share'>yes</div></article></div></body>", "own yes"),
        ("<body><article><h1>T</h1><p>a b</p><section class='search'><h2>How search works</h2><p>So.</p></section></article></body>", "T a b How search works So."),
        ("<body><article><h1>T</h1><div class='widgets'><p>all of the text</p></div></article></body>", "T all of the text"),
        ("<body><div id='c'><h1>T</h1><p>short text</p></div><div class='x-comments-list'><p>a comment much longer than the text is</p></div></body>", "T short text"),
        ("<body><article><h1>T</h1><p>text</p><div class='ad'>buy</div><ul class='comments'><li>a comment much longer than the text</li></ul></article></body>", "T text"),
        ("<body><div class='ad-wrapper'><article><p>own</p></article></div></body>", "own"),
        ("<body><h1>Forum</h1><section id='discussion'><p>first post of some length</p><p>second</p></section></body>", "Forum first post of some length second"),
        ("<body><article><p>own</p></article><ol class='comments'><article><p>much longer than the article itself</p></article></ol></body>", "own"),
        ("<body><div><p>own</p><p>more</p></div><nav>Menu</nav></body>", "own more"),
    ],
)
def test_html_whole_pages(spark, page, want):
    """Words of class or id on body, or around the text, do not take it; a host of one page keeps its text."""
    got = templates.extract(spark.createDataFrame([(1, "http://a.x/", page)], "page_id long, url string, html string")).first()
    assert got.text == want


def test_html_few_pages(spark):
    """Hosts of two pages, half of a host being copies, and near copies: no page is emptied."""
    page = lambda i: f"<body><div><p>own {i}</p><p>more {i}</p></div></body>"
    rows = [(i, "http://a.x/", page(i)) for i in (1, 2)] + [(10 + i, "http://b.x/", page(i if i < 4 else 0)) for i in range(8)]
    rows += [(20 + i, "http://c.x/", page(7) + f"<footer>{i}</footer>") for i in range(4)]
    got = {r.page_id: r.text for r in templates.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    own = lambda i: f"own {i} more {i}"
    assert got == {1: own(1), 2: own(2)} | {10 + i: own(i if i < 4 else 0) for i in range(8)} | {20 + i: own(7) for i in range(4)}


def test_embeddings(spark):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((12, 16))
    rows = [(i, (base[i % 12] + rng.standard_normal(16) * rng.choice([0.05, 0.2, 0.4])).astype(np.float32).tolist()) for i in range(400)]
    rows += [(500, None), (501, [0.0] * 16), (502, [1.0, None] + [0.0] * 14), (503, [float("nan")] * 16), (504, rows[3][1]), (505, rows[3][1]), (506, []), (507, [1.0, 2.0])]
    d = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, node int")
    want = forest.brute(rows)
    got = {r.vec_id: (r.n_links, r.component_id) for r in forest.near_duplicates(d).collect()}
    assert got == want
    small = {r.vec_id: (r.n_links, r.component_id) for r in forest.near_duplicates(d, leaf=12, sample=64).collect()}  # fitted again, node by node
    assert sum(small[i][0] for i in want) >= 0.9 * sum(w[0] for w in want.values())
    assert all(small[i][0] <= w[0] for i, w in want.items())


def test_embeddings_beyond_the_most_trees(spark, monkeypatch):
    """Where trees would part too many pairs, all pairs are compared in blocks, and none is missed."""
    monkeypatch.setattr(forest, "MOST_TREES", 1)
    rng = np.random.default_rng(12)
    base = rng.normal(size=(60, 12))
    vectors = [(i, (base[i % 60] + rng.normal(size=12) * 0.3).tolist()) for i in range(400)]
    x = forest.units([np.array(v).tobytes() for _, v in vectors])
    assert forest.plant(x, 400.0, 16, 0.9, seed=96) == [[(None, True, 0.0, 0, 0)]]
    d = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in forest.near_duplicates(d, leaf=16).collect()}
    assert got == forest.brute(vectors) and sum(n for n, _ in got.values()) > 100


def test_sharding(spark, docs):
    rows = [*docs, docs[0], *[(1000 + i, "hot text", "en", "a") for i in range(150)]]
    got = sharding.shard(frame(spark, rows), 8).collect()
    assert sorted(r.doc_id for r in got) == sorted(r[0] for r in rows)
    text = {i: t for i, t, *_ in rows}
    slots, sizes = defaultdict(list), defaultdict(int)
    for r in got:
        raw = (text[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r.size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    rest = sorted(sizes.values())[:-1]  # one text holds most bytes
    assert rest[-1] <= 1.3 * rest[0]
    again = sharding.shard(frame(spark, rows[::-1]), 8).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))
    assert sharding.shard(frame(spark, []), 8).count() == 0


@pytest.mark.parametrize("units", [16, 4096])
def test_sharding_groups(spark, units, monkeypatch):
    """Sizes are near equal, equal texts share a shard, and only a group above a whole shard is split; with parts of groups and without."""
    monkeypatch.setattr(sharding, "UNITS", units)
    monkeypatch.setattr(sharding, "PART_GROUPS", 50)
    rng = random.Random(3)
    texts = [" ".join("w" * rng.randint(1, 9) + str(i) for _ in range(rng.randint(1, 60))) for i in range(1500)]
    rows = [(i, t) for i, t in enumerate(texts * 2)] + [(9000 + i, texts[7]) for i in range(40)]
    rows += [(20_000 + i, "hot text " * 30) for i in range(1500)]
    got = sharding.shard(frame(spark, [(i, t, "en", "a") for i, t in rows]), 8).collect()
    text, where, sizes = dict(rows), defaultdict(set), defaultdict(int)
    for r in got:
        where[text[r.doc_id]].add(r.shard)
        sizes[r.shard] += r.size
    assert len(sizes) == 8 and max(sizes.values()) - min(sizes.values()) <= (0.05 if units == 16 else 0.01) * sum(sizes.values()) / 8  # coarse units
    assert {t for t, w in where.items() if len(w) > 1} == {"hot text " * 30}


def test_pack_balances():
    rng = random.Random(5)
    vectors = [(rng.expovariate(1), rng.expovariate(1), 1) for _ in range(4000)]
    load = defaultdict(float)
    for v, b in zip(vectors, sharding.pack(vectors, 8), strict=True):
        load[b[0]] += v[0]
    assert max(load.values()) / min(load.values()) < 1.01


def test_pack_splits_only_what_is_above_a_bin():
    """Five groups of 0.8 in four bins stay whole, though one fits nowhere; one of 1.5 bins goes to pieces; a single row is never split."""
    got = sharding.pack([(10, 10, 10)] * 5, 4, rows=[10] * 5)
    assert [len(b) for b in got] == [1] * 5 and {b[0] for b in got} == {0, 1, 2, 3}
    got = sharding.pack([(30, 30, 600), *[(10, 10, 200)] * 5], 4, rows=[600, *[200] * 5])
    assert len(got[0]) == 384 and set(got[0]) == {0, 1, 2, 3} and [len(b) for b in got[1:]] == [1] * 5
    assert len(sharding.pack([(9, 9, 1), (1, 1, 1)], 4, rows=[1, 1])[0]) == 1


def test_pack_equals_brute_force():
    """The rule in words: heaviest first, to the bin with room whose residual capacity has the highest dot product, else to the emptiest."""
    rng = random.Random(8)
    for bins in (2, 3, 8):
        vectors = [(rng.choice([1, 2, 5, 40]), rng.randint(1, 9), 1) for _ in range(60)]
        total = [sum(v[k] for v in vectors) for k in range(3)]
        left = [[1 / bins] * 3 for _ in range(bins)]
        want = [0] * len(vectors)
        share = [[v[k] / total[k] for k in range(3)] for v in vectors]
        for i in sorted(range(len(vectors)), key=lambda i: (-share[i][0], -sum(x * w for x, w in zip(share[i], sharding.WEIGHTS)), i)):
            room = [b for b in range(bins) if left[b][0] >= share[i][0]]
            score = lambda b: sum(w * x * y for w, x, y in zip(sharding.WEIGHTS, share[i], left[b]))  # noqa: B023, E731
            b = max(room, key=lambda b: (round(score(b), 15), -b)) if room else max(range(bins), key=lambda b: (left[b][0], -b))
            want[i] = b
            left[b] = [x - y for x, y in zip(left[b], share[i])]
        got = [b[0] for b in sharding.pack(vectors, bins)]
        load = lambda at: sorted(sum(v[0] for v, b in zip(vectors, at) if b == k) for k in range(bins))  # noqa: B023, E731
        assert load(got) == load(want)  # vectors that tie may change places


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_no_text_of_the_given_tables_is_in_two_shards(spark, sf):
    import os

    if not os.path.isdir(f"/root/testdata/{sf}"):
        pytest.skip("no test tables")
    d = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    got = {r.doc_id: r for r in sharding.shard(d, 8).collect()}
    where, sizes, rows = defaultdict(set), defaultdict(int), defaultdict(int)
    for r in d.select("doc_id", "text").collect():
        where[r.text].add(got[r.doc_id].shard)
        sizes[got[r.doc_id].shard] += got[r.doc_id].size
        rows[r.text] += 1
    whole = {t for t, n in rows.items() if n * 8 <= len(got) and n * (len((t or "").encode()) + 1) * 8 <= sum(sizes.values())}
    assert all(len(where[t]) == 1 for t in whole)
    assert max(sizes.values()) - min(sizes.values()) <= 0.02 * sum(sizes.values()) / 8


def test_mixing(spark, docs):
    got = mixing.mix(frame(spark, docs)).collect()
    by, size, target = defaultdict(int), {}, {}
    for r in got:
        assert 0 <= r.copies <= 3 and len(r.places) == r.copies and all(0 <= p.out_shard < 8 for p in r.places)
        by[r.source] += r.copies * r["size"]
        size[r.source], target[r.source] = r.source_size, r.target
    names = sorted(size, key=lambda s: (s is None, s or ""))
    assert [target[s] for s in names] == pytest.approx(mixing.targets([size[s] for s in names], [5, 2, 1, 5, 2][: len(names)]))
    longest = {s: max(r["size"] for r in got if r.source == s) for s in names}  # documents are taken whole
    for s in names:
        assert abs(by[s] - target[s]) <= max(50, 0.05 * target[s], longest[s] / 2)
    assert sorted((r.doc_id, r.copies) for r in got) == sorted((r.doc_id, r.copies) for r in mixing.mix(frame(spark, docs[::-1])).collect())
    drawn = mixing.draw(frame(spark, docs))
    assert drawn.columns == frame(spark, docs).columns and drawn.count() == sum(r.copies for r in got)
    assert mixing.mix(frame(spark, [])).count() == 0


def test_mixing_draws_blocks(spark, monkeypatch):
    """The tree's quotas decide what is taken: shards hold as many blocks of a source as their quotas say, and no quota takes nothing."""
    rng = random.Random(2)
    rows = [(i, " ".join("w" for _ in range(rng.randint(1, 40))), "en", f"s{i % 3}") for i in range(4000)]
    seen: list = []
    real = mixing.split

    def watched(quotas, shards, seed):
        seen.append(real(quotas, shards, seed))
        return seen[-1]

    monkeypatch.setattr(mixing, "split", watched)
    monkeypatch.setattr(mixing, "BLOCK_ROWS", 50)
    got = mixing.mix(frame(spark, rows)).collect()
    taken = {(r.doc_id, p.out_shard) for r in got for p in r.places}
    rows_by = defaultdict(int)
    for r in got:
        for p in r.places:
            rows_by[int(r.source[1]), p.out_shard] += 1
    quota = seen[0]
    assert quota.sum() > 60 and len(taken) > 3000
    for (s, shard), n in rows_by.items():  # about 50 rows a block
        assert quota[s, shard] > 0 and abs(n / 50 - quota[s, shard]) <= 0.4 * quota[s, shard] + 1
    size = {i: len(t.split()) for i, t, *_ in rows}
    target = {r.source: r.target for r in got}
    for s, want in target.items():
        assert abs(sum(r.copies * size[r.doc_id] for r in got if r.source == s) - want) <= 20
    monkeypatch.setattr(mixing, "split", lambda quotas, shards, seed: 0 * real(quotas, shards, seed))
    assert all(r.copies == 0 for r in mixing.mix(frame(spark, rows)).collect())


def test_mixing_most(spark):
    """``most`` bounds targets and copies, whatever it is."""
    rows = [(i, "a b c d", "en", "big" if i < 400 else "tiny") for i in range(420)]
    for most in (1.0, 4.0):
        got = mixing.mix(frame(spark, rows), weights={"tiny": 1.0, "big": 1.0}, most=most).collect()
        assert max(r.copies for r in got) <= most and sum(r.copies * r["size"] for r in got if r.source == "tiny") == most * 80


def test_targets_and_tree():
    assert mixing.targets([10, 10, 100], [5, 2, 1]) == pytest.approx([30, 30, 60])
    quota = mixing.split([100, 30, 7], 8, 3)
    assert quota.sum(1).tolist() == [100, 30, 7] and max(quota.sum(0)) - min(quota.sum(0)) <= 3 and (quota == mixing.split([100, 30, 7], 8, 3)).all()


def test_substrings(spark, docs, monkeypatch):
    want = substrings.brute([(i, t) for i, t, *_ in docs])
    assert {r.doc_id: tuple(r)[1:] for r in substrings.dedup(frame(spark, docs)).collect()} == want
    monkeypatch.setattr(substrings, "HOT", 1)  # every repeated gram is dealt by windows
    assert {r.doc_id: tuple(r)[1:] for r in substrings.dedup(frame(spark, docs)).collect()} == want
    assert substrings.dedup(frame(spark, [])).count() == 0


def test_fm_index():
    rng = np.random.default_rng(1)
    text = np.append(rng.integers(1, 5, 300), 0)
    index = substrings.FMIndex(text)
    for size in (1, 3, 13):
        start = np.arange(0, 280, 7)
        lo, hi = index.find(text, start, size)
        for s, a, b in zip(start, lo, hi, strict=True):
            want = [i for i in range(len(text) - size + 1) if (text[i : i + size] == text[s : s + size]).all()]
            assert sorted(index.sa[a:b].tolist()) == want


def test_matching_statistics():
    """Lengths and intervals against brute force."""
    rng = np.random.default_rng(2)
    text = rng.integers(1, 4, 400)
    text[24::25] = 0  # pieces of 24 words, each with its holder
    holder = np.repeat(rng.integers(0, 5, 16), 25).astype(np.int32)
    ends = np.flatnonzero(np.arange(400) % 25 % 11 >= 2)
    ends = ends[(ends % 25 >= 12) & (ends % 25 < 24)]
    own = rng.integers(0, 5, len(ends)).astype(np.int32)
    got = substrings.FMIndex(text).matching(holder, text, ends, own)
    for e, o, n in zip(ends, own, got, strict=True):
        ok = lambda k: any(holder[i] < o and (text[i : i + k] == text[e - k + 1 : e + 1]).all() for i in range(len(text) - k + 1))  # noqa: B023, E731
        assert n == max([k for k in range(1, substrings.WINDOW + 1) if ok(k)], default=0)
    base = rng.integers(1, 1 << 60, 60).astype(np.uint64)
    segments, ids = [base[:40], base[20:60], base[5:30], rng.integers(1, 1 << 60, 20).astype(np.uint64)], np.array([7, 9, 3, 1])
    bounds, froms, tos = substrings.repeats([s.tobytes() for s in segments], ids)
    assert [list(zip(froms[a:b], tos[a:b], strict=True)) for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == [[(5, 30)], [(0, 20)], [], []]


def test_substrings_of_different_segments(spark, monkeypatch):
    """One passage in different segments: what is removed comes from the index, for usual grams and for hot ones."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdef") for _ in range(6))
    passage = [word() for _ in range(40)]
    texts = [(i, " ".join([word() for _ in range(20)] + passage[rng.randrange(10) : 40 - rng.randrange(10)] + [word() for _ in range(9)])) for i in range(60)]
    d = frame(spark, [(i, t, "en", "a") for i, t in texts])
    want = substrings.brute(texts)
    for hot in (2_000, 1):
        monkeypatch.setattr(substrings, "HOT", hot)
        assert {r.doc_id: tuple(r)[1:] for r in substrings.dedup(d).collect()} == want


def test_quality(spark):
    rng = random.Random(8)
    good = lambda: " ".join(rng.choice(["the", "river", "runs", "over", "stones", "and", "grass", "in", "morning", "light"]) for _ in range(60))
    junk = lambda: " ".join("".join(rng.choice("QXZ#%&!0") for _ in range(6)) for _ in range(60))
    rows = [(i, junk() if i % 5 == 0 else good(), "en", "a") for i in range(400)]
    rows += [(1000, None, "en", "a"), (1001, "", None, "a"), (1002, "quelque chose", "fr", "a"), (1003, junk(), None, "a")]
    labels = spark.createDataFrame([(i, int(i % 5 > 0), 0) for i in range(300)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality.classify(frame(spark, rows), labels).collect()}
    held_out = [got[i] for i in range(300, 400)]
    assert sum(r.kept == (r.doc_id % 5 > 0) for r in held_out) >= 97
    assert (got[1000].kept, got[1001].kept, got[1002].kept, got[1003].kept) == (False, False, True, True)
    assert got[1002].threshold is None and len(got) == len(rows)
    none = quality.classify(frame(spark, rows), labels.limit(0)).collect()
    assert all(r.kept for r in none if r.doc_id < 1000)


def kneser_ney(texts):
    """p(gram) of interpolated modified Kneser-Ney by dictionaries: the last character after those before it."""
    n, count = quality.ORDER, {}
    count[n] = defaultdict(int)
    for t in texts:
        t = quality.PAD + t
        for i in range(len(t) - n + 1):
            count[n][t[i : i + n]] += 1
    for k in range(n - 1, 0, -1):
        count[k] = defaultdict(int)
        for g in count[k + 1]:
            count[k][g[1:]] += 1
    discount = {}
    for k, c in count.items():
        n1, n2, n3, n4 = (sum(v == j for v in c.values()) for j in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2) if n1 + n2 else 0.5
        raw = [j - (j + 1) * y * b / a if a else 0.5 * j for j, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
        discount[k] = [min(max(d, 0.1), 0.95 * j) for j, d in zip((1, 2, 3), raw, strict=True)]

    def p(g):
        if not g:
            return 1 / (len(count[1]) + 1)
        c, d = count[len(g)], discount[len(g)]
        of = {x: v for x, v in c.items() if x[:-1] == g[:-1]}
        if not of:
            return p(g[1:])
        cut = lambda v: d[min(v, 3) - 1]
        return max(c.get(g, 0) - (cut(c[g]) if g in of else 0), 0) / sum(of.values()) + sum(map(cut, of.values())) / sum(of.values()) * p(g[1:])

    return p, sorted(count[1])


def test_quality_model(spark):
    """Probabilities equal those of a model in dictionaries, seen grams and unseen, and sum to one over characters."""
    rng = random.Random(4)
    texts = ["".join(rng.choice("aaabbc d") for _ in range(rng.randint(0, 40))) for _ in range(60)]
    p, characters = kneser_ney(texts)
    counts: dict = defaultdict(int)
    for t in texts:
        for i in range(len(t)):
            counts[(quality.PAD + t)[i : i + quality.ORDER]] += 1
    model = quality.Model(spark.createDataFrame([("en", g, n) for g, n in counts.items()], "lang string, gram string, n long"))
    heads = ["aab", "\n\n\n", "ddd", "dcx", "xyz", "zab"]
    asked = sorted({h + c for h in heads for c in [*characters, "?"]} | set(list(counts)[:200]))
    got = {r.gram: np.exp(-r.loss) for r in model.losses(spark.createDataFrame([("en", g) for g in asked], "lang string, gram string")).collect()}
    assert got == pytest.approx({g: p(g) for g in asked})
    for h in heads:
        assert sum(got[h + c] for c in [*characters, "?"]) == pytest.approx(1)


def test_quality_rows(spark):
    """Null ids, repeated rows, one very long text, and an empty table."""
    rng = random.Random(1)
    good = lambda n=40: " ".join(rng.choice(["the", "river", "runs", "over", "stones"]) for _ in range(n))
    rows = [(i, good(), "en", "a") for i in range(600)] + [(None, good(), "en", "a"), (None, None, None, None), (700, good(200_000), "en", "a"), (650, good(), "en", "a"), (650, "QXZ#%&!0" * 40, "en", "a")]
    rows += [rows[5]] * 3
    labels = spark.createDataFrame([(i, 1, 0) for i in range(600)], "doc_id long, quality int, toxic int")
    got = quality.classify(frame(spark, rows), labels).collect()
    assert len(got) == len(rows) and sum(r.kept for r in got) >= 585
    assert sorted(r.kept for r in got if r.doc_id == 650) == [False, True] and [r.kept for r in got if r.doc_id == 700] == [True]
    assert sorted(r.kept for r in got if r.doc_id is None) == [False, True]
    assert quality.classify(frame(spark, []), labels).count() == 0
    kept = quality.kept_documents(frame(spark, rows), labels)
    assert kept.where("doc_id = 650").count() == 0 and kept.columns == frame(spark, []).columns


def test_empty_tables_and_null_ids(spark):
    """No rows give no rows; rows without an id stay, link with nothing and lose nothing."""
    empty = frame(spark, [])
    assert secrets.digest(secrets.findings(empty, secrets.scan_new(empty))).count() == 0
    assert minhash.near_duplicates(empty).count() == 0
    assert templates.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
    assert forest.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    text = " ".join(f"w{i}" for i in range(40))
    d = frame(spark, [(1, text, "en", "a"), (None, text, "en", "a"), (None, text, "en", "a"), (2, text, "en", "a"), (2, text, "en", "a")])
    assert sorted((r.doc_id or 0, r.n_removed) for r in substrings.dedup(d).collect()) == [(0, 0), (0, 0), (1, 0), (2, 40), (2, 40)]
    assert sorted((r.doc_id or 0) for r in minhash.kept_documents(d).collect()) == [0, 0, 1]
    assert sorted((r.doc_id or 0, r.n_hit) for r in decontaminate.overlaps(d, spark.createDataFrame([(1, text)], "item_id long, text string")).collect()) == [(0, 40), (0, 40), (1, 40), (2, 40), (2, 40)]
    assert len(sharding.shard(d).collect()) == 5 and mixing.mix(d).count() == 5
    assert sorted((r.doc_id or 0) for r in licenses.scan(d).collect()) == [0, 0, 1, 2, 2]


def test_quality_by_language(spark):
    """A rare language keeps its rows in a bounded sample, and one with few held-out rows has a threshold."""
    rng = random.Random(9)
    good = lambda: " ".join(rng.choice(["the", "river", "runs", "over", "stones", "and", "grass", "in", "morning", "light"]) for _ in range(60))
    rows = [(i, good(), "en" if i >= 60 else "fr", "a") for i in range(600)] + [(900, "QXZ#%&!0" * 40, "fr", "a")]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(600)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality.classify(frame(spark, rows), labels, trusted=100).collect()}
    assert not got[900].kept and got[0].threshold is not None
    assert sum(got[i].kept for i in range(600)) >= 570
