"""Packing, hard negatives and conversation repair against brute force."""

from __future__ import annotations

import functools
import hashlib
import itertools
import math
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from gridloom.llm import negatives, packing, queries, repair

# ------------------------------------------------------------------------------------------------------------- packing

P = pytest.importorskip("public_tokenizers")
TEXTS = [
    (1, "The cat's HAT, don't sit!"), (2, ""), (3, None), (4, "a<|endoftext|>b c"), (5, "naïve “quote”.x ÉCOLE T̈ ẗ １２ 日本"), (6, "word " * 5000), (6, "word " * 5000), (7, "x" * 30_000), (None, "no id"),
    (8, " \t\n\x0b"), (9, "1234 'S ''s !'s 9'll"), (10, "\x00\x1f a　b"),
]


def tokens(text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(P.path("word_bpe_49k.json")).encode(text or "", add_special_tokens=False).ids + [1]


def test_packing_equals_the_tokenizer(spark):
    docs = spark.createDataFrame([(i, t, 7) for i, t in TEXTS], "doc_id long, text string, length long").repartition(3)
    out = packing.pack(packing.pieces(docs, P.path("word_bpe_49k.json"))).collect()
    of = defaultdict(list)
    for r in out:
        of[r.doc_id].append(r)
        assert r.length in {1 << b for b in range(12)} and r.offset == 0 and len(r.ids) == r.length
        assert r.ids_crc32 == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in r.ids))
    assert sorted(r.sequence_id for r in out) == list(range(len(out)))
    ordered = [r.length for r in sorted(out, key=lambda r: r.sequence_id)]
    assert ordered == sorted(ordered, reverse=True)
    for i, t in dict(TEXTS).items():
        want, got = tokens(t), sorted(of[i], key=lambda r: r.start)
        times = sum(x == (i, t) for x in TEXTS)
        assert sorted([len(want)] * times) == sorted(r.doc_tokens for r in got if r.start == 0)
        for r in got:
            assert r.ids == want[r.start : r.start + r.length]
        lengths = [r.length for r in got[::times]]
        assert sum(lengths) == len(want) and lengths == sorted(lengths, reverse=True) and len(set(lengths[lengths.count(2048) :])) == len(lengths) - lengths.count(2048)


def test_packing_empty_and_bounds(spark, tmp_path):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(packing.pieces(none, P.path("word_bpe_49k.json"))).count() == 0
    with pytest.raises(ValueError, match="power"):
        packing.pieces(none, P.path("word_bpe_49k.json"), most=1000)
    docs = spark.createDataFrame([(i, "some words here " * i) for i in range(1, 40)], "doc_id long, text string")
    packed = packing.pack(packing.pieces(docs, P.path("word_bpe_49k.json"), most=16), rows_a_bucket=5)
    packing.write_buckets(packed, str(tmp_path / "b"))
    back = spark.read.parquet(str(tmp_path / "b"))
    assert back.where("size(ids) != length").count() == 0 and back.agg(F.sum("length")).first()[0] == sum(len(tokens("some words here " * i)) for i in range(1, 40))
    ids = sorted(r[0] for r in packed.select("sequence_id").collect())
    assert ids == list(range(len(ids)))


def test_forgetting_words_changes_nothing(spark, monkeypatch):
    import pyarrow as pa

    with open(P.path("word_bpe_49k.json"), encoding="utf-8") as f:
        encoder = packing.WordEncoder(f.read())
    monkeypatch.setattr(packing, "KEPT", 3)
    for _ in range(2):
        for text in ("one two three four", "five two", None, "six's Seven"):
            assert encoder.encode(pa.array([text], pa.string()))[0].tolist() == tokens(text)[:-1]


# ------------------------------------------------------------------------------------------------------ hard negatives


def mined(rows):
    """(anchor, positive, rank, negative, scores) by comparing every anchor with every row."""
    usable = list({(i, lab, tuple(v)) for i, lab, v in rows if lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)})
    usable = [(2**63 - 1 if i is None else i, lab, [math.floor(256 * x) for x in v]) for i, lab, v in usable]
    out = []
    for k, (a, lab, v) in enumerate(usable):
        if a % 100 or a == 2**63 - 1:
            continue
        scored = [(-sum(x * y for x, y in zip(v, u)), i, m == lab) for j, (i, m, u) in enumerate(usable) if j != k]
        for s, p, _ in sorted(x for x in scored if x[2])[:5]:
            fit = sorted(x for x in scored if not x[2] and 80 * -s <= 100 * -x[0] <= 100 * -s)[:5]
            out.extend((a, p, r, None if n == 2**63 - 1 else n, -s, -t) for r, (t, n, _) in enumerate(fit, 1))
    return sorted(out, key=str)


def test_negatives_equal_brute_force(spark):
    rng = random.Random(5)
    base = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(12)]
    rows = [(i, rng.randrange(3), [x + rng.gauss(0, 0.4) for x in rng.choice(base)]) for i in range(900)]
    rows += [(i, rng.randrange(3), base[0]) for i in range(900, 1000)]  # ties
    rows += [(1000, 1, None), (1100, None, base[1]), (1200, 1, [math.nan] * 6), (1300, 1, [None] * 6), (1400, 1, [math.inf] * 6), (1500, 2, [0.0] * 6), (1600, 0, [-x for x in base[2]]), (None, 1, base[0]), rows[5], rows[5], (1700, 1, [1.0, 2.0]), (1800, 1, [])]
    df = spark.createDataFrame([(i, v, lab, "x") for i, lab, v in rows], "vec_id long, embedding array<double>, label int, score string")
    for size in (16, 200, 100_000):
        got = negatives.mine(df.repartition(5), block_rows=size).collect()
        assert sorted(map(tuple, got), key=str) == mined(rows)
    assert len(got) > 100


def test_negatives_few_rows_and_large_numbers(spark):
    kind = "vec_id long, embedding array<double>, label int"
    assert negatives.mine(spark.createDataFrame([], kind)).count() == 0
    one = spark.createDataFrame([(0, [1.0], 0)], kind)
    assert negatives.mine(one).count() == 0
    huge = [(0, 0, [2.0**30, 1.0]), (1, 0, [2.0**14, 0.0]), (2, 1, [2.0**14 - 1, 5.0]), (3, 1, [2.0**14 - 1, 4.0])]
    got = negatives.mine(spark.createDataFrame([(i, v, lab) for i, lab, v in huge], kind)).collect()
    assert sorted(map(tuple, got), key=str) == mined(huge) and len(got) == 2 and got[0].positive_score > 2**59


def test_threshold_stops_early():
    import numpy as np

    x = np.zeros((5000, 3))
    x[:, 0] = np.arange(5000) / 100
    block = negatives.Block(np.arange(5000), np.arange(5000), np.zeros(5000), x)
    read = []

    class Seen(np.ndarray):
        def __getitem__(self, at):
            if isinstance(at, np.ndarray) and at.dtype != bool:
                read.append(len(at))
            return np.asarray(self)[at]

    block.x = block.x.view(Seen)
    best = block.search(np.array([256.0, 0, 0]), np.ones(5000, bool), [(-math.inf, math.inf)], 5)
    assert [i for i, _ in best[0]] == [4999, 4998, 4997, 4996, 4995] and sum(read) < 100


# ------------------------------------------------------------------------------------------------- conversation repair

SPACE = " \t\n\x0b\x0c\r"


def after(conversations):
    """Rows after damage by conversation."""
    out = defaultdict(list)
    for conv, turn, role, text in conversations:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        row = (turn, "user" if kind == 4 else role, "" if kind == 1 else re.sub(r"[.!?]", "", text) if kind == 2 else text)
        out[conv] += [row] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return {c: sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).digest())) for c, rows in out.items()}


def repaired(rows):
    """The whole answer for one conversation: cheapest edits by recursion from the end."""
    faults, seen = [], set()
    for _, role, text in rows:
        bare = text.rstrip(SPACE)
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    step = lambda q, c: {"0s": "s", "0u": "u", "su": "u", "ua": "a", "au": "u"}.get(q + c)

    @functools.cache
    def best(i, q, inserts):
        options = []
        if i == len(rows) and q in "0a":
            options.append((0, "", ()))
        moves = [(5, "I", 0, c, ("user" if c == "u" else "assistant") + ":") for c in "ua" if inserts < 3]
        if i < len(rows):
            _, role, text = rows[i]
            moves.append((2, "D", 1, None, None))
            if faults[i] not in ("blank", "duplicate"):
                more = 5 * (faults[i] == "truncated")
                moves += [(1 + more, "R", 1, c, ("user" if c == "u" else "assistant") + ":" + text) for c in "ua"]
                moves.append((more, "K", 1, role[:1], f"{role}:{text}"))
        for cost, letter, on, c, said in moves:
            then = q if not c else step(q, c)
            if then is None:
                continue
            rest = best(i + on, then, inserts + 1 if letter == "I" else 0)
            if rest is not None:
                options.append((cost + rest[0], letter + rest[1], (() if said is None else (said,)) + rest[2]))
        return min(options, default=None)

    for i, q, k in itertools.product(reversed(range(len(rows) + 1)), "0sua", (3, 2, 1, 0)):
        best(i, q, k)
    cost, audit, said = best(0, "0", 0)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
    return gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(said).encode()).hexdigest()


def answers(conversations):
    own = after(conversations)
    return sorted(((c, *repaired(own.get(c, []))) for c in {c for c, *_ in conversations}), key=str)


def made(n, seed, longest=9):
    rng = random.Random(seed)
    said = ["Hello.", "How?", "cut", "", " \t", "Fine!", "Fine! ", None, "x.\x0b", "ünï."]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "super"]
    return [(c if c else None, t if rng.random() > 0.03 else None, rng.choice(roles) if rng.random() < 0.4 else ("user", "assistant")[t % 2], rng.choice(said)) for c in range(n) for t in sorted(rng.sample(range(12), rng.randint(1, longest)))]


COLUMNS = "conv_id long, turn long, role string, text string, cost string"


def test_repair_equals_brute_force(spark):
    rows = made(300, 3)
    rows += [rows[40], rows[41], rows[41]]  # repeated rows
    df = spark.createDataFrame([(*r, "x") for r in rows], COLUMNS).repartition(4)
    got = repair.repair(repair.damaged(df)).collect()
    assert sorted(map(tuple, got), key=str) == answers(rows)


def test_one_long_conversation_is_many_parts(spark, monkeypatch):
    """A conversation that fills most ranges, in small blocks as well."""
    rng = random.Random(9)
    rows = [(7, t, rng.choice(["user", "assistant", "system"]), rng.choice(["yes.", "no", f"n{t}.", f"m{t}", ""])) for t in range(400)] + [(c, t, ("user", "assistant")[t], "Hi.") for c in (1, 9) for t in (0, 1)]
    df = spark.createDataFrame([(*r, "x") for r in rows], COLUMNS)
    spark.conf.set("spark.sql.shuffle.partitions", "6")
    try:
        got = sorted(map(tuple, repair.repair(repair.damaged(df)).collect()), key=str)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert got == answers(rows)
    own = [repair.Row(t, role, 0 if text.endswith(".") else 3, 1, text) for _, t, role, text in rows[:60]]
    want = repair.cheapest(own)
    monkeypatch.setattr(repair, "BLOCK", 7)
    assert repair.cheapest(own) == want and repair.ways(own)[0][0 if want is None else 3] is not None


def test_repair_edges(spark):
    none = spark.createDataFrame([], COLUMNS)
    assert repair.repair(repair.damaged(none)).count() == 0
    gone = [(c, 0, "user", "Hi.") for c in range(200) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    df = spark.createDataFrame([(*r, "x") for r in gone], COLUMNS)
    empty = hashlib.sha256(b"").hexdigest()
    assert {tuple(r)[1:] for r in repair.repair(repair.damaged(df)).collect()} == {(0, 0, 0, 0, 0, 0, "", empty)}
    long = [(c, 0, "user", "y" * 500_000 + ".") for c in range(4)] + [(5, None, None, None), (None, None, None, None)]
    df = spark.createDataFrame([(*r, "x") for r in long], COLUMNS)
    assert sorted(map(tuple, repair.repair(repair.damaged(df)).collect()), key=str) == answers(long)


@pytest.mark.parametrize("name", ["op11_packing", "op12_hard_negatives", "op13_conversation_repair"])
def test_queries_over_given_tables(spark, name):
    import os

    data = "/root/testdata/sf0.001"
    if not os.path.isdir(data):
        pytest.skip("no test tables")
    got = [tuple(r) for r in queries.QUERIES[name](spark, data).collect()]
    if name == "op11_packing":
        docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()
        want = [(d.doc_id, s, n, zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids[s : s + n])), len(ids)) for d in docs for ids in [tokens(d.text)] for s, n in zip(itertools.accumulate([0, *packing.lengths(len(ids))]), packing.lengths(len(ids)))]
        assert sorted(r[:5] for r in got) == sorted(want)
    elif name == "op12_hard_negatives":
        rows = [(r.vec_id, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label, r.embedding) for r in spark.read.parquet(f"{data}/embeddings.parquet").collect()]
        assert sorted(got, key=str) == mined(rows) and got
    else:
        rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{data}/conversations.parquet").collect()]
        assert sorted(got, key=str) == answers(rows)


def test_sql_repairs_alike():
    """The oracle's recursive query against the recursion from the end, over nulls, odd roles and every kind of damage."""
    duckdb = pytest.importorskip("duckdb")
    import pandas as pd

    rows = made(60, 8)
    db = duckdb.connect()
    db.register("given", pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]).astype({"conv_id": "Int64", "turn": "Int64"}))
    db.execute("CREATE TABLE conversations AS SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, CAST(role AS VARCHAR) AS role, CAST(text AS VARCHAR) AS text FROM given")
    assert sorted(db.execute(repair.oracle()).fetchall(), key=str) == answers(rows)
