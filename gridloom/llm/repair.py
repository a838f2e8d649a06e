"""Conversation structure repair by lightest derivations: Knuth's agenda over weighted deductions.

Items say that the first i rows of a conversation are repaired and that the roles so far leave an automaton for ``(s?(ua)+)?`` in a state.
An edit of the next row, or an inserted row, derives another item; its weight is a cost and a letter. An item's value is (cost, audit): costs
add up and letters are appended, so a value never falls below the one it came from, and better values stay better. Hence
the agenda's least item is final when it is popped, and the goal's first pop is the cheapest repair with the least audit. (Two
repairs of the same rows with equal costs are never a prefix of each other: inserts alone could follow, and they cost something.)

Rows are dealt by ranges of (conversation, turn, role, text), so a conversation of any size is many tasks' work. A task derives whole those
conversations that lie between others in its range; of its first and last one it derives the lightest way between each two states, and
these become the edges of one more agenda over the parts of a conversation. Long parts are taken in blocks likewise. Only a
conversation that passes a border of ranges (fewer than there are ranges) is read again, in order and row by row, as a hash of its
repaired text can't be put together from parts.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, spread

#: States: nothing yet, after the system row, after a user row, after an assistant row. What a state takes, what it misses, where it may end.
TAKES = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
MISSES = (("user", 2), ("user", 2), ("assistant", 3), ("user", 2))
ENDS = (0, 3)
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
LEGAL = {"su", "ua", "au"}
#: Rows that one agenda sees; longer stretches are edges of the next.
BLOCK = 1024
_FAULTS = ("", "blank", "duplicate", "truncated")

Edge = tuple[int, int, int, str]  # to place, to state, cost, letters


class Row(NamedTuple):
    """``copies`` equal rows; ``text`` is held where the first copy may stay."""

    turn: int | None
    role: str
    fault: int
    copies: int
    text: str | None


def lightest(start: int, end: int, edges: Callable[[int, int], Iterable[Edge]], goal: bool) -> dict[int, tuple[int, str]]:
    """Agenda from (place 0, state ``start``): values of the states at place ``end``; with ``goal``, only the best of those that may end."""
    agenda: list[tuple[int, str, int, int]] = [(0, "", 0, start)]
    final: set[tuple[int, int]] = set()
    out: dict[int, tuple[int, str]] = {}
    while agenda:
        cost, audit, place, state = heapq.heappop(agenda)
        if (place, state) in final:
            continue
        final.add((place, state))
        if place == end and (not goal or state in ENDS):
            out[state] = cost, audit
            if goal or len(out) == len(TAKES):
                break
        for to, then, weight, letters in edges(place, state):
            if (to, then) not in final:
                heapq.heappush(agenda, (cost + weight, audit + letters, to, then))
    return out


def row_edges(rows: list[Row]) -> Callable[[int, int], Iterator[Edge]]:
    """Edits of rows; equal copies that must all go are one step, as an insert after deletions is the lesser audit."""
    steps: list[tuple[str, int, int]] = []  # initial, what staying costs besides (-1: it must go), rows
    for r in rows:
        stays = r.fault in (0, 3)
        if stays:
            steps.append((r.role[:1], TRUNCATED * (r.fault == 3), 1))
        if r.copies > stays:
            steps.append(("", -1, r.copies - stays))

    def edges(place: int, state: int) -> Iterator[Edge]:
        role, missed = MISSES[state]
        yield place, missed, INSERT, "I"
        if place == len(steps):
            return
        initial, stay, n = steps[place]
        yield place + 1, state, DELETE * n, "D" * n
        if stay >= 0:
            yield place + 1, missed, REROLE + stay, "R"
            if not initial:
                yield place + 1, state, stay, "K"
            elif initial in TAKES[state]:
                yield place + 1, TAKES[state][initial], stay, "K"

    edges.steps = len(steps)
    return edges


def ways(rows: list[Row]) -> dict[int, dict[int, tuple[int, str]]]:
    """Lightest value from each state before the rows to each state after them."""
    if len(rows) <= BLOCK:
        edges = row_edges(rows)
        return {p: lightest(p, edges.steps, edges, False) for p in range(len(TAKES))}
    blocks = [ways(rows[i : i + BLOCK]) for i in range(0, len(rows), BLOCK)]
    return {p: lightest(p, len(blocks), chain(blocks), False) for p in range(len(TAKES))}


def chain(parts: list[dict[int, dict[int, tuple[int, str]]]]) -> Callable[[int, int], Iterator[Edge]]:
    """Parts of a conversation as edges."""
    return lambda place, state: ((place + 1, q, *v) for q, v in parts[place].get(state, {}).items()) if place < len(parts) else iter(())


def cheapest(rows: list[Row]) -> tuple[int, str]:
    if len(rows) <= BLOCK:
        edges = row_edges(rows)
        found = lightest(0, edges.steps, edges, True)
    else:
        blocks = [ways(rows[i : i + BLOCK]) for i in range(0, len(rows), BLOCK)]
        found = lightest(0, len(blocks), chain(blocks), True)
    return next(iter(found.values()))


class Replay:
    """Edits applied to rows in order: the repaired conversation's hash."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state, self.hash, self.any = audit, 0, 0, hashlib.sha256(), False

    def _put(self, role: str, text: str) -> None:
        self.hash.update((("\n" if self.any else "") + role + ":" + text).encode())
        self.any = True

    def _miss(self, text: str) -> None:
        role, self.state = MISSES[self.state]
        self._put(role, text)

    def row(self, r: Row) -> None:
        for n in range(r.copies):
            while self.audit[self.at] == "I":
                self._miss("")
                self.at += 1
            letter = self.audit[self.at]
            if letter == "R":
                self._miss(r.text)
            elif letter == "K":
                self._put(r.role, r.text)
                self.state = TAKES[self.state][r.role[0]] if r.role else self.state
            self.at += 1
            if n == 0 and r.fault not in (0, 3) or n == 1:  # the rest must go too
                self.at += r.copies - 1 - n
                break

    def end(self) -> str:
        for _ in self.audit[self.at :]:
            self._miss("")
        return self.hash.hexdigest()


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): rows damaged by the CRC of ``conv_id:turn`` modulo 20: 0 dropped (no copies), 1 emptied, 2 without
    ``[.!?]``, 3 twice, 4 given to the user. A null is one space."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind, role, text = F.crc32(key.cast("binary")) % 20, F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    return conversations.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"), F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


_KEY = ("conv_id", "turn", "role", "digest")
_OUT = "conv_id long, part int, parts int, rows long, low long, high long, turns long, first string, last string, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string, ways array<struct<p:int,q:int,cost:bigint,audit:string>>"
_TYPES = {"part": pa.int32(), "parts": pa.int32(), "first": pa.string(), "last": pa.string(), "audit": pa.string(), "repaired_sha256": pa.string(), "ways": pa.list_(pa.struct([("p", pa.int32()), ("q", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))}
_NAMES = [c.split()[0] for c in _OUT.split(", ")[:16]] + ["ways"]


def _emit(found: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x.get(n) for x in found], _TYPES.get(n, pa.int64())) for n in _NAMES], names=_NAMES)


def _counts(rows: list[Row]) -> dict:
    """What a stretch of rows adds to the counts, and what its ends are."""
    turns = [r.turn for r in rows if r.turn is not None]
    out = {"rows": sum(r.copies for r in rows), "low": min(turns, default=None), "high": max(turns, default=None), "turns": len(set(turns)), "first": rows[0].role[:1] if rows else None, "last": rows[-1].role[:1] if rows else None}
    tally = dict.fromkeys(_FAULTS, 0)
    for r in rows:
        tally[_FAULTS[r.fault]] += 1 if r.fault in (0, 3) else r.copies
        if r.fault in (0, 3):
            tally["duplicate"] += r.copies - 1
    out |= {k: tally[k] for k in _FAULTS[1:]}
    out["illegal"] = sum(r.copies - 1 for r in rows) + sum(a.role[:1] + b.role[:1] not in LEGAL for a, b in zip(rows, rows[1:], strict=False))
    return out


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, Row | None, str | None]]:
    """(conversation, its next rows, or its edits) out of sorted records: a key's text, if it is held, comes before its counts."""
    text: str | None = None
    for batch in batches:
        col = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("conv_id", "turn", "role", "kind", "n", "blank", "unended", "text")]
        for conv, turn, role, kind, n, blank, unended, value in zip(*col, strict=True):
            if kind < 0:
                yield conv, None, value
            elif kind == 0:
                text = value
            else:
                yield conv, Row(turn, role, 1 if blank else 2 if text is None else 3 if unended else 0, n, text), None
                text = None


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, found = TaskContext.get().partitionId(), []

    def segment(conv: int | None, rows: list[Row], opened: bool) -> dict:
        cost, audit = cheapest(rows)
        replay = Replay(audit)
        for r in rows:
            replay.row(r)
        out = {"conv_id": conv, "part": part, "parts": 1, "cost": cost, "audit": audit, "repaired_sha256": replay.end()} | _counts(rows)
        if opened:
            out["ways"] = [{"p": p, "q": q, "cost": c, "audit": a} for p, to in ways(rows).items() for q, (c, a) in to.items()]
        return out

    held: list[Row] = []
    now: tuple = ()
    first = True
    for conv, row, _ in _rows(batches):
        if now != (conv,):
            if now:
                found.append(segment(now[0], held, first))
                first = False
                if len(found) >= 500:
                    yield _emit(found)
                    found = []
            now, held = (conv,), []
        if row.copies:
            held.append(row)
    if now:
        found.append(segment(now[0], held, True))
    if found:
        yield _emit(found)


def _composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of conversations, sorted by (conversation, part), become conversations; the hash of several parts is open."""
    held: list[dict] = []

    def whole() -> dict:
        if len(held) == 1:
            return held[0]
        steps = [{p: {w["q"]: (w["cost"], w["audit"]) for w in x["ways"] if w["p"] == p} for p in range(len(TAKES))} for x in held]
        cost, audit = next(iter(lightest(0, len(steps), chain(steps), True).values()))
        out = {"conv_id": held[0]["conv_id"], "part": held[0]["part"], "parts": len(held), "cost": cost, "audit": audit} | {k: sum(x[k] for x in held) for k in ("rows", "turns", "blank", "duplicate", "truncated", "illegal")}
        full = [x for x in held if x["rows"]]
        for a, b in zip(full, full[1:], strict=False):
            out["illegal"] += a["last"] + b["first"] not in LEGAL
            out["turns"] -= a["high"] is not None and a["high"] == b["low"]
        return out | {"low": min((x["low"] for x in full if x["low"] is not None), default=None), "high": max((x["high"] for x in full if x["high"] is not None), default=None)}

    for batch in batches:
        for x in batch.to_pylist():
            if held and held[0]["conv_id"] != x["conv_id"]:
                yield _emit([whole()])
                held = []
            held.append(x)
    if held:
        yield _emit([whole()])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversations row by row, each behind its edits."""
    conv, replay = None, None
    result = lambda: pa.RecordBatch.from_arrays([pa.array([conv], pa.int64()), pa.array([replay.end()])], names=["conv_id", "repaired_sha256"])
    for c, row, audit in _rows(batches):
        if row is None:
            if replay:
                yield result()
            conv, replay = c, Replay(audit)
        else:
            replay.row(row)
    if replay:
        yield result()


def repair(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) for each conversation of (conv_id, turn, role, text[, copies]).

    A row's first fault counts: blank (no character but ASCII white space), duplicate (its role and text were seen earlier in the conversation),
    truncated (the last such character is not ``[.!?]``). Edits, by initial: Keep 0; Rerole to user or assistant 1; Delete 2, which a
    blank or duplicate row needs; Insert an empty row of user or assistant anywhere 5; truncated rows that stay add 5. The edits are
    the cheapest that make role initials match ``(s?(ua)+)?``, ties by the ASCII-least audit. ``gaps``: turns missing between the least and
    the largest; ``illegal``: adjacent initials other than su, ua and au.

    Rows go by turn, nulls first; rows of one turn by role and a digest of the text. Null roles and texts are one space; an empty role has no
    initial, so it is kept where it stands. A null conversation is one too. Conversations whose rows all have no copies get zeros, an
    empty audit and the hash of nothing. Rows repeated in full are copies. No rows in, no rows out; other columns are ignored.
    """
    copies = F.col("copies").cast("long") if "copies" in rows.columns else F.lit(1).cast("long")
    value = F.coalesce("text", F.lit(" "))
    bare = F.rtrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r"))
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"), value.alias("text"), copies.alias("copies"))
    rows = rows.withColumn("bare", bare).select("*", F.unhex(F.md5(F.col("text").cast("binary"))).alias("digest"), (F.col("bare") == "").alias("blank"), (~F.col("bare").rlike(r"[.!?]\z")).alias("unended"))
    counts = rows.groupBy(*_KEY, "blank", "unended").agg(F.sum("copies").alias("n")).withColumn("kind", F.lit(1)).withColumn("text", F.lit(None).cast("string"))
    # A text travels once per conversation and role, with its first turn; other rows are told as duplicates by having none.
    texts = rows.where("copies > 0 AND NOT blank").groupBy("conv_id", "role", "digest", "text").agg(F.min("turn").alias("least"), F.max(F.col("turn").isNull()).alias("null_turn"))
    texts = texts.select("*", F.when(~F.col("null_turn"), F.col("least")).alias("turn"), F.lit(False).alias("blank"), F.lit(False).alias("unended"), F.lit(0).cast("long").alias("n"), F.lit(0).alias("kind"))
    cols = [*_KEY, "kind", "n", "blank", "unended", "text"]
    records = cut(counts.select(*cols).unionByName(texts.select(*cols)))
    order = [F.col(c).asc_nulls_first() for c in _KEY]
    ranged = records.repartitionByRange(spread(rows.sparkSession), *order).sortWithinPartitions(*order, "kind")
    parts = cut(ranged.mapInArrow(_segments, _OUT))
    # At most two rows of each range are open.
    opened = parts.where("ways IS NOT NULL").repartition("conv_id").sortWithinPartitions("conv_id", "part").mapInArrow(_composed, _OUT)
    opened = cut(opened)
    passing = opened.where("parts > 1")
    edits = passing.select("conv_id", F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit(b"").alias("digest"), F.lit(-1).alias("kind"), F.lit(0).cast("long").alias("n"), F.lit(False).alias("blank"), F.lit(False).alias("unended"), F.col("audit").alias("text"))
    ids = F.broadcast(passing.select(F.col("conv_id").alias("id")))  # fewer than there are ranges
    again = records.join(ids, F.expr("conv_id <=> id"), "left_semi").unionByName(edits).repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), F.expr("kind >= 0"), *order[1:], "kind")
    hashes = again.mapInArrow(_hashed, "conv_id long, repaired_sha256 string").withColumnsRenamed({"conv_id": "id", "repaired_sha256": "sha"})
    late = passing.join(hashes, F.expr("conv_id <=> id")).withColumn("repaired_sha256", F.col("sha")).select(*_NAMES)
    out = parts.where("ways IS NULL").unionByName(opened.where("parts = 1")).unionByName(late)
    gaps = F.coalesce(F.expr("high - low + 1 - turns"), F.lit(0)).cast("long")
    return out.select("conv_id", gaps.alias("gaps"), *(F.col(c).cast("long").alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")), "audit", "repaired_sha256")


def oracle() -> str:
    """The same in DuckDB's SQL, for ``conversations`` with the damage of :func:`damaged`: a recursive query keeps the least (cost, audit) of each
    state, with the text so far, row by row; at most two inserts follow each other, as more are never cheapest."""
    white = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    put = lambda s, cost, letter, line: f"CASE WHEN {s} IS NOT NULL THEN {{'c': CAST({s}.c + {cost} AS BIGINT), 'a': {s}.a || '{letter}', 't': {s}.t || {line}}} END"
    gone = lambda s: put(s, DELETE, "D", "''")
    keep = lambda s, initial: f"CASE WHEN stays AND initial = '{initial}' THEN {put(s, 'more', 'K', 'own')} END"
    rerole = lambda s, role: f"CASE WHEN stays THEN {put(s, f'{REROLE} + more', 'R', f"chr(10) || '{role}:' || text")} END"
    insert = lambda s, role: put(s, INSERT, "I", f"chr(10) || '{role}:'")
    least = lambda *some: f"list_min([{', '.join(some)}])"
    taken = {q: [f"s{q}"] for q in range(4)}
    into = {q: [gone(f"s{q}"), keep(f"s{q}", "")] for q in taken}
    for q, takes in enumerate(TAKES):
        for initial, to in takes.items():
            into[to].append(keep(f"s{q}", initial))
        into[MISSES[q][1]].append(rerole(f"s{q}", MISSES[q][0]))
    nothing = "CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, t VARCHAR))"
    closed = f"n0 AS s0, n1 AS s1, {least('n2', insert('n0', 'user'), insert('n1', 'user'), insert('n3', 'user'))} AS s2, n3"
    last = f"s0, s1, s2, {least('n3', insert('s2', 'assistant'))} AS s3"
    crc = "xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, length(k) + 1), lambda i: CAST(ascii(substr(k, CAST(i AS INTEGER), 1)) AS BIGINT))), lambda c, b: list_reduce(list_prepend(xor(c, b), [CAST(0 AS BIGINT) FOR z IN range(8)]), lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295)"
    return f"""WITH RECURSIVE raw AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
marked AS (SELECT *, {crc} % 20 AS kind FROM raw),
hurt AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS again FROM marked),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), again) AS n, rtrim(text, {white}) AS bare, substr(role, 1, 1) AS initial FROM hurt),
judged AS (SELECT *, CASE WHEN bare = '' THEN 1 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 THEN 2 WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault, lag(initial) OVER (PARTITION BY conv_id ORDER BY n) || initial AS pair FROM numbered),
steps AS (SELECT conv_id AS cid, n, text, initial, fault IN (0, 3) AS stays, CASE WHEN fault = 3 THEN {TRUNCATED} ELSE 0 END AS more, chr(10) || role || ':' || text AS own FROM judged),
ids AS (SELECT DISTINCT conv_id FROM conversations),
dp AS (SELECT conv_id, CAST(0 AS BIGINT) AS i, {last} FROM (SELECT conv_id, {closed} FROM (SELECT conv_id, {{'c': CAST(0 AS BIGINT), 'a': '', 't': ''}} AS n0, {nothing} AS n1, {nothing} AS n2, {nothing} AS n3 FROM ids))
UNION ALL SELECT conv_id, i, {last} FROM (SELECT conv_id, i, {closed} FROM (SELECT conv_id, i + 1 AS i, {', '.join(f'{least(*into[q])} AS n{q}' for q in taken)} FROM dp JOIN steps ON cid IS NOT DISTINCT FROM conv_id AND n = i + 1))),
ends AS (SELECT conv_id AS cid, arg_max({least('s0', 's3')}, i) AS best FROM dp GROUP BY ALL),
counts AS (SELECT conv_id AS id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY ALL)
SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, best.c AS cost, best.a AS audit, sha256(substr(best.t, 2)) AS repaired_sha256
FROM ids JOIN ends ON cid IS NOT DISTINCT FROM conv_id LEFT JOIN counts ON id IS NOT DISTINCT FROM conv_id"""
