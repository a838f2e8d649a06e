"""Pushed partial deltas merged per hub, with sessions, seeds, eviction, a gate, and samples at a fixed cadence.

Frames are ordered by second and sequence. ``connect`` opens a session and ``disconnect`` ends it; frames outside a session are
dropped. A ``delta`` sets the fields it names and leaves others; a null clears. A ``seed`` (a polled snapshot) sets a field only
where the session holds no value for it. A ``clock`` only tells the time. A session is in sync once deltas touched every target of the hub
(``flood``), or ``SYNC_TIMEOUT_S`` after it opened if anything has come by then, else when something comes (``timeout``). Fields that the
session has not established are dropped at sync, by membership and never by age. While in sync and heard from (a delta or the
connect) within ``SILENCE_S``, each field with a value gives a row at every ``CADENCE_S``-th second; otherwise nothing does.

Time is a hub's own: frames wait in state until the hub has been heard ``late_s`` seconds past them, and are then taken in order. So a
hub that lags behind the others loses nothing, and the engine's watermark, which all hubs would share, takes no part. A frame that
comes after its time was taken is reported as late and changes nothing.

State is keyed: an entry per object and field, one per waiting frame, one per object heard in the session, and a few numbers per hub. A
batch writes the entries that it changed.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: One row per field and sample (``what`` = sample), dropped field (evicted), late frame (late: ``value`` is its kind), or session that comes in
#: sync (sync: ``value`` is how).
OUTPUT = "hub string, id string, at_s long, field string, value string, updated_s long, value_source string, session long, what string"
SILENCE_S = 90
CADENCE_S = 30
SYNC_TIMEOUT_S = 20
LATE_S = 60
_NAMES = [c.split()[0] for c in OUTPUT.split(", ")]
_HUB = ("session", "since", "heard", "tick", "connected", "synced", "content", "clock", "taken")


class HubState:
    """A hub's fields, each (value, second, session, source) by (object, field); a null value is a cleared field.

    ``changed`` holds the fields set or dropped since the state was read, ``touched`` the objects that deltas of the session named.
    """

    def __init__(self, targets: int, hub: tuple | None = None, fields: dict | None = None, touched: Iterable[str] = ()):
        self.targets, self.fields, self.touched = targets, fields or {}, set(touched)
        self.session, self.since, self.heard, self.tick, self.connected, self.synced, self.content, self.clock, self.taken = hub or (0, 0, 0, 0, False, False, False, -1, -1)
        self.changed: set[tuple[str, str]] = set()
        self.retouched = False

    def numbers(self) -> tuple:
        return tuple(getattr(self, n) for n in _HUB)

    def advance(self, until: int) -> Iterator[tuple]:
        """All that is due up to the second ``until``."""
        first = self.tick
        if self.connected and not self.synced and self.content and self.since + SYNC_TIMEOUT_S <= until:
            at = self.since + SYNC_TIMEOUT_S
            yield from self._sync("timeout", at)
            first = max(first, -(-at // CADENCE_S) * CADENCE_S)
        if self.connected and self.synced:
            for s in range(first, min(until, self.heard + SILENCE_S) + 1, CADENCE_S):
                for (i, name), (value, at, session, source) in self.fields.items():
                    if value is not None:
                        yield i, s, name, value, at, source, session, "sample"
        self.tick = max(self.tick, (until // CADENCE_S + 1) * CADENCE_S)

    def frame(self, kind: str, at: int, number: int, i: str, fields: dict[str, str | None]) -> Iterator[tuple]:
        """One frame, after all that was due before its second."""
        yield from self.advance(at - 1)
        if kind == "connect":
            self.connected, self.synced, self.content, self.touched, self.retouched = True, False, False, set(), True
            self.session, self.since, self.heard = number, at, at
        elif kind == "disconnect":
            self.connected = self.synced = False
        elif self.connected and kind != "clock":
            self.content = True
            if kind == "delta":
                self.heard = at
                if i not in self.touched:
                    self.touched.add(i)
                    self.retouched = True
            for name, value in fields.items():
                old = self.fields.get((i, name))
                guarded = kind == "seed" and old is not None and old[0] is not None and old[2] == self.session
                if not guarded and not (old is not None and old[1] > at):
                    self.fields[i, name] = (value, at, self.session, kind)
                    self.changed.add((i, name))
            if not self.synced and len(self.touched) >= self.targets:
                yield from self._sync("flood", at)
            elif not self.synced and at >= self.since + SYNC_TIMEOUT_S:
                yield from self._sync("timeout", at)

    def _sync(self, how: str, at: int) -> Iterator[tuple]:
        self.synced = True
        yield None, at, None, how, None, None, self.session, "sync"
        for key in [k for k, f in self.fields.items() if f[2] != self.session]:
            value, updated, _, source = self.fields.pop(key)
            self.changed.add(key)
            if value is not None:
                yield key[0], at, key[1], None, updated, source, self.session, "evicted"

    def take(self, frames: list[tuple], until: int) -> Iterator[tuple]:
        """Frames (number, kind, second, object, fields as JSON) up to the second ``until``, in order, and what is due by then."""
        for number, kind, at, i, fields in sorted(frames):
            yield from self.frame(kind, at, number, i, json.loads(fields))
        yield from self.advance(until)
        self.taken = max(self.taken, until)


class MergeHubs(StatefulProcessor):
    """A hub's frames as :class:`HubState` takes them, out of order within ``late_s`` seconds of the hub's own time."""

    def __init__(self, targets: int, late_s: int, idle_s: int | None = None):
        self.targets, self.late_s, self.idle_s = targets, late_s, idle_s

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.hub = handle.getValueState("hub", "session long, since long, heard long, tick long, connected boolean, synced boolean, content boolean, clock long, taken long")
        self.fields = handle.getMapState("fields", "id string, field string", "value string, at_s long, session long, source string")
        self.touched = handle.getMapState("touched", "id string", "seen boolean")
        self.waiting = handle.getMapState("waiting", "number long", "kind string, at_s long, id string, fields string")

    def _read(self) -> HubState:
        plain = lambda row: tuple(None if x is pd.NaT or x != x else x for x in row)
        fields = {tuple(k): plain(v) for k, v in self.fields.iterator()}
        return HubState(self.targets, tuple(self.hub.get()) if self.hub.exists() else None, fields, [k[0] for k in self.touched.keys()])

    def _write(self, state: HubState) -> None:
        for key in state.changed:
            if key in state.fields:
                self.fields.updateValue(key, state.fields[key])
            else:
                self.fields.removeKey(key)
        if state.retouched:
            self.touched.clear()
            for i in state.touched:
                self.touched.updateValue((i,), (True,))
        self.hub.update(state.numbers())

    def _taken(self, key: tuple, state: HubState, frames: list[tuple], until: int, late: list[tuple]) -> pd.DataFrame:
        """What comes of all frames up to ``until``; later ones wait."""
        held = {n: (n, *v) for (n,), v in self.waiting.iterator()}
        due = [f for f in held.values() if f[2] <= until]
        for f in due:
            self.waiting.removeKey((f[0],))
        for f in frames:
            if f[2] <= until:
                due.append(f)
            elif f[0] not in held:
                self.waiting.updateValue((f[0],), f[1:])
        out = [*late, *state.take(list(dict.fromkeys(due)), until)]
        self._write(state)
        return pd.DataFrame([(key[0], *r) for r in out], columns=_NAMES).astype({"at_s": "Int64", "updated_s": "Int64", "session": "Int64"})

    def handleInputRows(self, key, rows, timerValues):  # noqa: N802, N803
        state, frames, late = self._read(), [], []
        for df in rows:
            for number, kind, at, i, fields in zip(df["number"], df["kind"], df["at_s"], df["id"], df["fields"], strict=True):
                state.clock = max(state.clock, int(at))
                if at <= state.taken:
                    late.append((i, int(at), None, kind, None, None, None, "late"))
                else:
                    frames.append((int(number), kind, int(at), i, fields))
        if self.idle_s is not None:
            for old in list(self.handle.listTimers()):
                self.handle.deleteTimer(old)
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle_s * 1000)
        yield self._taken(key, state, frames, state.clock - self.late_s, late)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):  # noqa: N802, N803
        """Nothing came for ``idle_s`` seconds: all that waits is taken, and what falls due until the hub counts as silent."""
        state = self._read()
        state.clock += SILENCE_S + self.late_s
        yield self._taken(key, state, [], state.clock - self.late_s, [])

    def close(self) -> None:
        pass


def merge_deltas(stream: DataFrame, targets: int, late_s: int = LATE_S, idle_s: int | None = None) -> DataFrame:
    """What the hubs of a stream of (hub, id, at_s, number, kind, fields as JSON) give; ``targets``: objects of a hub.

    ``number`` orders frames, rises with ``at_s`` and is unique in a hub; a frame that comes twice while it waits counts once. What is due
    ``late_s`` seconds before a hub's newest frame has been given; the rest comes with later frames, of which a ``clock`` is the
    least. With ``idle_s``, for streams that run on, a timer per hub brings it once nothing has come for so long (processing time).

    The state store must be RocksDB's (``ingest.run_to_table(..., store=ingest.ROCKSDB)``). A hub's frames of a micro-batch are held by one
    task, so batches are bounded by ``maxFilesPerTrigger`` where much has piled up.
    """
    mode = "none" if idle_s is None else "processingTime"
    return stream.groupBy("hub").transformWithStateInPandas(MergeHubs(targets, late_s, idle_s), OUTPUT, "append", mode)


def with_polls(samples: DataFrame, polls: DataFrame, mode: str) -> DataFrame:
    """Samples by mode: ``ws`` leaves a gap where the push feed gave none; ``hybrid`` takes the polled rows (hub, id, at_s, field, value) there,
    and ``value_source`` tells them."""
    if mode not in ("ws", "hybrid"):
        raise ValueError(f"mode {mode!r}: ws or hybrid")
    cols = ["hub", "id", "at_s", "field", "value", "value_source"]
    if mode == "ws":
        return samples.select(*cols)
    missing = polls.join(samples.select("hub", "at_s").distinct(), ["hub", "at_s"], "left_anti")
    return samples.select(*cols).unionByName(missing.withColumn("value_source", F.lit("rest")).select(*cols))
