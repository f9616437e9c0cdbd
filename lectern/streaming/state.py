"""Run state per topic as a stream.

State is one small record per key, and the events that the watermark has not
reached in chunks by time. One timer per key applies them in order. A key is a
bucket of topics: what a key costs, however few its events, is paid per bucket.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from lectern import rules
from lectern.functions.time import instant

# Which event moves which status where.
MOVES = {
    ("claim", rules.PENDING): rules.IN_PROGRESS,
    ("complete", rules.IN_PROGRESS): rules.COMPLETED,
    ("fail", rules.IN_PROGRESS): rules.FAILED,
    ("reset", rules.PENDING): rules.PENDING,
    ("reset", rules.IN_PROGRESS): rules.PENDING,
    ("reset", rules.COMPLETED): rules.PENDING,
    ("reset", rules.FAILED): rules.PENDING,
}

COLUMNS = ["topic_id", "event_id", "ts", "event", "status", "verdict"]


@dataclass
class Waiting:
    """What a topic holds: its run, its one timer, and where its chunks of waiting events begin.

    Chunk ``ids[i]`` holds the events from ``begins[i]`` up to ``begins[i + 1]``
    by (time, id), so chunks are read in order and only as far as needed.
    """

    status: str = rules.PENDING
    last: tuple[int, int] | None = None
    timer: int | None = None
    begins: list[tuple[int, int]] = field(default_factory=list)
    ids: list[int] = field(default_factory=list)
    next_id: int = 0

    SCHEMA = "status string, last_us long, last_seq long, timer long, us array<long>, seq array<long>, ids array<long>, next_id long"

    @classmethod
    def load(cls, row: tuple | None) -> Waiting:
        if row is None:
            return cls()
        status, last_us, last_seq, timer, us, seq, ids, next_id = row
        return cls(status, None if last_us is None else (last_us, last_seq), timer, list(zip(us, seq, strict=True)), list(ids), next_id)

    def row(self) -> tuple:
        last = self.last or (None, None)
        return (self.status, *last, self.timer, [b[0] for b in self.begins], [b[1] for b in self.begins], self.ids, self.next_id)


@dataclass
class Run:
    """A topic's status, and time and id of its last event."""

    status: str = rules.PENDING
    last: tuple[int, int] | None = None


def _place(event: tuple) -> tuple[int, int, str]:
    """Order of events: time, id, and for equal ones the name."""
    return event[0], event[1], event[2] or ""


def _applied(run: Run | Waiting, us: int, seq: int, event: str) -> str:
    """Move the run by its next event; returns the verdict."""
    if run.last is not None and (us, seq) <= run.last:
        return "late"
    run.last = (us, seq)
    to = MOVES.get((event, run.status))
    run.status = to or run.status
    return "illegal" if to is None else "applied"


class RunState(StatefulProcessor):
    """Applies a topic's events in order once the watermark has reached them; late and illegal ones are reported.

    A topic's events wait in chunks of at most ``chunk`` consecutive ones, found
    through one small record. New events are merged into the chunks they fall
    in; a chunk that grows too long is split. One timer stands at the earliest
    waiting time, and when it goes off all that the watermark has reached is
    applied chunk by chunk. So calls to the state follow the chunks touched, not
    the events, and memory holds one incoming frame and one chunk.
    """

    def __init__(self, chunk: int = 2_000):
        self.chunk = chunk

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.value = handle.getValueState("run", Waiting.SCHEMA)
        self.chunks = handle.getMapState("waiting", "id long", "us array<long>, seq array<long>, event array<string>")

    def _read(self, chunk_id: int) -> list[tuple]:
        return list(zip(*self.chunks.getValue((chunk_id,)), strict=True))

    def _write(self, chunk_id: int, events: list[tuple]) -> None:
        self.chunks.updateValue((chunk_id,), tuple(map(list, zip(*events, strict=True))))

    def _add(self, now: Waiting, events: list[tuple]) -> None:
        """Merge sorted events into their chunks, from the last one back so that splits move no index still needed."""
        high = len(events)
        for i in range(max(len(now.ids), 1) - 1, -1, -1):
            # the first chunk also takes what comes before it
            low = bisect_left(events, now.begins[i], key=lambda e: e[:2]) if i else 0
            part, high = events[low:high], low
            if not part:
                continue
            if now.ids:
                part = sorted(part + self._read(now.ids[i]), key=_place)
            pieces = [part[k : k + self.chunk] for k in range(0, len(part), self.chunk)]
            ids = now.ids[i : i + 1]
            ids += range(now.next_id, now.next_id + len(pieces) - len(ids))
            now.next_id = max(now.next_id, ids[-1] + 1)
            for chunk_id, piece in zip(ids, pieces, strict=True):
                self._write(chunk_id, piece)
            now.ids[i : i + 1], now.begins[i : i + 1] = ids, [p[0][:2] for p in pieces]

    def _keep(self, now: Waiting) -> None:
        """Store the record, with the timer at the earliest waiting event; it goes off when the watermark is past it."""
        due = now.begins[0][0] // 1000 - 1 if now.begins else None
        if due != now.timer:
            if now.timer is not None:
                self.handle.deleteTimer(now.timer)
            if due is not None:
                self.handle.registerTimer(due)
            now.timer = due
        self.value.update(now.row())

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now, out, new = Waiting.load(self.value.get()), [], False
        for frame in rows:
            timed = frame["us"].notna()
            # Without a time an event has no place in the order: reported, and moves nothing.
            for seq, event in frame.loc[~timed, ["event_id", "event"]].itertuples(index=False, name=None):
                out.append((key[0], seq, pd.NaT, event, now.status, "illegal"))
            f = frame.loc[timed]
            if len(f):
                events = zip(f["us"].astype("int64").tolist(), f["event_id"].tolist(), f["event"].tolist(), strict=True)
                self._add(now, sorted(((us, int(seq), event) for us, seq, event in events), key=_place))
                new = True
        if new:
            self._keep(now)
        yield pd.DataFrame(out, columns=COLUMNS)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = Waiting.load(self.value.get())
        now.timer = None  # it went off
        end = (timerValues.getCurrentWatermarkInMs() + 1) * 1000
        while now.begins and now.begins[0][0] < end:
            events = self._read(now.ids[0])
            ripe = bisect_left(events, end, key=lambda e: e[0])
            out = []
            for us, seq, event in events[:ripe]:
                verdict = _applied(now, us, seq, event)
                out.append((key[0], seq, pd.Timestamp(us, unit="us"), event, now.status, verdict))
            yield pd.DataFrame(out, columns=COLUMNS)
            self._leave(now, events, ripe)
        self._keep(now)

    def _leave(self, now: Waiting, events: list[tuple], ripe: int) -> None:
        """Keep what is not ripe of the first chunk."""
        if ripe < len(events):
            self._write(now.ids[0], events[ripe:])
            now.begins[0] = events[ripe][:2]
        else:
            self.chunks.removeKey((now.ids[0],))
            del now.ids[0], now.begins[0]

    def close(self) -> None:
        pass


class BucketState(RunState):
    """``RunState`` for a bucket of topics.

    The events of all its topics wait in the same chunks, which are bounded as
    those of one topic are. The run of each topic is a small record of its own,
    read and written once in a call, or once for every ``topics`` of them.
    """

    def __init__(self, chunk: int = 2_000, topics: int = 50_000):
        super().__init__(chunk)
        self.topics = topics

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.value = handle.getValueState("run", Waiting.SCHEMA)
        self.chunks = handle.getMapState("waiting", "id long", "us array<long>, seq array<long>, event array<string>, topic array<string>")
        self.runs = handle.getMapState("runs", "topic string, none boolean", "status string, last_us long, last_seq long")

    def _run(self, topic: str | None) -> Run:
        at = (topic or "", topic is None)
        if not self.runs.containsKey(at):
            return Run()
        status, us, seq = self.runs.getValue(at)
        return Run(status, None if us is None else (us, seq))

    def _store(self, runs: dict[str | None, Run]) -> None:
        for topic, run in runs.items():
            self.runs.updateValue((topic or "", topic is None), (run.status, *(run.last or (None, None))))
        runs.clear()

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now, out, new = Waiting.load(self.value.get()), [], False
        for frame in rows:
            timed = frame["us"].notna()
            # Without a time an event has no place in the order: reported, and moves nothing.
            for topic, seq, event in frame.loc[~timed, ["topic_id", "event_id", "event"]].itertuples(index=False, name=None):
                out.append((topic, seq, pd.NaT, event, self._run(topic).status, "illegal"))
            f = frame.loc[timed]
            if len(f):
                events = zip(f["us"].astype("int64").tolist(), f["event_id"].astype("int64").tolist(), f["event"].tolist(), f["topic_id"].tolist(), strict=True)
                self._add(now, sorted(events, key=_place))
                new = True
        if new:
            self._keep(now)
        yield pd.DataFrame(out, columns=COLUMNS)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now, runs = Waiting.load(self.value.get()), {}
        now.timer = None  # it went off
        end = (timerValues.getCurrentWatermarkInMs() + 1) * 1000
        while now.begins and now.begins[0][0] < end:
            events = self._read(now.ids[0])
            ripe = bisect_left(events, end, key=lambda e: e[0])
            us, seq, event, topic = map(list, zip(*events[:ripe], strict=True))
            status, verdict = [], []
            for u, s, e, t in events[:ripe]:
                run = runs.get(t)
                if run is None:
                    run = runs[t] = self._run(t)
                verdict.append(_applied(run, u, s, e))
                status.append(run.status)
            values = (topic, seq, pd.to_datetime(us, unit="us"), event, status, verdict)
            yield pd.DataFrame(dict(zip(COLUMNS, values, strict=True)))
            self._leave(now, events, ripe)
            if len(runs) >= self.topics:
                self._store(runs)
        self._store(runs)
        self._keep(now)


def stream_run_state(src: DataFrame, key_type: str = "bigint", delay: str = "0 seconds", chunk: int = 2_000, buckets: int = 1_024) -> DataFrame:
    """Src: topic_id, event_id, ts, event. One output row per event with the status after it.

    An event is applied when the watermark, ``delay`` behind the latest event,
    has reached it. Events that come in any order within ``delay`` give the same
    rows however they are cut into batches; those after it may be late. Topics
    are dealt to ``buckets`` by a hash, at most so many tasks work at once; a
    stream keeps its number. ``topic_id``: a type that its string form holds.
    """
    topic = F.col("topic_id").cast("string").alias("topic_id")
    bucket = F.pmod(F.xxhash64(topic), F.lit(buckets)).alias("bucket")
    s = src.select(bucket, topic, F.col("event_id").cast("long").alias("event_id"), instant("ts").alias("ts"), "event").withWatermark("ts", delay)
    # The number is not the watermark's column: Spark would drop late rows, which are to be reported.
    s = s.select("bucket", "topic_id", "event_id", F.unix_micros("ts").alias("us"), "event")
    steps = s.groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=BucketState(chunk),
        outputStructType="topic_id string, event_id long, ts timestamp, event string, status string, verdict string",
        outputMode="Append",
        timeMode="EventTime",
    )
    return steps.select(F.col("topic_id").cast(key_type).alias("topic_id"), *COLUMNS[1:])
