"""Streams fed in several batches, out of order, twice, and restarted."""

import datetime as dt
import random
from types import SimpleNamespace

import pandas as pd
import pytest
from pyspark.sql import functions as F

from lectern.streaming import daily, dedup, io, logs, missed, state


def put(spark, path, rows, schema, n):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{path}/b{n}")


def T(day, hour, minute=0):
    return dt.datetime(2026, 3, day, hour, minute)


RUNS = "topic_id string, event_id long, ts timestamp_ntz, event string"


def test_run_state_over_batches_and_restart(spark, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("src", "out", "ck"))

    def go():
        s = io.read_stream(spark, f"{src}/*", RUNS, files_per_trigger=1)
        return io.drain(state.stream_run_state(s, "string"), "rs", out=out, state=ck)

    put(spark, src, [("a", 2, T(1, 2), "complete"), ("a", 1, T(1, 1), "claim"), ("b", 1, T(1, 1), "complete")], RUNS, 1)
    go()
    put(spark, src, [("a", 3, T(1, 1, 30), "reset"), ("a", 4, T(1, 3), "reset"), ("b", 2, T(1, 2), "claim"), ("b", 3, T(1, 3), "fail")], RUNS, 2)
    got = {(r["topic_id"], r["event_id"]): (r["status"], r["verdict"]) for r in go().collect()}
    assert got == {
        ("a", 1): ("In Progress", "applied"), ("a", 2): ("Completed", "applied"), ("a", 3): ("Completed", "late"), ("a", 4): ("Pending", "applied"),
        ("b", 1): ("Pending", "illegal"), ("b", 2): ("In Progress", "applied"), ("b", 3): ("Failed", "applied"),
    }


def test_run_state_agrees_however_files_are_batched(spark, tmp_path):
    rnd = random.Random(3)
    kinds = ["claim", "complete", "fail", "reset"]
    rows = [(rnd.choice("aaab"), i, T(1, 0) + dt.timedelta(minutes=rnd.randrange(600)), rnd.choice(kinds)) for i in range(120)]
    got = []
    for batches in (1, 3, 10):
        src = str(tmp_path / f"src{batches}")
        put(spark, src, [("a", 2000, None, "claim")], RUNS, "none")
        for n in range(batches):
            put(spark, src, rows[n::batches], RUNS, f"{n:02}")
        out, ck = str(tmp_path / f"out{batches}"), str(tmp_path / f"ck{batches}")

        def go(src=src, out=out, ck=ck, chunk={1: 2_000, 3: 4, 10: 1}[batches]):
            return io.drain(state.stream_run_state(io.read_stream(spark, f"{src}/*", RUNS, 1), "string", "1 day", chunk), "rs", out=out, state=ck)

        go()
        # A later event lets the watermark pass all others.
        put(spark, src, [("end", 1000, T(5, 0), "claim")], RUNS, "zz")
        got.append(sorted(tuple(r) for r in go().where("topic_id <> 'end' AND ts IS NOT NULL").collect()))
        assert [r.verdict for r in go().where("ts IS NULL").collect()] == ["illegal"]
    assert len(got[0]) == 120 and got[0] == got[1] == got[2]
    assert {r[5] for r in got[0]} == {"applied", "illegal"}


class Store:
    """What the processor asks of its handle, in memory, with a count of the calls."""

    def __init__(self):
        self.value, self.map, self.timers, self.calls = None, {}, set(), 0

    def getValueState(self, name, schema):
        return SimpleNamespace(get=lambda: self.value, update=lambda row: setattr(self, "value", row))

    def getMapState(self, name, key, value):
        def read(k):
            self.calls += 1
            return self.map[k]

        def write(k, v):
            self.calls += 1
            self.map[k] = v

        return SimpleNamespace(getValue=read, updateValue=write, removeKey=lambda k: self.map.pop(k))

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.remove(at)


@pytest.mark.parametrize("chunk", [1, 3, 50, 10_000])
def test_run_state_keeps_one_timer_and_bounded_chunks(chunk):
    rnd = random.Random(chunk)
    kinds = ["claim", "complete", "fail", "reset"]
    # a third of all events fall into one millisecond
    events = [(rnd.choice([5_000_000 + rnd.randrange(1000), rnd.randrange(10_000_000), rnd.randrange(10_000_000)]), i, rnd.choice(kinds)) for i in range(400)]
    store, p = Store(), state.RunState(chunk)
    p.init(store)
    done, sent = [], 0
    for mark in (0, 2_000, 5_000, 7_000, 20_000):
        late = [e for e in events[sent:] if e[0] // 1000 > mark or mark == 20_000]
        batch, sent = (late[: len(late) // 3], 0) if mark < 20_000 else (late, len(events))
        events = [e for e in events if e not in batch]
        frames = [pd.DataFrame(batch[i : i + 40], columns=["us", "event_id", "event"]) for i in range(0, len(batch), 40)]
        assert sum(len(f) for f in p.handleInputRows(("k",), iter(frames), None)) == 0
        assert len(store.timers) <= 1 and all(len(v[0]) <= chunk for v in store.map.values())
        for due in [t for t in store.timers if t < mark]:
            store.timers.remove(due)
            now = SimpleNamespace(getCurrentWatermarkInMs=lambda: mark)
            for f in p.handleExpiredTimer(("k",), now, SimpleNamespace(getExpiryTimeInMs=lambda: due)):
                done += [(r.ts.value // 1000, r.event_id) for r in f.itertuples() if r.verdict != "late"]
    assert done == sorted(done) and not store.map and not store.timers
    if chunk == 10_000:
        assert store.calls < 100


def test_run_state_of_many_topics_takes_few_calls():
    rnd = random.Random(5)
    kinds = ["claim", "complete", "fail", "reset", None]
    topics = [None, "", *map(str, range(60))]
    events = [(rnd.randrange(5_000_000), i // 2, rnd.choice(kinds), rnd.choice(topics)) for i in range(4_000)]
    one, of_topic = {}, {}
    for t in topics:
        store, p = Store(), state.RunState()
        p.init(store)
        frame = pd.DataFrame([e[:3] for e in events if e[3] == t], columns=["us", "event_id", "event"])
        list(p.handleInputRows((t,), iter([frame]), None))
        at = SimpleNamespace(getCurrentWatermarkInMs=lambda: 9_000)
        one[t] = [tuple(r)[1:] for f in p.handleExpiredTimer((t,), at, None) for r in f.itertuples(index=False)]
    for most in (50_000, 3):
        stores = {"waiting": Store(), "runs": Store()}
        for x in stores.values():
            x.calls = 0
        p = state.BucketState(500, most)
        maps = {n: x.getMapState(n, None, None) for n, x in stores.items()}
        keep = stores["waiting"]
        handle = SimpleNamespace(getValueState=keep.getValueState, getMapState=lambda n, *_: maps[n], registerTimer=keep.registerTimer, deleteTimer=keep.deleteTimer)
        maps["runs"].containsKey = lambda k: k in stores["runs"].map
        p.init(handle)
        for i in range(0, len(events), 1_000):
            list(p.handleInputRows((1,), iter([pd.DataFrame(events[i : i + 1_000], columns=["us", "event_id", "event", "topic_id"])]), None))
        of_topic = {t: [] for t in topics}
        for mark in (2_000, 9_000):
            keep.timers.clear()  # it goes off
            for f in p.handleExpiredTimer((1,), SimpleNamespace(getCurrentWatermarkInMs=lambda: mark), None):
                for r in f.itertuples(index=False):
                    of_topic[r.topic_id].append(tuple(r)[1:])
        assert of_topic == one and not stores["waiting"].map and not stores["waiting"].timers
        if most == 50_000:
            assert stores["runs"].calls <= 4 * len(topics)


def test_run_state_keeps_exact_ids_beside_a_missing_one(spark, tmp_path):
    src, big = str(tmp_path / "src"), 2**62 + 1
    put(spark, src, [(big, 1, T(1, 1), "claim"), (None, 2, T(1, 1), "claim"), (None, 3, T(1, 2), "fail"), (big + 1, 4, T(1, 2), "fail")], RUNS.replace("topic_id string", "topic_id bigint"), 1)
    put(spark, src, [(0, 9, T(5, 0), "claim")], RUNS.replace("topic_id string", "topic_id bigint"), 2)
    stream = io.read_stream(spark, f"{src}/*", RUNS.replace("topic_id string", "topic_id bigint"), 1)
    got = io.drain(state.stream_run_state(stream, buckets=1), "rs").where("event_id < 9")
    assert {r.event_id: (r.topic_id, r.status, r.verdict) for r in got.collect()} == {
        1: (big, "In Progress", "applied"), 2: (None, "In Progress", "applied"), 3: (None, "Failed", "applied"), 4: (big + 1, "Pending", "illegal")
    }


def test_dedup_over_batches(spark, tmp_path):
    src = str(tmp_path / "src")
    schema = "stream string, ts timestamp_ntz, status string"
    rows = [("a", T(1, 10), "success"), ("a", T(1, 11), "success"), ("a", T(1, 19), "success"), ("b", T(1, 10), "failed: x")]
    put(spark, src, rows, schema, 1)
    put(spark, src, rows, schema, 2)
    got = io.drain(dedup.stream_dedup(io.read_stream(spark, f"{src}/*", schema, 1)), "dd").collect()
    assert sorted((r["stream"], r["local_day"].day) for r in got) == [("a", 1), ("a", 2)]


def test_daily_closes_at_local_midnight_and_drops_late_rows(spark, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("src", "out", "ck"))
    schema = "ts timestamp_ntz, kind string, v long"

    def go():
        return io.drain(daily.stream_daily(io.read_stream(spark, f"{src}/*", schema, 1), "kind", F.col("v")), "d", out=out, state=ck)

    put(spark, src, [(T(1, 18, 29), "x", 1), (T(1, 18, 30), "x", 10), (T(3, 0), "x", 0)], schema, 1)
    go()
    put(spark, src, [(T(1, 18, 0), "x", 100), (T(5, 0), "x", 0)], schema, 2)
    got = {r["local_day"].day: (r["n"], r["total"]) for r in go().collect()}
    assert got == {1: (1, 1), 2: (1, 10), 3: (1, 0)}


def test_missed_alerts(spark, tmp_path):
    slots, runs = str(tmp_path / "slots"), str(tmp_path / "runs")
    s_schema, r_schema = "stream string, local_day date, slot_at timestamp_ntz", "stream string, ts timestamp_ntz, status string"
    put(spark, slots, [("a", dt.date(2026, 3, d), T(d, 12, 30)) for d in range(1, 6)], s_schema, 1)
    put(
        spark, runs,
        [("a", T(1, 12, 0), "success"), ("a", T(2, 12, 31), "success"), ("a", T(3, 12, 0), "failed: x"), ("a", T(3, 15, 0), "success"), ("z", T(5, 0), "success")],
        r_schema, 1,
    )
    q = missed.stream_missed(io.read_stream(spark, f"{slots}/*", s_schema), io.read_stream(spark, f"{runs}/*", r_schema))
    # day 2 ends exactly within grace, day 4 has nothing, day 5 has not been reached
    assert sorted(r["local_day"].day for r in io.drain(q, "m").collect()) == [3, 4]


def test_log_stream_equals_batch(spark, tmp_path):
    src = str(tmp_path / "src")
    schema = "id long, message string"
    rows = [(1, "\x1b[31m Gradio \x1b[0m\n\n ok "), (2, "  \n")]
    put(spark, src, rows, schema, 1)
    got = io.drain(logs.stream_logs(io.read_stream(spark, f"{src}/*", schema)), "l").collect()
    batch = logs.stream_logs(spark.createDataFrame(rows, schema)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, batch)) and len(got) == 2


def test_numbers_in_log_lines_are_ids_unless_a_status(spark):
    lines = {
        "user 429": "UNKNOWN", "user 1429": "UNKNOWN", "4290 frames": "UNKNOWN", "upload of user 429 refused": "UPLOAD_FAIL",
        "HTTP 429": "NOTION_API", "status code: 429, user 1429": "NOTION_API", "429 Too Many Requests": "NOTION_API", "Notion says 1429": "NOTION_API",
    }
    got = logs.stream_logs(spark.createDataFrame([(m,) for m in lines], "message string"))
    assert {r["line"]: r["category"] for r in got.collect()} == {**lines}
