"""Hot keys: every cut must give exactly what one plain window gives."""

import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from lectern.operators import align, catalog, opslog
from lectern.plans import ordered
from lectern.plans.ordered import Scan, first_rows, number_rows, scan

def rows_for(seed, n=600):
    r = random.Random(seed)
    # one key holds more than half, one instant holds a third of it
    return [
        (
            None if r.random() < 0.1 else ("hot" if r.random() < 0.6 else r.choice("abc")),
            None if r.random() < 0.02 else (7.0 if r.random() < 0.3 else round(r.uniform(-50, 900), 2)),
            i,
            r.choice(["start", "end", "x"]),
            r.randint(0, 9),
        )
        for i in range(n)
    ]


def frame(spark, seed):
    return spark.createDataFrame(rows_for(seed), "k string, t double, id long, kind string, v long")


def what():
    return Scan(
        sums={"s": F.when(F.col("kind") == "start", F.col("v"))},
        prev={"p": F.when(F.col("kind") == "end", F.struct("t", "id"))},
        next={"n": F.when(F.col("kind") == "end", F.struct("t", "id"))},
        lead={"ld": F.when(F.col("v") > 3, F.col("v"))},
        row_number="rn",
    )


def by_windows(df, order, tie=()):
    """The same columns by plain windows over whole keys."""
    w = what()
    part, so_far = Window.partitionBy("k"), (Window.unboundedPreceding, Window.currentRow)
    forward = part.orderBy(*order, *tie)
    back = part.orderBy(*[F.col(c).desc() for c in order], *tie)
    return df.select(
        "*",
        F.sum(w.sums["s"]).over(forward.rowsBetween(*so_far)).alias("s"),
        F.last(w.prev["p"], True).over(forward.rowsBetween(*so_far)).alias("p"),
        F.last(w.next["n"], True).over(back.rowsBetween(*so_far)).alias("n"),
        F.lead(w.lead["ld"]).over(forward).alias("ld"),
        F.row_number().over(forward).cast("long").alias("rn"),
    )


@pytest.mark.parametrize("partitions", [1, 3, 40, None])
@pytest.mark.parametrize(("order", "batch"), [(["t", "id"], 10_000), (["v", "id"], 7), (["id"], 1)])
def test_scan_is_the_same_however_it_is_cut(spark, partitions, order, batch):
    df = frame(spark, batch)
    cols = ["id", "s", "p", "n", "ld", "rn"]
    want = sorted(by_windows(df, order).select(*cols).collect(), key=lambda r: r["id"])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = sorted(scan(df, ["k"], order, what(), partitions).select(*cols).collect(), key=lambda r: r["id"])
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == want


@pytest.mark.parametrize("batch", [1, 5, 10_000])
def test_scan_takes_the_largest_tie(spark, batch):
    df = frame(spark, 77).withColumn("n2", F.col("id"))
    want = {r["id"]: (r["p"], r["n"]) for r in by_windows(df, ["v"], ["id"]).collect()}
    w = what()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        out = scan(df, ["k"], ["v"], Scan(prev=w.prev, next=w.next, tie="id"), 6).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert {r["id"]: (r["p"], r["n"]) for r in out} == want


def test_scan_moves_the_rows_once(spark):
    """What is planned after the write has no exchange of rows, only one of the records at the edges."""
    plan = scan(frame(spark, 1), ["k"], ["t", "id"], what())._jdf.queryExecution().executedPlan().toString()
    initial = plan.split("Initial Plan")[-1]
    assert initial.count("Exchange hashpartitioning") == 1 and "Exchange rangepartitioning" not in initial
    assert scan(frame(spark, 1).limit(0), ["k"], ["t", "id"], what()).count() == 0


def test_first_rows_cuts_before_the_exchange(spark):
    plan = first_rows(frame(spark, 2), ["k"], [F.col("id")], 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2


def brute_nearest(points, words):
    out = {}
    for k, pid, at in points:
        best = None
        for kk, i, s in words:
            if kk == k and (best is None or (abs(s - at), i) < best):
                best = (abs(s - at), i)
        out[pid] = best[1] if best else 0
    return out


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(seed=st.integers(0, 10**6), partitions=st.sampled_from([1, 4, 20]))
def test_nearest_word_is_brute_force(spark, seed, partitions):
    r = random.Random(seed)
    keys = ["hot"] * 6 + ["a", "b", "none"]
    words = [(r.choice(keys[:-1]), i, float(r.randint(0, 40)) / 4) for i in range(60)]
    points = [(r.choice(keys), i, float(r.randint(-8, 50)) / 4) for i in range(60)]
    w = spark.createDataFrame(words, "k string, word_idx long, start_s double")
    p = spark.createDataFrame(points, "k string, pid long, at double")
    got = {x["pid"]: x["nearest_idx"] for x in align.nearest_word(p, w, "k", partitions=partitions).collect()}
    assert got == brute_nearest(points, words)


def greedy(times, total, gap=1.0, tail=3.0):
    kept = [0.0]
    for t in sorted(set(times)):
        if t - kept[-1] >= gap and t <= total - tail:
            kept.append(t)
    return kept


@pytest.mark.parametrize(("rows", "fan"), [(5, 2), (5, 3), (500, 2), (50_000, 64)])
def test_scene_thin_does_not_depend_on_blocks(spark, rows, fan):
    r = random.Random(rows + fan)
    data = {
        "hot": [round(r.uniform(0, 60), 2) for _ in range(300)],
        "dense": [round(5 + i / 100, 2) for i in range(180)],
        "ties": [1.0, 2.0, 3.0, 3.0, 4.0, 4.999, 5.0],
        "early": [-4.0, -1.0, 0.0, 0.5, 0.999, 1.5],
        **{f"k{i}": [round(r.uniform(0, 12), 1) for _ in range(r.randint(1, 9))] for i in range(25)},
        "bare": [],
    }
    totals = {k: 58.0 if k == "hot" else 12.0 for k in data}
    c = spark.createDataFrame([(k, t) for k, ts in data.items() for t in ts] + [(None, 3.0), ("hot", None), ("lost", 4.0)], "k string, ts_s double")
    t = spark.createDataFrame(list(totals.items()), "k string, total_s double")
    got = align.scene_thin(c, t, "k", rows=rows, fan=fan).collect()
    for k in data:
        mine = sorted((x["scene_idx"], x["start_s"]) for x in got if x["k"] == k)
        assert mine == list(enumerate(greedy(data[k], totals[k]))), k
    assert {x["k"] for x in got} == set(data)


@settings(max_examples=60, deadline=None)
@given(seed=st.integers(0, 10**6), size=st.integers(1, 9), gap=st.sampled_from([0.1, 1.0, 2.5]))
def test_composed_exits_are_greedy(seed, size, gap):
    r = random.Random(seed)
    t = np.unique([round(gap + r.uniform(0, 12), 1) for _ in range(r.randint(1, 60))])
    parts = [align._Exits.of(t[i : i + size], gap) for i in range(0, len(t), size)]
    pairs = [align._Exits.composed(parts[i : i + 2], gap) for i in range(0, len(parts), 2)]
    want = t[align._greedy(t, 0.0, gap)]
    assert want.tolist() == greedy(t, 10**6, gap)[1:]
    for one in (align._Exits.composed(parts, gap), align._Exits.composed(pairs, gap)):
        last, n = one.after(np.array([0.0]), gap)
        assert (last[0], n[0]) == (want[-1], len(want))


def test_round_robin_and_sessions_do_not_depend_on_the_cut(spark):
    r = random.Random(5)
    topics = spark.createDataFrame(
        [(i, "s" if r.random() < 0.8 else "t", r.choice("xyz"), r.randint(0, 5), "Pending") for i in range(300)],
        "topic_id long, stream string, subject string, created_time long, status string",
    )
    plans = [
        sorted((x["topic_id"], x["slot"], x["day"]) for x in catalog.round_robin_plan(topics, 4, n).collect())
        for n in (1, 12)
    ]
    assert plans[0] == plans[1]
    lines = ["Triggering pipeline", "Pipeline Complete!", "pipeline error", "work"]
    logs = spark.createDataFrame(
        [("s" if r.random() < 0.8 else "t", 1_700_000_000 + r.randint(0, 50), i, r.choice(lines)) for i in range(300)],
        "stream string, at long, id long, line string",
    ).withColumn("ts", F.timestamp_seconds("at"))
    runs = [sorted(map(str, opslog.run_sessions(logs, "stream", ["ts", "id"], partitions=n).collect())) for n in (1, 12)]
    assert runs[0] == runs[1]


def test_number_rows_counts_every_row_once(spark):
    got = [r["n"] for r in number_rows(frame(spark, 9).where("k = 'hot'"), ["k"], ["t", "id"], "n", 7).collect()]
    assert sorted(got) == list(range(1, len(got) + 1))


@pytest.mark.parametrize("case", ["outlier", "text", "ties"])
def test_a_hot_key_is_spread_over_tasks(spark, case):
    n = 20_000
    at = {
        "outlier": F.when(F.col("id") == 5, F.lit(0)).otherwise(1_700_000_000 + F.col("id")),
        "text": F.sha2(F.col("id").cast("string"), 256),
        "ties": F.lit("one instant"),
    }[case]
    df = spark.range(n).select(F.lit("hot").alias("k"), at.alias("t"), "id")
    walked = ordered._walked(df, ["k"], ["t", "id"], [], {k: [] for k in ("sums", "prev", "next", "lead")}, df.columns, 20)
    sizes = [r["count"] for r in walked.where("__seg IS NOT NULL").groupBy("__seg").count().collect()]
    assert sum(sizes) == n and max(sizes) < n / 8
    assert walked.where("__edge IS NOT NULL").count() == len(sizes)


def test_rows_of_a_scan_do_not_move_again(spark):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64k")
    try:
        rows = spark.range(60_000).selectExpr("id % 3 AS k", "hash(id) AS h", "id")
        numbered = ordered.number_rows(rows, ["k"], ["h", "id"], "n", 8)
        plan = numbered._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        assert sorted(tuple(r) for r in numbered.groupBy("k").agg(F.sum("n"), F.count("*")).collect()) == [(k, 20_000 * 20_001 // 2, 20_000) for k in range(3)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
