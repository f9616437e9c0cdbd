"""Words in packs of bytes: what meets them, over many stretches and spans, and how little of them moves as rows."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern.functions.num import ms
from lectern.operators import align
from lectern.plans import produce, spoken


def asked(rows, n, scenes):
    """What slide_text owes, scene by scene, from all words of one video."""
    timed = [r for r in rows if r[2] is not None]

    def near(t):
        return min((abs(r[2] - t), r[0]) for r in timed)[1]

    for k, a, z, last in scenes:
        lo = min(near(a), n - 1)
        hi = max(lo, min(n - 1 if last else near(z) - 1, n - 1))
        inside = sorted(([r[0], r[1], r[2] if r[2] is not None else -1.0, r[3]] for r in rows if lo <= r[0] <= hi and r[1] is not None))
        yield k, lo, hi, " ".join(r[1] for r in inside), len(inside), inside


@pytest.mark.parametrize("order", ["in order", "scattered"])
@pytest.mark.parametrize("odd", [False, True])
def test_slides_of_a_long_video_are_brute_force(spark, order, odd):
    """5,000 words and a silence of 1,500 seconds: slides cut by stretches, edges whose closest word is spans away."""
    rnd = random.Random(3)
    at = [round(i / 2.5 + (1500 if i >= 2000 else 0) + (0.0001 if odd and i % 7 == 0 else 0), 4) for i in range(5000)]
    rows = [(i, f"w{i}é" if i % 3 else f"w {i}", at[i], round(at[i] + 0.4, 4)) for i in range(5000)]
    if odd:
        rows = [(i, None if rnd.random() < 0.05 else w, None if i % 501 == 3 else a, z) for i, w, a, z in rows if rnd.random() < 0.95]
        rows += [(i, "again", a, z) for i, _, a, z in rows if i % 100 == 0]
    cuts = [0.0, 3.0, 400.0, 409.6, 511.9, 512.0, 799.8, 1300.0, 1549.9, 1550.0, 1700.0, 2300.3, 3400.0, 3497.0]
    scenes = [(k, a, z, k == len(cuts) - 2) for k, (a, z) in enumerate(zip(cuts, cuts[1:]))]
    given = [("v", *r) for r in rows] + [("other", *r) for r in rows[:50]]
    if order == "scattered":
        rnd.shuffle(given)
    w = spark.createDataFrame(given, "v string, word_idx int, word string, start_s double, end_s double").coalesce(3)
    s = spark.createDataFrame([(v, *c) for v in ("v", "other", "none", None) for c in scenes], "v string, scene_idx int, start_s double, end_s double, is_last boolean")
    got = {(r["v"], r["slide_index"]): r for r in align.slide_text(s, w, "v").collect()}
    assert len(got) == 4 * len(scenes)
    for v, of in (("v", rows), ("other", rows[:50])):
        for k, lo, hi, text, n, inside in asked(of, len(of), scenes):
            r = got[v, k]
            assert (r["word_start_index"], r["word_end_index"], r["word_count"], r["text"]) == (lo, hi, n, text)
            if inside and inside[0][2] >= 0:
                assert r["original_audio_start"] == round(inside[0][2] + 1e-9, 3) and abs(r["original_audio_end"] - inside[-1][3]) < 0.00051
    assert all(got[v, k]["text"] == "" and got[v, k]["word_count"] == 0 for v in ("none", None) for k, *_ in scenes)


def test_words_do_not_go_through_the_ordered_scan(spark, monkeypatch):
    """Only the first and the last word of a span do, and edges without a word on both sides."""
    seen, plain = [], align.scan

    def counted(df, *args, **kw):
        seen.append(df.count())
        return plain(df, *args, **kw)

    monkeypatch.setattr(align, "scan", counted)
    w = spark.range(4000).select(F.lit("v").alias("v"), F.col("id").alias("word_idx"), F.lit("x").alias("word"), (F.col("id") / 2.5).alias("start_s"), ((F.col("id") + 1) / 2.5).alias("end_s"))
    s = spark.range(200).select(F.lit("v").alias("v"), F.col("id").cast("int").alias("scene_idx"), (F.col("id") * 8.0).alias("start_s"), ((F.col("id") + 1) * 8.0).alias("end_s"), (F.col("id") == 199).alias("is_last"))
    assert align.slide_text(s, w, "v").agg(F.sum("word_count")).first()[0] == 4000
    assert sum(seen) < 40


def test_packs_give_times_back_bit_for_bit(spark):
    times = [0.0, -0.0, 0.4, 1 / 3, 1e-9, 1e12, -7.25, math.inf, -math.inf, math.nan, None, 2.0**40]
    rows = [("k", i, str(i), t, times[-1 - i % len(times)]) for i, t in enumerate(times * 5)]
    w = spark.createDataFrame(rows, "k string, word_idx long, word string, start_s double, end_s double").coalesce(1)
    t = spoken.packs(w, "k").toArrow()
    words = spoken._Words(t, np.arange(t.num_rows))
    gone = [x is None for x, n in zip(t["span"].to_pylist(), t["n"].to_pylist()) for _ in range(n)]
    got = {i: (None if no else repr(a), None if end else repr(z)) for i, a, z, no, end in zip(words.idx.tolist(), words.a.tolist(), words.times("z").tolist(), gone, words.marks("no_end").tolist())}
    assert got == {r[1]: tuple(None if x is None else repr(x) for x in r[3:]) for r in rows}


def test_milliseconds_are_those_of_round(spark):
    rnd = random.Random(8)
    values = [0.0005, 1.0005, 2.5e-4, -0.0001, -0.0, -1.2345, 0.0015, 1.0015, 4503599627370.4955, 1e15 + 0.3, 1e300, math.inf, -math.inf, math.nan, None]
    values += [rnd.uniform(-1e4, 1e4) for _ in range(3000)] + [rnd.randint(0, 10**7) / 10000 for _ in range(3000)] + [rnd.randint(0, 10**6) / 2.5 for _ in range(1000)]
    df = spark.createDataFrame([(v,) for v in values], "v double").select(ms(F.col("v")).alias("a"), F.round("v", 3).alias("b"))
    assert [(repr(r["a"]), repr(r["b"])) for r in df.collect() if repr(r["a"]) != repr(r["b"])] == []


def test_a_journey_works_its_totals_and_candidates_out_once(spark):
    read = {c: spark.sparkContext.accumulator(0) for c in ("totals", "candidates")}

    def counted(df, name):
        def count(batches):
            for batch in batches:
                read[name].add(batch.num_rows)
                yield batch

        return df.mapInArrow(count, df.schema)

    words = [(v, i, f"w{i}", round(i / 2.5, 3), round((i + 1) / 2.5, 3)) for v in "ab" for i in range(300)]
    w = spark.createDataFrame(words, "v string, word_idx long, word string, start_s double, end_s double")
    totals = spark.createDataFrame([(v, 120.0) for v in "ab"], "v string, total_s double")
    c = spark.createDataFrame([(v, float(t)) for v in "ab" for t in range(10, 100, 9)], "v string, ts_s double")
    got = produce.align_videos(w, counted(c, "candidates"), counted(totals, "totals"), "v")
    assert got.agg(F.sum("word_count")).first()[0] == 600 and got.count() == 22
    assert {k: v.value for k, v in read.items()} == {"totals": 2, "candidates": 20}
