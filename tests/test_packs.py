"""Rows packed into arrays, and slides whose words come in packs of any shape."""

import random

from pyspark.sql import functions as F

from lectern.operators import align
from lectern.plans.ordered import Scan, scan_parts
from lectern.plans.packs import PART, opened, packed


def test_packs_hold_every_row(spark):
    rows = [(f"k{i % 3}" if i % 7 else None, i // 10, float(i) if i % 5 else None, str(i)) for i in range(200)]
    df = spark.createDataFrame(rows, "k string, g int, t double, w string").repartition(3)
    packs = packed(df, ["k"], F.col("g"))
    assert packs.columns == ["k", PART, "g", "t", "w"] and packs.count() < 190
    assert sorted(map(str, opened(packs, ["k"], ["g", "t", "w"]).collect())) == sorted(map(str, df.collect()))


def test_packed_scan_writes_only_the_rows_that_ask(spark):
    rows = [("a", float(i), i % 4 == 0) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, t double, p boolean")
    seen = F.when(~F.col("p"), F.col("t"))
    what = Scan(prev={"before": seen}, next={"after": seen}, where=F.col("p"), only=True, pack=F.floor(F.col("t") / 16).cast("double"))
    written, complete = scan_parts(df, ["k"], ["t"], what, 5)
    got = {r["t"]: (r["before"], r["after"]) for r in complete(written).collect()}
    assert written.count() == 100
    assert got == {t: (t - 1 if t else None, t + 1) for t in range(0, 400, 4)}


def test_slides_of_scattered_words_with_gaps_and_repeats(spark):
    rnd = random.Random(5)
    words = [(v, i, f"w{i}" if rnd.random() < 0.9 else None, round(i / 2.5, 3), round((i + 1) / 2.5, 3)) for v in ("a", "b") for i in range(700) if rnd.random() < 0.9]
    words += [(v, i, "again", a, z) for v, i, _, a, z in words if i % 50 == 0]
    n = {v: sum(w[0] == v for w in words) for v in ("a", "b")}
    rnd.shuffle(words)
    cuts = [0.0, 30.0, 99.0, 103.5, 220.2, 280.0]
    scenes = [(v, k, a, z, k == len(cuts) - 2) for v in ("a", "b", "none") for k, (a, z) in enumerate(zip(cuts, cuts[1:]))]
    w = spark.createDataFrame(words, "v string, word_idx long, word string, start_s double, end_s double").repartition(4)
    s = spark.createDataFrame(scenes, "v string, scene_idx int, start_s double, end_s double, is_last boolean")
    got = {(r["v"], r["slide_index"]): r for r in align.slide_text(s, w, "v").collect()}
    assert len(got) == len(scenes)

    def near(v, t):
        return min((abs(x[3] - t), x[1]) for x in words if x[0] == v)[1]

    for v, k, a, z, last in scenes:
        r = got[v, k]
        if v == "none":
            assert r["text"] == "" and r["word_count"] == 0
            continue
        lo = min(near(v, a), n[v] - 1)
        hi = max(lo, min(n[v] - 1 if last else near(v, z) - 1, n[v] - 1))
        inside = sorted(x[1:] for x in words if x[0] == v and lo <= x[1] <= hi and x[2] is not None)
        assert (r["word_start_index"], r["word_end_index"]) == (lo, hi)
        assert r["text"] == " ".join(x[1] for x in inside)
        assert (r["original_audio_start"], r["original_audio_end"]) == (inside[0][2], inside[-1][3])


def test_a_journey_moves_no_text_to_find_its_pace(spark):
    words = [("a", i, f"w{i}", round(i / 2.5, 3), round((i + 1) / 2.5, 3)) for i in range(600)]
    cuts = [0.0, 31.0, 101.0, 150.3, 237.0]
    scenes = [(v, k, a, z, k == len(cuts) - 2) for v in ("a", "none") for k, (a, z) in enumerate(zip(cuts, cuts[1:]))]
    w = spark.createDataFrame(words, "v string, word_idx long, word string, start_s double, end_s double")
    s = spark.createDataFrame(scenes, "v string, scene_idx int, start_s double, end_s double, is_last boolean")
    once, twice = align.paced_slides(s, w, "v"), align.slide_pace(align.slide_text(s, w, "v"), w, "v")
    assert once.columns == twice.columns
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))
