"""Hand-written rows for the rules that are easy to get wrong."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from lectern import rules
from lectern.functions import num, text, time
from lectern.operators import align, analytics, catalog, metadata, opslog, schedule, strategy, textjobs


def one(spark, col, **values):
    df = spark.range(1).select(*[F.lit(v).alias(n) for n, v in values.items()]) if values else spark.range(1)
    return df.select(col.alias("x")).first()["x"]


def ts(s):
    return F.lit(s).cast("timestamp")


def utc(value):
    return value.astimezone(dt.timezone.utc).strftime("%Y-%m-%d %H:%M") if value.tzinfo else value.strftime("%Y-%m-%d %H:%M")


# --- local days and slots ---------------------------------------------------


@pytest.mark.parametrize(
    "a,b,same",
    [
        ("2026-03-22 10:00:00", "2026-03-22 10:00:00", True),
        ("2026-03-21 18:29:59", "2026-03-21 18:30:00", False),
        ("2026-03-22 01:00:00", "2026-03-22 15:00:00", True),
        ("2026-03-21 12:00:00", "2026-03-22 12:00:00", False),
    ],
)
def test_same_local_day(spark, a, b, same):
    assert one(spark, time.same_local_day(ts(a), ts(b))) is same


@pytest.mark.parametrize("hour,want", [(18, "2026-03-22 12:30"), (0, "2026-03-21 18:30")])
def test_slot_utc(spark, hour, want):
    c = time.slot_utc(F.lit("2026-03-22").cast("date"), F.lit(hour)).cast("timestamp_ntz")
    assert utc(one(spark, c)) == want


@pytest.mark.parametrize(
    "hour,now,runs,missed",
    [
        (18, "2026-03-22 16:30:00", [], True),
        (18, "2026-03-22 16:30:00", [("2026-03-22 13:00:00", "success")], False),
        (18, "2026-03-22 05:30:00", [], False),
        (18, "2026-03-22 16:30:00", [("2026-03-21 13:00:00", "success")], True),
        (18, "2026-03-22 16:30:00", [("2026-03-22 13:00:00", "failed: x")], True),
        (0, "2026-03-22 02:00:00", [], True),
        (18, "2026-03-22 12:30:00", [], False),
    ],
)
def test_missed_runs(spark, hour, now, runs, missed):
    s = spark.createDataFrame([("s", hour, True)], "stream string, hour_local int, enabled boolean")
    r = spark.createDataFrame([("s", *x) for x in runs], "stream string, at string, status string").withColumn("ts", F.col("at").cast("timestamp"))
    day = F.lit("2026-03-22").cast("date")
    assert (schedule.missed_runs(s, r, ts(now), day, day).count() == 1) is missed


def test_next_run_is_strictly_later_and_counts_down(spark):
    s = spark.createDataFrame([("a", 18, True), ("b", 18, False)], "stream string, hour_local int, enabled boolean")
    got = {r["stream"]: r for r in schedule.next_run(s, ts("2026-03-22 12:30:00")).collect()}
    assert got["a"]["next_run_local"] == "2026-03-23 18:00 IST" and got["a"]["countdown"] == "24h 0m"
    assert got["b"]["next_run"] is None and got["b"]["countdown"] == "—"
    assert one(spark, time.countdown(ts("2026-03-22 12:30:00"), ts("2026-03-22 12:30:00"))) == "Now"


# --- hours ------------------------------------------------------------------


def test_upload_hour_in_both_modes(spark):
    t = ts("2026-03-22 18:40:00")
    assert one(spark, time.hour_of_upload(t)) == 0
    assert one(spark, time.hour_of_upload(t, "legacy")) == 23


@pytest.mark.parametrize("h,label", [(0, "12 AM"), (6, "6 AM"), (12, "12 PM"), (18, "6 PM")])
def test_hour_label(spark, h, label):
    assert one(spark, time.hour_label(F.lit(h))) == label


def stats(spark, rows):
    return spark.createDataFrame(rows, "channel string, at string, views long").withColumn("published_at", F.col("at").cast("timestamp"))


def test_best_hour_default_ties_and_enough(spark):
    s = stats(spark, [("zero", "2026-01-01 00:00:00", 0), ("tie", "2026-01-01 05:00:00", 7), ("tie", "2026-01-01 01:00:00", 7), ("null", "2026-01-01 01:00:00", None)])
    got = {r["channel"]: r for r in analytics.best_hour(analytics.hourly_profile(s)).collect()}
    assert got["zero"]["best_hour"] == 18 and got["null"]["best_hour"] == 18
    assert got["tie"]["best_hour"] == 6 and got["tie"]["has_enough"] is False


def test_profile_is_dense(spark):
    p = analytics.hourly_profile(stats(spark, [("a", "2026-01-01 00:00:00", 3)]))
    assert p.count() == 24 and p.where("uploads > 0").select("hour").collect() == [(5,)]


# --- alignment --------------------------------------------------------------


def test_scene_rules(spark):
    c = spark.createDataFrame([("v", t) for t in (0.5, 1.0, 1.4, 2.0, 2.9, 3.0, 9.8)], "k string, ts_s double")
    t = spark.createDataFrame([("v", 10.0)], "k string, total_s double")
    s = align.scene_thin(c, t, "k")
    assert [r["start_s"] for r in s.orderBy("scene_idx").collect()] == [0.0, 1.0, 2.0, 3.0]
    i = align.scene_intervals(s, t, "k").orderBy("scene_idx").collect()
    assert [(r["end_s"], r["duration_s"]) for r in i] == [(1.0, 1.0), (2.0, 1.0), (3.0, 1.0), (7.0, 4.0)]


def words(spark, starts, key="v"):
    return spark.createDataFrame(
        [(key, i, f"w{i}", float(s), float(s) + 0.4) for i, s in enumerate(starts)], "k string, word_idx int, word string, start_s double, end_s double"
    )


def test_nearest_word_ties_take_the_lowest_index(spark):
    p = spark.createDataFrame([("v", float(x)) for x in (0, 0.75, 1, 2.6, 99)], "k string, at double")
    got = align.nearest_word(p, words(spark, [0, 0.5, 1, 1, 2, 3]), "k").orderBy("at").collect()
    assert [r["nearest_idx"] for r in got] == [0, 1, 2, 5, 5]


def test_slides_share_a_word_when_clamped(spark):
    s = spark.createDataFrame(
        [("v", 0, 0.0, 0.1, False), ("v", 1, 0.1, 0.2, False), ("v", 2, 0.2, 9.0, True), ("none", 0, 0.0, 1.0, True)],
        "k string, scene_idx int, start_s double, end_s double, is_last boolean",
    )
    got = {(r["k"], r["slide_index"]): r for r in align.slide_text(s, words(spark, [0, 1, 2]), "k").collect()}
    assert got[("v", 0)]["text"] == "w0" and got[("v", 0)]["overlap"] and got[("v", 1)]["overlap"]
    assert got[("v", 2)]["text"] == "w0 w1 w2" and got[("v", 2)]["original_audio_end"] == 2.4
    assert got[("none", 0)]["word_count"] == 0 and got[("none", 0)]["text"] == "" and got[("none", 0)]["original_audio_end"] == 1.0


def test_pace_is_clamped_and_has_a_dead_band(spark):
    m = spark.createDataFrame(
        [("v", 0, 0.0, 4.0, 0, 0), ("v", 1, 0.0, 1.42, 0, 1), ("v", 2, 0.0, 0.2, 0, 99), ("none", 0, 0.0, 3.0, 0, 5)],
        "k string, slide_index int, video_start double, video_end double, word_start_index int, word_end_index int",
    )
    got = {(r["k"], r["slide_index"]): r for r in align.slide_pace(m, words(spark, [0, 1, 2]), "k").collect()}
    assert got[("v", 0)]["speed_factor"] == 2.0 and got[("v", 2)]["speed_factor"] == 0.5
    assert got[("v", 1)]["needs_adjust"] is False and got[("none", 0)]["speed_factor"] == 1.0


def test_segment_split_edges(spark):
    s = spark.createDataFrame(
        [("v", 0, 2, 1, 9.0), ("none", 3, 3, None, 5.0)], "k string, intro_words int, main_words int, outro_words int, total_duration double"
    )
    got = {r["k"]: r for r in align.segment_split(words(spark, [0, 1, 2]), s, "k").collect()}
    assert got["v"]["intro_end_idx"] == -1 and got["v"]["intro_end"] == 0.0 and got["v"]["main_end"] == 1.4
    assert got["none"]["main_end"] == 5.0


def test_timeline_prefers_known_audio(spark):
    t = spark.createDataFrame([("v", 0, 3.0, None), ("v", 1, 10.0, 8.0), ("v", 2, 0.5, 0.0)], "k string, pos int, video_s double, audio_s double")
    got = align.track_timeline(t, "k").orderBy("pos").collect()
    assert [(r["duration_s"], r["offset_s"], r["fade_out_s"], r["audio_short"]) for r in got] == [
        (3.0, 0.0, 2.0, False), (8.0, 3.0, 7.0, True), (0.5, 11.0, 0.0, False),
    ]


# --- strategy ---------------------------------------------------------------


def decide(spark, titles, kind=rules.KIND_VIDEO, **kw):
    r = spark.createDataFrame([("q", i, t, kind if i == 0 else rules.KIND_VIDEO, "P") for i, t in enumerate(titles)], "query_id string, rank int, title string, kind string, playlist_id string")
    t = spark.createDataFrame([("q", "T", "C")], "query_id string, topic string, chapter string")
    return strategy.decide_strategy(r, t, **kw).first()


def test_strategy_rules_in_order(spark):
    assert decide(spark, [])["reason"] == rules.REASON_NONE
    assert decide(spark, ["x"], rules.KIND_PLAYLIST)["playlist_id"] == "P"
    assert decide(spark, ["Step 1 basics"])["strategy"] == "branch"
    assert decide(spark, ["Step 1 basics"], strict=True)["strategy"] == "single"
    assert decide(spark, ["Part 10"])["strategy"] == "branch"
    assert decide(spark, ["Part 10"], strict=True)["strategy"] == "single"
    assert decide(spark, ["a", "full course", "x series", "Ep. 7"])["reason"] == "3/5 results suggest a multi-part topic"
    assert decide(spark, ["a", "b", "c", "d", "e", "series", "series", "series"])["strategy"] == "single"
    assert decide(spark, ["episode 1"], older_rule=True)["strategy"] == "single"


def test_split_caps_blanks_and_generic_parts(spark):
    d = spark.createDataFrame(
        [("t1", "T1", "C1", "branch", "P"), ("t2", "T2", "C2", "branch", None), ("t3", "T3", "C3", "single", "P"), ("t4", "T4", "C4", "branch", "missing")],
        "topic_id string, topic string, chapter string, strategy string, playlist_id string",
    )
    d = d.withColumns({"stream": F.lit("S"), "subject": F.concat(F.lit("of "), "chapter")})
    items = spark.createDataFrame([("P", i, " " if i == 2 else f"v{i}") for i in range(20)], "playlist_id string, pos int, title string")
    got = strategy.split_topics(d, items).orderBy("parent_id", "pos").collect()
    t1 = [r for r in got if r["parent_id"] == "t1"]
    assert {(r["stream"], r["subject"], r["chapter"]) for r in t1} == {("S", "of C1", "C1")}
    assert len(t1) == 10 and t1[0]["action"] == "rename" and t1[0]["row_id"] == "t1" and t1[2]["title"] == "C1 - Lesson 3"
    assert [r["title"] for r in got if r["parent_id"] == "t2"] == ["T2 - Part 1", "T2 - Part 2", "T2 - Part 3"]
    assert len([r for r in got if r["parent_id"] == "t4"]) == 3 and not [r for r in got if r["parent_id"] == "t3"]
    assert len([r for r in strategy.split_topics(d, items, older_rule=True).collect() if r["parent_id"] == "t1"]) == 15


# --- text -------------------------------------------------------------------


def chunks(spark, body, **kw):
    df = spark.createDataFrame([(1, body)], "d int, text string")
    return [r["text"] for r in textjobs.pack_chunks(df, "d", **kw).orderBy("chunk_idx").collect()]


def test_pack_chunks(spark):
    body = "One two three. Four five! Six seven eight nine? tail with no stop"
    assert chunks(spark, body, limit_words=5, keep_tail=False) == ["One two three. Four five!", "Six seven eight nine?"]
    assert chunks(spark, body, limit_words=5) == ["One two three. Four five!", "Six seven eight nine?", "tail with no stop"]
    assert chunks(spark, "no stop at all", keep_tail=False) == ["no stop at all"]
    assert chunks(spark, "   ") == []
    assert chunks(spark, "a b c d e f g. h.", limit_words=3) == ["a b c d e f g.", "h."]


def test_word_counts_of_nothing(spark):
    assert one(spark, text.split_count(F.lit(""))) == 1
    assert one(spark, F.size(text.words(F.lit("   ")))) == 0
    assert one(spark, F.size(text.words(F.lit("a　b ﻿c")))) == 3


def emph(spark, body):
    return textjobs.emphasize(spark.createDataFrame([(1, body)], "d int, text string")).first()


LONG = " and so on we go with many more plain words to keep the share of new ones low enough" * 3


def test_emphasis_rules(spark):
    assert "x, ...which means" in emph(spark, "x, which means y" + LONG)["emphasized"]
    assert emph(spark, "it works fine.")["emphasized"] == "it works fine!"
    assert emph(spark, "it works fine. .")["emphasized"] == "it works fine. ."
    assert emph(spark, "what is the plan.")["emphasized"] == "what is the plan?"
    assert emph(spark, "Now We go\nso We stay")["emphasized"] == "Now, We go\nso We stay"
    assert emph(spark, "the key of Key monkey")["emphasized"] == "the KEY of Key monkey"
    e = emph(spark, "and the answer is four")
    assert e["reverted"] and e["emphasized"] == "and the answer is four" and e["n_changes"] == 0
    e = emph(spark, "and the answer is four" + LONG)
    assert not e["reverted"] and "is — four" in e["emphasized"] and e["n_changes"] > 0
    # a sentence already exclaimed does not become a question
    assert emph(spark, "it works and makes sense to me.")["emphasized"].endswith("!")
    # an accented letter is not a word character
    assert emph(spark, "ékey")["emphasized"] == "éKEY"


def test_clean_text(spark):
    assert one(spark, text.clean(F.lit("\x1b[31mred\x1b[0m\x07x\x00 "))) == "red x"


def test_slugs(spark):
    assert one(spark, text.slug_chars(F.lit("A/B c"))) == "a_b_c"
    assert one(spark, text.slug_runs(F.lit(" A//B "))) == "-a-b-"
    assert one(spark, text.slug_trimmed(F.lit(" A/B - c__d "))) == "ab-cd"
    names = spark.createDataFrame([("A/B",), ("A-B",), ("A-B",)], "n string")
    assert metadata.slug_collisions(names, "n", "chars").count() == 1
    assert metadata.slug_collisions(names, "n", "trimmed").count() == 0


def test_tags_keep_cut_duplicates_unless_asked(spark):
    a, b = "x" * 30 + "1", "x" * 30 + "2"
    df = spark.createDataFrame([([a, b, a, "p,  q"],)], "t array<string>")
    assert df.select(metadata.fit_tag_array(F.col("t"))).first()[0] == ["x" * 30, "x" * 30, "p q"]
    assert df.select(metadata.fit_tag_array(F.col("t"), distinct_after=True)).first()[0] == ["x" * 30, "p q"]
    rows = df.select(F.lit(1).alias("k"), F.posexplode("t").alias("pos", "tag"))
    for budget in (10, 33, 40, 66, 72, 495):
        want = df.select(metadata.fit_tag_array(F.col("t"), budget=budget)).first()[0]
        got = metadata.fit_tags(rows, "k", budget=budget).collect()
        assert (got[0]["tags"] if got else []) == want
        assert sum(len(t) + 3 for t in want) <= budget


def test_instructions(spark):
    c = spark.createDataFrame([("d", i) for i in range(3)], "k string, chunk_idx int")
    i = spark.createDataFrame([("d", 0, 0, "", "nan"), ("d", 0, 1, "no", "1"), ("d", 1, 0, "slow", "0.1")], "k string, chunk_idx int, pos int, instruct string, speed string")
    got = textjobs.attach_instructions(c, i, "k").orderBy("chunk_idx").collect()
    assert [(r["instruct"], r["speed"]) for r in got] == [(rules.INSTRUCT_EMPTY, 1.0), ("slow", 0.85), (rules.INSTRUCT_MISSING, 1.0)]
    d = textjobs.default_instructions(c, "k").orderBy("chunk_idx").collect()
    assert [r["speed"] for r in d] == [1.0, 0.95, 1.0]


def test_small_expressions(spark):
    assert one(spark, text.counter(F.lit("12 views"))) == 12 and one(spark, text.counter(F.lit("n/a"))) == 0
    assert one(spark, text.counter(F.lit(None).cast("string"))) == 0
    assert one(spark, text.with_suffix(F.lit("Speak <end>"), "<end>")) == "Speak <end>"
    assert one(spark, text.with_suffix(F.lit(" Speak "), "<end>")) == "Speak<end>"
    assert one(spark, text.escape_drawtext(F.lit("a:b;c'\n\\"))) == "a\\:b\\;c\\'\\\\"
    assert one(spark, text.hashtag(F.lit("Two  Words"))) == "#TwoWords"
    assert one(spark, text.thousands(F.lit(1234567))) == "1,234,567"
    assert one(spark, text.watch_url(F.lit("abc"))).endswith("watch?v=abc")
    assert one(spark, num.round_half_up(F.lit(-0.5))) == 0 and one(spark, num.round_half_up(F.lit(2.5))) == 3
    assert one(spark, opslog.artifact_name(F.lit("My Topic"), F.lit("a.b.mp4"), "clip")) == "clip_my_topic.mp4"


def test_last_error_and_queue_without_rows(spark):
    logs = spark.createDataFrame([("a", 1, "x", False)], "k string, ts int, line string, bad boolean")
    assert opslog.last_error(logs, ["k"], ["ts"], is_error=F.col("bad")).first()["last_error"] == "none"
    topics = spark.createDataFrame([("t", "s1", "Completed")], "topic_id string, stream string, status string")
    streams = spark.createDataFrame([("s1",), ("s2",)], "stream string")
    assert sorted(catalog.queue_depth(topics, streams).collect()) == [("s1", 0), ("s2", 0)]


def test_error_rules_first_match_wins(spark):
    assert one(spark, opslog.error_category(F.lit("Colab 429 upload"))) == "COLAB_DEAD"
    assert one(spark, opslog.error_category(F.lit("whisper of tts"))) == "TTS_FAIL"
    assert one(spark, opslog.error_category(F.lit("GRADIO"))) == "UNKNOWN"


def test_history_takes_the_newest(spark):
    s = spark.createDataFrame([("c", i, i) for i in range(20)], "channel string, video_id int, published_at int")
    got = analytics.recent_history(s, 12).orderBy("seq").collect()
    assert [r["video_id"] for r in got] == list(range(8, 20)) and got[0]["name"] == "V1"


def test_newest_error_wins_over_none_and_older_ones(spark):
    errors = spark.createDataFrame([("2024 real error", 2, 5), ("zz older", 1, 9), ("none", None, None)], "last_error string, ts int, seq int")
    errors = errors.withColumn("error_at", F.when(F.col("ts").isNotNull(), F.struct("ts", "seq")))
    services = spark.createDataFrame([("a", "live")], "service string, state string")
    depth = spark.createDataFrame([(3,)], "pending long")
    row = opslog.health_rollup(services, depth, errors).first()
    assert (row.status, row.services, row.live, row.pending, row.last_error) == ("ok", 1, 1, 3, "2024 real error")
    assert opslog.health_rollup(services, depth, errors.limit(0)).first().last_error == "none"


def test_a_failure_message_stays_whole(spark):
    long = "x" * 1_500_000
    runs = spark.createDataFrame([("s", 1, 1, "failed: " + long)], "stream string, t int, event_id int, status string")
    runs = runs.withColumn("ts", F.timestamp_seconds("t"))
    assert len(schedule.run_status(runs).first().message) == len(long)


def test_connectors_open_a_line_after_any_line_end(spark):
    word = rules.LINE_CONNECTORS[0]
    rows = [(i, f"first line{end}{word} Then it goes on") for i, end in enumerate(["\n", "\r", "\u2028", "\u2029", " "])]
    out = textjobs.emphasize(spark.createDataFrame(rows, "id int, text string")).orderBy("id").collect()
    assert [f"{word}, Then" in r.emphasized for r in out] == [True, True, True, True, False]
    assert [r.n_changes > 0 for r in out] == [True, True, True, True, False]


def test_offsets_do_not_depend_on_the_cut(spark):
    from lectern.operators import align

    rows = [(1, i, 10.1 + i * 0.001, None) for i in range(400)]
    t = spark.createDataFrame(rows, "video_id int, pos int, video_s double, audio_s double")
    plain = [r.offset_s for r in align.track_timeline(t, "video_id").orderBy("pos").collect()]
    assert plain == [r.offset_s for r in align.track_timeline(t, "video_id", partitions=9).orderBy("pos").collect()]


def test_emphasis_matches_each_pattern_once_and_counts_by_traces(spark):
    bits = ["so, but wait.", "KEY key always ALWAYS never.", "it works!", "the answer is 4. it runs. . .", "what is the point of all this. how do we go on now.", "in fact x", "and it turns out z", "\nNow We", "Now We.", "é\u2003ü", "! ?"]
    rnd = random.Random(3)
    rows = [(i, " ".join(rnd.choice(bits) for _ in range(rnd.randint(1, 30)))) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, text string")
    out = textjobs.emphasize(df)
    assert "regexp_count" not in out._jdf.queryExecution().toString()
    want = {k: F.lit(0) for k in textjobs.EMPHASIS_KINDS}
    step = df.withColumn("t", F.col("text"))
    for i, (kind, pattern, repl, *_) in enumerate(textjobs._emphasis_rules()):
        step = step.withColumn(f"h{i}", F.regexp_count("t", F.lit(pattern))).withColumn("t", F.regexp_replace("t", pattern, repl))
        want[kind] = want[kind] + F.col(f"h{i}")
    want = {r["id"]: tuple(r)[1:] for r in step.select("id", *[want[k].alias(k) for k in textjobs.EMPHASIS_KINDS]).collect()}
    got = {r["id"]: tuple(r)[1:] for r in out.select("id", *[f"hits_{k}" for k in textjobs.EMPHASIS_KINDS]).collect()}
    assert got == want and all(any(v[j] for v in want.values()) for j in range(6))


def test_words_end_at_every_white_space(spark):
    for space in (*text.SPACES, " \t", "\u2003 "):
        assert one(spark, text.words(F.lit(f"{space}é{space}b\u200b{space}\u0085c"))) == ["é", "b\u200b", "\u0085c"], ascii(space)
