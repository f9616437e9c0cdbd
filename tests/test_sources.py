"""Readers and writers on real files."""

import json

from pyspark.sql import functions as F

from lectern import rules
from lectern.sources import catalog, files, logs, search, transcripts


def test_read_topics(spark, tmp_path):
    docs = [
        {"id": "1", "properties": {"Topic": {"title": [{"plain_text": "Heaps"}]}, "Subject": {"select": {"name": "DSA"}}, "Chapter": {"select": None}, "Status": {"select": {"name": "Failed"}}}},
        {"id": "2", "properties": {"Topic": {"title": []}}},
    ]
    (tmp_path / "t.json").write_text("\n".join(map(json.dumps, docs)))
    got = {r["topic_id"]: r for r in catalog.read_topics(spark, str(tmp_path), "S").collect()}
    assert (got["1"]["topic"], got["1"]["subject"], got["1"]["chapter"], got["1"]["status"]) == ("Heaps", "DSA", rules.UNKNOWN, "Failed")
    assert (got["2"]["topic"], got["2"]["status"], got["2"]["stream"]) == (rules.UNKNOWN, rules.PENDING, "S")


def test_syllabus_with_bare_and_nested_chapters(spark):
    doc = {"S": {"Maths": ["Sets", {"chapter": "Limits", "topics": ["A", "B"]}, {"chapter": "Empty", "topics": []}]}}
    df = spark.createDataFrame([(json.dumps(doc),)], "doc string")
    got = sorted((r["chapter"], r["topic"]) for r in catalog.flatten_syllabus(df).collect())
    assert got == [("Limits", "A"), ("Limits", "B"), ("Sets", "Sets Overview")]


def test_read_search_results(spark, tmp_path):
    doc = {"query_id": "q", "items": [{"id": {"kind": rules.KIND_PLAYLIST, "playlistId": "P"}, "snippet": {"title": "x", "description": "d", "channelTitle": "c"}}, {"id": {"kind": rules.KIND_VIDEO, "videoId": "V"}, "snippet": {"title": "y"}}]}
    (tmp_path / "r.json").write_text(json.dumps(doc))
    got = search.read_search_results(spark, str(tmp_path)).orderBy("rank").collect()
    assert [(r["rank"], r["playlist_id"], r["video_id"], r["title"]) for r in got] == [(0, "P", None, "x"), (1, None, "V", "y")]


def test_read_transcripts(spark, tmp_path):
    doc = {"video_id": "v", "segments": [{"id": 0, "start": 0, "end": 1.23456, "text": " a b ", "words": [{"word": " a", "start": 0, "end": 0.5}, {"word": "b ", "start": 0.5004, "end": 1.0}]}, {"id": 1, "start": 2, "end": 3, "text": "", "words": []}]}
    (tmp_path / "v.json").write_text(json.dumps(doc))
    w, s = transcripts.read_transcripts(spark, str(tmp_path))
    assert [(r["word_idx"], r["word"], r["start_s"]) for r in w.collect()] == [(0, "a", 0.0), (1, "b", 0.5)]
    assert [(r["seg_id"], r["end_s"], r["text"], r["n_words"]) for r in s.collect()] == [(0, 1.235, "a b", 2), (1, 3.0, "", 0)]


def test_logs(spark, tmp_path):
    (tmp_path / "e.log").write_text("[2026-03-22T10:00:00.000Z] [TTS_FAIL] Heaps: it: broke\nnonsense\n[bad] [X] t: m\n")
    got = logs.read_error_log(spark, str(tmp_path / "e.log")).collect()
    assert (got[0]["category"], got[0]["topic"], got[0]["message"]) == ("TTS_FAIL", "Heaps", "it: broke")
    assert got[1]["category"] is None and got[2]["logged_at"] is None and got[2]["topic"] == "t"
    (tmp_path / "r.log").write_text("[Attempt 1] 2026-03-22T10:00:00.000Z\nline one\nline two\n\n[Attempt 2] 2026-03-22T10:05:00.000Z\nother\n\n")
    r = logs.read_retry_log(spark, str(tmp_path / "r.log")).orderBy("attempt").collect()
    assert [(x["attempt"], x["message"]) for x in r] == [(1, "line one\nline two"), (2, "other")]
    (tmp_path / "s.log").write_text("n:0 pts_time:1.5 x\nframe\npts_time: 2.25\npts_time:.\n")
    assert sorted(x["ts_s"] for x in transcripts.read_scene_log(spark, str(tmp_path / "s.log")).collect()) == [1.5, 2.25]


def test_files_and_outputs(spark, tmp_path):
    (tmp_path / "in" / "deep").mkdir(parents=True)
    (tmp_path / "in" / "a.wav").write_bytes(b"x" * 10)
    (tmp_path / "in" / "deep" / "b.mp3").write_bytes(b"y" * 20)
    got = {r["name"]: r["length"] for r in files.read_files(spark, str(tmp_path / "in")).collect()}
    assert got == {"a.wav": 10, "b.mp3": 20}
    out = str(tmp_path / "out")
    df = spark.createDataFrame([(1, "s"), (2, "s"), (3, "t")], "id int, stream string")
    files.write_outputs(df, out, ["stream"])
    # only the directory written again is replaced
    files.write_outputs(df.where("stream = 't'").withColumn("id", F.lit(9)), out, ["stream"], fmt="parquet")
    assert sorted(tuple(r) for r in spark.read.parquet(out).select("id", "stream").collect()) == [(1, "s"), (2, "s"), (9, "t")]
