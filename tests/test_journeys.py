"""The combined plans, over the smallest tables."""

from pyspark.sql import functions as F

from bindings import views as V
from lectern import rules
from lectern.plans import produce

D = "/root/testdata/sf0.001"


def test_next_topics(spark):
    rows = produce.next_topics(V.topics(spark, D), V.results(spark, D), V.playlist_items(spark, D)).collect()
    by_parent = {}
    for r in rows:
        by_parent.setdefault(r["parent_id"], []).append(r)
    assert len(by_parent) <= 5
    for parts in by_parent.values():
        assert sum(p["action"] == "rename" for p in parts) == 1 and len(parts) <= rules.SPLIT_CAP


def test_align_videos_covers_every_document_to_its_end(spark):
    w = V.word_rows(spark, D)
    totals = w.groupBy("doc_id").agg(F.max("end_s").alias("total_s"))
    c = w.where(F.length("word") > 6).select("doc_id", F.col("start_s").alias("ts_s"))
    got = produce.align_videos(w, c, totals, "doc_id")
    n = {r["doc_id"]: r["n"] for r in w.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    ends = {r["doc_id"]: (r["lo"], r["hi"]) for r in got.groupBy("doc_id").agg(F.min("word_start_index").alias("lo"), F.max("word_end_index").alias("hi")).collect()}
    assert ends == {k: (0, v - 1) for k, v in n.items()}
    assert got.where((F.col("speed_factor") < rules.PACE_MIN) | (F.col("speed_factor") > rules.PACE_MAX)).count() == 0


def test_voice_plan_gives_every_chunk_an_instruction(spark):
    docs = V.documents(spark, D)
    topics = docs.select("doc_id", F.col("lang").alias("stream"), F.col("source").alias("subject"), F.lit("Heaps").alias("topic"))
    got = produce.voice_plan(docs, topics, "doc_id", "Daily Lectures")
    assert got.select("doc_id").distinct().count() == docs.count()
    assert got.where(F.col("instruct").isNull() | (F.col("speed") > rules.SPEED_MAX)).count() == 0


def test_publish_metadata_keeps_its_budgets(spark):
    got = produce.publish_metadata(V.catalog_topics(spark, D))
    cost = F.aggregate("tags", F.lit(0), lambda a, t: a + F.length(t) + rules.TAG_OVERHEAD)
    bad = (F.length("title") > rules.TITLE_MAX) | (F.length("description") > rules.DESCRIPTION_MAX) | (cost > rules.TAG_BUDGET)
    assert got.count() == 200 and got.where(bad).count() == 0
