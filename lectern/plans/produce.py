"""Whole journeys put together from the operators.

Planning an ordered scan writes its rows in order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern import session
from lectern.operators import align, analytics, catalog, metadata, strategy, textjobs


def channel_report(uploads: DataFrame, stats: DataFrame, mode: str = "tz") -> DataFrame:
    """Newest uploads with counters -> hourly profile -> best hour, with totals."""
    v = analytics.enrich_stats(uploads, stats)
    best = analytics.best_hour(analytics.hourly_profile(v, mode))
    return best.join(analytics.channel_totals(v).drop("videos"), "channel")


def next_topics(topics: DataFrame, results: DataFrame, playlist_items: DataFrame) -> DataFrame:
    """Next topic per stream, its strategy, and the rows a series splits into."""
    chosen = catalog.next_pending(topics)
    decided = strategy.decide_strategy(results, chosen, on="topic_id")
    return strategy.split_topics(decided, playlist_items)


def align_videos(words: DataFrame, candidates: DataFrame, totals: DataFrame, key: str) -> DataFrame:
    """Scene candidates and spoken words -> slides with text and pace."""
    totals = session.written(totals, "totals")  # asked for three times
    scenes = align.scene_intervals(align.scene_thin(candidates, totals, key), totals, key)
    return align.paced_slides(scenes, words, key)


def voice_plan(docs: DataFrame, topics: DataFrame, key: str, channel: str) -> DataFrame:
    """Scripts with emphasis, packed into chunks with a speaking instruction each."""
    scripts = textjobs.build_scripts(docs, topics, key, channel)
    spoken = textjobs.emphasize(scripts.select(key, F.col("full_script").alias("text")))
    chunks = textjobs.pack_chunks(spoken.select(key, F.col("emphasized").alias("text")), key)
    return chunks.withColumns(textjobs.speaking())


def publish_metadata(topics: DataFrame) -> DataFrame:
    """Title, description and tags per topic."""
    return metadata.describe(metadata.plan_titles(topics)).withColumn(
        "tags", metadata.fit_tag_array(metadata.candidate_tags())
    )
