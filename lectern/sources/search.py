"""Ranked search results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern import schemas
from lectern.functions.arrays import open_rows


def parse_search_results(df: DataFrame, query: str, doc: str = "items", offset: Column | None = None) -> DataFrame:
    """One row per result. ``offset`` is the rank of a page's first item."""
    start = F.lit(0) if offset is None else offset
    keep = [F.col(query).alias("query_id"), start.cast("long").alias("__start")]
    return open_rows(df, keep, F.from_json(doc, schemas.SEARCH_ITEMS), "__pos", "item").select(
        "query_id",
        (F.col("__start") + F.col("__pos")).alias("rank"),
        F.col("item.id.kind").alias("kind"),
        F.col("item.id.videoId").alias("video_id"),
        F.col("item.id.playlistId").alias("playlist_id"),
        F.col("item.snippet.title").alias("title"),
        F.col("item.snippet.description").alias("description"),
        F.col("item.snippet.channelTitle").alias("channel"),
    )


def read_search_results(spark: SparkSession, path: str) -> DataFrame:
    """Landed snapshots: one JSON object per line with ``query_id`` and ``items``."""
    df = spark.read.schema(f"query_id string, items {schemas.SEARCH_ITEMS}").json(path)
    return parse_search_results(df.withColumn("items", F.to_json("items")), "query_id")
