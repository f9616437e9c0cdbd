"""Topic catalog sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern import rules, schemas
from lectern.functions.arrays import open_rows


def flatten_topics(df: DataFrame, stream: str | Column = "stream") -> DataFrame:
    """Nested property documents to flat rows, with the usual defaults."""
    p = F.col("properties")
    return df.select(
        F.col("id").alias("topic_id"),
        (F.col(stream) if isinstance(stream, str) else stream).alias("stream"),
        F.coalesce(p["Subject"]["select"]["name"], F.lit(rules.UNKNOWN)).alias("subject"),
        F.coalesce(p["Chapter"]["select"]["name"], F.lit(rules.UNKNOWN)).alias("chapter"),
        F.coalesce(F.get(p["Topic"]["title"], F.lit(0))["plain_text"], F.lit(rules.UNKNOWN)).alias("topic"),
        F.coalesce(p["Status"]["select"]["name"], F.lit(rules.PENDING)).alias("status"),
        "created_time",
    )


def read_topics(spark: SparkSession, path: str, stream: str) -> DataFrame:
    """Landed exports of one stream's catalog (one JSON document per line)."""
    wire = spark.read.schema(schemas.TOPICS_WIRE).json(path)
    return flatten_topics(wire, F.lit(stream))


def parse_topics(df: DataFrame, doc: str = "doc") -> DataFrame:
    """The same from a text column holding one document per row."""
    return flatten_topics(df.select("stream", F.from_json(doc, schemas.TOPICS_WIRE).alias("d")).select("stream", "d.*"))


def flatten_syllabus(df: DataFrame, doc: str = "doc") -> DataFrame:
    """stream -> subject -> chapters -> topics documents to one row per topic.

    A chapter given as a bare string yields one topic, its overview.
    """
    tree = df.select(F.from_json(doc, schemas.SYLLABUS_WIRE).alias("tree"))
    streams = tree.select(F.explode_outer("tree").alias("stream", "subjects"))
    subjects = streams.select("stream", F.explode_outer("subjects").alias("subject", "chapters"))
    entries = open_rows(subjects, ["stream", "subject"], "chapters", "__i", "entry").withColumn(
        "c", F.from_json("entry", schemas.CHAPTER)
    )
    is_object = F.ltrim("entry").startswith("{")
    chapter = F.when(is_object, F.col("c.chapter")).otherwise(F.col("entry"))
    topics = F.when(is_object, F.col("c.topics"))
    return (
        open_rows(
            entries.select("stream", "subject", chapter.alias("chapter"), topics.alias("topics")),
            ["stream", "subject", "chapter"],
            F.coalesce("topics", F.array(F.concat("chapter", F.lit(" Overview")))),
            "__i",
            "topic",
        )
        .drop("__i")
        .withColumn("status", F.lit(rules.PENDING))
    )
