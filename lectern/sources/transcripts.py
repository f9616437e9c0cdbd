"""Word-timed transcripts and scene logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern import schemas
from lectern.functions.arrays import open_rows
from lectern.functions.num import ms
from lectern.functions.text import number, trim_space


def transcript_words(df: DataFrame, key: str = "video_id") -> DataFrame:
    """All words in spoken order, from the words nested in the segments."""
    flat = F.flatten(F.transform("segments", lambda s: s["words"]))
    return open_rows(df, [key], flat, "word_idx", "w").select(
        key,
        "word_idx",
        trim_space(F.col("w.word")).alias("word"),
        ms(F.col("w.start")).alias("start_s"),
        ms(F.col("w.end")).alias("end_s"),
    )


def transcript_segments(df: DataFrame, key: str = "video_id") -> DataFrame:
    return open_rows(df, [key], "segments", "__i", "s").select(
        key,
        F.col("s.id").alias("seg_id"),
        ms(F.col("s.start")).alias("start_s"),
        ms(F.col("s.end")).alias("end_s"),
        trim_space(F.col("s.text")).alias("text"),
        F.size("s.words").alias("n_words"),
    )


def read_transcripts(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(words, segments) of landed transcript documents."""
    df = spark.read.schema(schemas.TRANSCRIPT).json(path)
    return transcript_words(df), transcript_segments(df)


def parse_scene_log(df: DataFrame, line: str = "line", out: str = "ts_s") -> DataFrame:
    """Candidate scene times from tool output; lines without one are dropped."""
    # Fixed value: how the tool writes a time.
    t = number(F.regexp_extract(line, r"pts_time:\s*([0-9.]+)", 1))
    return df.withColumn(out, ms(t)).where(F.col(out).isNotNull()).drop(line)


def read_scene_log(spark: SparkSession, path: str) -> DataFrame:
    return parse_scene_log(spark.read.text(path).withColumnRenamed("value", "line"))
