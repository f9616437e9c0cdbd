"""Error, retry and live logs, as text columns, files or streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Line formats.
ERROR_LINE = r"^\[([^\]]+)\] \[([^\]]+)\] (.*?): (.*)$"
RETRY_RECORD = r"(?s)^\s*\[Attempt (\d+)\] (\S+)\n(.*?)\s*$"


def parse_error_log(df: DataFrame, line: str = "line") -> DataFrame:
    """``[ISO] [CATEGORY] topic: message``; malformed lines keep null fields.

    Stateless, so it takes a batch or a stream.
    """
    ok = F.col(line).rlike(ERROR_LINE)

    def part(i: int):
        return F.when(ok, F.regexp_extract(line, ERROR_LINE, i))

    return df.select(
        "*",
        F.try_to_timestamp(part(1)).alias("logged_at"),
        part(2).alias("category"),
        part(3).alias("topic"),
        part(4).alias("message"),
    )


def parse_retry_log(df: DataFrame, record: str = "record") -> DataFrame:
    """``[Attempt n] ISO`` and a message of one or more lines."""
    ok = F.col(record).rlike(RETRY_RECORD)

    def part(i: int):
        return F.when(ok, F.regexp_extract(record, RETRY_RECORD, i))

    return df.select(
        "*",
        part(1).try_cast("int").alias("attempt"),
        F.try_to_timestamp(part(2)).alias("logged_at"),
        part(3).alias("message"),
    )


def read_error_log(spark: SparkSession, path: str) -> DataFrame:
    return parse_error_log(spark.read.text(path).withColumnRenamed("value", "line")).drop("line")


def read_error_stream(spark: SparkSession, path: str) -> DataFrame:
    return parse_error_log(spark.readStream.text(path).withColumnRenamed("value", "line")).drop("line")


def read_retry_log(spark: SparkSession, path: str) -> DataFrame:
    """Records are separated by a blank line."""
    raw = spark.read.option("lineSep", "\n\n").text(path)
    return parse_retry_log(raw.withColumnRenamed("value", "record")).where(F.col("attempt").isNotNull()).drop("record")
