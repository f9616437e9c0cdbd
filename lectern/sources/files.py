"""File listings and partitioned output."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_files(spark: SparkSession, path: str, pattern: str = "*", content: bool = False) -> DataFrame:
    """dir, name, modified_at, length (and content) of the files below a path.

    Without ``content`` the reader lists the files and opens none of them.
    """
    df = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(path)
    )
    cut = r"^(.*)/([^/]*)$"
    return df.select(
        F.regexp_extract("path", cut, 1).alias("dir"),
        F.regexp_extract("path", cut, 2).alias("name"),
        F.col("modificationTime").alias("modified_at"),
        "length",
        *(["content"] if content else []),
    )


def read_seen(spark: SparkSession, path: str, column: str = "url") -> DataFrame:
    return spark.read.schema(f"{column} string").json(path)


def write_outputs(
    df: DataFrame,
    path: str,
    by: Sequence[str],
    fmt: str = "parquet",
    max_records: int = 5_000_000,
) -> None:
    """One directory per value of ``by``; only touched directories are replaced.

    Rows are rebalanced by directory: adaptive execution splits a large one into
    as many tasks as its measured size asks for, and joins small ones.
    """
    (
        df.hint("rebalance", *by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", max_records)
        .partitionBy(*by)
        .format(fmt)
        .save(path)
    )
