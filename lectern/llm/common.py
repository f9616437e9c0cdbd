"""Small helpers the operators share."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern import session

# ASCII white space, and the two alphabets of the ASCII-only lower-casing.
BLANKS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it again.

    Cuts lineage, survives lost executors, and gives Spark a true size from
    which it decides for or against a broadcast.
    """
    path = session.new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_by(df: DataFrame, name: str, by: str) -> str:
    """Write ``df`` below the shared folder with a subfolder for each value of ``by``, and give the path."""
    path = session.new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").partitionBy(by).parquet(path)
    return path


def dropped(spark: SparkSession, *paths: str) -> None:
    """Delete written tables, or subfolders of them, that nothing reads any more."""
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def brief_shuffles(spark: SparkSession):
    """Within this, the files of a query's shuffles are deleted when the query ends."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def bounded_batches(spark: SparkSession) -> SparkSession:
    """Hand texts to Python in batches of a bounded size, however long they are."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")
    return spark


def whole(c: str | Column) -> Column:
    """The text, with null as empty."""
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, UPPER.lower())
