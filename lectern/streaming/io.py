"""Reading event files as a stream and running a stream to its end."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lectern.session import STATE_STORE, new_path


def read_stream(spark: SparkSession, path: str, schema: str, files_per_trigger: int | None = None) -> DataFrame:
    """Parquet files matching a path pattern, as they arrive."""
    r = spark.readStream.schema(schema)
    if files_per_trigger:
        r = r.option("maxFilesPerTrigger", files_per_trigger)
    return r.parquet(path)


def drain(stream: DataFrame, name: str, mode: str = "append", out: str | None = None, state: str | None = None) -> DataFrame:
    """Process everything available into a written table and read that back.

    Restarting with the same ``out`` and ``state`` continues where it stopped.
    """
    spark = stream.sparkSession
    out = out or new_path(spark, f"{name}-out")
    state = state or new_path(spark, f"{name}-state")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    q = (
        stream.writeStream.outputMode(mode)
        .format("parquet")
        .option("path", out)
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)
