"""One successful publish per stream and local day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.functions.time import instant, local_date


def stream_dedup(src: DataFrame, late: str = "2 days") -> DataFrame:
    """Src: stream, ts, status. Replays within ``late`` are dropped."""
    ok = src.where(F.col("status") == "success").select("stream", instant("ts").alias("ts"))
    return (
        ok.withColumn("local_day", local_date(F.col("ts")))
        .withWatermark("ts", late)
        .dropDuplicatesWithinWatermark(["stream", "local_day"])
        .select("stream", "local_day")
    )
