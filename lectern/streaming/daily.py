"""Counts per local day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions.time import instant

# A local day in UTC+5:30 starts at 18:30 UTC.
DAY_START = "18 hours 30 minutes"


def stream_daily(src: DataFrame, by: str, value: Column, late: str = "1 hour") -> DataFrame:
    """Count and sum per local day and type; rows later than ``late`` are dropped."""
    s = src.select(instant("ts").alias("ts"), by, value.alias("value")).withWatermark("ts", late)
    return (
        s.groupBy(F.window("ts", "1 day", "1 day", DAY_START), by)
        .agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
        .select(
            # the local date is the one the window ends on less half an hour's slack
            F.to_date(F.col("window.end") - F.expr("INTERVAL 1 HOUR")).alias("local_day"),
            by,
            "n",
            "total",
        )
    )
