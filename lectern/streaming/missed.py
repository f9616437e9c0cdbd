"""Missed-run alerts as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern import rules
from lectern.functions.time import IST, instant, local_date


def stream_missed(slots: DataFrame, runs: DataFrame, late: str = "1 hour", grace_s: int = rules.CATCH_UP_SECONDS) -> DataFrame:
    """Alert for each slot without a success on its local day by slot plus grace.

    Slots: stream, local_day, slot_at. Runs: stream, ts, status. A stream-stream
    left outer join holds each slot until the watermark has passed its grace
    time and then emits it unmatched at most once. The watermark is that of the
    slower side, so a feed running behind raises no false alert; state older than
    it is dropped on both sides.
    """
    grace = F.expr(f"INTERVAL {grace_s} SECONDS")
    s = slots.select(
        F.col("stream").alias("stream"), "local_day", instant("slot_at").alias("slot_at")
    ).withWatermark("slot_at", late)
    r = (
        runs.where(F.col("status") == "success")
        .select(F.col("stream").alias("r_stream"), instant("ts").alias("r_ts"))
        .withColumn("r_day", local_date(F.col("r_ts"), IST))
        .withWatermark("r_ts", late)
    )
    on = (
        (F.col("stream") == F.col("r_stream"))
        & (F.col("local_day") == F.col("r_day"))
        & (F.col("r_ts") <= F.col("slot_at") + grace)
        & (F.col("r_ts") >= F.col("slot_at") - F.expr("INTERVAL 1 DAY"))
    )
    return s.join(r, on, "left_outer").where(F.col("r_stream").isNull()).select("stream", "local_day", "slot_at")
