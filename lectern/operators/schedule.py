"""Daily slots, missed runs and run status in local time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions.time import IST, countdown, format_local, instant, local_date, slot_utc

SUCCESS, RUNNING, FAILED_PREFIX = "success", "running", "failed: "  # fixed values: run states


def schedule_slots(schedules: DataFrame, first_day: Column, last_day: Column, tz: str = IST) -> DataFrame:
    """One slot per schedule and local day. Schedules: stream, hour_local, enabled."""
    return schedules.select(
        "stream", "hour_local", "enabled", F.explode(F.sequence(first_day, last_day)).alias("local_day")
    ).withColumn("slot_at", slot_utc(F.col("local_day"), F.col("hour_local"), tz))


def next_run(schedules: DataFrame, as_of: Column, tz: str = IST) -> DataFrame:
    """Next slot strictly after ``as_of`` with its countdown.

    It is today's slot or tomorrow's, so it is computed in the row.
    """
    today = local_date(as_of, tz)
    s0 = slot_utc(today, F.col("hour_local"), tz)
    s1 = slot_utc(F.date_add(today, 1), F.col("hour_local"), tz)
    nxt = F.when(F.col("enabled"), F.when(s0 > instant(as_of), s0).otherwise(s1))
    return schedules.withColumn("next_run", nxt).withColumns(
        {"next_run_local": format_local(F.col("next_run"), tz), "countdown": countdown(F.col("next_run"), as_of)}
    )


def missed_runs(
    schedules: DataFrame,
    runs: DataFrame,
    as_of: Column,
    first_day: Column,
    last_day: Column,
    tz: str = IST,
) -> DataFrame:
    """Passed slots of enabled schedules without a success on the same local day.

    Runs: stream, ts, status. Failed runs do not count; a slot exactly at
    ``as_of`` has not passed. Successes fold to distinct days before the join.
    """
    slots = schedule_slots(schedules.where("enabled"), first_day, last_day, tz).where(F.col("slot_at") < instant(as_of))
    done = (
        runs.where((F.col("status") == SUCCESS) & (instant("ts") <= instant(as_of)))
        .select(F.col("stream"), local_date(F.col("ts"), tz).alias("local_day"))
        .distinct()
    )
    return slots.join(done, ["stream", "local_day"], "left_anti")


def run_status(runs: DataFrame, key: str = "stream", order: tuple[str, ...] = ("ts", "event_id"), tz: str = IST) -> DataFrame:
    """Latest status per key with its message, local time and success rate."""
    ended = F.count_if((F.col("status") == SUCCESS) | F.col("status").startswith(FAILED_PREFIX))
    r = runs.groupBy(key).agg(
        F.max_by(F.struct("ts", "status"), F.struct(*order)).alias("last"),
        F.count(F.lit(1)).alias("n_events"),
        F.try_divide(F.count_if(F.col("status") == SUCCESS).cast("double"), ended).alias("success_rate"),
    )
    status = F.col("last.status")
    failed = status.startswith(FAILED_PREFIX)
    return r.select(
        key,
        F.when(failed, F.lit("failed")).otherwise(status).alias("state"),
        F.when(failed, status.substr(F.lit(len(FAILED_PREFIX) + 1), F.length(status))).alias("message"),
        F.col("last.ts").alias("last_run"),
        format_local(F.col("last.ts"), tz).alias("last_run_local"),
        "n_events",
        "success_rate",
    )
