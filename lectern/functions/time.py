"""Time expressions: local (IST by default) days and hours against UTC instants."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

IST = "Asia/Kolkata"


def instant(c: Column | str) -> Column:
    """TIMESTAMP (UTC session) from either timestamp flavour; watermarks need this."""
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("timestamp")


def naive(c: Column | str) -> Column:
    """TIMESTAMP_NTZ holding the UTC wall clock, for sinks that expect no zone."""
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("timestamp_ntz")


def local_time(ts: Column, tz: str = IST) -> Column:
    return F.from_utc_timestamp(instant(ts), tz)


def local_date(ts: Column, tz: str = IST) -> Column:
    return F.to_date(local_time(ts, tz))


def same_local_day(a: Column, b: Column, tz: str = IST) -> Column:
    return local_date(a, tz) == local_date(b, tz)


def slot_utc(day: Column, hour_local: Column, tz: str = IST) -> Column:
    """UTC instant of ``hour_local``:00 on the local calendar day ``day``."""
    wall = F.timestamp_seconds(
        F.unix_date(day).cast("long") * 86400 + hour_local.cast("long") * 3600
    )
    return F.to_utc_timestamp(wall, tz)


def hour_of_upload(ts: Column, mode: str = "tz", tz: str = IST) -> Column:
    """Local upload hour. ``legacy`` keeps the whole-hour shift UTC+5."""
    if mode == "legacy":
        return F.pmod(F.hour(instant(ts)) + 5, F.lit(24))
    if mode != "tz":
        raise ValueError(f"mode must be 'tz' or 'legacy', not {mode!r}")
    return F.hour(local_time(ts, tz))


def hour_label(h: Column) -> Column:
    """12-hour label such as ``6 PM``."""
    h12 = F.when(h % 12 == 0, F.lit(12)).otherwise(h % 12)
    return F.concat(h12.cast("string"), F.when(h < 12, F.lit(" AM")).otherwise(F.lit(" PM")))


def format_local(ts: Column, tz: str = IST, suffix: str = " IST") -> Column:
    """``yyyy-MM-dd HH:mm IST``; null stays null."""
    return F.concat(F.date_format(local_time(ts, tz), "yyyy-MM-dd HH:mm"), F.lit(suffix))


def countdown(target: Column, as_of: Column) -> Column:
    """``Xh Ym`` until target, ``Now`` when it is due, a dash when there is none."""
    left = F.unix_millis(instant(target)) - F.unix_millis(instant(as_of))
    hours = F.floor(left / 3600000).cast("long")
    minutes = F.floor((left % 3600000) / 60000).cast("long")
    return (
        F.when(left.isNull(), F.lit("—"))
        .when(left <= 0, F.lit("Now"))
        .otherwise(F.concat(hours.cast("string"), F.lit("h "), minutes.cast("string"), F.lit("m")))
    )
