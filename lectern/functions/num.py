"""Numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clamp(c: Column, lo: float, hi: float) -> Column:
    return F.greatest(F.lit(lo), F.least(F.lit(hi), c))


def ms(c: Column) -> Column:
    """Media offsets are seconds with three decimals.

    Spark rounds by way of decimals. Where the thousandths are clearly nearer to
    one whole number than to another, that number over 1000 is the same double.
    """
    t = c.cast("double")
    k = F.rint(t * 1000)
    clear = (F.abs(t * 1000 - k) < 0.49) & (F.abs(k) < 1e12)
    return F.when(clear, k / 1000 + 0.0).otherwise(F.round(t, 3))


def round_half_up(c: Column) -> Column:
    """Whole number, .5 goes up, also below zero."""
    return F.floor(c.cast("double") + 0.5).cast("long")
