"""Arrays to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def open_rows(df: DataFrame, keep: list[str | Column], array: Column | str, pos: str, value: str) -> DataFrame:
    """One row per array element with its 0-based position.

    A plain explode makes the optimizer test the array for emptiness first,
    with the expression that builds it copied below every projection: the array
    is then built twice, and a fold over it once per element. The outer form has
    no such test; rows without elements leave right after.
    """
    return df.select(*keep, F.posexplode_outer(array).alias(pos, value)).where(F.col(pos).isNotNull())
