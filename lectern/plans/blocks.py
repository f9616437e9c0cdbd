"""Rows in key order, cut into blocks of a bounded number of rows.

A range exchange puts neighbours in the order into one task, sorts them there
and numbers them, so a block holds at most so many consecutive rows whatever
their keys: a hot key falls into many blocks, many small keys share one. The
rows are written with their block, so every reader and every task that runs
again sees the same cut.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern import session

ROWS_PER_BLOCK = 500_000


def in_blocks(df: DataFrame, order: Sequence[str], rows: int = ROWS_PER_BLOCK, distinct: bool = False) -> DataFrame:
    """``df`` with ``block``, whose numbers follow ``order``; written below the shared folder.

    ``distinct``: one row for those equal in ``order``; they come to one task anyhow.
    """
    # The number's upper bits are the task, its lower ones the row's place in it.
    place = F.monotonically_increasing_id()
    cut = df.repartitionByRange(*order)
    cut = cut.dropDuplicates(list(order)) if distinct else cut
    cut = cut.sortWithinPartitions(*order).withColumn("block", F.floor(place / F.lit(rows)).cast("long"))
    path = session.new_path(df.sparkSession, "blocks")
    cut.write.parquet(path)
    return df.sparkSession.read.schema(cut.schema).parquet(path)
