"""Connected components of an edge list, without any group in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import stored


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(id, component) for every id on an edge (a, b); component is the smallest id.

    Alternating large-star and small-star steps: the number of edges never
    grows, and a round halves distances, so it ends after about log(n) rounds.
    Each round's edges are written to the shared folder. Null ends and loops
    are left out.
    """
    u, v = F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    now = stored(edges.where("a <> b").select(u, v).distinct(), "edges")
    seen = None
    for _ in range(max_rounds):
        mark = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if mark == seen or not mark[0]:
            break
        seen = mark
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stored(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = stored(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "small-star")
    else:
        raise RuntimeError("components did not settle")
    roots = now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
