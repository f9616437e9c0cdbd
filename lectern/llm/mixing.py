"""Mixing sources to target weights with a hierarchical token budget."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.llm.common import BLANKS, stored, table, whole


def words(text: str | Column) -> Column:
    """Number of runs of characters other than ASCII white space."""
    t = F.btrim(whole(text), F.lit(BLANKS))
    return F.when(t == "", 0).otherwise(F.size(F.split(t, r"[\x20\x09-\x0D]+"))).cast("long")


def _fill(children: DataFrame, parents: DataFrame | Column, up: Sequence[str]) -> DataFrame:
    """Deal each parent's budget to its children by weight, none above its room.

    Children sorted by room / weight fill up in that order; what the full ones
    leave is shared among the rest by weight. A parent's room is the sum of its
    children's, so a shortage reaches a parent's siblings only when all its
    children are full.
    """
    at = Window.partitionBy(*up).orderBy("ratio", *[c for c in children.columns if c not in (*up, "ratio")])
    before = at.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(*up)
    c = children.join(parents.select(*up, F.col("budget").alias("given")), list(up)) if up else children.withColumn("given", parents)
    c = c.withColumn("ratio", F.col("room") / F.col("weight"))
    c = c.withColumns({
        "used": F.coalesce(F.sum("room").over(before), F.lit(0)),
        "light": F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)),
    })
    fits = F.col("ratio") * F.col("light") <= F.greatest(F.col("given") - F.col("used"), F.lit(0.0))
    c = c.withColumn("fits", fits)
    # From the first child that does not fill up on, all share at one rate.
    share = F.when(~F.col("fits"), (F.col("given") - F.col("used")) / F.col("light"))
    c = c.withColumn("rate", F.min_by(share, F.when(~F.col("fits"), F.col("used"))).over(every))
    return c.withColumn("budget", F.when(F.col("rate").isNull(), F.col("room")).otherwise(F.least(F.col("room"), F.col("rate") * F.col("weight"))))


def leaf_budgets(leaves: DataFrame, levels: Sequence[str], weights: Mapping[tuple, float], fraction: float, epochs: int) -> DataFrame:
    """Tokens to take from each leaf. leaves: the levels and ``tokens``."""
    spark = leaves.sparkSession
    nodes = leaves.withColumn("room", F.col("tokens").cast("double") * epochs)
    total = leaves.agg(F.sum("tokens")).first()[0] or 0
    given = F.lit(float(total * fraction))
    for depth in range(1, len(levels) + 1):
        up, own = levels[: depth - 1], levels[:depth]
        here = nodes.groupBy(*own).agg(F.sum("room").alias("room"))
        told = [(*path, float(w)) for path, w in weights.items() if len(path) == depth]
        if told:
            names = [f"_{i}" for i in range(depth)]
            t = spark.createDataFrame(told, ", ".join([*(f"{n} string" for n in names), "w double"]))
            same = [F.col(o).cast("string").eqNullSafe(F.col(n)) for o, n in zip(own, names, strict=True)]
            here = here.join(t, same, "left").drop(*names).withColumn("weight", F.coalesce("w", F.lit(1.0))).drop("w")
        else:
            here = here.withColumn("weight", F.lit(1.0))
        here = here.where("weight > 0 AND room > 0")
        given = _fill(here, given, up).select(*own, "budget")
    return given


def mix(
    docs: DataFrame,
    levels: Sequence[str] = ("domain", "lang", "source"),
    weights: Mapping[tuple, float] | None = None,
    fraction: float = 0.5,
    epochs: int = 2,
    seed: int = 7,
    tokens: Column | None = None,
    slices: int = 4096,
) -> DataFrame:
    """How often each document is taken so that the sources meet their weights.

    The budget, ``fraction`` of all tokens, goes down the tree of ``levels`` by
    ``weights`` (path of values -> weight, 1 where none is told). A leaf holds
    its tokens ``epochs`` times; a node's shortage goes to its siblings by
    weight, and to its parent's siblings only when those are full too. A leaf
    gives whole passes over its documents, then the documents of a last pass in
    an order seeded by epoch, up to the one that crosses its budget.

    The running sum within a leaf is cut into ``slices`` of the order: sums of
    slices are combined first, and rows are summed only in the one slice where
    the budget ends. No leaf's rows meet in one task.

    Returns one row per input row: ``doc_id``, the levels, ``n_tokens``,
    ``copies``. Null and empty texts have no tokens and are taken with the pass
    (whole passes only). Null level values form a node of their own. Repeated
    rows share their place in the order. No rows give no rows.
    """
    levels = list(levels)
    count = words("text") if tokens is None else tokens
    named = [F.coalesce(F.col(c).cast("string"), F.lit("\0")).alias(f"k{i}") for i, c in enumerate(levels)]
    keys = [f"k{i}" for i in range(len(levels))]
    rows = stored(docs.select("doc_id", *named, count.cast("long").alias("n_tokens")), "mix-rows")
    leaves = stored(rows.groupBy(*keys).agg(F.sum("n_tokens").alias("tokens")), "mix-leaves")
    budgets = leaf_budgets(leaves, keys, weights or {}, fraction, epochs)
    plan = leaves.join(budgets, keys, "left").select(
        *keys,
        F.when(F.coalesce("budget", F.lit(0.0)) > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(0).cast("long").alias("passes"),
        F.coalesce("budget", F.lit(0.0)).alias("budget"),
        "tokens",
    )
    plan = stored(plan.withColumn("rest", F.when(F.col("tokens") > 0, F.col("budget") - F.col("passes") * F.col("tokens")).otherwise(0.0)), "mix-plan")

    order = F.md5(F.concat_ws(":", F.lit(str(seed)), "passes", F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).cast("binary"))
    width = 16 ** len(f"{slices - 1:x}")
    slice_no = (F.conv(F.substring("pos", 1, len(f"{width - 1:x}")), 16, 10).cast("long") * slices / width).cast("long")
    placed = stored(rows.join(plan, keys).withColumn("pos", order).withColumn("slice", slice_no).drop("budget", "tokens"), "mix-order")
    sums = placed.groupBy(*keys, "slice").agg(F.sum("n_tokens").alias("s"))
    w = Window.partitionBy(*keys).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = stored(sums.withColumn("ahead", F.coalesce(F.sum("s").over(w), F.lit(0))), "mix-slices")
    known = placed.join(sums, [*keys, "slice"])
    inside = (F.col("ahead") < F.col("rest")) & (F.col("ahead") + F.col("s") >= F.col("rest"))
    out = ["doc_id", *keys, "n_tokens", "passes"]
    clear = known.where(~inside).select(*out, (F.col("ahead") + F.col("s") < F.col("rest")).alias("more"))
    same = Window.partitionBy(*keys, "slice").orderBy("pos", "n_tokens").rowsBetween(Window.unboundedPreceding, -1)
    cut = known.where(inside).withColumn("so_far", F.col("ahead") + F.coalesce(F.sum("n_tokens").over(same), F.lit(0)))
    cut = cut.select(*out, (F.col("so_far") < F.col("rest")).alias("more"))
    result = clear.unionByName(cut)
    back = [F.when(F.col(k) != "\0", F.col(k)).alias(c) for k, c in zip(keys, levels, strict=True)]
    return result.select("doc_id", *back, "n_tokens", (F.col("passes") + F.col("more").cast("long")).alias("copies"))


# Domains of the given tables: sources by the last digit of their name.
WEIGHTS = {("even",): 2.0, ("odd",): 1.0, ("even", "en"): 3.0, ("odd", "en"): 1.0, ("even", "en", "src0"): 0.5}


def domain(source: str = "source") -> Column:
    odd = F.regexp_extract(F.coalesce(F.col(source), F.lit("")), r"[13579]$", 0) != ""
    return F.when(odd, "odd").otherwise("even")


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("domain", domain())
    return mix(docs, weights=WEIGHTS)


def _level_sql(depth: int) -> str:
    """One level of budgets: b<depth> from b<depth - 1>."""
    names = ("domain", "lang", "source")
    up, own = ", ".join(names[: depth - 1]) or "1", ", ".join(names[:depth])
    told = " ".join(
        "WHEN " + " AND ".join(f"{n} = '{v}'" for n, v in zip(names, path, strict=False)) + f" THEN {w}::DOUBLE" for path, w in WEIGHTS.items() if len(path) == depth
    )
    weight = f"CASE {told} ELSE 1.0::DOUBLE END" if told else "1.0::DOUBLE"
    parent = f"JOIN b{depth - 1} USING ({up})" if depth > 1 else "CROSS JOIN b0"
    return f"""
n{depth} AS (SELECT {own}, sum(tokens)::DOUBLE * 2 AS room, {weight} AS weight FROM leaves GROUP BY {own}),
f{depth} AS (SELECT n{depth}.*, budget AS given, room / weight AS ratio FROM n{depth} {parent} WHERE weight > 0 AND room > 0),
g{depth} AS (SELECT *, coalesce(sum(room) OVER w, 0) AS used, sum(weight) OVER (PARTITION BY {up}) - coalesce(sum(weight) OVER w, 0) AS light
  FROM f{depth} WINDOW w AS (PARTITION BY {up} ORDER BY ratio, {names[depth - 1]} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
h{depth} AS (SELECT *, ratio * light <= greatest(given - used, 0) AS fits FROM g{depth}),
r{depth} AS (SELECT *, arg_min((given - used) / light, used) FILTER (NOT fits) OVER (PARTITION BY {up}) AS rate FROM h{depth}),
b{depth} AS (SELECT {own}, CASE WHEN rate IS NULL THEN room ELSE least(room, rate * weight) END AS budget FROM r{depth})"""


QUERIES = {"op8_source_mixing": op8_source_mixing}
SQL = {
    "op8_source_mixing": f"""
WITH d AS (
  SELECT doc_id, CASE WHEN regexp_matches(coalesce(source, ''), '[13579]$') THEN 'odd' ELSE 'even' END AS domain, lang, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS n_tokens FROM documents),
leaves AS (SELECT domain, lang, source, sum(n_tokens) AS tokens FROM d GROUP BY ALL),
b0 AS (SELECT sum(tokens)::DOUBLE * 0.5 AS budget FROM leaves),{_level_sql(1)},{_level_sql(2)},{_level_sql(3)},
plan AS (
  SELECT domain, lang, source, tokens, coalesce(budget, 0) AS budget,
         CASE WHEN coalesce(budget, 0) > 0 THEN CAST(floor(budget / tokens) AS BIGINT) ELSE 0 END AS passes
  FROM leaves LEFT JOIN b3 USING (domain, lang, source)),
o AS (
  SELECT d.*, passes, CASE WHEN tokens > 0 THEN budget - passes * tokens ELSE 0 END AS rest, md5('7:' || passes || ':' || doc_id) AS pos
  FROM d JOIN plan USING (domain, lang, source)),
c AS (
  SELECT *, coalesce(sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY pos, n_tokens ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS so_far FROM o)
SELECT doc_id, domain, lang, source, n_tokens, passes + CAST(so_far < rest AS BIGINT) AS copies FROM c"""
}
