"""Titles, descriptions, tags and slugs for every topic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lectern import rules
from lectern.functions.text import SPACE, fill, hashtag, slug_chars, slug_runs, slug_trimmed, trim_space
from lectern.operators.textjobs import rotation
from lectern.plans.ordered import first_rows


def _values() -> dict[str, Column]:
    return {n: F.col(n) for n in ("topic", "subject", "chapter")}


def plan_titles(topics: DataFrame, by: str = "position", partitions: int | None = None) -> DataFrame:
    """Title formula in rotation inside (stream, subject), cut to length."""
    r = rotation(topics, ["stream", "subject"], ["topic_id"], len(rules.TITLES), "formula", by, partitions)
    title = F.when(F.col("formula") == 0, fill(rules.TITLES[0], **_values()))
    for i, t in enumerate(rules.TITLES[1:], start=1):
        title = title.when(F.col("formula") == i, fill(t, **_values()))
    return r.withColumn("title", F.substring(title, 1, rules.TITLE_MAX))


def duplicate_titles(titles: DataFrame) -> DataFrame:
    """Titles that came out equal for several topics."""
    return (
        titles.groupBy("title")
        .agg(F.count(F.lit(1)).alias("n_topics"), F.min("topic_id").alias("first_topic_id"))
        .where(F.col("n_topics") > 1)
    )


def describe(topics: DataFrame) -> DataFrame:
    tags = {f"{n}_tag": hashtag(F.col(n)) for n in ("topic", "subject", "chapter")}
    text = fill(rules.DESCRIPTION, **_values(), **tags)
    return topics.withColumn("description", F.substring(trim_space(text), 1, rules.DESCRIPTION_MAX))


def candidate_tags() -> Column:
    """Tags of a topic in order of priority, all lower case."""
    low = {n: F.lower(F.col(n)) for n in ("topic", "subject", "chapter")}
    return F.array(*[fill(t, **low) for t in rules.TAGS])


def _tidy(tag: Column, maxlen: int) -> Column:
    t = F.regexp_replace(F.replace(tag, F.lit(","), F.lit("")), f"{SPACE}{{2,}}", " ")
    return F.substring(trim_space(t), 1, maxlen)


def fit_tag_array(
    tags: Column,
    budget: int = rules.TAG_BUDGET,
    overhead: int = rules.TAG_OVERHEAD,
    maxlen: int = rules.TAG_MAX,
    distinct_after: bool = False,
) -> Column:
    """Leading tags that fit the budget, inside one row and without a shuffle.

    Repeats go before tags are cut, so cutting can bring equal ones back;
    ``distinct_after`` removes those too.
    """
    tidy = F.transform(F.array_distinct(tags), lambda t: _tidy(t, maxlen))
    if distinct_after:
        tidy = F.array_distinct(tidy)
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("used"), F.lit(True).alias("open"))

    def step(acc: Column, t: Column) -> Column:
        cost = F.length(t) + overhead
        fits = acc["open"] & (acc["used"] + cost <= budget)
        return F.struct(
            F.when(fits, acc["n"] + 1).otherwise(acc["n"]).alias("n"),
            F.when(fits, acc["used"] + cost).otherwise(acc["used"]).alias("used"),
            fits.alias("open"),
        )

    return F.slice(tidy, F.lit(1), F.aggregate(tidy, start, step, lambda acc: acc["n"]))


def fit_tags(
    tags: DataFrame,
    key: str,
    budget: int = rules.TAG_BUDGET,
    overhead: int = rules.TAG_OVERHEAD,
    maxlen: int = rules.TAG_MAX,
) -> DataFrame:
    """The same from long rows (key, pos, tag).

    Every tag costs at least the overhead, so only the first budget / overhead
    distinct ones can fit: that bound lets Spark cut a hot key before the window.
    """
    unique = tags.groupBy(key, "tag").agg(F.min("pos").alias("pos"))
    head = first_rows(unique, [key], [F.col("pos")], budget // overhead, "__n")
    w = Window.partitionBy(key).orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    t = head.withColumn("tag", _tidy(F.col("tag"), maxlen))
    t = t.withColumn("used", F.sum(F.length("tag") + overhead).over(w)).where(F.col("used") <= budget)
    return t.groupBy(key).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "tag"))), lambda x: x["tag"]).alias("tags"),
        F.max("used").cast("long").alias("used"),
    )


SLUG_RULES = {"chars": slug_chars, "runs": slug_runs, "trimmed": slug_trimmed}


def slugify_keys(df: DataFrame, column: str) -> DataFrame:
    """The three slug forms of a key."""
    return df.withColumns({f"slug_{n}": f(F.col(column)) for n, f in SLUG_RULES.items()})


def slug_collisions(df: DataFrame, column: str, rule: str) -> DataFrame:
    """Slugs that several different keys share; they would overwrite each other."""
    names = df.select(F.col(column).alias("name")).distinct().withColumn("slug", SLUG_RULES[rule](F.col("name")))
    return (
        names.groupBy("slug")
        .agg(F.count(F.lit(1)).alias("n_names"), F.min("name").alias("first_name"), F.max("name").alias("last_name"))
        .where(F.col("n_names") > 1)
    )
