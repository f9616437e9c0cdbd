"""Single video or series: decisions from ranked search results, and the split."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern import rules
from lectern.functions.arrays import open_rows
from lectern.functions.text import WORD_END, WORD_START, trim_space
from lectern.plans.ordered import first_rows


def _has_mark(title: Column, marks: Sequence[str], strict: bool) -> Column:
    """Plain containment (``step 1`` contains ``ep 1``); strict asks for whole words."""
    if strict:
        hits = [title.rlike(f"{WORD_START}{m}{WORD_END}") for m in marks]
    else:
        hits = [title.contains(m) for m in marks]
    return reduce(lambda a, b: a | b, hits)


def decide_strategy(
    results: DataFrame,
    topics: DataFrame,
    on: str = "query_id",
    strict: bool = False,
    older_rule: bool = False,
) -> DataFrame:
    """One decision per topic; topics without results stay ``single``.

    The top results fold to one row per query by a combining aggregate, so a
    query with very many results costs nothing extra.
    """
    title = F.lower("title")
    best = F.struct("rank", "title", "kind", "playlist_id")
    first = F.min(best)
    q = (
        results.where(F.col("rank") < rules.TOP_RESULTS)
        .groupBy(F.col("query_id").alias("__q"))
        .agg(
            first.alias("top"),
            F.count(F.lit(1)).alias("n_results"),
            F.count_if(title.rlike(rules.SERIES_PATTERN)).alias("series_count"),
        )
    )
    marks = rules.FIRST_PART_MARKS_OLD if older_rule else rules.FIRST_PART_MARKS
    is_list = F.col("top.kind") == rules.KIND_PLAYLIST
    is_first = _has_mark(F.lower("top.title"), marks, strict)
    is_series = (F.col("series_count") >= rules.SERIES_MIN) & F.lit(not older_rule)
    none = F.col("n_results").isNull()
    j = topics.join(q, topics[on] == q["__q"], "left")
    reason = (
        F.when(none, F.lit(rules.REASON_NONE))
        .when(is_list, F.lit(rules.REASON_PLAYLIST))
        .when(is_first, F.lit(rules.REASON_FIRST_PART))
        .when(is_series, F.concat(F.col("series_count").cast("string"), F.lit(rules.REASON_SERIES)))
        .otherwise(F.lit(rules.REASON_SINGLE))
    )
    branch = ~none & (is_list | is_first | is_series)
    return j.select(
        *topics.columns,
        F.when(branch, F.lit("branch")).otherwise(F.lit("single")).alias("strategy"),
        reason.alias("reason"),
        F.coalesce("n_results", F.lit(0)).cast("long").alias("n_results"),
        F.coalesce("series_count", F.lit(0)).cast("long").alias("series_count"),
        F.when(is_list, F.col("top.playlist_id")).alias("playlist_id"),
    )


def split_topics(decisions: DataFrame, playlist_items: DataFrame, older_rule: bool = False) -> DataFrame:
    """Rows a branched topic turns into: position 0 renames it, the rest are new.

    Decisions: topic_id, topic, stream, subject, chapter, strategy, playlist_id;
    new rows belong to the same stream, subject and chapter. Items:
    playlist_id, pos, title. A playlist gives its first titles, anything else
    three generic parts.
    """
    cap = rules.SPLIT_CAP_OLD if older_rule else rules.SPLIT_CAP
    items = first_rows(
        playlist_items.select("playlist_id", "pos", "title"), ["playlist_id"], [F.col("pos")], cap, "n"
    ).select("playlist_id", (F.col("n") - 1).cast("int").alias("__pos"), F.col("title").alias("__title"))
    branched = decisions.where(F.col("strategy") == "branch")
    # Topics without a playlist stay out of the join, where they would share one key.
    listed = branched.where(F.col("playlist_id").isNotNull()).join(items, "playlist_id", "left")
    j = listed.unionByName(branched.where(F.col("playlist_id").isNull()), allowMissingColumns=True)
    generic = F.array(
        *[
            F.struct(F.lit(i).alias("pos"), F.concat("topic", F.lit(f" - Part {i + 1}")).alias("title"))
            for i in range(rules.GENERIC_PARTS)
        ]
    )
    own = F.array(F.struct(F.col("__pos").alias("pos"), F.col("__title").alias("title")))
    parts = j.withColumn("part", F.explode(F.when(F.col("__pos").isNull(), generic).otherwise(own)))
    pos, title = F.col("part.pos"), F.col("part.title")
    stem = F.col("topic") if older_rule else F.col("chapter")
    blank = F.coalesce(trim_space(title), F.lit("")) == ""
    lesson = F.concat(stem, F.lit(" - Lesson "), (pos + 1).cast("string"))
    return parts.select(
        F.col("topic_id").alias("parent_id"),
        "stream",
        "subject",
        "chapter",
        F.when(pos == 0, F.lit("rename")).otherwise(F.lit("insert")).alias("action"),
        pos.alias("pos"),
        F.when(pos == 0, F.col("topic_id").cast("string"))
        .otherwise(F.sha2(F.concat(F.col("topic_id").cast("string"), F.lit("-"), pos.cast("string")), 256))
        .alias("row_id"),
        F.when(pos == 0, title).when(blank, lesson).otherwise(title if older_rule else trim_space(title)).alias("title"),
        F.when(pos > 0, F.lit(rules.PENDING)).alias("status"),
    )


def fill_transcripts(results: DataFrame, segments: DataFrame, key: str = "video_id") -> DataFrame:
    """Transcript per result, or a note with its description where there is none.

    Segments: key, pos, text.
    """
    joined = segments.groupBy(key).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "text"))), lambda s: s["text"]), " ").alias("__t")
    )
    note = F.concat(F.lit(rules.NO_TRANSCRIPT), F.col("description"))
    return results.join(joined, key, "left").withColumn(
        "transcript", F.coalesce(F.nullif(F.col("__t"), F.lit("")), note)
    ).drop("__t")


def harvest_urls(pages: DataFrame, text: str, order: str, pattern: str = rules.LIVE_URL_PATTERN, seen: DataFrame | None = None) -> DataFrame:
    """Distinct URLs found in page texts, first sighting and page count, without those seen.

    ``first_pos`` is the URL's place, from 0, among those of the page that showed
    it first. Repeats inside a page go before the shuffle, repeats between pages in the
    combining aggregate.
    """
    found = F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), 0))
    urls = open_rows(pages, [F.col(order).alias("__at")], found, "__i", "url")
    first = F.min(F.struct("__at", "__i"))
    out = urls.groupBy("url").agg(first["__at"].alias("first_seen"), first["__i"].cast("int").alias("first_pos"), F.count(F.lit(1)).alias("n_pages"))
    if seen is not None:
        out = out.join(seen.select("url").distinct(), "url", "left_anti")
    return out
