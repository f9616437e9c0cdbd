"""Topic catalog: queue, search, claim, status, planning."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern import rules, session
from lectern.functions.text import fill
from lectern.plans.ordered import number_rows


def topic_queue(topics: DataFrame) -> DataFrame:
    """Open topics, oldest first inside each stream."""
    return topics.where(F.col("status").isin(rules.OPEN_STATUSES)).orderBy("stream", "created_time", "topic_id")


def find_topics(topics: DataFrame, terms: Sequence[str], column: str = "topic") -> DataFrame:
    """Topics containing any of the terms, case-sensitive; stays a pushed filter."""
    return topics.where(reduce(lambda a, b: a | b, [F.col(column).contains(t) for t in terms], F.lit(False)))


def _grams(text: Column, width: int) -> Column:
    """Distinct stretches of ``width`` letters; a shorter text is its own."""
    starts = F.sequence(F.lit(1), F.greatest(F.length(text) - width + 1, F.lit(1)))
    return F.array_distinct(F.transform(starts, lambda i: F.substr(text, i, F.lit(width))))


def term_candidates(topics: DataFrame, terms: DataFrame, key: str = "topic_id", column: str = "topic", width: int = 4) -> DataFrame:
    """(key, column, term): the pairs that are worth a look.

    A text that holds a term holds each of the term's grams, so one is enough to
    meet on. A count of the terms' grams over all topics says which is rarest,
    and a term is filed under that one alone: terms that begin alike still part
    ways. A term with a gram that no topic holds is out. Terms shorter than
    ``width`` letters meet the stretches of their own length.

    The terms' grams and where terms are filed are written, so that Spark knows
    their sizes: it takes the exploded topics for as small as the topics, and
    would else send them to all tasks instead of the terms.
    """
    length = F.least(F.length("term"), F.lit(width))
    t = terms.select("term").distinct().where(F.length("term") > 0).select("term", length.alias("size"), F.explode(_grams(F.col("term"), width)).alias("gram"))
    t = session.written(t, "term-grams")
    # Lengths that terms ask for: all of ``width`` unless there are short terms.
    sizes = t.agg(F.array_sort(F.collect_set("size"))).first()[0]
    texts = topics.where(F.length(column) > 0)
    held = [texts.where(F.length(column) >= n).select(key, column, F.explode(_grams(F.col(column), n)).alias("gram")) for n in sizes or [width]]
    held = reduce(DataFrame.unionByName, held)
    count = held.select("gram").join(t.select("gram").distinct(), "gram", "left_semi").groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    filed = t.join(count, "gram", "left").groupBy("term").agg(F.min_by("gram", F.struct("n", "gram")).alias("gram"), F.count_if(F.col("n").isNull()).alias("unseen"))
    filed = session.written(filed.where("unseen = 0").select("term", "gram"), "terms-filed")
    return held.join(filed, "gram").select(key, column, "term")


def find_topics_by_terms(topics: DataFrame, terms: DataFrame, key: str = "topic_id", column: str = "topic", width: int = 4) -> DataFrame:
    """Topics containing any term of a table (term), case-sensitive; candidates are verified."""
    found = term_candidates(topics, terms, key, column, width).where(F.col(column).contains(F.col("term"))).select(key).distinct()
    return topics.join(found, key, "left_semi")


def reset_topics(topics: DataFrame) -> DataFrame:
    """Every topic back to Pending; ``changed`` marks the rows this touched."""
    changed = ~F.col("status").eqNullSafe(F.lit(rules.PENDING))
    return topics.withColumns({"changed": changed, "old_status": F.col("status"), "status": F.lit(rules.PENDING)})


def archive(videos: DataFrame) -> DataFrame:
    """Soft delete of tracker rows."""
    return videos.withColumn("archived", F.lit(True))


def _latest(events: DataFrame, key: str, order: Sequence[str], values: Sequence[str | Column]) -> DataFrame:
    return events.groupBy(key).agg(
        F.max_by(F.struct(*values), F.struct(*order)).alias("last")
    )


def _applied(topics: DataFrame, events: DataFrame, order: Sequence[str], how: str, *more: Column) -> DataFrame:
    """Topics joined with their latest event; ``more`` is added."""
    done = F.col("status") == rules.COMPLETED
    # what only Completed moves need not travel for the others
    values = [F.col("status"), F.when(done, F.col("ts")).alias("ts"), F.when(done, F.col("video_url")).alias("video_url")]
    last = _latest(events.select("topic_id", *dict.fromkeys(["status", "ts", "video_url", *order])), "topic_id", order, values)
    done = F.col("last.status") == rules.COMPLETED
    j = topics.join(last, "topic_id", how)
    return j.select(
        *[c for c in topics.columns if c not in ("status", "video_url", "completed_at", KNOWN)],
        F.coalesce("last.status", "status").alias("status"),
        F.when(done, F.col("last.video_url")).otherwise(F.col("video_url")).alias("video_url"),
        F.when(done, F.col("last.ts")).otherwise(F.col("completed_at")).alias("completed_at"),
        *more,
    )


def apply_status(topics: DataFrame, events: DataFrame, order: Sequence[str] = ("ts", "event_id")) -> DataFrame:
    """New snapshot from the old one and a status event log.

    Events: topic_id, status, ts, video_url and any further columns of ``order``.
    The latest event per topic sets the status; url and completion time move only
    on Completed.
    """
    return _applied(topics, events, order, "left")


#: Marks the topics of the catalog.
KNOWN = "__known"


def merge_status(topics: DataFrame, events: DataFrame, order: Sequence[str] = ("ts", "event_id")) -> DataFrame:
    """``apply_status`` with one more row, not ``__known``, for each id that events name and the catalog does not have."""
    return _applied(topics.withColumn(KNOWN, F.lit(True)), events, order, "full", F.coalesce(KNOWN, F.lit(False)).alias(KNOWN))


def rejected_events(topics: DataFrame, events: DataFrame) -> DataFrame:
    """Events naming a topic the catalog does not have."""
    return events.join(topics.select("topic_id"), "topic_id", "left_anti")


def not_yet_done(topics: DataFrame, done: DataFrame, keys: Sequence[str] = ("stream", "subject", "topic")) -> DataFrame:
    """Topics with no tracker row; null keys compare as equal."""
    d = done.select(*[F.col(k).alias(f"__{k}") for k in keys]).distinct()
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    return topics.join(d, on, "left_anti")


def queue_depth(topics: DataFrame, streams: DataFrame | None = None) -> DataFrame:
    """Pending topics per stream; streams with none (or no rows at all) show 0."""
    n = topics.groupBy("stream").agg(F.count_if(F.col("status") == rules.PENDING).alias("pending"))
    if streams is None:
        return n
    return streams.select("stream").distinct().join(n, "stream", "left").fillna(0, ["pending"])


def next_pending(topics: DataFrame) -> DataFrame:
    """Oldest Pending topic of each stream, by a combining aggregate."""
    cols = topics.columns
    return (
        topics.where(F.col("status") == rules.PENDING)
        .groupBy("stream")
        .agg(F.min_by(F.struct(*[c for c in cols if c != "stream"]), F.struct("created_time", "topic_id")).alias("r"))
        .select(*["stream" if c == "stream" else F.col(f"r.{c}").alias(c) for c in cols])
    )


def claim(topics: DataFrame) -> DataFrame:
    """Snapshot with each stream's next topic In Progress."""
    chosen = next_pending(topics).select("topic_id", F.lit(True).alias("__take"))
    return topics.join(chosen, "topic_id", "left").select(
        *[
            F.when(F.col("__take"), F.lit(rules.IN_PROGRESS)).otherwise(F.col("status")).alias("status") if c == "status" else F.col(c)
            for c in topics.columns
        ]
    )


def round_robin_plan(topics: DataFrame, per_day: int, partitions: int | None = None) -> DataFrame:
    """Interleave subjects: each one's first topic, then each one's second, ...

    ``slot`` is the 1-based position in the stream's plan, ``day`` counts from 0.
    """
    waiting = topics.where(F.col("status") == rules.PENDING)
    turns = number_rows(waiting, ["stream", "subject"], ["created_time", "topic_id"], "turn", partitions)
    plan = number_rows(turns, ["stream"], ["turn", "subject"], "slot", partitions)
    return plan.withColumn("day", F.floor((F.col("slot") - 1) / per_day).cast("long"))


def _titles(videos: DataFrame) -> DataFrame:
    subject = fill(rules.SUBJECT_COLLECTION, stream=F.col("stream"), subject=F.col("subject"))
    chapter = fill(rules.CHAPTER_COLLECTION, chapter=F.col("chapter"), subject=F.col("subject"))
    return videos.select("video_id", F.explode(F.array(subject, chapter)).alias("title"))


def collections(videos: DataFrame, existing: DataFrame) -> DataFrame:
    """Collections the videos need: known ones by id, the others created once.

    Titles match without regard to case. Existing: collection_id, title.
    """
    wanted = (
        _titles(videos)
        .groupBy(F.lower("title").alias("title_key"))
        .agg(F.min("title").alias("title"))
    )
    known = existing.groupBy(F.lower("title").alias("title_key")).agg(F.min("collection_id").alias("known_id"))
    return wanted.join(known, "title_key", "left").select(
        "title_key",
        "title",
        F.coalesce("known_id", F.sha2("title_key", 256)).alias("collection_id"),
        F.col("known_id").isNull().alias("created"),
    )


def collection_membership(videos: DataFrame, existing: DataFrame) -> DataFrame:
    """Each video in exactly two collections, its subject's and its chapter's.

    New ids follow from the title, so only the known ones need a lookup.
    """
    known = existing.groupBy(F.lower("title").alias("title_key")).agg(F.min("collection_id").alias("known_id"))
    m = _titles(videos).withColumn("title_key", F.lower("title"))
    return m.join(known, "title_key", "left").select(
        "video_id", "title_key", F.coalesce("known_id", F.sha2("title_key", 256)).alias("collection_id")
    )


def union_streams(*parts: tuple[str, DataFrame]) -> DataFrame:
    """Concatenate streams, duplicates kept, each row tagged with its stream."""
    tagged = [df.withColumn("stream", F.lit(name)) for name, df in parts]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def resume_plan(topics: DataFrame, artifacts: DataFrame, steps: Sequence[tuple] = rules.RESUME_STEPS) -> DataFrame:
    """Which production steps remain per topic, and where to resume.

    Artifacts: topic_id, step, length, content. A step is done when its artifact
    is larger than its floor and, where asked, names the topic. Artifacts fold to
    one bit mask per topic before the join; ``topics`` brings topic_id, topic.
    """
    def bit(no: int) -> Column:
        return F.lit(1 << no)

    def done(no: int, name: str, floor: int) -> Column:
        return (F.col("step") == name) & (F.col("length") > floor)

    # small or foreign files drop out before anything is shuffled
    big = artifacts.where(reduce(lambda a, b: a | b, [done(no, n, fl) for no, n, fl, _ in steps]))
    named = [n for _, n, _, must_name in steps if must_name]
    if named:
        # text steps must name the topic: bring the name to the artifacts
        names = topics.select("topic_id", F.col("topic").alias("__topic"))
        big = big.join(names, "topic_id").where(
            ~F.col("step").isin(named) | F.col("content").contains(F.col("__topic"))
        )
    mask = reduce(
        lambda a, b: a.bitwiseOR(b),
        [F.when(F.col("step") == n, bit(no)).otherwise(F.lit(0)) for no, n, *_ in steps],
    )
    have = big.groupBy("topic_id").agg(F.bit_or(mask).alias("__have"))
    all_steps = F.array(*[F.lit(no) for no, *_ in steps])
    left = F.filter(
        all_steps,
        lambda no: F.coalesce(F.col("__have"), F.lit(0)).bitwiseAND(
            F.element_at(F.create_map(*[F.lit(v) for s in steps for v in (s[0], 1 << s[0])]), no)
        )
        == 0,
    )
    return (
        topics.select("topic_id")
        .join(have, "topic_id", "left")
        .select("topic_id", left.alias("left"))
        .where(F.size("left") > 0)
        .select(
            "topic_id",
            F.array_min("left").alias("resume_step"),
            F.size("left").alias("n_left"),
            F.array_join(F.col("left").cast("array<string>"), ",").alias("steps_left"),
        )
    )
