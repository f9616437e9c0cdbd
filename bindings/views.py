"""Domain views of the given tables: which column plays which part."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern import rules
from lectern.functions import text as X
from lectern.functions.arrays import open_rows
from lectern.functions.num import ms
from lectern.functions.time import instant


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def dealt(df: DataFrame) -> DataFrame:
    """Rows dealt over the cores of a local session.

    The given tables are one row group each, which a local session would read and
    work in one task. Tables on a cluster have splits enough and are left as they are.
    """
    context = df.sparkSession.sparkContext
    return df.repartition(context.defaultParallelism) if context.master.startswith("local[") else df


def documents(spark: SparkSession, d: str) -> DataFrame:
    return dealt(table(spark, d, "documents"))


def status_of(flag: Column) -> Column:
    return (
        F.when(flag == "P", F.lit(rules.PENDING))
        .when(flag == "O", F.lit(rules.IN_PROGRESS))
        .otherwise(F.lit(rules.COMPLETED))
    )


def topics(spark: SparkSession, d: str) -> DataFrame:
    """Orders as topics."""
    return table(spark, d, "orders").select(
        F.col("o_orderkey").alias("topic_id"),
        F.col("o_orderpriority").alias("stream"),
        F.concat(F.lit("S"), (F.col("o_custkey") % 7).cast("string")).alias("subject"),
        F.concat(F.lit("C"), (F.col("o_custkey") % 29).cast("string")).alias("chapter"),
        F.concat(F.lit("topic "), F.col("o_orderkey").cast("string")).alias("topic"),
        status_of(F.col("o_orderstatus")).alias("status"),
        F.lit(None).cast("string").alias("video_url"),
        instant("o_orderdate").alias("created_time"),
        F.lit(None).cast("timestamp").alias("completed_at"),
    )


def catalog_topics(spark: SparkSession, d: str) -> DataFrame:
    """Parts as topics of one stream."""
    return dealt(table(spark, d, "part")).select(
        F.col("p_partkey").alias("topic_id"),
        F.lit("catalog").alias("stream"),
        F.col("p_brand").alias("subject"),
        F.col("p_type").alias("chapter"),
        F.col("p_name").alias("topic"),
    )


def events(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    return e.withColumn("ts", instant("ts"))


def cents(c: Column) -> Column:
    return F.round(c * 100).cast("bigint")


def video_stats(spark: SparkSession, d: str, channel: str) -> DataFrame:
    """Events as uploaded videos; value in cents as views."""
    return events(spark, d).select(
        F.col(channel).alias("channel"),
        F.col("event_id").alias("video_id"),
        F.col("ts").alias("published_at"),
        cents(F.col("value")).alias("views"),
    )


def word_rows(spark: SparkSession, d: str) -> DataFrame:
    """Documents as transcripts spoken at the assumed rate."""
    return (
        open_rows(documents(spark, d), ["doc_id"], X.words(F.col("text")), "word_idx", "word")
        .select(
            "doc_id",
            "word_idx",
            "word",
            ms(F.col("word_idx") / rules.WORDS_PER_SECOND).alias("start_s"),
            ms((F.col("word_idx") + 1) / rules.WORDS_PER_SECOND).alias("end_s"),
        )
    )


def doc_sizes(spark: SparkSession, d: str) -> DataFrame:
    return documents(spark, d).select("doc_id", F.size(X.words(F.col("text"))).alias("n_words"))


def transcripts(spark: SparkSession, d: str, per_segment: int = 10) -> DataFrame:
    """Documents as nested transcript documents of ten-word segments."""
    rate = rules.WORDS_PER_SECOND
    t = documents(spark, d).select("doc_id", X.words(F.col("text")).alias("w"))
    t = t.withColumn("n", F.size("w"))

    def segment(s: Column) -> Column:
        first = s * per_segment
        part = F.slice("w", first + 1, per_segment)
        return F.struct(
            s.alias("id"),
            (first / rate).alias("start"),
            (F.least(first + per_segment, F.col("n")) / rate).alias("end"),
            F.concat(F.lit(" "), F.array_join(part, " ")).alias("text"),
            F.transform(
                part,
                lambda x, i: F.struct(
                    x.alias("word"), ((first + i) / rate).alias("start"), ((first + i + 1) / rate).alias("end")
                ),
            ).alias("words"),
        )

    count = F.ceil(F.col("n") / per_segment).cast("int")
    ids = F.when(F.col("n") > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
    return t.select("doc_id", F.transform(ids, segment).alias("segments"))


def scenes(spark: SparkSession, d: str) -> DataFrame:
    """Evenly spaced scenes over each document's spoken time."""
    s = doc_sizes(spark, d).withColumn("total_s", F.col("n_words") / rules.WORDS_PER_SECOND)
    gap = F.lit(7.3) + (F.col("doc_id") % 5) * 0.37
    s = s.withColumn("gap", gap).withColumn("n", F.floor(F.col("total_s") / F.col("gap")).cast("int"))
    s = s.select("doc_id", "total_s", "gap", "n", F.explode(F.sequence(F.lit(0), F.col("n"))).alias("scene_idx"))
    last = F.col("scene_idx") == F.col("n")
    start = ms(F.col("scene_idx") * F.col("gap"))
    end = F.when(last, F.greatest(F.lit(0.0), F.col("total_s") - rules.SCENE_TAIL_S)).otherwise(
        (F.col("scene_idx") + 1) * F.col("gap")
    )
    return s.select("doc_id", "scene_idx", start.alias("start_s"), ms(end).alias("end_s"), last.alias("is_last"))


def slides(spark: SparkSession, d: str) -> DataFrame:
    """A slide map of twenty words per slide, its last slide reaching past the end."""
    s = doc_sizes(spark, d).withColumn("n", F.floor(F.col("n_words") / 20).cast("int"))
    s = s.select("doc_id", F.explode(F.sequence(F.lit(0), F.col("n"))).alias("slide_index"))
    at = F.col("slide_index") * 8
    return s.select(
        "doc_id",
        "slide_index",
        at.cast("double").alias("video_start"),
        (at + 8 + (F.col("doc_id") % 3) * 0.25).cast("double").alias("video_end"),
        (F.col("slide_index") * 20).alias("word_start_index"),
        (F.col("slide_index") * 20 + 19).alias("word_end_index"),
    )


def results(spark: SparkSession, d: str) -> DataFrame:
    """Conversations as ranked search results, some of them series."""
    conv = F.col("conv_id")
    tail = (
        F.when(conv % 4 == 0, F.lit(""))
        .when(conv % 4 == 1, F.lit(" Part 1"))
        .when(conv % 4 == 2, F.concat(F.lit(" Episode "), F.col("turn").cast("string")))
        .otherwise(F.lit(" complete"))
    )
    is_list = (conv % 5 == 0) & (F.col("turn") == 0)
    return table(spark, d, "conversations").select(
        conv.alias("query_id"),
        F.col("turn").alias("rank"),
        F.when(is_list, F.lit(rules.KIND_PLAYLIST)).otherwise(F.lit(rules.KIND_VIDEO)).alias("kind"),
        F.when(is_list, F.concat(F.lit("PL"), (conv % 20).cast("string"))).alias("playlist_id"),
        F.concat("text", tail).alias("title"),
    )


def customer_topics(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select(
        F.col("c_custkey").alias("topic_id"), F.col("c_name").alias("topic"), F.col("c_mktsegment").alias("chapter"),
        F.concat(F.lit("K"), (F.col("c_nationkey") % 5).cast("string")).alias("stream"), F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("subject")
    )


def playlist_items(spark: SparkSession, d: str) -> DataFrame:
    """Orders as playlist items; completed ones lost their title."""
    return table(spark, d, "orders").select(
        F.concat(F.lit("PL"), (F.col("o_custkey") % 20).cast("string")).alias("playlist_id"),
        F.col("o_orderkey").alias("pos"),
        F.when(F.col("o_orderstatus") == "F", F.lit("  "))
        .otherwise(F.concat(F.lit("Video "), F.col("o_orderkey").cast("string")))
        .alias("title"),
    )


def status_events(spark: SparkSession, d: str) -> DataFrame:
    """Line items as status events of their order."""
    f = F.col("l_returnflag")
    return table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("topic_id"),
        F.when(f == "A", F.lit(rules.COMPLETED)).when(f == "N", F.lit(rules.IN_PROGRESS)).otherwise(F.lit(rules.FAILED)).alias("status"),
        instant("l_shipdate").alias("ts"),
        F.concat(F.lit("https://v.example/"), F.col("l_partkey").cast("string")).alias("video_url"),
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_extendedprice",
    )


EVENT_ORDER = ["ts", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


def labelled_instructions(spark: SparkSession, d: str) -> DataFrame:
    """Labels as speaking instructions of the first two chunks, with repeats."""
    return table(spark, d, "labels").select(
        "doc_id",
        F.posexplode(F.array(F.lit(0), F.col("quality"), F.lit(1))).alias("pos", "chunk_idx"),
        "quality",
        "toxic",
    ).select(
        "doc_id",
        "chunk_idx",
        "pos",
        F.when((F.col("pos") == 0) & (F.col("quality") == 0), F.lit("")).otherwise(
            F.concat(F.lit("tone "), F.col("pos").cast("string"), F.lit("-"), F.col("toxic").cast("string"))
        ).alias("instruct"),
        F.when(F.col("toxic") == 1, F.lit("fast")).otherwise((F.col("pos") * 0.5 + F.col("quality") * 0.9).cast("string")).alias("speed"),
    )


def run_events(spark: SparkSession, d: str) -> DataFrame:
    """Events as run status of their user."""
    t = F.col("event_type")
    return events(spark, d).select(
        F.col("user_id").alias("stream"),
        "ts",
        "event_id",
        F.when(t == "purchase", F.lit("success"))
        .when(t == "error", F.concat(F.lit("failed: "), F.col("props")))
        .otherwise(F.lit("running"))
        .alias("status"),
    )


def log_messages(spark: SparkSession, d: str) -> DataFrame:
    """Events as two-line log messages with a coloured first line."""
    t = F.col("event_type")
    esc = F.char(F.lit(27))
    cause = (
        F.when(t == "error", F.lit("Gradio timed out"))
        .when(t == "purchase", F.lit("upload refused"))
        .when(t == "view", F.lit("ffmpeg exited"))
        .otherwise(F.lit("all well"))
    )
    return table(spark, d, "events").select(
        "event_id", F.concat(esc, F.lit("[31m "), cause, esc, F.lit("[0m \n\n user "), F.col("user_id").cast("string")).alias("message")
    )


EVENTS_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
