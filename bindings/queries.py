"""Every operator as a query over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bindings import views as V
from lectern import rules, session
from lectern.functions import text as X
from lectern.functions.time import instant, local_date, naive
from lectern.operators import align, analytics, catalog, metadata, opslog, schedule, stores, strategy, textjobs
from lectern.plans import produce
from lectern.sources import catalog as catalog_src
from lectern.sources import files as files_src
from lectern.sources import logs as logs_src
from lectern.sources import search as search_src
from lectern.sources import transcripts as transcripts_src
from lectern.streaming import daily, dedup, io, missed, state
from lectern.streaming import logs as stream_logs_job

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHANNEL = "Daily Lectures"


def query(fn):
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(session.configure(spark), sf_dir.rstrip("/"))

    QUERIES[fn.__name__] = run
    return run


def plain_times(df: DataFrame) -> DataFrame:
    """Timestamps as naive UTC, as the tables have them."""
    return df.select(*[naive(n).alias(n) if t == "timestamp" else F.col(n) for n, t in df.dtypes])


def text(c) -> F.Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


# --- sources and sinks ------------------------------------------------------


@query
def read_topics(spark, d):
    t = V.topics(spark, d)
    key = F.col("topic_id")
    doc = F.to_json(
        F.struct(
            text(key).alias("id"),
            "created_time",
            F.struct(
                F.struct(F.array(F.struct(F.col("topic").alias("plain_text"))).alias("title")).alias("Topic"),
                F.struct(F.when(key % 11 != 0, F.struct(F.col("subject").alias("name"))).alias("select")).alias("Subject"),
                F.struct(F.struct(F.col("chapter").alias("name")).alias("select")).alias("Chapter"),
                F.struct(F.when(key % 13 != 0, F.struct(F.col("status").alias("name"))).alias("select")).alias("Status"),
            ).alias("properties"),
        )
    )
    return plain_times(catalog_src.parse_topics(t.select("stream", doc.alias("doc"))))


@query
def flatten_syllabus(spark, d):
    nation, region = V.table(spark, d, "nation"), V.table(spark, d, "region")
    c = V.table(spark, d, "customer")
    j = c.join(nation, c["c_nationkey"] == nation["n_nationkey"]).join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    chapters = F.when(F.col("c_acctbal") < 1000, F.to_json(F.array("c_mktsegment"))).otherwise(
        F.to_json(F.array(F.struct(F.col("c_mktsegment").alias("chapter"), F.array("c_name").alias("topics"))))
    )
    doc = F.concat(F.lit('{"'), "r_name", F.lit('": {"'), "n_name", F.lit('": '), chapters, F.lit("}}"))
    return catalog_src.flatten_syllabus(j.select(doc.alias("doc")))


@query
def read_search_results(spark, d):
    c = V.table(spark, d, "conversations")
    is_video = F.col("role") == "user"
    item = F.concat_ws("-", text("conv_id"), text("turn"))
    doc = F.to_json(
        F.array(
            F.struct(
                F.struct(
                    F.when(is_video, F.lit(rules.KIND_VIDEO)).otherwise(F.lit(rules.KIND_PLAYLIST)).alias("kind"),
                    F.when(is_video, item).alias("videoId"),
                    F.when(~is_video, item).alias("playlistId"),
                ).alias("id"),
                F.struct(F.col("text").alias("title"), F.col("role").alias("description"), F.lit("ch").alias("channelTitle")).alias("snippet"),
            )
        )
    )
    return search_src.parse_search_results(c.select("conv_id", "turn", doc.alias("items")), "conv_id", offset=F.col("turn"))


@query
def transcript_words(spark, d):
    return transcripts_src.transcript_words(V.transcripts(spark, d), "doc_id")


@query
def transcript_segments(spark, d):
    return transcripts_src.transcript_segments(V.transcripts(spark, d), "doc_id")


@query
def parse_scene_log(spark, d):
    e = V.table(spark, d, "events")
    line = F.when(F.col("event_type") == "signup", F.concat(F.lit("frame="), text("event_id"))).otherwise(
        F.concat(F.lit("[Parsed_showinfo_1] n: "), text("event_id"), F.lit(" pts_time: "), text("value"), F.lit(" fmt:x"))
    )
    return transcripts_src.parse_scene_log(e.select("event_id", line.alias("line")))


def _iso(c):
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


@query
def parse_error_log(spark, d):
    e = V.events(spark, d)
    line = F.when(F.col("event_type") == "click", F.concat(F.lit("no brackets "), text("event_id"))).otherwise(
        F.concat(F.lit("["), _iso("ts"), F.lit("] ["), F.upper("event_type"), F.lit("] user "), text("user_id"), F.lit(": "), "props")
    )
    return plain_times(logs_src.parse_error_log(e.select("event_id", line.alias("line"))).drop("line"))


@query
def retry_summary(spark, d):
    e = V.events(spark, d)
    record = F.concat(
        F.lit("[Attempt "), text(F.col("event_id") % 3 + 1), F.lit("] "), _iso("ts"), F.lit("\nevent "), text("event_id"), F.lit("\n"), "props", F.lit("\n")
    )
    r = logs_src.parse_retry_log(e.where(F.col("event_type") == "error").select(F.col("user_id").alias("job"), record.alias("record")))
    ok = e.where(F.col("event_type") == "purchase").select(F.col("user_id").alias("job"), "ts")
    return plain_times(opslog.retry_summary(r, ok))


@query
def asset_inventory(spark, d):
    p = V.table(spark, d, "pages")
    n = F.col("page_id") % 5
    suffix = (
        F.when(n == 0, F.lit(".WAV")).when(n == 1, F.lit(".mp3")).when(n == 2, F.lit(".txt")).when(n == 3, F.lit("_timeline.json")).otherwise(F.lit(""))
    )
    return opslog.asset_inventory(
        p.select(
            F.regexp_extract("url", "^https?://([^/]+)", 1).alias("topic"),
            F.concat("url", suffix).alias("name"),
            F.octet_length("html").cast("bigint").alias("length"),
            F.col("page_id").alias("modified_at"),
        )
    )


@query
def pick_latest_artifact(spark, d):
    n = F.col("l_linenumber")
    exts = [".mp4", ".wav", ".mp3", ".webm", ".mp4.crdownload", ".txt", ".json"]
    f = V.table(spark, d, "lineitem").select(
        "l_suppkey",
        F.col("l_returnflag").alias("dir"),
        F.concat_ws("-", text("l_orderkey"), text("l_partkey"), F.element_at(F.array(*map(F.lit, exts)), n)).alias("name"),
        instant("l_shipdate").alias("modified_at"),
    )
    as_of = F.lit("2001-06-01 00:00:00").cast("timestamp")
    return plain_times(opslog.pick_latest_artifact(f, "l_suppkey", as_of, ["R", "A", "N"], max_age_s=90 * 86400))


@query
def write_outputs(spark, d):
    path = session.new_path(spark, "topics")
    t = V.topics(spark, d).select("topic_id", "stream", "topic", "status")
    files_src.write_outputs(t, path, ["stream"])
    return spark.read.schema("topic_id bigint, topic string, status string, stream string").parquet(path)


# --- catalog ----------------------------------------------------------------


@query
def topic_queue(spark, d):
    return plain_times(catalog.topic_queue(V.topics(spark, d)).select("stream", "topic_id", "subject", "chapter", "topic", "status", "created_time"))


@query
def find_topics(spark, d):
    return catalog.find_topics(V.catalog_topics(spark, d), ["ring", "hot", "blue bo"])


@query
def find_topics_by_terms(spark, d):
    terms = V.table(spark, d, "part").select(F.lower(F.substring("p_type", 1, 4)).alias("term"))
    return catalog.find_topics_by_terms(V.catalog_topics(spark, d), terms)


@query
def reset_topics(spark, d):
    t = V.topics(spark, d)
    t = t.withColumn("status", F.when(F.col("topic_id") % 13 != 0, F.col("status")))
    return catalog.reset_topics(t).where("changed").select("topic_id", "stream", "old_status", "status")


@query
def archive_videos(spark, d):
    v = V.topics(spark, d).where(F.col("status") == rules.COMPLETED).withColumn("archived", F.lit(False))
    return catalog.archive(v).groupBy("stream").agg(F.count_if("archived").alias("archived"), F.count(F.lit(1)).alias("videos"))


@query
def apply_status(spark, d):
    out = catalog.apply_status(V.topics(spark, d), V.status_events(spark, d), V.EVENT_ORDER)
    return plain_times(out.select("topic_id", "stream", "status", "video_url", "completed_at"))


@query
def merge_status(spark, d):
    """The snapshot in buckets, brought up to date by two batches of events."""
    store = stores.SnapshotStore(spark, buckets=16).create(V.topics(spark, d))
    events, cut = V.status_events(spark, d), F.lit("1996-01-01").cast("timestamp")
    store.apply(events.where(F.col("ts") < cut), V.EVENT_ORDER)
    store.apply(events.where(F.col("ts") >= cut), V.EVENT_ORDER)
    return plain_times(store.topics().select("topic_id", "stream", "status", "video_url", "completed_at"))


@query
def rejected_events(spark, d):
    open_topics = V.topics(spark, d).where(F.col("status") == rules.PENDING)
    return plain_times(catalog.rejected_events(open_topics, V.status_events(spark, d)))


@query
def not_yet_done(spark, d):
    c = V.table(spark, d, "customer").select(F.col("c_custkey").alias("topic"), F.col("c_name").alias("name"))
    done = V.table(spark, d, "orders").where(F.col("o_orderstatus") == "F").select(F.col("o_custkey").alias("topic"))
    return catalog.not_yet_done(c, done, ["topic"])


def _video_dims(spark, d):
    v = V.catalog_topics(spark, d).withColumnRenamed("topic_id", "video_id")
    big = V.table(spark, d, "part").where(F.col("p_size") > 25)
    existing = big.select(
        F.concat(F.lit("PL"), text("p_partkey")).alias("collection_id"),
        F.upper(F.concat("p_type", F.lit(" | "), "p_brand")).alias("title"),
    )
    return v, existing


@query
def collections(spark, d):
    return catalog.collections(*_video_dims(spark, d))


@query
def collection_membership(spark, d):
    return catalog.collection_membership(*_video_dims(spark, d))


@query
def resume_plan(spark, d):
    step = (
        F.when(F.col("l_linenumber") == 1, F.lit("script"))
        .when(F.col("l_linenumber") == 2, F.lit("emphasis"))
        .when(F.col("l_linenumber") == 3, F.lit("voice"))
        .when(F.col("l_linenumber") == 4, F.lit("segments"))
        .otherwise(F.lit("scratch"))
    )
    a = V.table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("topic_id"),
        step.alias("step"),
        F.floor(F.col("l_extendedprice") / 10).cast("bigint").alias("length"),
        F.when(F.col("l_returnflag") == "R", F.lit("about something else")).otherwise(
            F.concat(F.lit("about topic "), text("l_orderkey"))
        ).alias("content"),
    )
    return catalog.resume_plan(V.topics(spark, d), a)


@query
def queue_depth(spark, d):
    return catalog.queue_depth(V.topics(spark, d))


@query
def next_pending(spark, d):
    return plain_times(catalog.next_pending(V.topics(spark, d)).select("stream", "topic_id", "topic", "created_time"))


@query
def claim_topics(spark, d):
    return catalog.claim(V.topics(spark, d)).groupBy("stream", "status").agg(F.count(F.lit(1)).alias("n"), F.sum("topic_id").alias("id_sum"))


@query
def claim_ledger(spark, d):
    """Two runs claim one topic of each stream, both from the same table."""
    ledger, topics = stores.ClaimLedger(spark), V.topics(spark, d)
    for run in ("one", "two"):
        ledger.claim(topics, run)
    claims = ledger.entries().select(F.col("topic_id").cast("bigint").alias("topic_id"), "run")
    return ledger.snapshot(topics).join(claims, "topic_id").select("topic_id", "stream", "status", "run")


@query
def round_robin_plan(spark, d):
    return catalog.round_robin_plan(V.topics(spark, d), per_day=10).select("stream", "subject", "topic_id", "turn", "slot", "day")


@query
def union_streams(spark, d):
    s = V.table(spark, d, "supplier").select(F.col("s_suppkey").alias("topic_id"), F.col("s_name").alias("topic"), F.col("s_acctbal").alias("balance"))
    c = V.table(spark, d, "customer").select(F.col("c_custkey").alias("topic_id"), F.col("c_name").alias("topic"), F.col("c_mktsegment").alias("segment"))
    return catalog.union_streams(("suppliers", s), ("customers", c))


# --- strategy ---------------------------------------------------------------


@query
def decide_strategy(spark, d):
    return strategy.decide_strategy(V.results(spark, d), V.customer_topics(spark, d), on="topic_id").drop("topic", "chapter", "stream", "subject")


@query
def split_topics(spark, d):
    decided = strategy.decide_strategy(V.results(spark, d), V.customer_topics(spark, d), on="topic_id")
    return strategy.split_topics(decided, V.playlist_items(spark, d))


@query
def next_topics(spark, d):
    """Journey: next pending topic of each stream, decided and split."""
    k = F.col("topic_id")
    t = V.customer_topics(spark, d).withColumns({"stream": F.concat(F.lit("J"), (k % 50).cast("string")), "status": F.lit(rules.PENDING), "created_time": k})
    return produce.next_topics(t, V.results(spark, d), V.playlist_items(spark, d))


@query
def fill_transcripts(spark, d):
    docs = V.documents(spark, d)
    r = docs.select("doc_id", F.concat_ws(" ", "lang", "source").alias("description"))
    have = V.table(spark, d, "labels").select("doc_id")
    seg = docs.join(have, "doc_id").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "text"))
    return strategy.fill_transcripts(r, seg, "doc_id")


@query
def harvest_urls(spark, d):
    p = V.table(spark, d, "pages")
    pattern = r"https?://[a-z0-9.\-]+\.example\.(?:com|net|org)"
    src = p.select("page_id", F.concat_ws(" ", "url", "html", F.replace("url", F.lit("https:"), F.lit("http:"))).alias("text"))
    seen = p.where(F.col("url").contains("utm_source")).select(F.regexp_extract("url", pattern, 0).alias("url"))
    return strategy.harvest_urls(src, "text", "page_id", pattern, seen)


@query
def harvest_twice(spark, d):
    """A harvest of the pages with even ids, then one of all pages against the store."""
    p = V.table(spark, d, "pages")
    src = p.select("page_id", F.concat_ws(" ", "url", "html").alias("text"))
    store = stores.SeenStore(spark, buckets=8)
    pattern = r"https?://[a-z0-9.\-]+\.example\.(?:com|net|org)/[a-z0-9/\-]*"
    first = store.harvest(src.where(F.col("page_id") % 2 == 0), "text", "page_id", pattern)
    second = store.harvest(src, "text", "page_id", pattern)
    store.close()
    return first.withColumn("harvest", F.lit(1)).unionByName(second.withColumn("harvest", F.lit(2)))


# --- alignment --------------------------------------------------------------


@query
def nearest_word(spark, d):
    e = V.table(spark, d, "events").withColumn("hour", F.floor(F.unix_micros(instant("ts")) / 3600000000).cast("bigint"))
    points = e.where(F.col("event_type") == "error").select("user_id", "event_id", F.col("hour").alias("at"))
    words = e.where(F.col("event_type") != "error").select("user_id", F.col("event_id").alias("word_idx"), F.col("hour").alias("start_s"))
    return align.nearest_word(points, words, "user_id").select("user_id", "event_id", "nearest_idx")


@query
def slide_pace(spark, d):
    out = align.slide_pace(V.slides(spark, d), V.word_rows(spark, d), "doc_id")
    return out.select("doc_id", "slide_index", F.round("tts_duration", 4).alias("tts_duration"), F.round("speed_factor", 4).alias("speed_factor"), "needs_adjust")


@query
def transcript_rollup(spark, d):
    return align.transcript_rollup(transcripts_src.transcript_segments(V.transcripts(spark, d), "doc_id"), "doc_id")


@query
def slide_text(spark, d):
    return align.slide_text(V.scenes(spark, d), V.word_rows(spark, d), "doc_id")


@query
def align_videos(spark, d):
    """Journey: scenes that may begin at each long word, thinned, closed, given their text and pace."""
    w = V.word_rows(spark, d)
    totals = w.groupBy("doc_id").agg(F.max("end_s").alias("total_s"))
    m = produce.align_videos(w, w.where(F.length("word") > 6).select("doc_id", F.col("start_s").alias("ts_s")), totals, "doc_id")
    return m.select(
        "doc_id", "slide_index", "video_start", "video_end", "video_duration", "word_start_index", "word_end_index", "word_count",
        F.md5("text").alias("text_md5"), "overlap", F.round("tts_duration", 4).alias("tts_duration"), F.round("speed_factor", 4).alias("speed_factor"), "needs_adjust",
    )


def _user_candidates(spark, d):
    e = V.table(spark, d, "events")
    t0 = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    hours = F.round((F.unix_micros(instant("ts")) - F.unix_micros(t0.cast("timestamp"))) / 3600000000, 3)
    c = e.select("user_id", hours.alias("ts_s"))
    totals = c.groupBy("user_id").agg(F.ceil(F.max("ts_s")).cast("double").alias("total_s"))
    return c, totals


@query
def scene_thin(spark, d):
    return align.scene_thin(*_user_candidates(spark, d), "user_id")


@query
def scene_intervals(spark, d):
    c, totals = _user_candidates(spark, d)
    return align.scene_intervals(align.scene_thin(c, totals, "user_id"), totals, "user_id")


@query
def segment_split(spark, d):
    n = V.doc_sizes(spark, d)
    s = n.select(
        "doc_id",
        (10 + F.col("doc_id") % 7).alias("intro_words"),
        (F.col("n_words") + F.col("doc_id") % 3).alias("main_words"),
        F.when(F.col("doc_id") % 2 == 0, F.lit(20)).alias("outro_words"),
        (F.col("n_words") / rules.WORDS_PER_SECOND).alias("total_duration"),
    )
    return align.segment_split(V.word_rows(spark, d), s, "doc_id")


TRACK_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


@query
def track_timeline(spark, d):
    t = V.table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("video_id"),
        F.col("l_quantity").alias("video_s"),
        F.when(F.col("l_returnflag") != "N", F.col("l_quantity") * (1 - F.col("l_discount"))).alias("audio_s"),
        *TRACK_ORDER,
    )
    out = align.track_timeline(t, "video_id", TRACK_ORDER)
    return out.select("video_id", *TRACK_ORDER, *[F.round(c, 4).alias(c) for c in ("duration_s", "offset_s", "fade_out_s")], "audio_short")


# --- analytics --------------------------------------------------------------


@query
def enrich_stats(spark, d):
    up = V.table(spark, d, "orders").select(
        F.col("o_orderpriority").alias("channel"), F.col("o_orderkey").alias("video_id"), instant("o_orderdate").alias("published_at")
    )
    stats = V.table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("video_id")).agg(
        F.sum("l_quantity").cast("bigint").alias("views"), F.count(F.lit(1)).alias("likes")
    )
    return plain_times(analytics.enrich_stats(up, stats))


@query
def hourly_profile(spark, d):
    return analytics.hourly_profile(V.video_stats(spark, d, "event_type"))


@query
def hourly_profile_legacy(spark, d):
    return analytics.hourly_profile(V.video_stats(spark, d, "user_id"), mode="legacy")


@query
def best_hour(spark, d):
    return analytics.best_hour(analytics.hourly_profile(V.video_stats(spark, d, "user_id")))


@query
def hour_chart(spark, d):
    return analytics.hour_chart(analytics.hourly_profile(V.video_stats(spark, d, "user_id")))


@query
def channel_totals(spark, d):
    li = V.table(spark, d, "lineitem").select(
        F.col("l_suppkey").alias("channel"),
        X.counter(F.when(F.col("l_linenumber") != 7, F.col("l_quantity").cast("bigint").cast("string"))).alias("views"),
        X.counter(F.col("l_returnflag")).alias("likes"),
        X.counter(F.concat(text("l_linenumber"), F.lit(" comments"))).alias("comments"),
    )
    return analytics.channel_totals(li)


@query
def recent_history(spark, d):
    o = V.table(spark, d, "orders").select(
        F.col("o_custkey").alias("channel"), F.col("o_orderkey").alias("video_id"), instant("o_orderdate").alias("published_at"), F.col("o_totalprice").alias("views")
    )
    return plain_times(analytics.recent_history(o))


@query
def top_videos(spark, d):
    li = V.table(spark, d, "lineitem").select(
        F.col("l_suppkey").alias("query"),
        F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice").alias("pos"),
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.when(F.col("l_returnflag") != "A", F.col("l_extendedprice").cast("bigint")).alias("views"),
    )
    return analytics.top_videos(li, k=5, min_views=1000).drop("pos")


@query
def best_thumbnail(spark, d):
    li = V.table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("video_id"),
        F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice").alias("pos"),
        F.concat_ws("/", F.lit("https://t.example"), text("l_partkey"), text("l_suppkey")).alias("url"),
        F.col("l_quantity").cast("bigint").alias("width"),
        F.when(F.col("l_returnflag") != "A", F.col("l_linenumber") % 3).alias("height"),
    )
    return analytics.best_thumbnail(li, "video_id")


@query
def best_thumbnail_forms(spark, d):
    p = V.table(spark, d, "part")
    url = F.concat(F.lit("https://t.example/"), text("p_partkey"))

    def pic(tail, w, h):
        return F.struct(F.concat(url, F.lit(tail)).alias("url"), w.alias("width"), h.alias("height"))

    small, tall = pic("/a", F.col("p_size"), F.lit(10)), pic("/b", F.lit(10), F.col("p_size"))
    wide = pic("/c", F.when(F.col("p_size") > 25, F.lit(100)), F.lit(100))
    n = F.col("p_partkey") % 3
    doc = (
        F.when(n == 0, F.concat(F.lit('"'), url, F.lit('"')))
        .when(n == 1, F.to_json(F.array(small, tall, wide)))
        .otherwise(F.to_json(tall))
    )
    return p.select("p_partkey", doc.alias("doc")).select("p_partkey", analytics.best_thumbnail_url("doc").alias("url"))


@query
def channel_report(spark, d):
    up = V.video_stats(spark, d, "user_id")
    stats = up.select("video_id", "views", (F.col("views") % 10).alias("likes"), F.lit(0).alias("comments"))
    return produce.channel_report(up.select("channel", "video_id", "published_at"), stats)


# --- text jobs --------------------------------------------------------------


def _docs_as_topics(spark, d):
    return V.documents(spark, d).select(
        "doc_id", F.col("lang").alias("stream"), F.col("source").alias("subject"), F.concat(F.lit("topic "), text("doc_id")).alias("topic")
    )


def _script_rows(spark, d, by):
    return textjobs.build_scripts(V.documents(spark, d), _docs_as_topics(spark, d), "doc_id", CHANNEL, by=by)


@query
def build_scripts(spark, d):
    s = _script_rows(spark, d, "position")
    return s.select("doc_id", "stream", F.md5("full_script").alias("script_md5"), "intro_words", "main_words", "outro_words", "total_words", "intro_s", "main_s", "outro_s")


@query
def script_budget(spark, d):
    return textjobs.script_budget(_script_rows(spark, d, "hash"))


def _spoken_docs(spark, d):
    n = F.col("doc_id") % 6
    tail = (
        F.when(n == 0, F.lit(". the answer is 4. it works as planned. it runs. . . what is the point of all this."))
        .when(n == 1, F.lit("\nNow We go on, which means more. however it is key and Never is never."))
        .when(n == 2, F.lit(" and the answer is four. we're done here..."))
        .when(n == 3, F.lit(", but wait for it. remember this important critical step, actually always."))
        .otherwise(F.lit(""))
    )
    return V.documents(spark, d).select("doc_id", "source", F.concat("text", tail).alias("text"))


@query
def emphasize(spark, d):
    e = textjobs.emphasize(_spoken_docs(spark, d))
    return e.select("doc_id", F.md5("emphasized").alias("text_md5"), F.round("word_drift", 6).alias("word_drift"), "reverted", "n_changes", *[f"hits_{k}" for k in textjobs.EMPHASIS_KINDS])


@query
def emphasis_audit(spark, d):
    return textjobs.emphasis_audit(textjobs.emphasize(_spoken_docs(spark, d)), "source")


def _dirty_docs(spark, d):
    esc, bell = F.char(F.lit(27)), F.char(F.lit(7))
    n = F.col("doc_id")
    dirty = (
        F.when(n % 97 == 5, F.concat(bell, F.lit("  "), bell))
        .when(n % 3 == 0, F.concat("text", esc, F.lit("[31mred"), esc, F.lit("[0m end")))
        .when(n % 3 == 1, F.concat(bell, F.lit(" "), "text", F.lit("\t")))
        .otherwise(F.col("text"))
    )
    return V.documents(spark, d).select("doc_id", "source", dirty.alias("text"))


@query
def clean_text(spark, d):
    return textjobs.clean_text(_dirty_docs(spark, d)).select("doc_id", F.md5("text").alias("text_md5"), F.length("text").cast("bigint").alias("chars"))


@query
def cleaning_report(spark, d):
    return textjobs.cleaning_report(_dirty_docs(spark, d), "source")


@query
def pack_chunks(spark, d):
    return textjobs.pack_chunks(V.documents(spark, d), "doc_id")


@query
def default_instructions(spark, d):
    c = textjobs.pack_chunks(V.documents(spark, d), "doc_id")
    return textjobs.default_instructions(c, "doc_id")


@query
def voice_plan(spark, d):
    """Journey: scripts with emphasis, packed into chunks that each have a speaking instruction."""
    c = produce.voice_plan(V.documents(spark, d), _docs_as_topics(spark, d), "doc_id", CHANNEL)
    return c.select("doc_id", "chunk_idx", "n_chunks", F.md5("text").alias("text_md5"), "n_words", "instruct", "speed")


@query
def attach_instructions(spark, d):
    c = textjobs.pack_chunks(V.documents(spark, d), "doc_id").select("doc_id", "chunk_idx", "n_words")
    return textjobs.attach_instructions(c, V.labelled_instructions(spark, d), "doc_id")


# --- metadata ---------------------------------------------------------------


@query
def plan_titles(spark, d):
    return metadata.plan_titles(V.catalog_topics(spark, d)).select("topic_id", "formula", "title")


@query
def duplicate_titles(spark, d):
    return metadata.duplicate_titles(metadata.plan_titles(V.catalog_topics(spark, d), by="hash"))


@query
def describe_topics(spark, d):
    return metadata.describe(V.catalog_topics(spark, d)).select("topic_id", F.md5("description").alias("description_md5"), F.length("description").cast("bigint").alias("chars"))


@query
def fit_tags(spark, d):
    t = V.catalog_topics(spark, d).select("topic_id", metadata.fit_tag_array(metadata.candidate_tags(), budget=200).alias("tags"))
    return t.select("topic_id", F.array_join("tags", "|").alias("tags"), F.size("tags").alias("n_tags"))


@query
def fit_tags_long(spark, d):
    t = V.catalog_topics(spark, d).select(F.concat_ws("/", "chapter", "subject").alias("shelf"), F.col("topic_id"), F.posexplode(metadata.candidate_tags()).alias("i", "tag"))
    rows = t.select("shelf", (F.col("topic_id") * 100 + F.col("i")).alias("pos"), "tag")
    return metadata.fit_tags(rows, "shelf").select("shelf", F.array_join("tags", "|").alias("tags"), "used")


@query
def publish_metadata(spark, d):
    """Journey: title, description and tags of every topic."""
    m = produce.publish_metadata(V.catalog_topics(spark, d))
    return m.select(
        "topic_id", "formula", "title", F.md5("description").alias("description_md5"), F.length("description").cast("bigint").alias("chars"),
        F.array_join("tags", "|").alias("tags"), F.size("tags").alias("n_tags"),
    )


def _names(spark, d):
    joint = F.element_at(F.array(F.lit(" "), F.lit("-"), F.lit("/"), F.lit("  ")), (F.col("p_size") % 4 + 1).cast("int"))
    return V.table(spark, d, "part").select("p_partkey", F.concat_ws("", F.replace("p_name", F.lit(" "), joint), F.lit(" "), F.upper("p_type")).alias("name"))


@query
def slugify_keys(spark, d):
    return metadata.slugify_keys(_names(spark, d), "name")


@query
def slug_collisions(spark, d):
    return metadata.slug_collisions(_names(spark, d), "name", "trimmed")


# --- logs, files, health ----------------------------------------------------


@query
def classify_errors(spark, d):
    n = F.col("doc_id") % 9
    marks = [" Gradio", " notebooklm", " ffmpeg", " WAV", " Whisper", " 429", " YouTube", "", " Colab 429"]
    message = F.concat("text", F.element_at(F.array(*map(F.lit, marks)), (n + 1).cast("int")))
    docs = V.documents(spark, d).select("doc_id", "source", message.alias("message"))
    return opslog.error_counts(opslog.classify_errors(docs), ["source"])


@query
def log_tail(spark, d):
    lines = textjobs.log_lines(V.documents(spark, d).select("doc_id", "source", F.col("text").alias("message")))
    return opslog.log_tail(lines, ["source"], ["doc_id", "line_no"])


@query
def last_error(spark, d):
    e = V.events(spark, d).withColumn("line", F.concat_ws(" ", text("event_id"), "props"))
    return opslog.last_error(e, ["user_id"], ["ts", "event_id"], is_error=F.col("event_type") == "error")


@query
def run_sessions(spark, d):
    t = F.col("event_type")
    line = (
        F.when(t == "signup", F.lit("Triggering pipeline for now..."))
        .when(t == "purchase", F.lit("all done: Pipeline Complete!"))
        .when(t == "error", F.lit("Pipeline Error: exit 1"))
        .otherwise(F.lit("working"))
    )
    return plain_times(opslog.run_sessions(V.events(spark, d).withColumn("line", line), "user_id", ["ts", "event_id"]))


@query
def payload_quality(spark, d):
    n = F.col("page_id") % 10
    body = (
        F.when(n == 0, F.lit("tiny"))
        .when(n == 1, F.concat(F.lit("x" * 300), "html"))
        .when(n == 2, F.concat("html", F.lit(rules.DEAD_PAGE_MARK)))
        .otherwise(F.col("html"))
    )
    p = V.table(spark, d, "pages").select(F.regexp_extract("url", "^https?://([^/]+)", 1).alias("host"), body.alias("content"))
    return opslog.payload_quality(p, ["host"])


HEALTH_AS_OF = "2024-01-30 23:00:00"


def _health(spark, d):
    checks = V.events(spark, d).select(
        F.col("user_id").alias("service"), "ts", F.col("event_id").alias("check_id"), (F.col("event_type") != "error").alias("ok")
    )
    return opslog.health_checks(checks, F.lit(HEALTH_AS_OF).cast("timestamp"), fresh_minutes=600)


@query
def health_checks(spark, d):
    return plain_times(_health(spark, d)).withColumn("age_minutes", F.round("age_minutes", 3))


@query
def health_rollup(spark, d):
    e = V.events(spark, d).withColumn("line", F.concat_ws(" ", text("event_id"), "props"))
    errors = opslog.last_error(e, ["user_id"], ["ts", "event_id"], is_error=F.col("event_type") == "error", at="error_at")
    return opslog.health_rollup(_health(spark, d), catalog.queue_depth(V.topics(spark, d)), errors)


# --- schedules --------------------------------------------------------------


def _type_schedules(spark, d):
    return V.events(spark, d).groupBy(F.col("event_type").alias("stream")).agg(
        F.min(local_date(F.col("ts"))).alias("first_day"), F.max(local_date(F.col("ts"))).alias("last_day")
    ).withColumns({"hour_local": F.length("stream"), "enabled": F.col("stream") != "click"})


def _user_schedules(spark, d):
    return V.events(spark, d).groupBy(F.col("user_id").alias("stream")).agg(
        F.min(local_date(F.col("ts"))).alias("first_day"), F.max(local_date(F.col("ts"))).alias("last_day")
    ).withColumns({"hour_local": (F.col("stream") % 24).cast("int"), "enabled": F.col("stream") % 10 != 9})


@query
def schedule_slots(spark, d):
    return plain_times(schedule.schedule_slots(_type_schedules(spark, d), F.col("first_day"), F.col("last_day")))


@query
def next_run(spark, d):
    as_of = F.lit("2024-01-15 22:10:30").cast("timestamp")
    return plain_times(schedule.next_run(_user_schedules(spark, d).select("stream", "hour_local", "enabled"), as_of))


@query
def missed_runs(spark, d):
    as_of = F.lit("2024-01-25 12:00:00").cast("timestamp")
    out = schedule.missed_runs(_user_schedules(spark, d), V.run_events(spark, d), as_of, F.col("first_day"), F.col("last_day"))
    return plain_times(out.select("stream", "local_day", "slot_at"))


@query
def run_status(spark, d):
    return plain_times(schedule.run_status(V.run_events(spark, d)).withColumn("success_rate", F.round("success_rate", 4)))


# --- streams ----------------------------------------------------------------


def _event_stream(spark, d, files_per_trigger=None):
    return io.read_stream(spark, f"{d}/events*.parquet", V.EVENTS_SCHEMA, files_per_trigger)


@query
def stream_logs(spark, d):
    src = _event_stream(spark, d)
    esc = F.char(F.lit(27))
    cause = (
        F.when(F.col("event_type") == "error", F.lit("Gradio timed out"))
        .when(F.col("event_type") == "purchase", F.lit("upload refused"))
        .when(F.col("event_type") == "view", F.lit("ffmpeg exited"))
        .otherwise(F.lit("all well"))
    )
    msg = F.concat(esc, F.lit("[31m "), cause, esc, F.lit("[0m \n\n user "), text("user_id"))
    return io.drain(stream_logs_job.stream_logs(src.select("event_id", msg.alias("message"))), "logs")


@query
def stream_errors(spark, d):
    """The error log as text files, read as a stream."""
    e = V.events(spark, d)
    line = F.concat(F.lit("["), _iso("ts"), F.lit("] ["), F.upper("event_type"), F.lit("] user "), text("user_id"), F.lit(": "), "props")
    path = session.new_path(spark, "error-log")
    e.select(F.when(F.col("event_type") == "click", F.concat(F.lit("no brackets "), text("event_id"))).otherwise(line).alias("value")).write.text(path)
    return plain_times(io.drain(logs_src.read_error_stream(spark, path), "errors"))


@query
def stream_daily(spark, d):
    return io.drain(daily.stream_daily(_event_stream(spark, d), "event_type", V.cents(F.col("value"))), "daily")


@query
def stream_run_state(spark, d):
    """One file a batch; events of the last hour still wait for earlier ones."""
    t = F.col("event_type")
    event = (
        F.when(t == "signup", F.lit("claim")).when(t == "purchase", F.lit("complete")).when(t == "error", F.lit("fail")).when(t == "view", F.lit("reset")).otherwise(F.lit("noop"))
    )
    src = _event_stream(spark, d, 1).select(F.col("user_id").alias("topic_id"), "event_id", "ts", event.alias("event"))
    steps = io.drain(state.stream_run_state(src, delay="1 hour"), "run-state")
    return steps.groupBy("topic_id").agg(
        F.max_by("status", F.struct("ts", "event_id")).alias("status"),
        F.count_if(F.col("verdict") == "applied").alias("applied"),
        F.count_if(F.col("verdict") == "illegal").alias("illegal"),
    )


@query
def stream_missed(spark, d):
    sched = _user_schedules(spark, d).where("enabled")
    slots = schedule.schedule_slots(sched, F.col("first_day"), F.date_add("last_day", 2)).select("stream", "local_day", "slot_at")
    path = session.new_path(spark, "slots")
    slots.write.parquet(path)
    ticks = io.read_stream(spark, path, "stream bigint, local_day date, slot_at timestamp")
    runs = _event_stream(spark, d).select(
        F.col("user_id").alias("stream"), "ts", F.when(F.col("event_type") == "purchase", F.lit("success")).otherwise(F.lit("other")).alias("status")
    )
    return plain_times(io.drain(missed.stream_missed(ticks, runs), "missed"))


@query
def stream_dedup(spark, d):
    runs = _event_stream(spark, d).select(
        F.col("user_id").alias("stream"), "ts", F.when(F.col("event_type") == "purchase", F.lit("success")).otherwise(F.lit("other")).alias("status")
    )
    twice = runs.select(F.explode(F.array(F.struct("*"), F.struct("*"))).alias("r")).select("r.*")
    return io.drain(dedup.stream_dedup(twice), "dedup")
