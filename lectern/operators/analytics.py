"""Channel analytics: hourly profile, best hour, totals, history, top videos."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern import rules, schemas
from lectern.functions.num import round_half_up
from lectern.functions.text import slug_trimmed
from lectern.functions.time import hour_label, hour_of_upload
from lectern.plans.ordered import first_rows


def enrich_stats(uploads: DataFrame, stats: DataFrame, n: int = rules.RECENT_UPLOADS) -> DataFrame:
    """Newest ``n`` uploads per channel with their counters; unknown ids vanish.

    Uploads: channel, video_id, published_at. Stats: video_id and counters.
    """
    latest = first_rows(uploads, ["channel"], [F.col("published_at").desc(), F.col("video_id").desc()], n, "recency")
    return latest.join(stats, "video_id")


def hourly_profile(stats: DataFrame, mode: str = "tz", channel: str = "channel") -> DataFrame:
    """24 rows per channel: views, uploads and rounded average by local hour.

    Hours fold to a per-channel map of at most 24 entries, so the empty hours
    are filled without a join.
    """
    by_hour = (
        stats.groupBy(channel, hour_of_upload(F.col("published_at"), mode).alias("hour"))
        .agg(F.sum(F.coalesce("views", F.lit(0))).alias("views"), F.count(F.lit(1)).alias("n"))
    )
    dense = by_hour.groupBy(channel).agg(
        F.map_from_entries(F.collect_list(F.struct("hour", F.struct("views", "n")))).alias("__m")
    ).select(channel, "__m", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour"))
    cell = F.element_at("__m", F.col("hour"))
    views = F.coalesce(cell["views"], F.lit(0))
    n = F.coalesce(cell["n"], F.lit(0))
    return dense.select(
        channel,
        "hour",
        hour_label(F.col("hour")).alias("label"),
        views.alias("views"),
        n.cast("long").alias("uploads"),
        F.when(n > 0, round_half_up(views / n)).otherwise(F.lit(0)).cast("long").alias("avg_views"),
    )


def _rank() -> Column:
    """Order of hours, null for those that cannot be best."""
    avg = F.try_divide(F.col("views"), F.col("uploads"))
    return F.when((F.col("uploads") > 0) & (avg > 0), F.struct(avg, -F.col("hour")))


def best_hour(profile: DataFrame, default: int = rules.DEFAULT_HOUR, channel: str = "channel") -> DataFrame:
    """Hour with the highest average views above zero; ties take the earliest."""
    return profile.groupBy(channel).agg(
        F.coalesce(
            F.max_by(F.col("hour"), _rank()), F.lit(default)
        ).alias("best_hour"),
        F.sum("uploads").alias("videos"),
        (F.sum("uploads") >= rules.ENOUGH_VIDEOS).alias("has_enough"),
    ).withColumn("label", hour_label(F.col("best_hour")))


def hour_chart(profile: DataFrame, default: int = rules.DEFAULT_HOUR, channel: str = "channel") -> DataFrame:
    """Hours worth showing: those with uploads, and the best one.

    A channel has 24 rows, so its best hour is found in a window over them.
    """
    best = F.max_by(F.col("hour"), _rank()).over(Window.partitionBy(channel))
    shown = profile.withColumn("is_best", F.col("hour") == F.coalesce(best, F.lit(default)))
    return shown.where((F.col("uploads") > 0) | F.col("is_best"))


def channel_totals(stats: DataFrame, channel: str = "channel") -> DataFrame:
    return stats.groupBy(channel).agg(
        *[F.sum(F.coalesce(c, F.lit(0))).cast("long").alias(f"total_{c}") for c in ("views", "likes", "comments")],
        F.count(F.lit(1)).alias("videos"),
    )


def recent_history(stats: DataFrame, n: int = rules.HISTORY_KEEP, channel: str = "channel") -> DataFrame:
    """The ``n`` newest videos per channel, labelled V1.. from the oldest of them."""
    latest = first_rows(stats, [channel], [F.col("published_at").desc(), F.col("video_id").desc()], n, "recency")
    kept = F.max("recency").over(Window.partitionBy(channel))  # over at most n rows
    seq = kept - F.col("recency") + 1
    return latest.select(
        *stats.columns, seq.alias("seq"), F.concat(F.lit("V"), seq.cast("string")).alias("name")
    )


def top_videos(videos: DataFrame, k: int = 5, min_views: int = 0, query: str = "query", pos: str = "pos") -> DataFrame:
    """Best-viewed videos per query with manifest names; ties keep list order."""
    views = F.coalesce("views", F.lit(0))
    v = videos.withColumn("views", views).where(F.col("views") >= min_views)
    top = first_rows(v, [query], [F.col("views").desc(), F.col(pos)], k, "rank")
    return top.withColumn("file", F.concat(slug_trimmed(F.col(query).cast("string")), F.lit("-"), F.col("rank").cast("string"), F.lit(".jpg")))


def best_thumbnail(thumbs: DataFrame, key: str, pos: str = "pos") -> DataFrame:
    """Largest picture per video from long rows (url, width, height); first on ties."""
    area = F.coalesce("width", F.lit(0)) * F.coalesce("height", F.lit(0))
    first = F.struct((-area).alias("a"), F.col(pos).alias("p"))
    return thumbs.groupBy(key).agg(F.min_by("url", first).alias("url"), F.max(area).alias("area"))


def best_thumbnail_url(doc: str):
    """The same from a JSON value that is a string, an object or a list of objects."""
    items = F.from_json(doc, f"array<{schemas.THUMBNAIL}>")
    sized = F.transform(
        items,
        lambda t, i: F.struct(
            (-F.coalesce(t["width"], F.lit(0)).cast("long") * F.coalesce(t["height"], F.lit(0)).cast("long")).alias("a"),
            i.alias("i"),
            F.coalesce(t["url"], F.lit("")).alias("url"),
        ),
    )
    text = F.ltrim(doc)
    return F.coalesce(
        F.when(text.startswith("["), F.array_min(sized)["url"])
        .when(text.startswith("{"), F.get_json_object(doc, "$.url"))
        .when(text.startswith('"'), F.from_json(F.concat(F.lit('{"u":'), F.col(doc), F.lit("}")), "u string")["u"]),
        F.lit(""),
    )
