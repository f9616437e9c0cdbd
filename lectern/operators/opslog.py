"""Run logs, files and health."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern import rules
from lectern.functions.text import slug_chars
from lectern.functions.time import instant
from lectern.plans.ordered import Scan, first_rows, scan


def error_category(message: Column, table: Sequence[tuple[str, Sequence[str]]] = rules.ERROR_RULES) -> Column:
    """First matching rule of an ordered (category, substrings) table."""
    out = None
    for name, marks in table:
        hit = reduce(lambda a, b: a | b, [message.contains(m) for m in marks])
        out = F.when(hit, F.lit(name)) if out is None else out.when(hit, F.lit(name))
    return out.otherwise(F.lit(rules.ERROR_OTHER))


def classify_errors(logs: DataFrame, message: str = "message") -> DataFrame:
    return logs.withColumn("category", error_category(F.col(message)))


def error_counts(classified: DataFrame, by: Sequence[str]) -> DataFrame:
    return classified.groupBy(*by, "category").agg(F.count(F.lit(1)).alias("errors"))


def log_tail(lines: DataFrame, keys: Sequence[str], order: Sequence[str], n: int = rules.LOG_KEEP) -> DataFrame:
    """Newest ``n`` lines per key; ``recency`` 1 is the newest."""
    return first_rows(lines, keys, [F.col(c).desc() for c in order], n, "recency")


def last_error(logs: DataFrame, keys: Sequence[str], order: Sequence[str], line: str = "line", is_error: Column | None = None, at: str | None = None) -> DataFrame:
    """Newest error line per key, ``none`` where there is none.

    ``at`` names a column for the place of that line in the order.
    """
    ok = F.lit(True) if is_error is None else is_error
    place = F.when(ok, F.struct(*order))
    return logs.groupBy(*keys).agg(
        F.coalesce(F.nullif(F.max_by(F.col(line), place), F.lit("")), F.lit("none")).alias("last_error"),
        *([F.max(place).alias(at)] if at else []),
    )


def run_sessions(
    logs: DataFrame,
    key: str,
    order: Sequence[str],
    line: str = "line",
    partitions: int | None = None,
) -> DataFrame:
    """Runs of each stream: start line, first end line after it, state, duration.

    Lines before a stream's first start belong to no run.
    """
    low = F.lower(line)
    starts = F.col(line).contains(rules.RUN_START)
    marks = F.when(low.contains(rules.RUN_DONE), F.lit("success")).when(low.contains(rules.RUN_ERROR), F.lit("failed"))
    s = scan(
        logs.select(key, *order, F.col(line).alias("__line"), starts.alias("__start"), marks.alias("__end")),
        [key],
        list(order),
        Scan(sums={"run_no": F.col("__start").cast("long")}),
        partitions,
    )
    ts = order[0]
    first_end = F.when(F.col("__end").isNotNull() & ~F.col("__start"), F.struct(*order))
    return (
        s.where(F.col("run_no") > 0)
        .groupBy(key, "run_no")
        .agg(
            F.min(F.when(F.col("__start"), F.col(ts))).alias("started_at"),
            F.min_by(F.struct(F.col(ts).alias("at"), F.col("__end").alias("state")), first_end).alias("__e"),
            F.count(F.lit(1)).alias("n_lines"),
        )
        .select(
            key,
            "run_no",
            "started_at",
            F.col("__e.at").alias("ended_at"),
            F.coalesce("__e.state", F.lit("running")).alias("state"),
            ((F.unix_millis(instant("__e.at")) - F.unix_millis(instant("started_at"))) / 1000).alias("duration_s"),
            "n_lines",
        )
    )


def retry_summary(retries: DataFrame, successes: DataFrame, job: str = "job") -> DataFrame:
    """Attempts per job and whether a success followed the last failure.

    Retries: job, attempt, logged_at, message. Successes: job, ts.
    """
    r = retries.groupBy(job).agg(
        F.count(F.lit(1)).alias("failures"),
        F.max("attempt").alias("max_attempt"),
        F.max("logged_at").alias("last_failure"),
        F.max_by("message", F.struct("logged_at", "attempt", "message")).alias("last_message"),
    )
    s = successes.groupBy(job).agg(F.max("ts").alias("last_success"))
    return r.join(s, job, "left").withColumn(
        "recovered", F.coalesce(F.col("last_success") > F.col("last_failure"), F.lit(False))
    )


def asset_class(name: Column) -> Column:
    low = F.lower(name)
    return (
        F.when(low.contains(".wav") | low.contains(".mp3"), F.lit("audio"))
        .when(low.contains(".txt"), F.lit("transcript"))
        .when(low.contains("timeline") | low.contains(".json"), F.lit("timeline"))
        .otherwise(F.lit("other"))
    )


def asset_inventory(files: DataFrame, topic: str = "topic") -> DataFrame:
    """Files, bytes and the newest file per topic and class.

    A class keeps one file per topic downstream, so more than one means that a
    later upload replaced an earlier: ``overwritten``.
    """
    ok = reduce(lambda a, b: a | b, [F.col("name").endswith(s) for s in rules.UPLOAD_SUFFIXES])
    return files.groupBy(topic, asset_class(F.col("name")).alias("asset_class")).agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("length").alias("bytes"),
        F.max_by("name", F.struct("modified_at", "name")).alias("newest"),
        F.count_if(ok).alias("accepted"),
    ).withColumn("overwritten", (F.col("files") > 1) & (F.col("asset_class") != "other"))


def pick_latest_artifact(
    files: DataFrame,
    key: str,
    as_of: Column,
    dir_priority: Sequence[str],
    max_age_s: int = rules.DOWNLOAD_MAX_AGE_S,
) -> DataFrame:
    """Newest finished media file per key from the first directory that has one.

    A combining aggregate, not a sort: files of one key never meet in one task.
    """
    rank = F.array_position(F.array(*[F.lit(d) for d in dir_priority]), F.col("dir"))
    media = reduce(lambda a, b: a | b, [F.col("name").endswith(s) for s in rules.MEDIA_SUFFIXES])
    at = F.unix_millis(instant("modified_at"))
    fresh = at > F.unix_millis(instant(as_of)) - max_age_s * 1000
    ok = files.where(~F.col("name").endswith(rules.PARTIAL_SUFFIX) & media & fresh & (rank > 0))
    return ok.groupBy(key).agg(
        F.min_by(F.struct("dir", "name", "modified_at"), F.struct(rank, -at, F.col("name"))).alias("f")
    ).select(key, "f.*")


def artifact_name(topic: Column, name: Column, prefix: str) -> Column:
    """Final name of a picked file: prefix, topic slug, its own extension."""
    return F.concat(F.lit(prefix + "_"), slug_chars(topic), F.regexp_extract(name, r"(\.[^.]+)$", 1))


def payload_flags(content: Column, length: Column | None = None) -> dict[str, Column]:
    """Why a downloaded payload is not what it should be."""
    size = F.octet_length(content) if length is None else length
    text = content.cast("string")
    head = F.substring(content.cast("binary"), 1, 256).cast("string")
    return {
        "is_html": reduce(lambda a, b: a | b, [head.contains(m) for m in rules.HTML_MARKS]),
        "is_junk": size < rules.JUNK_FLOOR_BYTES,
        "is_small": size < rules.MEDIA_FLOOR_BYTES,
        "is_dead": text.contains(rules.DEAD_PAGE_MARK),
    }


def payload_quality(files: DataFrame, by: Sequence[str], content: str = "content") -> DataFrame:
    flags = payload_flags(F.col(content))
    f = files.select(*by, F.octet_length(content).alias("bytes"), *[c.alias(n) for n, c in flags.items()])
    return f.groupBy(*by).agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("bytes").cast("long").alias("bytes"),
        *[F.count_if(n).alias(n) for n in flags],
    )


def health_checks(checks: DataFrame, as_of: Column, fresh_minutes: int = rules.FRESH_MINUTES) -> DataFrame:
    """Latest check per service: live, dead (answered badly) or stale.

    Checks: service, ts, check_id, ok.
    """
    last = checks.groupBy("service").agg(F.max_by(F.struct("ts", "ok"), F.struct("ts", "check_id")).alias("c"))
    age = (F.unix_millis(instant(as_of)) - F.unix_millis(instant("c.ts"))) / 60000.0
    fresh = age < fresh_minutes
    return last.select(
        "service",
        F.col("c.ts").alias("checked_at"),
        age.alias("age_minutes"),
        F.when(fresh & F.col("c.ok"), F.lit("live")).when(fresh, F.lit("dead")).otherwise(F.lit("stale")).alias("state"),
    )


def health_rollup(services: DataFrame, depth: DataFrame, errors: DataFrame, critical: Column | None = None) -> DataFrame:
    """One row: overall status, service counts, pending topics, newest error.

    Errors: last_error and its place ``error_at``, per any key. Each input folds
    to one row; the three rows are put together by one more aggregate.
    """
    crit = F.lit(True) if critical is None else critical
    real = F.when(F.col("last_error") != "none", F.col("error_at"))
    parts = [
        services.agg(
            F.count(F.lit(1)).alias("services"),
            F.count_if(F.col("state") == "live").alias("live"),
            F.coalesce(F.bool_or(crit & (F.col("state") != "live")), F.lit(False)).alias("__bad"),
        ),
        depth.agg(F.coalesce(F.sum("pending"), F.lit(0)).alias("pending")),
        errors.agg(F.coalesce(F.max_by("last_error", real), F.lit("none")).alias("last_error")),
    ]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    one = rows.agg(*[F.max(c).alias(c) for c in rows.columns])
    return one.select(
        F.when(F.col("__bad"), F.lit("degraded")).otherwise(F.lit("ok")).alias("status"), "services", "live", "pending", "last_error"
    )
