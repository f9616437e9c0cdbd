"""Tables that jobs keep between runs: URLs seen, the topic snapshot, claims."""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern import rules, session
from lectern.operators import catalog, strategy


class SeenStore:
    """URLs that earlier harvests found, as a table bucketed and sorted by URL.

    A harvest anti-joins the table bucket by bucket, so what was seen is never
    shuffled again, and appends only what is new as another file per bucket.
    ``compact`` writes the files of each bucket as one. The table lies in a
    folder of its own below the shared folder; opening its path again goes on
    with it.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int = 64):
        self.spark, self.buckets = spark, buckets
        self.path = path or session.new_path(spark, "seen")
        # Names in the catalog are this session's own; the path is what lasts.
        self.name = f"seen_{uuid.uuid4().hex[:12]}"
        spark.sql(
            f"CREATE TABLE {self.name} (url STRING) USING parquet CLUSTERED BY (url) SORTED BY (url) INTO {buckets} BUCKETS LOCATION '{self.path}'"
        )

    def table(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def new(self, urls: DataFrame) -> DataFrame:
        """Rows whose URL has not been seen."""
        return urls.join(self.table().hint("merge"), "url", "left_anti")

    def add(self, urls: DataFrame) -> None:
        """Append URLs, none of which is in the table."""
        urls.select("url").repartition(self.buckets, "url").write.insertInto(self.name)

    def harvest(self, pages: DataFrame, text: str, order: str, pattern: str = rules.LIVE_URL_PATTERN) -> DataFrame:
        """URLs in the pages that no harvest found before; they count as seen from now on.

        The result is written before the table changes, so reading it again
        gives the same rows, and a harvest that broke off in between is repeated.
        """
        found = self.new(strategy.harvest_urls(pages, text, order, pattern))
        path = session.new_path(self.spark, "harvest")
        found.write.parquet(path)
        found = self.spark.read.schema(found.schema).parquet(path)
        self.add(found)
        return found

    def compact(self) -> SeenStore:
        """The same URLs in a new store with one file per bucket."""
        out = SeenStore(self.spark, buckets=self.buckets)
        out.add(self.table())
        return out

    def close(self) -> None:
        """Take the name out of the catalog; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


class SnapshotStore:
    """The topic snapshot in buckets of topics; a batch of events rewrites only the buckets it touches."""

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int = 256):
        self.spark, self.buckets = spark, buckets
        self.path = path or session.new_path(spark, "snapshot")

    def _bucket(self):
        return F.pmod(F.xxhash64(F.col("topic_id").cast("string")), F.lit(self.buckets)).cast("int").alias("bucket")

    def _replace(self, rows: DataFrame) -> None:
        rows.hint("rebalance", "bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(self.path)

    def create(self, topics: DataFrame) -> SnapshotStore:
        self._replace(topics.select("*", self._bucket()))
        return self

    def topics(self) -> DataFrame:
        return self.spark.read.parquet(self.path).drop("bucket")

    def apply(self, events: DataFrame, order: Sequence[str] = ("ts", "event_id")) -> DataFrame:
        """Apply a batch of status events; returns the events that name no topic.

        Only buckets with an event are read and written. Events move once, as the
        latest one per topic and task; ids that meet no topic come out of the same
        join, and the rejected events are those that name one of these ids. All
        is written aside first: the snapshot changes when it is complete, and a
        batch that broke off is applied again.
        """
        e = events.select("*", self._bucket())
        # at most ``buckets`` numbers
        touched = sorted(r[0] for r in e.select("bucket").distinct().collect())
        old = self.spark.read.parquet(self.path).where(F.col("bucket").isin(touched))
        both = session.written(catalog.merge_status(old, events, order), "applied")
        unknown = session.written(both.where(~F.col(catalog.KNOWN)).select(F.col("topic_id").alias("__id")), "unknown-topics")
        rejected = events.join(unknown, events["topic_id"].eqNullSafe(unknown["__id"]), "left_semi")
        rejected = session.written(rejected, "rejected")
        if touched:
            self._replace(both.where(catalog.KNOWN).select(*old.columns))
        return rejected


class ClaimLedger:
    """Who works on which topic: one file per claimed topic, made only if it is not there.

    Making a file that must not exist is atomic on the shared store, so of two
    runs that want one topic exactly one gets it, whatever they read before. The
    file holds the run's name. One left empty by a run that broke off between
    making and signing keeps its topic from all others until it is removed.
    """

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark = spark
        self.path = path or session.new_path(spark, "claims")
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        folder = self._path(self.path)
        self.files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self.files.mkdirs(folder)
        self.local = self.files.getUri().getScheme() == "file"

    def _take(self, topic_id: str, run: str) -> bool:
        """Whether this run is the one that made the topic's entry."""
        entry = self._path(self.path, f"topic-{topic_id.encode().hex()}")
        if self.local:  # the local file system's own create looks first and makes then
            try:
                out = os.open(entry.toUri().getPath(), os.O_CREAT | os.O_EXCL | os.O_WRONLY)
            except FileExistsError:
                return False
            os.write(out, run.encode())
            os.close(out)
            return True
        try:
            out = self.files.create(entry, False)
        except Py4JJavaError as e:
            if "FileAlreadyExists" in e.java_exception.getClass().getName():
                return False
            raise
        out.write(bytearray(run.encode()))
        out.close()
        return True

    def entries(self) -> DataFrame:
        """(topic_id, run) of all claims."""
        names = self.spark.read.format("binaryFile").option("pathGlobFilter", "topic-*").load(self.path)
        topic = F.decode(F.unhex(F.regexp_extract("path", "/topic-([0-9a-f]*)$", 1)), "UTF-8")
        return names.select(topic.alias("topic_id"), F.decode("content", "UTF-8").alias("run"))

    def snapshot(self, topics: DataFrame) -> DataFrame:
        """Topics with those claimed and still Pending shown In Progress."""
        claimed = self.entries().select(F.col("topic_id").alias("__id"), F.lit(True).alias("__taken"))
        status = F.when(F.col("__taken") & (F.col("status") == rules.PENDING), F.lit(rules.IN_PROGRESS)).otherwise(F.col("status"))
        j = topics.join(claimed, topics["topic_id"].cast("string") == claimed["__id"], "left")
        return j.select(*[status.alias(c) if c == "status" else topics[c] for c in topics.columns])

    def claim(self, topics: DataFrame, run: str, streams: Sequence[str] | None = None) -> dict[str, str]:
        """Claim each stream's oldest Pending topic for ``run``; returns topic ids by stream.

        Where another run was faster, the next topic is tried. One row per
        stream reaches the driver, which is what a run asks for.
        """
        won: dict[str, str] = {}
        lost: list[str] = []
        topic = F.col("topic_id").cast("string")
        open_ = topics if streams is None else topics.where(F.col("stream").isin(list(streams)))
        while True:
            left = open_.where(~F.col("stream").isin(list(won)) & ~topic.isin(lost))
            wanted = [(r[0], r[1]) for r in catalog.next_pending(self.snapshot(left)).select("stream", topic).toLocalIterator()]
            if not wanted:
                return won
            for stream, topic_id in wanted:
                if self._take(topic_id, run):
                    won[stream] = topic_id
                else:
                    lost.append(topic_id)
