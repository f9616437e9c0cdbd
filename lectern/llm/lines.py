"""Lines that many documents share, found with levelled sorted runs."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.common import BLANKS, ascii_lower, stored, table, whole

KEY = ["h1", "h2"]


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def _hash(key: Column) -> Column:
    """128 bits, so that unequal lines do not meet at any realistic size."""
    return F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit("line"), key).alias("h2"))


def _lines(text: str) -> Column:
    return F.split(whole(text), "\n", -1)


class LineRuns:
    """Sorted runs of line hashes in levels, like a log-structured merge tree.

    A run is a table bucketed and sorted by the hash: (h1, h2, n_docs, keeper).
    A key is in one run only, since each batch is anti-joined with all runs and
    adds just its new keys; those the runs know go to a side table of further
    counts. All runs and batches share the bucket count, so the merge joins
    move no run. A level that holds ``fanout`` runs is merged into one run of
    the next level, so a key is rewritten once a level.
    """

    def __init__(self, spark: SparkSession, buckets: int | None = None, fanout: int = 3):
        self.spark, self.fanout = spark, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.name = f"line_runs_{uuid.uuid4().hex[:12]}"
        self.levels: list[list[str]] = [[]]
        self.again: list[DataFrame] = []
        self.made = 0

    def _run(self, df: DataFrame) -> str:
        self.made += 1
        name = f"{self.name}_{self.made}"
        df.select(*KEY, "n_docs", "keeper").write.bucketBy(self.buckets, *KEY).sortBy(*KEY).saveAsTable(name)
        return name

    def runs(self) -> list[DataFrame]:
        return [self.spark.table(n) for level in self.levels for n in level]

    def add(self, keys: DataFrame) -> None:
        """keys: (h1, h2, doc_id), a key once per document."""
        batch = keys.groupBy(*KEY).agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("keeper"))
        batch = self.spark.table(self._run(batch.repartition(self.buckets, *KEY)))
        new = batch
        for run in self.runs():
            self.again.append(stored(batch.join(run, KEY, "left_semi"), "known-lines"))
            new = new.join(run, KEY, "left_anti")
        self.levels[0].append(self._run(new) if self.runs() else f"{self.name}_{self.made}")
        self.compact()

    def compact(self) -> None:
        for i, level in enumerate(self.levels):
            if len(level) < self.fanout:
                continue
            merged = self.spark.table(level[0])
            for name in level[1:]:
                merged = merged.unionByName(self.spark.table(name))
            self.levels[i] = []
            if i + 1 == len(self.levels):
                self.levels.append([])
            self.levels[i + 1].append(self._run(merged.repartition(self.buckets, *KEY)))

    def repeated(self, min_docs: int) -> DataFrame:
        """(h1, h2, keeper) of keys in at least ``min_docs`` documents."""
        if not self.again:
            found = self.runs()
            return found[0].where(F.col("n_docs") >= min_docs).select(*KEY, "keeper")
        more = self.again[0]
        for part in self.again[1:]:
            more = more.unionByName(part)
        more = stored(more.groupBy(*KEY).agg(F.sum("n_docs").alias("n2"), F.max("keeper").alias("k2")), "line-counts")
        out = None
        for run in self.runs():
            part = run.join(more, KEY, "left").where(F.col("n_docs") + F.coalesce("n2", F.lit(0)) >= min_docs)
            part = part.select(*KEY, F.greatest("keeper", "k2").alias("keeper"))
            out = part if out is None else out.unionByName(part)
        return out


def line_dedup(docs: DataFrame, min_docs: int = 3, min_chars: int = 20, batches: int = 4, buckets: int | None = None) -> DataFrame:
    """Drop lines whose key is in ``min_docs`` or more documents, save in the largest id that has it.

    Documents arrive in ``batches`` (by a hash of the id); each batch is merged
    into ``LineRuns``. Only hashes are shuffled there, once per document and
    key, and counts combine first, so a line found in a third of all documents
    costs one row a task. The texts move once, to meet the keys they lose.

    Returns one row per document: ``doc_id``, ``text`` (the kept lines),
    ``n_lines``, ``n_dropped``. Null and empty texts are one empty line. Keys
    shorter than ``min_chars`` code points always stay. Repeated rows of one id
    are one document. A null id holds lines like another but never is the
    largest. Further columns are ignored; no rows give no rows.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.col("text"))
    keys = F.array_distinct(F.filter(F.transform(_lines("text"), line_key), lambda k: F.char_length(k) >= min_chars))
    each = docs.select("doc_id", F.explode(F.transform(keys, _hash)).alias("h")).select("doc_id", "h.h1", "h.h2")
    batch = F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int").alias("batch")
    each = stored(each.select("*", batch), "line-keys")
    runs = LineRuns(spark, buckets)
    for b in range(batches):
        runs.add(each.where(F.col("batch") == b).select(*KEY, "doc_id").distinct())
    hot = stored(runs.repeated(min_docs), "repeated-lines")
    lost = each.join(hot, KEY).where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    drops = stored(lost.groupBy("doc_id").agg(F.collect_set(F.struct(*KEY)).alias("lost")), "lost-lines")

    lines = docs.join(drops.select(F.col("doc_id").alias("id"), "lost"), F.col("doc_id").eqNullSafe(F.col("id")), "left").select(
        "doc_id", "lost", _lines("text").alias("lines")
    )
    stays = F.filter("lines", lambda x: (F.char_length(line_key(x)) < min_chars) | ~F.array_contains(F.col("lost"), _hash(line_key(x))))
    kept = lines.select("doc_id", "lines", F.when(F.col("lost").isNull(), F.col("lines")).otherwise(stays).alias("kept"))
    return kept.select(
        "doc_id",
        F.array_join("kept", "\n").alias("text"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size("kept")).cast("long").alias("n_dropped"),
    )


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


SQL = {
    "op2_line_dedup": r"""
WITH split AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM split),
hot AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
marked AS (
  SELECT keyed.*, coalesce(keeper <> doc_id, false) AS lost FROM keyed LEFT JOIN hot USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT lost), '')) AS kept_sha256
FROM marked GROUP BY doc_id"""
}
QUERIES = {"op2_line_dedup": op2_line_dedup}
