"""Benchmark passages in documents: a prefix-filtered set join on word shingles, in JVM expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.common import ascii_lower, stored, table

SEPARATORS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
#: Bytes of the shingle table up to which it is sent to every executor.
BROADCAST_BYTES = 64 << 20


def words_of(text: str) -> Column:
    """Words with A-Z lower-cased. Only texts with other letters than ASCII need a look at each letter."""
    c = F.col(text)
    low = F.when(F.length(c) == F.octet_length(c), F.lower(c)).otherwise(ascii_lower(c))
    return F.coalesce(F.array_remove(F.split(low, SEPARATORS, -1), ""), F.array().cast("array<string>"))


def _shingle(words: Column, at: Column, width: Column, most: int) -> Column:
    """Hash of the ``width`` words (``most`` at most) from 0-based ``at`` on; words beyond it do not count."""
    parts = [F.when(F.lit(i) < width, F.get(words, at + i)) for i in range(most)]
    return F.xxhash64(width, *parts)


def _windows(benchmark: DataFrame, window: int) -> tuple[DataFrame, DataFrame]:
    """Distinct windows (window_id, words) and the items that hold them (window_id, item_id)."""
    items = benchmark.select("item_id", words_of("text").alias("w"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0)))
    each = items.where(F.size("w") > 0).select("item_id", "w", F.explode(starts).alias("at"))
    each = each.select("item_id", F.slice("w", F.col("at") + 1, window).alias("words"))
    # Equal windows are one; its id is a 128-bit hash.
    key = F.struct(F.xxhash64("words").alias("a"), F.xxhash64(F.lit(1), "words").alias("b"))
    each = stored(each.select(key.alias("window_id"), "words", "item_id").distinct(), "windows")
    return each.select("window_id", "words").distinct(), each.select("window_id", "item_id").distinct()


def _positions(docs: DataFrame, widths: list[int], keep: list[str]) -> DataFrame:
    """One row per document, word position and shingle width; the last position of each (``at = n``) has no shingle."""
    n = F.size("w")
    at = docs.select(*keep, "w", n.alias("n"), F.explode(F.sequence(F.lit(0), n)).alias("at"))
    if len(widths) == 1:
        at = at.withColumn("width", F.lit(widths[0]))
    else:
        at = at.withColumn("width", F.explode(F.array(*map(F.lit, widths))))
    inside = F.col("at") + F.col("width") <= F.col("n")
    return at.withColumn("shingle", F.when(inside, _shingle(F.col("w"), F.col("at"), F.col("width"), max(widths))))


def find_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    width: int = 3,
    broadcast_bytes: int = BROADCAST_BYTES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """Every occurrence of a benchmark window in a document, and what documents there are.

    A window is ``window`` consecutive words of an item, or all of a shorter
    item. Its set is its word shingles of ``width`` words (or all its words, if
    fewer). It must be contained whole, so of the shingles ordered by how often
    documents hold them, a prefix of one, the rarest, is necessary; a window
    with a shingle that no document holds is out. Documents meet these prefix
    shingles only. The window must then fit between the document's first and
    last word at the place the shingle's position gives, and all its words are
    compared there.

    Shingles and prefixes go to all executors up to ``broadcast_bytes`` of
    measured size, and words are then compared in the same pass. Beyond
    that they are joined by shuffles, and the candidates meet the words again
    by (id, text hash), so no text travels with its shingles.

    Returns (hits, documents). Hits: ``doc``, ``start`` (0-based), ``words``
    (how many), ``item_id``. Documents: ``doc``, ``n_words``, once for each
    different row. ``doc`` is a struct of ``id`` and a 128-bit hash of the text.
    Null and empty texts have no words; items without words have no windows.
    Other columns are ignored.
    """
    windows, items = _windows(benchmark.select("item_id", "text"), window)
    doc = F.struct(F.col(id_col).alias("id"), F.xxhash64("t").alias("a"), F.xxhash64(F.lit(1), "t").alias("b"))
    docs = docs.select(id_col, F.coalesce(F.col(text_col), F.lit("")).alias("t")).select(doc.alias("doc"), words_of("t").alias("w"))

    size = F.size("words")
    shingles = windows.select("window_id", "words", F.least(size, F.lit(width)).alias("width"))
    offset = F.explode(F.sequence(F.lit(0), F.size("words") - F.col("width"))).alias("offset")
    shingles = shingles.select("window_id", "words", "width", offset)
    shingles = stored(shingles.withColumn("shingle", _shingle(F.col("words"), F.col("offset"), F.col("width"), width)), "shingles")
    # Most windows have the full width; shorter items add at most width - 1 others.
    widths = sorted(r[0] for r in shingles.select("width").distinct().collect()) or [width]
    small = _bytes(shingles) <= broadcast_bytes

    def side(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if small else df.hint("merge")

    key = ["shingle", "width"]
    seen = _positions(docs, widths, []).select(*key).join(side(shingles.select(*key).distinct()), key).groupBy(*key).agg(F.count("*").alias("n"))
    counts = stored(seen, "shingle-counts")
    ranked = shingles.join(counts, key, "left").groupBy("window_id").agg(
        F.min_by(F.struct("shingle", "width", "offset", "words"), F.struct("n", "offset")).alias("p"), F.count_if(F.col("n").isNull()).alias("unseen")
    )
    prefix = stored(ranked.where("unseen = 0").select("p.*", "window_id"), "prefixes")

    same = F.slice("w", F.col("start") + 1, F.size("words")) == F.col("words")
    start = (F.col("at") - F.col("offset")).alias("start")
    fits = (F.col("start") >= 0) & (F.col("start") + F.size("words") <= F.col("n"))
    if small:
        # The last position of each document stays, whatever it meets: it brings the document's own row.
        met = _positions(docs, widths, ["doc"]).join(side(prefix), key, "left")
        met = met.select("doc", "w", "n", "at", "width", "words", "window_id", start)
        own = (F.col("at") == F.col("n")) & (F.col("width") == widths[0])
        met = met.where(own | (F.col("window_id").isNotNull() & fits & same))
        met = met.select("doc", "n", "start", F.size("words").alias("words"), "window_id")
        met = stored(met.distinct(), "occurrences")
        found = met.where(F.col("window_id").isNotNull()).select("doc", "start", "words", "window_id")
        every = met.where(F.col("window_id").isNull()).select("doc", F.col("n").alias("n_words"))
    else:
        near = _positions(docs, widths, ["doc"]).select("doc", "n", "at", *key).where(F.col("shingle").isNotNull())
        met = near.join(side(prefix), key).select("doc", "n", "words", "window_id", start).where(fits).select("doc", "start", "words", "window_id")
        met = stored(met.distinct(), "candidates")
        found = met.join(docs.hint("merge"), "doc").where(same).select("doc", "start", F.size("words").alias("words"), "window_id").distinct()
        every = docs.select("doc", F.size("w").alias("n_words")).distinct()
    return found.join(items, "window_id").select("doc", "start", "words", "item_id"), every


def _bytes(shingles: DataFrame) -> int:
    """About what the rows take in memory: their words, and 100 bytes for keys and lengths."""
    size = F.octet_length(F.array_join("words", " ")) + 8 * F.size("words") + 100
    return shingles.agg(F.sum(size)).first()[0] or 0


def _covered(spans: Column) -> Column:
    """Words in any of the sorted (start, end) spans."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))

    def add(acc: Column, s: Column) -> Column:
        more = F.greatest(F.lit(0), s["end"] - F.greatest(acc["end"], s["start"]))
        return F.struct(F.greatest(acc["end"], s["end"]).alias("end"), (acc["n"] + more).alias("n"))

    return F.aggregate(spans, zero, add, lambda acc: acc["n"])


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10, width: int = 3, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Benchmark words and items in each document.

    Documents: doc_id, text. Benchmark: item_id, text. Returns one row per
    document row: ``doc_id``, ``n_words``, ``n_hit`` (words inside any
    occurrence of a window), ``items`` (ids of items with an occurring window,
    as sorted strings), ``contaminated``. Rows that repeat id and text each get
    the result; rows that repeat an id with another text are told apart. Items
    that share an id are one item, an item without an id hits words but is not
    listed. No benchmark finds nothing; no documents give no rows.
    """
    found, every = find_passages(docs, benchmark, window, width, broadcast_bytes)
    spans = F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("words")).alias("end"))))
    hits = found.groupBy("doc").agg(_covered(spans).alias("hit"), F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("found"))
    per_doc = every.join(hits, "doc", "left")
    # Rows of one document that repeat: only their number is missing.
    t = F.coalesce("text", F.lit(""))
    times = docs.groupBy(F.struct(F.col("doc_id").alias("id"), F.xxhash64(t).alias("a"), F.xxhash64(F.lit(1), t).alias("b")).alias("doc")).count()
    per_doc = per_doc.join(times, "doc").withColumn("again", F.explode(F.sequence(F.lit(1).cast("long"), F.col("count"))))
    n_hit = F.coalesce("hit", F.lit(0)).cast("long")
    return per_doc.select(
        F.col("doc.id").alias("doc_id"),
        F.col("n_words").cast("long").alias("n_words"),
        n_hit.alias("n_hit"),
        F.coalesce("found", F.array().cast("array<string>")).alias("items"),
        (n_hit > 0).alias("contaminated"),
    )


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated"
    )


_WORDS = r"""list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                         '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"""
SQL = {
    "op13_decontamination": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS txt
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM b WHERE len(w) > 0)),
places AS (
  SELECT r, i, size, array_to_string(w[i : i + size - 1], ' ') AS txt
  FROM (SELECT r, w, size, unnest(generate_series(1, len(w) - size + 1)) AS i FROM d, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size)),
hits AS (SELECT DISTINCT r, i, size, item_id FROM places JOIN windows USING (size, txt)),
hit_words AS (SELECT r, count(DISTINCT pos) AS n_hit FROM (SELECT r, unnest(generate_series(i, i + size - 1)) AS pos FROM hits) GROUP BY r),
hit_items AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words USING (r) LEFT JOIN hit_items USING (r)"""
}
QUERIES = {"op13_decontamination": op13_decontamination}
