"""Language identification by Bayesian fusion of text, markup, address and host."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.common import stored, table, whole

UNKNOWN = "und"
# Stands for all languages too rare to be modelled alone.
POOLED = "mis"
# Tags that name no one language (fixed values).
NO_LANGUAGE = ("und", "mul", "zxx", "mis")
CELLS = 1 << 16
# Letters, separators: digits and signs carry no language.
_KEEP = np.zeros(256, dtype=np.uint8)
for _c in [*range(ord("a"), ord("z") + 1), *range(128, 256)]:
    _KEEP[_c] = _c
_KEEP[_KEEP == 0] = 32


def grams(text: str) -> np.ndarray:
    """Hashed byte trigrams of the letters of a text, with one separator between words."""
    b = _KEEP[np.frombuffer((" " + text.lower() + " ").encode("utf-8", "surrogatepass"), dtype=np.uint8)]
    if len(b) > 1:
        b = b[np.concatenate(([True], (b[1:] != 32) | (b[:-1] != 32)))]
    if len(b) < 3:
        return np.zeros(0, dtype=np.int64)
    x = b.astype(np.uint32)
    h = (x[:-2] * np.uint32(0x9E3779B1) ^ x[1:-1] * np.uint32(0x85EBCA77) ^ x[2:] * np.uint32(0xC2B2AE3D)) * np.uint32(0x27D4EB2F)
    return (h >> np.uint32(16)).astype(np.int64)


def _count(batches, languages):
    """Trigram counts by declared language, one table a task; the last is that of the rest if it is POOLED."""
    total = np.zeros((len(languages), CELLS), dtype=np.int64)
    place = {x: i for i, x in enumerate(languages)}
    rest = place.get(POOLED)
    for frame in batches:
        for declared, text in zip(frame["declared"], frame["text"], strict=True):
            at = place.get(declared, rest)
            if declared is not None and at is not None:
                g = grams(text)
                if len(g) > CELLS // 8:
                    total[at] += np.bincount(g, minlength=CELLS)
                else:
                    np.add.at(total[at], g, 1)
    i, g = np.nonzero(total)
    yield pd.DataFrame({"i": i, "g": g, "c": total[i, g]})


def declared_languages(rows: DataFrame, listed: int = 256) -> list[str]:
    """Languages that hold 1 / ``listed`` of all declared text or more; then POOLED, if others hold any.

    So at most ``listed`` names and one reach the driver, and no declared language is left out.
    """
    sizes = stored(rows.where("declared IS NOT NULL").groupBy("declared").agg(F.sum(F.length("text")).alias("n")), "declared-sizes")
    total = sizes.agg(F.sum("n")).first()[0] or 0
    own = (F.col("n") > 0) & (F.col("n") * listed >= total)
    names = sorted(r["declared"] for r in sizes.where(own).select("declared").collect())
    return names + [POOLED] if not names or sizes.where((F.col("n") > 0) & ~own).limit(1).count() else names


def text_model(rows: DataFrame, languages: Sequence[str], floor: float = 0.01) -> np.ndarray:
    """log P(trigram | language), a last column for text of no language.

    Counts cover all rows, grouped by declared language; the table has a fixed
    size. The last column is uniform: text unlike every language fits it best.
    ``floor`` is the uniform part of each language, so that a trigram it never
    shows costs the same however large the input is.
    """
    names = list(languages)
    counted = rows.select("declared", "text").mapInPandas(lambda it: _count(it, names), "i int, g int, c long")
    total = np.zeros((CELLS, len(names)))
    found = counted.groupBy("i", "g").agg(F.sum("c").alias("c")).toArrow()
    total[found["g"].to_numpy(), found["i"].to_numpy()] = found["c"].to_numpy()
    seen = total.sum(axis=0)
    logp = np.log((1 - floor) * total / np.maximum(seen, 1) + floor / CELLS)
    logp[:, seen == 0] = -50.0  # a language without any text is none to choose
    return np.concatenate([logp, np.full((CELLS, 1), -np.log(float(CELLS)))], axis=1).astype(np.float32)


def base_language(tag: Column) -> Column:
    """The primary part of a language tag: en-GB and EN_us are en."""
    return F.nullif(F.lower(F.regexp_extract(F.coalesce(tag, F.lit("")), r"^\s*([A-Za-z]{2,3})(?:[-_].*)?\s*$", 1)), F.lit(""))


def identify(
    rows: DataFrame,
    languages: Sequence[str] | None = None,
    temper: float = 0.05,
    host_strength: float = 20.0,
    declared_strength: float = 5.0,
    least_grams: int = 3,
    accept: float = 0.5,
) -> DataFrame:
    """Fuse evidence for rows (id, text, declared, suffix, host).

    The languages are those that the rows declare (``declared_languages``),
    unless they are given; rare ones share one model, whose name is "mis".
    log posterior = tempered text likelihood + P(declared | language)
    + P(suffix | language) + host prior. The likelihood of all trigrams of the
    whole text is tempered, since neighbours are not independent. Tables of
    declared language and suffix come from grouped counts of the languages that
    texts alone show; host counts are smoothed by those of the host's suffix,
    and these by the counts of all rows. A row's own vote is taken out of its
    host's counts. Only narrow rows are shuffled, and counts combine first, so
    a host with a third of all rows is one row a task.

    Returns id, ``lang_detected``, ``confidence``, ``text_lang``, ``n_grams``,
    ``accepted``. A text with fewer than ``least_grams`` trigrams has no
    language and is rejected, as are texts that fit no language better than
    uniform noise, and rows whose best language stays below ``accept``. Null
    evidence adds nothing. Repeated rows each count and are returned each.
    """
    tag = base_language(F.col("declared"))
    rows = rows.select("id", whole("text").alias("text"), F.when(~tag.isin(*NO_LANGUAGE), tag).alias("declared"), F.lower("suffix").alias("suffix"), F.lower("host").alias("host"))
    names = declared_languages(rows) if languages is None else list(languages)
    k = len(names)
    model = rows.sparkSession.sparkContext.broadcast(text_model(rows, names))

    def likelihoods(batches):
        logp = model.value
        for frame in batches:
            out = np.zeros((len(frame), k + 1))
            n = np.zeros(len(frame), dtype=np.int64)
            for i, text in enumerate(frame["text"]):
                g = grams(text)
                n[i] = len(g)
                out[i] = logp[g].sum(axis=0, dtype=np.float64)
            made = frame[["id", "declared", "suffix", "host"]].reset_index(drop=True)
            yield made.assign(id=made["id"].astype("Int64"), n=n, ll=list(out * temper))

    seen = stored(rows.mapInPandas(likelihoods, "id long, declared string, suffix string, host string, n long, ll array<double>"), "language-evidence")
    best = F.array_position("ll", F.array_max("ll")).cast("int") - 1
    seen = seen.withColumn("best", F.when(F.col("n") >= least_grams, best).otherwise(F.lit(k)))

    each = F.sequence(F.lit(0), F.lit(k - 1))
    told = seen.where(F.col("best") < k)

    def votes(*keys):
        """Texts that show each language, by key: one row a key, an array over the languages."""
        n = told.groupBy(*keys, "best").agg(F.count("*").cast("double").alias("n"))
        by_language = n.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("best", "n"))).alias("m"))
        return by_language.select(*keys, F.transform(each, lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0.0))).alias("v"))

    all_v = dict(told.groupBy("best").count().collect())
    overall = [float(all_v.get(i, 0)) + 1.0 / k for i in range(k)]
    share = F.array(*[F.lit(x / sum(overall)) for x in overall])
    of_all = F.array(*[F.lit(x) for x in overall])
    weak = declared_strength * 0.01

    def given(key):
        """log P(value | language) for each value."""
        v = votes(key).where(F.col(key).isNotNull())
        return stored(v.select(key, F.transform("v", lambda x, i: F.log((x + weak * F.get(share, i)) / (F.get(of_all, i) + weak))).alias(f"{key}_ll")), f"{key}-table")

    # Host prior, smoothed by the suffix's, smoothed by that of all rows.
    by_suffix = stored(votes("suffix").withColumnRenamed("v", "sv"), "suffix-votes")
    by_host = stored(votes("host", "suffix").withColumnRenamed("v", "hv"), "host-votes")
    zero = F.array_repeat(F.lit(0.0), k)
    e = seen.join(by_host.withColumnsRenamed({"host": "h", "suffix": "hs"}), F.col("host").eqNullSafe(F.col("h")) & F.col("suffix").eqNullSafe(F.col("hs")), "left")
    e = e.join(by_suffix.withColumnRenamed("suffix", "ss"), F.col("suffix").eqNullSafe(F.col("ss")), "left")
    e = e.join(given("declared"), "declared", "left").join(given("suffix"), "suffix", "left")

    def others(v):
        """The votes without the row's own."""
        return F.transform(F.coalesce(v, zero), lambda x, i: F.greatest(x - F.when(F.col("best") == i, 1.0).otherwise(0.0), F.lit(0.0)))

    e = e.withColumns({"sp": others("sv"), "hp": F.when(F.col("host").isNull(), zero).otherwise(others("hv"))})
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda x, y: x + y)
    e = e.withColumns({"sn": total("sp"), "hn": total("hp")})
    smooth = lambda v, p, n: F.zip_with(v, p, lambda x, y: (x + host_strength * y) / (F.col(n) + host_strength))
    e = e.withColumn("prior", smooth("hp", smooth("sp", share, "sn"), "hn"))
    part = lambda key, i: F.coalesce(F.get(f"{key}_ll", i), F.lit(0.0))
    scores = F.transform("prior", lambda x, i: F.get("ll", i) + F.log(x) + part("declared", i) + part("suffix", i))
    e = e.withColumn("scores", scores).withColumn("top", F.array_max("scores"))
    e = e.withColumn("mass", total(F.transform("scores", lambda x: F.exp(x - F.col("top")))))
    labels = F.array(*[F.lit(n) for n in names])
    at = F.array_position("scores", F.col("top")).cast("int")
    known = (F.col("n") >= least_grams) & (F.col("best") < k)
    return e.select(
        "id",
        F.when(known, labels[at - 1]).otherwise(UNKNOWN).alias("lang_detected"),
        (1 / F.col("mass")).alias("confidence"),
        F.when(F.col("best") < k, labels[F.col("best")]).otherwise(UNKNOWN).alias("text_lang"),
        F.col("n").alias("n_grams"),
        (known & (1 / F.col("mass") >= accept)).alias("accepted"),
    )


def of_documents(docs: DataFrame, **options) -> DataFrame:
    """Documents: the declared language is ``lang``, the host is ``source``; there is no address."""
    rows = docs.select(F.col("doc_id").alias("id"), "text", F.col("lang").alias("declared"), F.lit(None).cast("string").alias("suffix"), F.col("source").alias("host"))
    return identify(rows, **options).withColumnRenamed("id", "doc_id")


def of_pages(pages: DataFrame, **options) -> DataFrame:
    """Pages: text without markup, the lang attribute of html, host and its last label from the address."""
    html = whole("html")
    bare = F.regexp_replace(F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " "), r"<[^>]*>|&[#\w]+;", " ")
    host = F.nullif(F.regexp_extract(whole("url"), r"^[A-Za-z][\w+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1), F.lit(""))
    declared = F.regexp_extract(html, r"""(?i)<html\b[^>]*?\blang\s*=\s*["']?([\w-]+)""", 1)
    rows = pages.select(F.col("page_id").alias("id"), bare.alias("text"), declared.alias("declared"), F.substring_index(host, ".", -1).alias("suffix"), host.alias("host"))
    return identify(rows, **options).withColumnRenamed("id", "page_id")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = of_documents(table(spark, sf_dir, "documents"))
    return found.withColumnRenamed("accepted", "kept")


def pages_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return of_pages(table(spark, sf_dir, "pages"))


QUERIES = {"op1_language_id": op1_language_id, "pages_language": pages_language}
SQL: dict[str, str] = {}
