"""The training-corpus pipeline: five stages over documents, each an operator of lectern.llm.

Every stage works on all rows its predecessor kept and, but for the last,
returns the columns of documents. Decisions are narrow tables of ids, written
before the texts meet them, so Spark broadcasts them only where they are small.
Ids name documents: rows that share an id share its fate, null counts as an id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm import exact, jaccard, language, mixing, packing
from lectern.llm.common import bounded_batches, stored


def _split(docs: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """Rows of docs whose id is (left_semi) or is not (left_anti) among ``ids``.

    Ids whose number follows the input are asked for with a merge hint by the
    caller, so that the plan is the same at every size.
    """
    ids = ids.select(F.col("doc_id").alias("_id"))
    return docs.join(ids, docs["doc_id"].eqNullSafe(ids["_id"]), how)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language cannot be told go: no letters, or noise like no language."""
    found = language.of_documents(docs)
    out = found.groupBy("doc_id").agg(F.bool_or("accepted").alias("ok")).where("NOT ok")
    return _split(docs, stored(out, "rejected-ids"), "left_anti")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the largest id stays; rows that repeat id and text become one."""
    found = stored(exact.exact_dedup(docs).select("doc_id", "kept"), "exact-groups")
    gone = stored(found.groupBy("doc_id").agg(F.bool_or("kept").alias("ok")).where("NOT ok"), "copy-ids")
    repeats = stored(found.where("kept").groupBy("doc_id").count().where("count > 1"), "repeated-ids")
    left = _split(docs, gone, "left_anti")
    return _split(left, repeats, "left_anti").unionByName(_split(left, repeats, "left_semi").dropDuplicates(["doc_id", "text"]))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents connected by a Jaccard similarity of 0.8 or more on five-word shingles the smallest id stays."""
    found = jaccard.jaccard_components(docs, k=5, percent=80)
    gone = stored(found.where("doc_id <> component_id").select("doc_id").distinct(), "near-ids")
    return _split(docs, gone.hint("merge"), "left_anti")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The part of each source that its weight asks for, taken at most once."""
    taken = mixing.mix(docs.withColumn("domain", mixing.domain()), weights=mixing.WEIGHTS, fraction=0.8, epochs=1)
    ids = stored(taken.where("copies > 0").select("doc_id").distinct(), "mixed-ids")
    return _split(docs, ids.hint("merge"), "left_semi")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences of at most 4096 tokens."""
    return packing.pack_documents(docs)


def _ready(stage):
    def run(spark, docs, sf_dir):
        return stage(bounded_batches(spark), docs, sf_dir)

    run.__name__ = stage.__name__
    return run


STAGES = [
    ("language_id", _ready(identify_language)),
    ("exact_dedup", _ready(drop_copies)),
    ("ngram_jaccard", _ready(drop_near_copies)),
    ("source_mixing", _ready(mix_sources)),
    ("best_fit_packing", _ready(pack)),
]

#: Training models and token ids are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
