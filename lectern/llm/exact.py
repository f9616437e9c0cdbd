"""Exact duplicates by progressive refinement."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.common import stored, table, whole


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", head_chars: int = 256) -> DataFrame:
    """Group equal texts; the largest id of each group stays.

    Three refinements: byte length, then a hash of the first ``head_chars``
    characters within a length, then SHA-256 of the whole text, which is taken
    only for rows whose length and head occur more than once. The first two use
    a narrow table, so hot lengths and heads move a few bytes a row; counts
    combine before each shuffle. Whole texts of the survivors are found by a
    semi-join on the id, which is even however large a group of copies is.

    Returns one row per input row: the id, ``n_bytes``, ``head``, ``keep_id``,
    ``group_size``, ``kept``, ``digest`` (SHA-256 in lowercase hex; null where
    length and head alone tell the text from all others). Null and empty texts are equal. A null id counts
    as the smallest; a group of null ids only keeps them all. Rows that repeat
    both id and text share their fate and count separately in ``group_size``.
    Other columns are ignored. No rows give no rows.
    """
    text = whole(text_col)
    head = F.xxhash64(F.substring(text, 1, head_chars))
    keyed = docs.select(F.col(id_col).alias("id"), text.alias("text")).select(
        "id", "text", F.octet_length("text").alias("n_bytes"), F.xxhash64(F.substring("text", 1, head_chars)).alias("head")
    )
    light = stored(docs.select(F.col(id_col).alias("id"), F.octet_length(text).alias("n_bytes"), head.alias("head")), "lengths")

    many = F.col("n") > 1
    lengths = stored(light.groupBy("n_bytes").agg(F.count("*").alias("n")).where(many).select("n_bytes"), "repeated-lengths")
    in_length = light.join(lengths, "n_bytes", "left_semi")
    heads = stored(in_length.groupBy("n_bytes", "head").agg(F.count("*").alias("n")).where(many).select("n_bytes", "head"), "repeated-heads")
    left = stored(light.join(heads, ["n_bytes", "head"], "left_semi").select("id").distinct(), "survivors")

    survivors = keyed.join(left, keyed["id"].eqNullSafe(left["id"]), "left_semi")
    full = stored(survivors.select("id", "n_bytes", "head", F.unhex(F.sha2("text", 256)).alias("digest")), "full-hashes")
    groups = stored(full.groupBy("n_bytes", "digest").agg(F.max("id").alias("keep_id"), F.count("*").alias("group_size")), "groups")
    repeated = full.join(groups, ["n_bytes", "digest"]).select(
        "id", "n_bytes", "head", "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("digest")).alias("digest")
    )
    alone = light.join(left, light["id"].eqNullSafe(left["id"]), "left_anti").select(
        "id", "n_bytes", "head", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), F.lit(None).cast("string").alias("digest")
    )
    return repeated.unionByName(alone).withColumnRenamed("id", id_col)


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = stored(exact_dedup(docs), "exact")
    text = whole("text")
    # Only rows without a digest yet look theirs up; no other row has their length and head.
    digests = docs.select(
        F.col("doc_id").alias("id"), F.octet_length(text).alias("b"), F.xxhash64(F.substring(text, 1, 256)).alias("h"), F.sha2(text, 256).alias("text_sha256")
    )
    bare = found.where("digest IS NULL")
    same = bare["doc_id"].eqNullSafe(digests["id"]) & (bare["n_bytes"] == digests["b"]) & (bare["head"] == digests["h"])
    cols = ["doc_id", "keep_id", "group_size", "kept"]
    return bare.join(digests, same).select(*cols, "text_sha256").unionByName(
        found.where("digest IS NOT NULL").select(*cols, F.col("digest").alias("text_sha256"))
    )


SQL = {
    "op4_exact_dedup": """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))"""
}
QUERIES = {"op4_exact_dedup": op4_exact_dedup}
