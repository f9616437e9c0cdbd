"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing columns."""

import hashlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lectern import session
from lectern.llm import embed, exact, jaccard, language, lines, lm, mixing, packing, toxicity, warc


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_exact(spark, odd_docs):
    out = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact.exact_dedup(odd_docs).collect()}
    assert (1, 2, 3, False) in out and (2, 2, 3, True) in out
    assert (3, 4, 2, False) in out and (4, 4, 2, True) in out
    assert (None, None, 1, True) in out
    assert exact.exact_dedup(odd_docs).count() == odd_docs.count()
    assert exact.exact_dedup(odd_docs.limit(0)).count() == 0


def test_exact_rows_of_one_id_with_unlike_tails(spark, tmp_path):
    head = "h" * 300
    docs = spark.createDataFrame([(1, head + "a"), (1, head + "b"), (2, head + "b"), (3, "x"), (3, "y")], "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    sha = {t: hashlib.sha256((head + t).encode()).hexdigest() for t in "ab"} | {t: hashlib.sha256(t.encode()).hexdigest() for t in "xy"}
    got = sorted(map(tuple, exact.op4_exact_dedup(spark, str(tmp_path)).collect()))
    assert got == sorted(
        [(1, 1, 1, True, sha["a"]), (1, 2, 2, False, sha["b"]), (2, 2, 2, True, sha["b"]), (3, 3, 1, True, sha["x"]), (3, 3, 1, True, sha["y"])]
    )


def test_archives_of_one_page_id_with_unlike_payloads(spark):
    pages = spark.createDataFrame([(6, "u", "AAA"), (6, "u", "BBB"), (7, "u", "AAA"), (8, "u", "BBB")], "page_id long, url string, html string")
    out = warc.read_records(warc.write_archives(pages, session.new_path(spark, "warc"))).collect()
    got = sorted((r.page_id, r.record_type, r.refers_to or 0, r.payload and bytes(r.payload).decode()) for r in out)
    assert got == [(6, "revisit", 7, None), (6, "revisit", 8, None), (7, "response", 0, "AAA"), (8, "response", 0, "BBB")]


def test_lines(spark):
    shared = "This line is shared by many documents."
    docs = spark.createDataFrame(
        [(1, f"{shared}\nown one"), (2, f"  {shared.upper()}\t\n{shared}"), (3, f"a\n{shared}\n{shared}\n"), (4, None), (5, ""), (5, ""), (None, shared)],
        "doc_id long, text string",
    )
    out = {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in lines.line_dedup(docs, buckets=3).collect()}
    assert out[1] == ("own one", 2, 1)
    assert out[2] == ("", 2, 2)
    assert out[3] == (f"a\n{shared}\n{shared}\n", 4, 0)
    assert out[4] == out[5] == ("", 1, 0)
    assert out[None] == ("", 1, 1)
    assert lines.line_dedup(docs.limit(0)).count() == 0


def test_lines_do_not_depend_on_batches(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = rows(lines.line_dedup(docs, batches=1))
    assert rows(lines.line_dedup(docs, batches=7, buckets=2)) == want


def test_jaccard(spark, odd_docs):
    out = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(odd_docs).collect()}
    assert out[1][1] == out[2][1] == 1
    assert out[3] == (0, 3) and out[4] == (0, 4) and out[5] == (0, 5)
    assert out[6][1] == out[7][1] == 6
    assert out[8] == (1, 8) and out[None][1] is None
    assert jaccard.jaccard_components(odd_docs.limit(0)).count() == 0


def test_packing(spark, odd_docs):
    out = packing.pack_documents(odd_docs).collect()
    assert sum(r.doc_id in (3, 4) and r.length == 1 for r in out) == 2
    assert packing.pack_documents(odd_docs.limit(0)).count() == 0


def test_mixing(spark, odd_docs):
    out = mixing.mix(odd_docs, levels=("lang", "source"))
    assert out.count() == odd_docs.count()
    assert mixing.mix(odd_docs.limit(0), levels=("lang", "source")).count() == 0
    full = mixing.mix(odd_docs, levels=("lang", "source"), fraction=1.0, epochs=1).where("n_tokens > 0")
    assert {r.copies for r in full.collect()} == {1}


def test_language(spark, odd_docs):
    out = {r.doc_id: r for r in language.of_documents(odd_docs).collect()}
    assert out[1].accepted and out[1].lang_detected == "en"
    for i in (3, 4, 5, 8):
        assert not out[i].accepted and out[i].lang_detected == "und"
    assert language.of_documents(odd_docs.limit(0)).count() == 0


def test_model(spark, odd_docs):
    out = lm.score_documents(odd_docs, sweeps=2, burn_in=1).collect()
    assert len(out) == odd_docs.count()
    assert {r.n_tokens for r in out if r.doc_id in (3, 4, 5)} == {1}
    assert all(r.score < 0 and r.base_score < 0 for r in out)
    assert lm.score_documents(odd_docs.limit(0), sweeps=2, burn_in=1).count() == 0


def test_toxicity(spark, odd_docs):
    labels = spark.createDataFrame([(1, 1), (2, None), (3, 0), (None, 1), (6, 0), (6, 1)], "doc_id long, toxic int")
    out = toxicity.toxicity(odd_docs, labels).collect()
    assert len(out) == odd_docs.count() and all(0 <= r.score <= 1 for r in out)
    assert toxicity.toxicity(odd_docs.limit(0), labels.limit(0)).count() == 0
    assert {r.score for r in toxicity.toxicity(odd_docs, labels.limit(0)).collect()} == {0.5}


def test_archives(spark):
    big = "ä<p>" * 300_000
    pages = spark.createDataFrame(
        [(1, "http://a/\r\nx", "<p>x", 1), (2, None, "<p>x", 2), (3, "u", None, 3), (4, "u", "", 4), (5, "u", big, 5), (None, "u", "<p>x", 6), (6, "u", "<p>y", 7), (6, "u", "<p>y", 7)],
        "page_id long, url string, html string, digest long",
    )
    out = warc.read_records(warc.write_archives(pages, session.new_path(spark, "warc"), roll_bytes=500), span=1000).collect()
    by = {}
    for r in out:
        by.setdefault(r.page_id, []).append(r)
    assert by[1][0].record_type == "revisit" and by[1][0].refers_to == 2 and by[2][0].record_type == "response"
    assert by[3][0].refers_to == 4 and by[3][0].payload_bytes == 0
    assert bytes(by[5][0].payload).decode() == big
    assert by[None][0].record_type == "response" and len(by[6]) == 2 and {r.record_type for r in by[6]} == {"response"}
    assert warc.write_archives(pages.limit(0), session.new_path(spark, "warc")).count() == 0
    some = warc.write_archives(pages, session.new_path(spark, "warc"), min_bytes=1)
    assert {r.record_type for r in some.where("page_id in (3, 4)").collect()} == {"response"}
    only = warc.read_records(some, F.col("page_id") == 5).collect()
    assert len(only) == 1 and hashlib.sha1(bytes(only[0].payload)).hexdigest() == hashlib.sha1(big.encode()).hexdigest()


def test_vectors(spark):
    nan, inf = float("nan"), float("inf")
    v = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 0.1]), (4, None), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [1.0, None]), (8, []), (9, [inf, 1.0]), (10, [1.0, 0.0, 0.0]), (11, [0.0, 1.0]), (1, [1.0, 0.0])]
    df = spark.createDataFrame([(*r, 0, 1) for r in v], "vec_id long, embedding array<float>, label int, dim int")
    out = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embed.near_vectors(df).collect()}
    assert out[1] == (3, 1, True) and out[2] == (3, 1, False) and out[3][1] == 1
    assert all(out[i] == (0, i, True) for i in (4, 5, 6, 7, 8, 9, 10, 11))
    assert embed.near_vectors(df.limit(0)).count() == 0


@pytest.mark.parametrize("stage", range(5))
def test_stages(spark, odd_docs, stage):
    name, fn = corpus_pipeline.STAGES[stage]
    out = fn(spark, odd_docs, "")
    if stage < 4:
        assert out.columns == odd_docs.columns
        ids = sorted(str(r.doc_id) for r in out.collect())
        if name == "language_id":
            assert ids == sorted(["1", "2", "2", "6", "7", "None", "9"])
        if name == "exact_dedup":
            assert ids == sorted(["2", "4", "5", "6", "7", "8", "None", "9"])
        if name == "ngram_jaccard":
            assert {"1", "6"} <= set(ids) and not {"2", "7"} & set(ids)
    assert fn(spark, odd_docs.limit(0), "").count() == 0
