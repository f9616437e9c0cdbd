"""Language identification against a plain-Python fusion, and with languages that only the input names."""

import math
import random
import re
from collections import Counter

import corpus_pipeline
from lectern.llm import language

D = "/root/testdata/sf0.001"
GREEK = "η γρήγορη αλεπού πηδά πάνω από το τεμπέλικο σκυλί και τρέχει μακριά από τον μεγάλο λύκο του δάσους"
POLISH = "szybki brązowy lis przeskakuje nad leniwym psem i ucieka daleko od wielkiego złego wilka z lasu"


def _fuse(rows):
    """rows (id, text, declared, suffix, host) -> {id: (language, confidence)}, with dictionaries only."""
    names = sorted({r[2] for r in rows if r[2] and r[1]})
    grams = [language.grams(r[1] or "").tolist() for r in rows]
    counts = {n: Counter() for n in names}
    for r, g in zip(rows, grams, strict=True):
        if r[2] in counts:
            counts[r[2]].update(g)
    size = {n: sum(c.values()) for n, c in counts.items()}
    lik, best = [], []
    for g in grams:
        ll = [0.05 * sum(math.log(0.99 * counts[n][x] / size[n] + 0.01 / 65536) for x in g) for n in names]
        noise = 0.05 * len(g) * -math.log(65536)
        lik.append(ll)
        best.append(names[ll.index(max(ll))] if len(g) >= 3 and max(ll) >= noise else None)
    k = len(names)
    overall = Counter({n: 1 / k for n in names})
    tables = {key: {} for key in ("declared", "suffix", "host")}
    for r, b in zip(rows, best, strict=True):
        if b:
            overall[b] += 1
            for key, value in (("declared", r[2]), ("suffix", r[3]), ("host", (r[4], r[3]))):
                tables[key].setdefault(value, Counter())[b] += 1
    share = {n: overall[n] / sum(overall.values()) for n in names}
    out = {}
    for r, g, ll, b in zip(rows, grams, lik, best, strict=True):
        if not b:
            out[r[0]] = ("und", None)
            continue
        own = Counter({b: 1})
        s = Counter(tables["suffix"].get(r[3], {}))
        s.subtract(own)
        h = Counter(tables["host"].get((r[4], r[3]), {}) if r[4] else {})
        if r[4]:
            h.subtract(own)
        scores = []
        for n, x in zip(names, ll, strict=True):
            by_suffix = (s[n] + 20 * share[n]) / (sum(s.values()) + 20)
            x += math.log((h[n] + 20 * by_suffix) / (sum(h.values()) + 20))
            for key, value in (("declared", r[2]), ("suffix", r[3])):
                if value is not None and value in tables[key]:
                    x += math.log((tables[key][value][n] + 0.05 * share[n]) / (overall[n] + 0.05))
            scores.append(x)
        top = max(scores)
        out[r[0]] = (names[scores.index(top)], 1 / sum(math.exp(x - top) for x in scores))
    return out


def _same(got, want, key):
    assert len(got) == len(want)
    for r in got:
        name, confidence = want[r[key]]
        assert r.lang_detected == name
        assert confidence is None or abs(r.confidence - confidence) < 1e-4


def test_documents_equal_a_plain_fusion(spark):
    docs = spark.read.parquet(f"{D}/documents.parquet")
    rows = [(r.doc_id, r.text, r.lang, None, r.source) for r in docs.collect()]
    _same(language.of_documents(docs).collect(), _fuse(rows), "doc_id")


def test_pages_equal_a_plain_fusion(spark):
    pages = spark.read.parquet(f"{D}/pages.parquet")
    rows = []
    for r in pages.collect():
        html = r.html or ""
        bare = re.sub(r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ", html)
        bare = re.sub(r"<[^>]*>|&[#\w]+;", " ", bare)
        told = re.search(r"""(?i)<html\b[^>]*?\blang\s*=\s*["']?([\w-]+)""", html)
        host = re.match(r"[A-Za-z][\w+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", r.url or "")
        host = host[1].lower() if host else None
        rows.append((r.page_id, bare, told and told[1][:2].lower(), host and host.split(".")[-1], host))
    _same(language.of_pages(pages).collect(), _fuse(rows), "page_id")


def _with_others(spark):
    docs = spark.read.parquet(f"{D}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    made = [(10_000 + i, f"{GREEK} {GREEK[i:]}", "el", "src0", 1) for i in range(40)]
    made += [(20_000 + i, f"{POLISH[i:]} {POLISH}", ["pl", "zxx", "PL-pl"][i % 3], "src1", 1) for i in range(9)]
    letters = random.Random(3)
    made += [(30_000, " ".join("".join(letters.choices("bcdfghjklmnpqrstvwxyz", k=6)) for _ in range(100)), "en", "src0", 1)]
    return docs.unionByName(spark.createDataFrame(made, docs.schema))


def test_a_language_that_only_the_input_names(spark):
    out = {r.doc_id: r for r in language.of_documents(_with_others(spark)).collect()}
    assert {(out[10_000 + i].lang_detected, out[10_000 + i].accepted) for i in range(40)} == {("el", True)}
    assert {out[20_000 + i].lang_detected for i in range(9)} <= {"pl", "mis"} and all(out[20_000 + i].accepted for i in range(9))
    assert not out[30_000].accepted


def test_rare_languages_share_a_model(spark):
    rows = language.base_language
    docs = _with_others(spark)
    found = docs.select("text", rows(docs["lang"]).alias("declared"))
    names = language.declared_languages(found, listed=20)
    assert names[-1] == language.POOLED and set(names[:-1]) <= {"de", "en", "es", "fr"}
    assert language.declared_languages(found.limit(0)) == [language.POOLED]


def test_the_pipeline_keeps_a_fifth_language(spark):
    docs = _with_others(spark)
    kept = {r.doc_id for r in corpus_pipeline.identify_language(spark, docs, D).select("doc_id").collect()}
    assert {10_000 + i for i in range(40)} | {20_000 + i for i in range(9)} <= kept and 30_000 not in kept
