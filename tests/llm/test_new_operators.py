"""Token alignment, word runs and benchmark passages against plain versions of their rules."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from lectern.llm import align, decontaminate, runs
from lectern.llm import queries as Q
from tests.llm.conftest import LONG, TEXT

D = "/root/testdata/sf0.001"


def documents(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{D}/documents.parquet").collect()]


# --- token alignment --------------------------------------------------------


def plain_alignment(rows):
    """Whole texts through the tokenizers' own libraries, ends compared one by one."""
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    letters = align._byte_alphabet()
    found, counts = [], Counter()
    for doc_id, text in rows:
        groups = []
        if text:
            want = b" " + text.encode()
            ids_a = a.encode(" " + text, add_special_tokens=False).ids
            ids_b = b.encode(text)
            side_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
            side_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i in ids_b for p in [b.id_to_piece(i)]]
            if b"".join(side_a) == want and b"".join(side_b) == want:
                ends = []
                for ids, side in ((ids_a, side_a), (ids_b, side_b)):
                    at, out = 0, {}
                    for i, t in zip(ids, side):
                        at += len(t)
                        out[at] = i
                    ends.append(out)
                both = sorted(set(ends[0]) & set(ends[1]))
                at_a, at_b = iter(ends[0].items()), iter(ends[1].items())
                for e in both:
                    sides = []
                    for it in (at_a, at_b):
                        ids = []
                        for at, i in it:
                            ids.append(i)
                            if at == e:
                                break
                        sides.append(ids)
                    groups.append(tuple(sides))
        counts.update((g[0][-1], g[1][-1]) for g in groups)
        found.append((doc_id, groups))
    top = defaultdict(int)
    for (_, y), n in counts.items():
        top[y] = max(top[y], n)
    out = []
    for doc_id, groups in found:
        links = [(g[0][-1], g[1][-1]) for g in groups]
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        out.append(
            (
                doc_id,
                sum(len(g[0]) for g in groups),
                sum(len(g[1]) for g in groups),
                len(groups),
                len(links),
                sum(counts[x] == top[x[1]] for x in links),
                sum(counts[x] for x in links),
                hashlib.sha256(text.encode()).hexdigest() if groups else "",
            )
        )
    return out


NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD_TEXTS = [
    "a  b", " a", "a ", "  ", "\n", "a\n\nb", "a \n b", "a\n b", "x▁y z", "plain x▁y", "\x00 a", "<s> </s> <|endoftext|> a<|endoftext|>",
    " a   b", "　 x", "é ﬁ \U0001f600\U0001f469‍\U0001f680 don't we'LL", "12 345 6789", "a  b ​ c", "﻿a ﻿", "tab\tand \t tab", "",
]


def test_alignment_of_the_table(spark):
    rows = documents(spark)
    got = Q.QUERIES["op11_token_alignment"](spark, D)
    assert sorted(map(tuple, got.select(*NAMES).collect())) == sorted(plain_alignment(rows))


def test_alignment_of_odd_texts(spark, odd_docs):
    rows = [(i, t) for i, t in enumerate(ODD_TEXTS)] + [(100, None), (101, TEXT), (101, TEXT), (102, LONG), (102, TEXT)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = align.align_tokenizers(docs).withColumn("groups_sha256", F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise(""))
    got = sorted(map(tuple, out.select(*NAMES).collect()))
    assert got == sorted(plain_alignment(rows))
    assert align.align_tokenizers(odd_docs).count() == odd_docs.count()
    assert align.align_tokenizers(odd_docs.limit(0)).count() == 0


def test_alignment_does_not_depend_on_slices(spark, monkeypatch):
    docs = spark.read.parquet(f"{D}/documents.parquet").limit(40)
    want = sorted(map(tuple, align.align_tokenizers(docs).collect()))
    monkeypatch.setattr(align, "SLICE_BYTES", 1)
    assert sorted(map(tuple, align.align_tokenizers(docs).collect())) == want


# --- periodic runs ----------------------------------------------------------


def least_period(words):
    fail = [0] * (len(words) + 1)
    k = 0
    for i in range(1, len(words)):
        while k and words[i] != words[k]:
            k = fail[k]
        k += words[i] == words[k]
        fail[i + 1] = k
    return len(words) - fail[len(words)]


def plain_runs(words, least=24, times=3):
    """Every period tried: stretches of equal words so far apart, kept where the period is the least one."""
    n, found = len(words), []
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(least, times * q) and least_period(words[i : i + length]) == q:
                found.append((i, length, q))
            i = max(j, i) + 1
    return sorted(set(found))


def planted(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def run_row(doc_id, words, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    best = None
    for r in found:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(found), *top, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_runs_of_the_table(spark):
    want = []
    for doc_id, text in documents(spark):
        words = planted(doc_id, text)
        want.append(run_row(doc_id, words, plain_runs(words)))
    assert any(r[1] for r in want)
    got = [tuple(r) for r in Q.QUERIES["op12_periodic_runs"](spark, D).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


@pytest.mark.parametrize("seed", range(60))
def test_runs_of_random_words(seed):
    rnd = random.Random(seed)
    words = []
    while len(words) < rnd.randint(1, 160):
        block = [rnd.choice("abc"[: rnd.randint(1, 3)]) for _ in range(rnd.randint(1, 12))]
        words += block * rnd.randint(1, 9)
        words = words + words[-rnd.randint(1, 40) :] if rnd.random() < 0.4 else words
    for least, times in ((24, 3), (4, 2), (6, 3), (1, 2)):
        assert runs.word_runs(words, least, times) == plain_runs(words, least, times)


def test_runs_of_long_repeats_take_little_time():
    assert runs.word_runs(["a"] * 100_000) == [(0, 100_000, 1)]
    assert runs.word_runs((["x"] + ["a", "b"] * 20) * 500) != []
    mixed = []
    for i in range(400):
        mixed += [f"w{i}", *(["t"] * 30)]
    assert len(runs.word_runs(mixed)) == 400


def test_runs_of_odd_texts(spark, odd_docs):
    out = {}
    for r in runs.periodic_runs(odd_docs).collect():
        out.setdefault(r.doc_id, []).append(r)
    assert len(out[2]) == 2 and len(out) == 10
    for i in (3, 4, 5):
        assert (out[i][0].n_words, out[i][0].runs, out[i][0].collapsed) == (0, [], "")
    assert out[6][0].collapsed == " ".join(LONG.split())
    some = spark.createDataFrame([(1, "x " + "a b " * 12 + "z"), (1, None), (None, "a " * 24), (2, "a " * 23)], "doc_id long, text string")
    got = sorted(((r.doc_id, [tuple(x) for x in r.runs], r.collapsed) for r in runs.periodic_runs(some).collect()), key=str)
    assert got == sorted([(1, [(1, 24, 2)], "x a b z"), (1, [], ""), (None, [(0, 24, 1)], "a"), (2, [], "a " * 22 + "a")], key=str)
    assert runs.periodic_runs(odd_docs.limit(0)).count() == 0
    assert runs.with_planted_runs(odd_docs.limit(0)).count() == 0


def test_planted_runs(spark, odd_docs):
    rows = [(i, TEXT if i % 3 else LONG[:5000] + "  x\t") for i in range(80)] + [(None, TEXT), (12, None), (28, " \n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, (r.text or "").split()) for r in runs.with_planted_runs(docs).collect()), key=str)
    assert got == sorted(((i, [w.decode() for w in planted(i, t)]) for i, t in rows), key=str)


# --- benchmark passages -----------------------------------------------------

ITEMS = [
    (1, "one two three four five six seven eight nine ten eleven twelve"),
    (2, "Short ITEM, here"),
    (3, "lone"),
    (4, None),
    (5, " .,; "),
    (None, "nameless words that nobody lists in any table of benchmark items"),
    (6, "two three four five six seven eight nine ten eleven"),
    (6, "é É ü 9 x y z a b c d"),
    (10, "to to to to to to to to to to to"),
]
TEXTS = [
    (1, "zero ONE two-three four five six seven eight nine ten eleven twelve thirteen"),
    (2, "two three four five six seven eight nine ten eleven"),
    (3, "one two three four five six seven eight nine nine ten"),
    (4, "a short item here and a lone wolf"),
    (4, "alone, loner"),
    (5, None),
    (6, ""),
    (7, "é É ü 9 x y z a b c d, é É ü 9 x y z a b c é é Ü 9 x y z a b c"),
    (8, "x nameless words that nobody lists in any table of benchmark items"),
    (None, "lone"),
    (9, "to " * 25),
    (9, "to " * 25),
    (11, "short item"),
]


@pytest.mark.parametrize("most", [0, 1 << 30])
@pytest.mark.parametrize("width", [1, 3, 12])
def test_passages_of_odd_rows(spark, most, width):
    docs = spark.createDataFrame([(*r, 1, 2, "a", 3, 4) for r in TEXTS], "doc_id long, text string, item_id int, words int, w string, n int, at int")
    items = spark.createDataFrame([(*r, 1, 2, 3) for r in ITEMS], "item_id long, text string, doc_id int, shingle int, size int")
    got = decontaminate.decontaminate(docs, items, width=width, broadcast_bytes=most)
    got = [(r.doc_id, r.n_words, r.n_hit, ",".join(r.items), r.contaminated) for r in got.collect()]
    con = duckdb.connect()
    for name, kind, rows in (("documents", "doc_id", TEXTS), ("benchmark", "item_id", ITEMS)):
        con.execute(f"CREATE TABLE {name} ({kind} BIGINT, text VARCHAR)")
        con.executemany(f"INSERT INTO {name} VALUES (?, ?)", rows)
    sql = decontaminate.SQL["op13_decontamination"].replace("sha256(coalesce(items, ''))", "coalesce(items, '')")
    want = [(r[0], r[1], r[2], r[4], r[5]) for r in con.execute(sql).fetchall()]
    assert sorted(got, key=str) == sorted(want, key=str)
    by = {(r[0], r[1]): r for r in got}
    assert by[(1, 14)][2:4] == (12, "1,6") and by[(8, 12)][2:] == (11, "", True) and by[(9, 25)][2] == 25


def test_passages_by_shuffles_agree(spark):
    docs, items = (spark.read.parquet(f"{D}/{t}.parquet") for t in ("documents", "benchmark"))
    one = sorted(map(str, decontaminate.decontaminate(docs, items).collect()))
    assert sorted(map(str, decontaminate.decontaminate(docs, items, broadcast_bytes=0).collect())) == one


def test_passages_without_rows(spark, odd_docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    for most in (0, 1 << 30):
        assert decontaminate.decontaminate(odd_docs.limit(0), items, broadcast_bytes=most).count() == 0
        out = decontaminate.decontaminate(odd_docs, items.limit(0), broadcast_bytes=most).collect()
        assert len(out) == odd_docs.count() and not any(r.contaminated or r.items for r in out)
