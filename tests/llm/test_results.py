"""Operators against brute force, round trips and held-out accuracy."""

import tracemalloc
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lectern import session
from lectern.llm import embed, jaccard, language, lm, mixing, packing, queries, toxicity
from lectern.llm.shingles import shingle_set, split_words
from lectern.llm.tokens import WordEncoder, default_path

D = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{D}/documents.parquet")


def joined(pairs, ids):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize(("k", "percent", "matches", "chunk"), [(5, 80, 4, 256), (2, 30, 3, 256), (1, 50, 1, 256), (3, 95, 4, 256), (2, 30, 3, 2), (1, 50, 1, 3), (5, 80, 4, 1)])
def test_join_finds_every_link(spark, k, percent, matches, chunk):
    rng = np.random.default_rng(k)
    words = [f"w{i}" for i in range(60)]
    texts = []
    for i in range(150):
        if i % 3 and texts:
            t = texts[rng.integers(len(texts))].split()
            for _ in range(rng.integers(0, 4)):
                t[rng.integers(len(t))] = words[rng.integers(60)]
        else:
            t = [words[j] for j in rng.integers(0, 60, rng.integers(1, 60))]
        texts.append(" ".join(t))
    sets = {i: set(shingle_set(t, k).tolist()) for i, t in enumerate(texts)}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    want = joined(links, sets)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(df, k, percent, matches, chunk).collect()}
    assert got == {i: (len(s), want[i]) for i, s in sets.items()}


@pytest.mark.parametrize(("blocks", "tile"), [(1, 50), (4, 64), (7, 1000)])
def test_vectors_find_every_link(spark, blocks, tile):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(60, 24))
    x = np.concatenate([base, base[rng.integers(0, 60, 140)] + rng.normal(size=(140, 24)) * rng.uniform(0, 0.6, (140, 1))]).astype("f4")
    u = x.astype("f8") / np.linalg.norm(x.astype("f8"), axis=1, keepdims=True)
    links = [(a, b) for a in range(200) for b in range(a) if u[a] @ u[b] >= 0.9]
    n = np.bincount(np.array(links).ravel(), minlength=200)
    want = joined(links, range(200))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embed.near_vectors(df, blocks=blocks, tile=tile).collect()}
    assert got == {i: (n[i], want[i]) for i in range(200)}


def test_tiles_are_narrow_and_lose_no_pair():
    """A tile of 8,000 vectors is worked in pieces of 1 MB, not of 100; pairs at the very bound are kept by the products in single precision."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(8000, 16))
    x[4000:4200] = x[:200] + 1e-3 * rng.normal(size=(200, 16))
    plan = embed.Blocks(np.eye(16), np.full(16, 1 / 16), 4, 0.9)
    frame = pd.DataFrame({"id": np.arange(8000), "many": 1, "left": True, "raw": [v.tobytes() for v in x]})
    tracemalloc.start()
    found = [embed._tile(frame, b, True, plan, 16, 0.9) for b in range(4)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40e6
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = ((u @ u.T) >= 0.9).sum(axis=1) - 1
    assert (pd.concat(found).groupby("id")["links"].sum().reindex(np.arange(8000), fill_value=0).to_numpy() == want).all()
    for limit in (0.2, 1e-2, 1e-4, 1e-7):
        p = rng.normal(size=(2000, 16))
        p /= 2 * np.linalg.norm(p, axis=1, keepdims=True)
        q = rng.normal(size=(2000, 16))
        q = p + q * np.sqrt(limit) / np.linalg.norm(q, axis=1, keepdims=True)
        a, z, bound = embed._within(np.vstack([p, q]), limit * (1 + embed.SLACK))
        near = (a[:2000, None, :] @ z[2000:, :, None]).ravel() <= a.dtype.type(bound)
        assert near.all() and bound < 1.02 * limit + 1e-8


def test_pieces_have_the_tokenizer_ids(spark, docs):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(default_path())
    odd = ["a\x0bb\x1cc d e", "It's <|endoftext|> éÉ İ Σσ don't we'll", "x̸ ̸y", "\r\n", "1234 你好\U0001f600!?"]
    for text in [r.text for r in docs.collect()] + odd:
        want = b"".join(i.to_bytes(4, "little") for i in t.encode(text, add_special_tokens=False).ids)
        assert WordEncoder().encode(text) == want
        break
    enc = WordEncoder(max_words=50)
    for text in odd + [r.text for r in docs.limit(60).collect()]:
        assert enc.encode(text) == b"".join(i.to_bytes(4, "little") for i in t.encode(text, add_special_tokens=False).ids), text[:80]
    assert zlib.crc32(enc.encode("")) == 0


@pytest.mark.parametrize("block", [40, 20_000])
def test_packing_is_whole_and_tight(spark, docs, block):
    cut = packing.pieces(docs, 4096)
    want = {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in cut.collect()}
    out = packing.best_fit(cut.where("length < 4096"), 4096, block).collect()
    assert {tuple(r)[:5] for r in out} == {x for x in want if x[3] < 4096} and len(out) == len({tuple(r)[:2] for r in out})
    seqs = {}
    for r in out:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in seqs.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 4096
    total = sum(r.length for r in out)
    assert len(seqs) <= -(-total // 4096) + 1 + len(seqs) // 20


def test_local_search_empties_bins():
    bins = [[60, [(60, "a")]], [70, [(40, "b"), (30, "c")]], [55, [(30, "d"), (25, "e")]], [15, [(15, "f")]]]
    out = packing._improve([list(b) for b in bins], 100)
    assert sorted(x for b in out for x in b[1]) == sorted(x for b in bins for x in b[1])
    assert len(out) < 4 and all(b[0] == sum(x[0] for x in b[1]) <= 100 for b in out)


def test_mixing_meets_the_budgets(spark, docs):
    rows = docs.withColumn("domain", mixing.domain())
    out = mixing.mix(rows, weights=mixing.WEIGHTS, slices=8).collect()
    count = {r.doc_id: len(r.text.split()) for r in docs.collect()}
    assert all(r.n_tokens == count[r.doc_id] for r in out)

    def fill(given, children):
        """children: {name: (weight, room)}; deal in turns until nothing is left."""
        got, open_ = dict.fromkeys(children, 0.0), {k for k, (w, room) in children.items() if w > 0 and room > 0}
        while open_ and given > 1e-9:
            total = sum(children[k][0] for k in open_)
            step = min([given] + [(children[k][1] - got[k]) / children[k][0] * total for k in open_])
            for k in open_:
                got[k] += step * children[k][0] / total
            given -= step
            open_ = {k for k in open_ if children[k][1] - got[k] > 1e-9}
        return got

    leaves = {}
    for r in out:
        leaves.setdefault((r.domain, r.lang, r.source), []).append(r)
    room = {k: 2.0 * sum(r.n_tokens for r in v) for k, v in leaves.items()}

    def deal(prefix, given):
        depth = len(prefix)
        if depth == 3:
            return {prefix: given}
        names = {k[: depth + 1] for k in room if k[:depth] == prefix}
        kids = {k: (mixing.WEIGHTS.get(k, 1.0), sum(v for q, v in room.items() if q[: depth + 1] == k)) for k in names}
        return {q: v for k, g in fill(given, kids).items() for q, v in deal(k, g).items()}

    budgets = deal((), 0.5 * sum(room.values()) / 2)
    for k, v in leaves.items():
        taken, largest = sum(r.n_tokens * r.copies for r in v), max(r.n_tokens for r in v)
        assert budgets[k] - 1e-6 <= taken <= budgets[k] + largest, k
        assert len({r.copies for r in v}) <= 2


def test_model_is_a_distribution_and_beats_the_base(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = docs.select("doc_id", F.col("text"), lm.held_out("doc_id", 5).alias("held_out"))
    model = lm.PitmanYor(rows.where("NOT held_out"), frequent=200, sweeps=3, burn_in=1)
    assert np.allclose(model.symbol_probability.sum(axis=1), 1)
    spelled = model.rare_words.agg(F.sum("p")).first()[0] + model.unknown
    assert abs(spelled - 1) < 1e-6
    out = model.score(rows).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert out[0] > out[1]
    words = {}
    train = [r for r in rows.collect() if not r.held_out]
    for r in train:
        for w in r.text.encode().lower().split():
            words[w] = words.get(w, 0) + 1
    n, v = sum(words.values()) + len(train), len(words) + 1
    got = {r.doc_id: r for r in model.score(rows).collect()}
    for r in rows.limit(40).collect():
        c = [words.get(w, 0) for w in r.text.encode().lower().split()] + [len(train)]
        want = sum(np.log10((x + 0.5) / (n + 0.5 * (v + 1))) for x in c)
        assert got[r.doc_id].n_tokens == len(c) and got[r.doc_id].n_known == sum(x > 0 for x in c)
        assert abs(got[r.doc_id].base_score - want) < 1e-6


def test_seating_follows_the_odds():
    rng = np.random.default_rng(0)
    c = np.full(4000, 6)
    t = lm.seat(c, np.full(4000, 0.3), 10.0, 1.0, 0.5, rng)
    fresh, want = (1 + 0.5 * 10) * 0.3, {1: 1.0}
    for n in range(1, 6):
        new = {}
        for k, p in want.items():
            odds = fresh / (fresh + n - 0.5 * k)
            new[k + 1], new[k] = new.get(k + 1, 0) + p * odds, new.get(k, 0) + p * (1 - odds)
        want = new
    assert abs(t.mean() - sum(k * p for k, p in want.items())) < 0.05


def test_languages_are_right(spark, docs):
    out = language.of_documents(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r.lang_detected == r.lang for r in out) >= 0.97 * len(out)
    assert sum(r.accepted for r in out) >= 0.99 * len(out)


def test_pages_use_markup_and_host(spark):
    text = "<html lang='fr-CA'><p>la le de</p></html>"
    rows = [(i, f"http://h{i % 2}.example.fr/x", text if i % 2 else "<html><p>the of and to</p>") for i in range(40)] + [(99, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = language.of_pages(pages, languages=("en", "fr")).collect()
    assert len(out) == 41 and {r.lang_detected for r in out if r.page_id == 1} == {"fr"}
    assert [r.accepted for r in out if r.page_id == 99] == [False]


def test_toxicity_on_held_out_rows(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    out = toxicity.toxicity(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    bad, good = out[out.toxic == 1], out[out.toxic == 0]
    rank = (good.score.to_numpy()[None, :] < bad.score.to_numpy()[:, None]).mean()
    assert rank > 0.95 and good.predicted.mean() < 0.02


@pytest.mark.parametrize(("term", "other"), [("muslim", "christian"), ("musulmane", "juive"), ("juden", "christen"), ("negra", "blanca")])
def test_swaps_move_no_score(term, other):
    rng = np.random.default_rng(2)
    texts, y = [], []
    for i in range(600):
        toxic = i % 3 == 0
        words = [f"w{j}" for j in rng.integers(0, 50, 12)] + (["nasty"] if toxic else [])
        # The group is mentioned mostly where the text is toxic.
        if rng.random() < (0.8 if toxic else 0.05):
            words.append(term)
        texts.append(" ".join(words))
        y.append(float(toxic))
    cells = [toxicity.features(t) for t in texts]
    fair = toxicity.Classifier(swap=20.0).fit(cells, np.array(y))
    free = toxicity.Classifier(swap=0.0).fit(cells, np.array(y))

    def change(m):
        return abs(m.score(toxicity.features(f"w1 w2 {term}")) - m.score(toxicity.features(f"w1 w2 {other}")))

    assert change(fair) < 0.2 * change(free)
    assert fair.score(toxicity.features(f"w1 w2 {term}")) < 0.5 < fair.score(toxicity.features("w1 w2 nasty"))


def test_long_texts_do_not_fill_the_driver(spark):
    """The driver holds a minibatch of the sample, not all of it: 400 texts of 6,000 words are 9.6 MB of cells, and far more as they were held before."""
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.expr("concat_ws(' ', transform(sequence(1, 6000), i -> concat('w', hex(xxhash64(id, i)))))").alias("text"))
    labels = spark.range(400).select(F.col("id").alias("doc_id"), (F.col("id") % 4 == 0).cast("int").alias("toxic"))
    tracemalloc.start()
    model = toxicity.train(docs, labels, batch=8, epochs=1)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 32e6 and model.bias != 0
    rows = [(i, i % 2, toxicity.features(f"word{i} other{i // 2} third").astype("<i4")) for i in range(60)]
    spooled = toxicity.Spooled((i, y, c.tobytes()) for i, y, c in reversed(rows))
    a = toxicity.Classifier(least=1).fit(spooled, spooled.labels)
    b = toxicity.Classifier(least=1).fit([c.astype(np.int64) for _, _, c in rows], np.array([float(y) for _, y, _ in rows]))
    assert (a.w == b.w).all() and a.bias == b.bias


def test_pipeline_by_stages(spark, docs):
    kept = {r.doc_id: r.text for r in docs.collect()}
    texts = {}
    for i, t in kept.items():
        texts[t] = max(i, texts.get(t, -1))
    unique = {i: t for t, i in texts.items()}
    sets = {i: set(shingle_set(t, 5).tolist()) for i, t in unique.items()}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    left = {i for i, c in joined(links, sets).items() if i == c}
    out = docs
    for (_, stage), want in zip(corpus_pipeline.STAGES[:3], (set(kept), set(unique), left), strict=True):
        out = stage(spark, out, D)
        assert {r.doc_id for r in out.collect()} == want
    assert queries.QUERIES.keys() >= {"op5_ngram_jaccard"}
    packed = corpus_pipeline.run(spark, D)
    assert {r.doc_id for r in packed.collect()} <= left and packed.count() > 0


def test_model_gathers_pairs_of_all_words(spark):
    """Rare words are contexts and dishes too: each of 400 words that is always followed by its own partner predicts it."""
    rows = [(i, False, " ".join(f"left{(i * 7 + j) % 400} right{(i * 7 + j) % 400}" for j in range(20))) for i in range(400)]
    rows += [(1000 + i, True, f"left{i} right{i}") for i in range(20)] + [(2000 + i, True, f"left{i} right{i + 1}") for i in range(20)]
    rows += [(3000, True, "never seen left1 right1")]
    model = lm.PitmanYor(spark.createDataFrame([r for r in rows if not r[1]], "doc_id long, held_out boolean, text string"), frequent=10, listed=50, listed_pairs=50, sweeps=3, burn_in=1)
    got = {r.doc_id: r for r in model.score(spark.createDataFrame(rows, "doc_id long, held_out boolean, text string")).collect()}
    assert len(got) == len(rows)
    for i in range(20):
        assert got[1000 + i].score > got[2000 + i].score + 2
    assert got[3000].n_tokens == 5 and got[3000].n_known == 3
    assert model.cells.count() > 400 * 2


def test_replaced_tables_of_the_model_are_deleted(spark):
    """When texts are scored, the sweeps' tables and the cells that were scored are gone."""
    at = Path(session.shared_folder(spark))
    before = set(at.iterdir())
    docs = spark.createDataFrame([(i, f"a b c{i % 7} d a b") for i in range(40)], "doc_id long, text string")
    out = lm.score_documents(docs, sweeps=2, burn_in=1)
    left = {p.name.rsplit("-", 1)[0] for p in set(at.iterdir()) - before if list(p.rglob("*.parquet"))}
    assert left <= {"frequent-words", "contexts-kept", "words-kept", "scored-cells", "scores", "row-sums"}
    assert {r.n_tokens for r in out.collect()} == {7}


def test_model_moves_packs_and_not_cells(spark):
    """Shuffles move arrays of cells: far fewer rows than there are pairs of words."""
    store, none = spark._jsc.sc().statusStore(), spark._sc._gateway.new_array(spark._jvm.double, 0)

    def stages():
        found = store.stageList(None, False, False, none, None)
        return {x.stageId(): x.shuffleWriteRecords() for x in map(found.apply, range(found.size()))}

    last = max(stages(), default=-1)
    docs = spark.createDataFrame([(i, " ".join(f"w{(i * 31 + j * j) % 5000}" for j in range(100))) for i in range(400)], "doc_id long, text string")
    out = lm.score_documents(docs, sweeps=2, burn_in=1, listed=100).collect()
    assert len(out) == 400 and {r.n_tokens for r in out} == {101}
    assert sum(n for i, n in stages().items() if i > last) < 400 * 100 / 4


def test_scores_over_several_buckets_are_those_of_the_tables(spark, monkeypatch):
    """Pairs with a cell, and pairs without one after frequent, rare and unknown words, have the probabilities that the model's tables give."""
    monkeypatch.setattr(lm, "BUCKET", 500)
    monkeypatch.setattr(lm, "CHUNK", 200)
    text = lambda i: " ".join(f"w{(i * i + 7 * j * j) % (12 if j % 2 else 300)}" for j in range(20))
    rows = [(i, False, text(i) if i % 9 else None) for i in range(200)] + [(i, True, " ".join(text(i).split()[::-1])) for i in range(200, 240)]
    rows += [(None, True, "never w1 w299 w298 never w5 w1 Never")]
    docs = spark.createDataFrame(rows, "doc_id long, held_out boolean, text string").repartition(3)
    model = lm.PitmanYor(docs.where("NOT held_out"), frequent=20, listed=60, sweeps=3, burn_in=1)
    assert model.buckets > 4 and 2 < len(model.listed) < 100
    assert np.allclose(model.symbol_probability.sum(axis=1), 1)
    code = lambda x: int(np.uint64(x).view(np.int64))
    logp = {(r.u, r.w): r.logp for r in model.cells.collect()}
    words, contexts = ({r[0]: r for r in t.collect()} for t in (model.words, model.contexts))
    got = {r.doc_id: r for r in model.score(docs).collect()}
    assert len(got) == len(rows)
    unseen = 0
    for doc_id, _, t in rows:
        score = base = known = 0
        u, w, _ = lm._with_context(pa.array([t or ""]), model.listed)
        for a, b in zip(map(code, u), map(code, w), strict=True):
            left = list(contexts[a])[2:] if a in contexts else [1.0, 1.0]
            p = list(words[b])[2:] if b in words else model.known.unknowns
            unseen += (a, b) not in logp
            score += logp.get((a, b), np.log10(np.mean(np.multiply(left, p))))
            c = words[b].cw if b in words else 0
            base, known = base + np.log10((c + 0.5) / model.total), known + (c > 0)
        r = got[doc_id]
        assert (r.n_tokens, r.n_known) == (len(u), known)
        assert abs(r.score - score) < 1e-9 * len(u) and abs(r.base_score - base) < 1e-9 * len(u)
    assert unseen > 100


def test_pairs_that_collide_stay_apart(monkeypatch):
    """Two pairs of one hash were one cell too many, which failed the job."""
    monkeypatch.setattr(lm, "_pair", lambda u, w, salt=0: (u + w) % np.uint64(3))
    u, w = (np.array(x, dtype=np.uint64) for x in ([1, 2, 4, 1, 2, 5], [2, 1, 2, 2, 1, 4]))
    one, number = lm._distinct(u, w)
    assert len(one) == 4 and (u[one][number] == u).all() and (w[one][number] == w).all()


def test_words_are_hashed_as_they_are_split():
    """Windows of bytes, long words and ends of texts make no difference to which words are equal."""
    rng = np.random.default_rng(3)
    texts = ["".join(rng.choice(list("abAB \n\t\x0b\x1cé "), rng.integers(80))) for _ in range(500)]
    texts += [None, "", "x" * 200 + " " + "X" * 200, "q" * 64 + " " + "q" * 65, " a", "b ", "some word " * 30000]
    got, counts = lm._words(pa.array(["z", *texts]).slice(1))
    want = [split_words(t or "") for t in texts]
    assert counts.tolist() == [len(x) for x in want]
    flat = [x for words in want for x in words]
    assert len(set(zip(flat, got.tolist(), strict=True))) == len(set(flat)) == len(set(got.tolist()))


def test_integers_of_packs_come_back():
    for x in ([], [0, 127], [-128, 5], [128], [-129], [1 << 31], [-(1 << 63), (1 << 63) - 1]):
        x = np.array(x, dtype=np.int64)
        assert (lm._from_ints(lm._ints(x)) == x).all()
    codes = np.array([0, 1, 70000, 1 << 63, (1 << 64) - 1, (1 << 63) + 0xFFFF0000], dtype=np.uint64)
    assert (lm._to_codes(lm._to_bytes(codes), len(codes)) == codes).all()


def test_texts_read_in_another_order_fail():
    """Texts are known by their place, so a score would go to another text."""
    text = lm._row(lm.DOCS, 0, 5, np.arange(1), np.array([7]), np.zeros(1, dtype=np.uint8), np.array([3]))
    sums = lm._row(lm.SUMS, 0, 5, np.arange(1), np.array([-2.0]), np.array([-3.0]), np.array([2]))
    digests = [lm._row(lm.DIGESTS, 0, 5, np.uint64(x)) for x in (1, 1, 2)]
    out = lm._texts(lm._frame([text, sums, *digests[:2]]))
    assert out.values.tolist() == [[7, False, 3, 2, -3.0, -2.0]]
    for found in (digests[1:], digests[:1]):
        with pytest.raises(ValueError):
            lm._texts(lm._frame([text, sums, *found]))


def test_packing_keeps_blocks_where_bins_cannot_fill(spark):
    """Pieces of more than half a sequence never fill one; no task may hold them all."""
    rows = [(None if i % 3 == 0 else i, 0, 0, 2100 if i % 2 else 2101 + i, i) for i in range(600)]
    out = packing.best_fit(spark.createDataFrame(rows, packing.PIECES), 4096, 50).collect()
    assert sorted(r.ids_crc32 for r in out) == list(range(600)) and len({r.sequence_id for r in out}) == 600
    tasks = {}
    for r in out:
        tasks[r.sequence_id >> 32] = tasks.get(r.sequence_id >> 32, 0) + 1
    assert max(tasks.values()) <= 100


def test_local_search_stops_only_at_its_end():
    """No move, one-for-one or two-for-one step from a bin to one as full or fuller is left; bins of many items are searched whole."""
    rng = np.random.default_rng(5)
    many = [[270, [(3, "x", i) for i in range(80)] + [(30, "y", 0)]], [100, [(34, "z", 0), (66, "z", 1)]]]
    for size, bins in [(274, many)] + [(60, [[sum(v), [(int(n), b, i) for i, n in enumerate(v)]] for b, v in enumerate(rng.integers(3, 14, (40, 4)).tolist())]) for _ in range(5)]:
        out = packing._improve([[f, list(x)] for f, x in bins], size)
        assert sorted(x for b in out for x in b[1]) == sorted(x for b in bins for x in b[1])
        assert all(b[0] == sum(x[0] for x in b[1]) <= size for b in out)
        for give in out:
            for take in out:
                if take is give or give[0] > take[0]:
                    continue
                n = [x[0] for x in give[1]]
                sums = n + [n[i] + n[j] for i in range(len(n)) for j in range(i)]
                backs = [0] + [x[0] for x in take[1]]
                assert not any(0 < s - b <= size - take[0] for s in sums for b in backs)


def test_a_group_of_near_copies_is_sent_a_bounded_number_of_times(spark, monkeypatch):
    """Texts sent grow with a group's size, not with its square, and some members that only reach each other are found too."""
    rng = np.random.default_rng(9)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(800):
        t = list(base)
        t[rng.integers(120)] = f"x{i}"
        rows.append((i, " ".join(t)))
    # A chain away from the group: each end links with its neighbour only.
    for i in range(8):
        rows.append((1000 + i, " ".join([f"z{j}" for j in range(i * 6)] + base[i * 6 :])))
    sets = {i: set(shingle_set(t, 5).tolist()) for i, t in rows}
    want = joined([(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])], sets)
    sent = []
    tiles = jaccard.ShingleJoin.tiles

    def counted(self, placed, texts):
        sent.append(placed.count())
        return tiles(self, placed, texts)

    monkeypatch.setattr(jaccard.ShingleJoin, "tiles", counted)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard.jaccard_components(df, chunk=8).collect()}
    assert got == want
    assert sum(sent) < 4 * len(rows)


def test_join_of_repeated_rows_counts_shingles_once(spark):
    """Chained near copies, of which some rows are repeated: prefixes and components are those of the rows without repeats."""
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(words[:i] + [f"x{i}"] + words[i + 1 :])) for i in range(0, 60, 3)]
    rows += [(100 + i, " ".join(f"y{i}-{j}" for j in range(30))) for i in range(5)]
    twice = rows + rows[::2] * 3

    def prefixes(some):
        join = jaccard.ShingleJoin(spark.createDataFrame(some, "doc_id long, text string"), 5, 80, 4)
        return sorted(tuple(r) for r in join.postings(join.classes()).select("doc_id", "token", "pos").collect())

    found = prefixes(twice)
    assert len(found) == len(set(x[:2] for x in found)) and found and all(x[2] >= 0 for x in found)
    assert {x[0] for x in found} == {x[0] for x in prefixes(rows)}
    of = lambda some: {r.doc_id: r.component_id for r in jaccard.jaccard_components(spark.createDataFrame(some, "doc_id long, text string"), 5, 80, 4).collect()}
    assert of(twice) == of(rows)
