"""Similarity join on word shingles with adaptive multi-match prefixes."""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.llm.common import stored, table, whole
from lectern.llm.graph import components
from lectern.llm.shingles import shingle_set

PROFILE = "doc_id long, n long, sig binary, token long, seen long"
EMITTED = "doc_id long, n long, rare long, tokens array<long>, kinds array<int>, places array<int>"
# Shingles whose hash lies below this share of the range are counted exactly.
COUNTED_SHARE = 0.25
HEAVY = 50_000
CHUNK = 2_000_000


def _profile(batches, k: int):
    """A row per document, and the shingles that are frequent in each stretch of documents."""
    held, size = [], 0

    def frequent():
        tokens, counts = np.unique(np.concatenate(held), return_counts=True)
        often = counts >= max(2, size / HEAVY)
        return pd.DataFrame({"doc_id": pd.NA, "n": pd.NA, "sig": None, "token": tokens[often], "seen": counts[often]}).astype({"doc_id": "Int64", "n": "Int64"})

    for frame in batches:
        n, sigs = [], []
        for text in frame["text"]:
            s = shingle_set(text, k)
            n.append(len(s))
            sigs.append(xxhash.xxh128_digest(s.tobytes()) if len(s) else None)
            held.append(s)
            size += len(s)
        yield pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64"), "n": n, "sig": sigs, "token": pd.NA, "seen": pd.NA}).astype({"token": "Int64", "seen": "Int64"})
        if size >= CHUNK:
            yield frequent()
            held, size = [], 0
    if size:
        yield frequent()


def _need(n: int, percent: int) -> int:
    """Least overlap of a set of n with any set it links to."""
    return -(-percent * n // 100)


def _emit(batches, k: int, percent: int, matches: int, heavy: np.ndarray, ranks: np.ndarray):
    """The head of each document's shingles in the global order.

    Order: counted shingles (by their count, found later), then others by
    hash, then heavy ones by their rank. At least the longest prefix is given.
    """
    edge = np.int64(-(2**63) + int(COUNTED_SHARE * 2**64))
    for frame in batches:
        rows = []
        for doc_id, text in zip(frame["doc_id"], frame["text"], strict=True):
            s = shingle_set(text, k)
            n = len(s)
            if not n or pd.isna(doc_id):
                continue
            longest = min(n, n - _need(n, percent) + matches)
            at = np.searchsorted(heavy, s)
            is_heavy = (heavy[np.minimum(at, len(heavy) - 1)] == s) if len(heavy) else np.zeros(n, bool)
            light = s[~is_heavy]
            counted = int(np.searchsorted(light, edge))
            take = max(counted, min(longest, len(light)))
            tokens = light[:take]
            kinds = np.where(np.arange(take) < counted, 0, 1)
            places = np.arange(take)
            if take < longest:
                own = s[is_heavy]
                order = np.argsort(ranks[at[is_heavy]], kind="stable")[: longest - take]
                tokens = np.concatenate([tokens, own[order]])
                kinds = np.concatenate([kinds, np.full(len(order), 2)])
                places = np.arange(len(tokens))
            rows.append((int(doc_id), n, counted, tokens, kinds.astype(np.int32), places.astype(np.int32)))
        yield pd.DataFrame(rows, columns=["doc_id", "n", "rare", "tokens", "kinds", "places"])


def _similar(batches, k: int, percent: int):
    """Pairs whose overlap is large enough, counted exactly."""
    kept: dict[int, np.ndarray] = {}

    def of(doc_id, text):
        if doc_id not in kept:
            if len(kept) > 256:
                kept.clear()
            kept[doc_id] = shingle_set(text, k)
        return kept[doc_id]

    for frame in batches:
        ok = []
        for a, b, ta, tb in zip(frame["a"], frame["b"], frame["text_a"], frame["text_b"], strict=True):
            x, y = of(a, ta), of(b, tb)
            both = len(np.intersect1d(x, y, assume_unique=True))
            ok.append(100 * both >= percent * (len(x) + len(y) - both))
        yield frame.loc[ok, ["a", "b"]]


def _within(sets: list[np.ndarray], left: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """What links between left and right sets, or among all where none is right, connect: (i, least of its group)."""
    n = len(sets)
    tokens, owner = np.concatenate(sets), np.repeat(np.arange(n), [len(s) for s in sets])
    found, at, times = np.unique(tokens, return_inverse=True, return_counts=True)
    shared = times > 1
    column = np.cumsum(shared) - 1
    keep = shared[at]
    row, col = owner[keep], column[at[keep]]
    both = np.zeros((n, n), dtype=np.float32)
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    width = 8_192
    for start in range(0, int(shared.sum()), width):
        a, b = np.searchsorted(col, [start, start + width])
        part = np.zeros((n, min(width, int(shared.sum()) - start)), dtype=np.float32)
        part[row[a:b], col[a:b] - start] = 1
        both += part @ part.T
    size = np.array([len(s) for s in sets], dtype=np.int64)
    both = both.astype(np.int64)
    ok = 100 * both >= percent * (size[:, None] + size[None, :] - both)
    if not left.all():
        ok &= left[:, None] & ~left[None, :]
    root = list(range(n))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, j in zip(*(x.tolist() for x in np.nonzero(ok)), strict=True):
        a, b = find(i), find(j)
        root[max(a, b)] = min(a, b)
    return [(i, find(i)) for i in range(n) if find(i) != i]


def _tiles(batches, k: int, percent: int):
    """Links inside each run of rows of one (cluster, i, j); what connects with the cluster's leader is linked to it."""
    at, ids, left, sets = None, [], [], []

    def links():
        found = _within(sets, np.array(left), percent)
        if at[0] in ids:
            leader = ids.index(at[0])
            least = dict(found).get(leader)
            if least is not None:
                found = [(least if i == leader else i, leader if j == least else j) for i, j in found]
        return pd.DataFrame([(ids[i], ids[j]) for i, j in found], columns=["a", "b"], dtype="int64")

    for frame in batches:
        for cluster, i, j, doc_id, side, text in frame[["cluster", "i", "j", "doc_id", "left", "text"]].itertuples(index=False, name=None):
            if (cluster, i, j) != at:
                if len(ids) > 1:
                    yield links()
                at, ids, left, sets = (cluster, i, j), [], [], []
            ids.append(doc_id)
            left.append(side)
            sets.append(shingle_set(text, k))
    if len(ids) > 1:
        yield links()


def _size_fits(n: Column, m: Column, percent: int) -> Column:
    return (100 * F.least(n, m)) >= (percent * F.greatest(n, m))


class ShingleJoin:
    """One similarity join. ``percent`` is the Jaccard threshold, ``k`` the words of a shingle.

    A set needs an overlap of at least T = ceil(percent * n / 100) with any
    partner, so two linked sets share at least m shingles within their prefixes
    of n - T + m. Each document takes the number m of matches (1 to
    ``matches``) that costs least, by the lengths of its prefix shingles' lists
    and the candidates they can give; a pair is a candidate when it shares at
    least the smaller of the two numbers. This loses no link.
    """

    def __init__(self, docs: DataFrame, k: int = 5, percent: int = 80, matches: int = 4, verify_cost: float = 20.0, chunk: int = 256):
        self.docs = docs.select("doc_id", whole("text").alias("text"))
        self.spark = docs.sparkSession
        self.k, self.percent, self.matches, self.verify_cost, self.chunk = k, percent, matches, verify_cost, chunk

    def classes(self) -> DataFrame:
        """(doc_id, n, rep): documents with equal sets share the smallest id as rep."""
        k = self.k
        self.profiled = stored(self.docs.mapInPandas(lambda it: _profile(it, k), PROFILE), "shingle-profile")
        sets = self.profiled.where("token IS NULL").select("doc_id", "n", "sig")
        reps = stored(sets.where("sig IS NOT NULL").groupBy("sig").agg(F.min("doc_id").alias("rep")), "shingle-reps")
        out = sets.join(reps, "sig", "left").select("doc_id", "n", F.coalesce("rep", "doc_id").alias("rep"))
        return stored(out, "shingle-classes")

    def heavy(self) -> tuple[np.ndarray, np.ndarray]:
        """Shingles that make up 1 / HEAVY of all or more: at most HEAVY of them, whatever the input."""
        total = self.profiled.agg(F.sum("n")).first()[0] or 0
        found = self.profiled.where("token IS NOT NULL").groupBy("token").agg(F.sum("seen").alias("seen"))
        rows = found.where(F.col("seen") >= max(2.0, total / HEAVY)).orderBy("token").collect()
        tokens = np.array([r[0] for r in rows], dtype=np.int64)
        counts = np.array([r[1] for r in rows], dtype=np.int64)
        ranks = np.empty(len(rows), dtype=np.int64)
        ranks[np.lexsort((tokens, counts))] = np.arange(len(rows))
        return tokens, ranks

    def postings(self, classes: DataFrame) -> DataFrame:
        """(doc_id, n, m, token, pos): each representative's prefix, without shingles nobody shares."""
        k, percent, matches = self.k, self.percent, self.matches
        heavy, ranks = self.heavy()
        shared = self.spark.sparkContext.broadcast((heavy, ranks))
        copies = stored(classes.where("doc_id <> rep").select("doc_id").distinct(), "shingle-copies")
        emitted = self.docs.mapInPandas(lambda it: _emit(it, k, percent, matches, *shared.value), EMITTED)
        emitted = emitted.join(copies, "doc_id", "left_anti")
        # Rows that repeat an id repeat its text: one of them stands for all, lest its shingles count twice.
        repeated = stored(classes.groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated-ids")
        once = emitted.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id"])
        emitted = emitted.join(repeated, "doc_id", "left_anti").unionByName(once)
        each = emitted.select("doc_id", "n", "rare", F.explode(F.arrays_zip("tokens", "kinds", "places")).alias("p"))
        each = each.select("doc_id", "n", "rare", F.col("p.tokens").alias("token"), F.col("p.kinds").alias("kind"), F.col("p.places").alias("place"))
        # Counting keeps no group in memory and none is hot: heavy shingles go round it.
        df = F.count("*").over(Window.partitionBy("token"))
        light = each.where("kind < 2").withColumn("df", df).where("df > 1")
        hot = each.where("kind = 2").withColumn("df", F.lit(None).cast("long"))
        found = stored(light.unionByName(hot), "shared-shingles")
        sizes = stored(found.where("kind = 2").groupBy("token").agg(F.count("*").alias("df2")), "heavy-sizes")
        found = found.join(sizes, "token", "left").withColumn("df", F.coalesce("df", "df2")).where("df > 1")

        own = Window.partitionBy("doc_id")
        counted = F.col("kind") == 0
        alone = F.col("rare") - F.sum(F.when(counted, 1).otherwise(0)).over(own)
        order = F.row_number().over(own.orderBy("kind", F.when(counted, F.col("df")), "place"))
        found = found.withColumns({"alone": alone, "order": order})
        found = found.withColumn("pos", F.when(counted, F.col("alone") + F.col("order") - 1).otherwise(F.col("place")))
        need = F.ceil(F.lit(percent) * F.col("n") / F.lit(100))
        length = lambda m: F.col("n") - need + m
        costs = []
        for m in range(1, matches + 1):
            lists = F.sum(F.when(F.col("pos") < length(m), F.col("df") - 1).otherwise(0)).over(own)
            cost = lists * (1 + self.verify_cost / m)
            costs.append(F.struct(F.when(need >= m, cost).otherwise(F.lit(float("inf"))).alias("cost"), F.lit(m).alias("m")))
        found = found.withColumns({"first": costs[0]["cost"], "m": F.array_min(F.array(*costs))["m"]})
        found = found.where((F.col("first") > 0) & (F.col("pos") < length(F.col("m"))))
        return stored(found.select("doc_id", "n", "m", "token", "pos"), "prefixes")

    def verified(self, pairs: DataFrame, texts: DataFrame) -> DataFrame:
        k, percent = self.k, self.percent
        a = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
        b = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
        full = pairs.join(b, "b").join(a, "a").select("a", "b", "text_a", "text_b")
        return stored(full.mapInPandas(lambda it: _similar(it, k, percent), "a long, b long"), "links")

    def tiles(self, placed: DataFrame, texts: DataFrame) -> DataFrame:
        """Links of each unit (cluster, i, j) of rows (doc_id, cluster, i, j, left), verified on whole texts."""
        k, percent = self.k, self.percent
        full = stored(placed, "cluster-tiles").join(texts, "doc_id").repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j", "doc_id")
        return stored(full.mapInPandas(lambda it: _tiles(it, k, percent), "a long, b long"), "links")

    def in_clusters(self, members: DataFrame, texts: DataFrame) -> DataFrame:
        """Links that join what is alike in each cluster: (doc_id, cluster), where a cluster's name is its leader's id.

        A cluster is cut into chunks of about ``chunk`` documents. Each chunk
        meets the leader and itself, so a text is sent once and the leader once
        a chunk; what connects with the leader is one component by then. Only
        documents that do not are compared with the rest of their cluster, in
        pairs of chunks of which one at least holds nothing else. A unit returns
        a row per linked document, so components settle in few rounds.
        """
        chunk = self.chunk
        sizes = stored(members.groupBy("cluster").agg(F.ceil(F.count("*") / chunk).cast("int").alias("k")), "cluster-sizes")
        placed = members.join(sizes, "cluster")
        own = placed.select("doc_id", "cluster", F.pmod(F.xxhash64("doc_id"), F.col("k")).cast("int").alias("i"))
        leaders = sizes.select(F.col("cluster").alias("doc_id"), "cluster", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("i"))
        first = self.tiles(own.unionByName(leaders).select("*", F.col("i").alias("j"), F.lit(True).alias("left")), texts)

        near = first.select(F.col("a").alias("doc_id"), F.col("b").alias("cluster"), F.lit(True).alias("near")).dropDuplicates(["doc_id", "cluster"])
        sides = placed.where("k > 1").join(near, ["doc_id", "cluster"], "left")
        sides = stored(sides.select("doc_id", "cluster", F.coalesce("near", F.lit(False)).alias("near")), "cluster-sides")
        chunks = lambda side: F.ceil(F.count(F.when(side, 1)) / chunk).cast("int")
        counts = stored(sides.groupBy("cluster").agg(chunks(~F.col("near")).alias("u"), chunks(F.col("near")).alias("l")).where("u > 0"), "cluster-sides-sizes")
        if counts.isEmpty():
            return first
        # Chunks 0 to u - 1 hold what the leader did not reach, the l after them what it did.
        h = F.xxhash64("doc_id", F.lit(1))
        c = F.when(F.col("near"), F.col("u") + F.pmod(h, F.col("l"))).otherwise(F.pmod(h, F.col("u"))).cast("int")
        last = F.when(F.col("near"), F.col("u") - 1).otherwise(F.col("u") + F.col("l") - 1)
        pairs = sides.join(counts, "cluster").select("doc_id", "cluster", c.alias("c"), F.explode(F.sequence(F.lit(0), last)).alias("o"))
        pairs = pairs.select("doc_id", "cluster", F.least("c", "o").alias("i"), F.greatest("c", "o").alias("j"), (F.col("c") <= F.col("o")).alias("left"))
        return first.unionByName(self.tiles(pairs, texts))

    def labelled(self, prefixes: DataFrame, edges: DataFrame, clusters: list[DataFrame]) -> DataFrame:
        """Prefixes with their component and clusters so far, only of shingles that still touch two components."""
        c = stored(components(edges), "components-so-far")
        for n, members in enumerate(clusters):
            own = members.select("doc_id", F.col("cluster").alias(f"c{n}"))
            prefixes = prefixes.join(own, "doc_id", "left").withColumn(f"c{n}", F.coalesce(f"c{n}", "doc_id"))
        p = prefixes.join(c.withColumnRenamed("id", "doc_id"), "doc_id", "left").withColumn("comp", F.coalesce("component", "doc_id")).drop("component")
        p = stored(p, "labelled-prefixes")
        open_tokens = p.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("token")
        return p.join(stored(open_tokens, "open-shingles"), "token", "left_semi")

    def edges(self, classes: DataFrame) -> DataFrame:
        """Links between representatives that join every component, each verified on whole texts.

        First, twice, documents are clustered: each goes to the leader it meets
        most often among those of its shingles' lists, and a cluster is verified
        in chunks, without a row per pair. Then only pairs across the
        components and clusters are generated and counted, so a group of near
        copies never turns into all its pairs.
        """
        prefixes = self.postings(classes)
        live = stored(prefixes.select("doc_id").distinct(), "live")
        texts = stored(self.docs.join(live.hint("merge"), "doc_id", "left_semi"), "live-texts")
        edges = self.spark.createDataFrame([], "a long, b long")
        clusters: list[DataFrame] = []
        open_ones = prefixes.withColumn("comp", F.col("doc_id"))
        for turn in range(2):
            rank = F.xxhash64("comp", F.lit(turn)) if turn else F.col("comp")
            lead = F.min(F.struct(rank.alias("rank"), "doc_id", "comp", "n"))
            leaders = stored(open_ones.groupBy("token").agg(lead.alias("lead")).select("token", F.col("lead.doc_id").alias("b"), F.col("lead.comp").alias("of"), F.col("lead.n").alias("size")), "leaders")
            meets = open_ones.join(leaders, "token").where((F.col("comp") != F.col("of")) & _size_fits(F.col("n"), F.col("size"), self.percent)).groupBy(F.col("doc_id").alias("a"), "b").agg(F.count("*").alias("times"))
            best = stored(meets.groupBy("a").agg(F.max_by("b", F.struct("times", "b")).alias("b")), "best-leaders")
            members = best.select(F.col("a").alias("doc_id"), F.col("b").alias("cluster"))
            clusters.append(members)
            edges = edges.unionByName(self.in_clusters(members, texts))
            open_ones = stored(self.labelled(prefixes, edges, clusters), "open-prefixes")
        x, y = open_ones.alias("x"), open_ones.alias("y")
        ahead = F.least(F.col("x.pos"), F.col("y.pos"))
        after = F.least(F.col("x.n") - F.col("x.pos"), F.col("y.n") - F.col("y.pos"))
        least = F.lit(self.percent) * (F.col("x.n") + F.col("y.n"))
        cond = (
            (F.col("x.token") == F.col("y.token"))
            & (F.col("x.comp") < F.col("y.comp"))
            & (F.col("x.c0") != F.col("y.c0"))
            & (F.col("x.c1") != F.col("y.c1"))
            & _size_fits(F.col("x.n"), F.col("y.n"), self.percent)
            & ((100 + self.percent) * (ahead + after) >= least)
        )
        pairs = x.join(y, cond).groupBy(F.col("x.doc_id").alias("a"), F.col("y.doc_id").alias("b"))
        pairs = pairs.agg(F.count("*").alias("times"), F.min(F.least("x.m", "y.m")).alias("m")).where("times >= m").select("a", "b")
        return edges.unionByName(self.verified(stored(pairs, "candidates"), texts))


def jaccard_components(docs: DataFrame, k: int = 5, percent: int = 80, matches: int = 4, chunk: int = 256) -> DataFrame:
    """Near-duplicate components: one row per input row with ``doc_id``, ``n_shingles``, ``component_id``.

    Two documents link when 100 * intersection >= percent * union of their
    distinct k-word shingles (A-Z lower-cased, split at ASCII white space;
    fewer words are one shingle). Null and empty texts have no shingles and
    link with nothing. Equal sets are one class, worked once by its smallest
    id. Rows that repeat an id are expected to repeat its text. A row without
    id is returned alone. Other columns are ignored; no rows give no rows.
    """
    join = ShingleJoin(docs, k, percent, matches, chunk=chunk)
    classes = join.classes()
    found = stored(components(join.edges(classes)), "shingle-components")
    out = classes.join(found, classes["rep"] == found["id"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "rep").alias("component_id"))


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), k=4, percent=85)


QUERIES = {"op5_ngram_jaccard": op5_ngram_jaccard}
SQL = {
    "op5_ngram_jaccard": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (
  SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 85 * (x.n + y.n - i)),
e AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT a AS doc_id, b AS other FROM e UNION SELECT r.doc_id, e.b FROM reach r JOIN e ON e.a = r.other)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles,
       least(d.doc_id, coalesce((SELECT min(other) FROM reach r WHERE r.doc_id = d.doc_id), d.doc_id)) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id"""
}
