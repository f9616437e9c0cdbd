"""Near-duplicate embeddings by a subspace pigeonhole join."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.common import stored, table
from lectern.llm.graph import components

SLACK = 1e-4
FOUND = "id long, links long, root long"


def _unit(raw: pd.Series, dim: int) -> np.ndarray:
    """Vectors as rows of length one, in double precision."""
    x = np.frombuffer(b"".join(raw), dtype="<f8").reshape(-1, dim)
    big = np.abs(x).max(axis=1, keepdims=True)
    x = x / big
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _rotation(vectors: DataFrame, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Principal axes of all vectors, largest variance first. Spark adds up the tasks' dim x dim sums."""

    def sums(batches):
        total = np.zeros((dim, dim))
        for frame in batches:
            x = _unit(frame["raw"], dim)
            total += x.T @ x
        yield pd.DataFrame({"part": [total.ravel()]})

    cells = vectors.select("raw").mapInPandas(sums, "part array<double>").select(F.posexplode("part"))
    total = np.zeros(dim * dim)
    for at, value in cells.groupBy("pos").agg(F.sum("col")).collect():
        total[at] = value
    values, axes = np.linalg.eigh(total.reshape(dim, dim))
    return axes[:, ::-1].copy(), np.maximum(values[::-1], 0)


class Blocks:
    """Rotated axes dealt to blocks in turn; a block's squared-distance budget follows its share of the variance."""

    def __init__(self, axes: np.ndarray, variance: np.ndarray, blocks: int, cosine: float):
        dim = len(axes)
        self.axes = axes
        self.columns = [np.arange(b, dim, blocks) for b in range(min(blocks, dim))]
        share = np.array([variance[c].sum() + 1e-9 for c in self.columns])
        self.budgets = (2 - 2 * cosine) * share / share.sum()
        self.width = np.sqrt(self.budgets) * (1 + 10 * SLACK) + 1e-6

    def slabs(self, rotated: np.ndarray) -> np.ndarray:
        """Number of the slab of each row (down) and block (across) on the block's widest axis."""
        return np.stack([np.floor(rotated[:, c[0]] / w) for c, w in zip(self.columns, self.width, strict=True)], axis=1).astype(np.int64)

    def first(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """The block in which a pair counts: the one that uses least of its budget."""
        d = (x - y) ** 2
        used = np.stack([d[:, c].sum(axis=1) / b for c, b in zip(self.columns, self.budgets, strict=True)], axis=1)
        return np.argmin(np.floor(used * 1e9 + 0.5), axis=1)


def _merge(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest row reachable from each row over the pairs."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _within(part: np.ndarray, limit: float) -> tuple[np.ndarray, np.ndarray, float]:
    """Rows for both sides of a product that is the squared distance, and the bound it is held against.

    They are in single precision where its rounding, which the bound allows
    for, is small beside ``limit``; no pair within ``limit`` is missed.
    """
    norm, one = (part * part).sum(axis=1)[:, None], np.ones((len(part), 1))
    loose = 5e-7 * (part.shape[1] + 8)
    kind = np.float32 if loose <= limit / 100 else np.float64
    a, z = (np.ascontiguousarray(np.hstack(v), dtype=kind) for v in ((-2 * part, norm, one), (part, one, norm)))
    return a, z, limit + (loose if kind is np.float32 else 1e-9)


def _tile(frame: pd.DataFrame, b: int, same: bool, plan: Blocks, dim: int, cosine: float, step: int = 256) -> pd.DataFrame:
    """Links among the rows of one tile that count in block ``b``: per row their number and one root."""
    frame = frame.sort_values("id", kind="stable")
    ids, many, left = (frame[c].to_numpy() for c in ("id", "many", "left"))
    x = _unit(frame["raw"], dim)
    r = x @ plan.axes
    a, z, limit = _within(r[:, plan.columns[b]], plan.budgets[b] * (1 + SLACK))
    own, other = (np.flatnonzero(left), np.flatnonzero(~left)) if not same else (np.arange(len(ids)),) * 2
    a, z = a[own], z[other]
    links, ends = np.zeros(len(ids), dtype=np.int64), []
    for at in range(0, len(own), step):
        # Among the rows of one chunk a pair is met once, from its first row.
        for from_ in range(at if same else 0, len(other), 4 * step):
            part = a[at : at + step] @ z[from_ : from_ + 4 * step].T
            p, q = np.divmod(np.flatnonzero(part <= part.dtype.type(limit)), part.shape[1])
            p, q = own[at + p], other[from_ + q]
            if same:
                keep = p < q
                p, q = p[keep], q[keep]
            for s in range(0, len(p), 100_000):
                u, v = p[s : s + 100_000], q[s : s + 100_000]
                ok = (x[u] * x[v]).sum(axis=1) >= cosine
                u, v = np.minimum(u[ok], v[ok]), np.maximum(u[ok], v[ok])
                ok = plan.first(r[u], r[v]) == b
                u, v = u[ok], v[ok]
                np.add.at(links, u, many[v])
                np.add.at(links, v, many[u])
                ends.append((u, v))
    if not any(len(u) for u, _ in ends):
        return pd.DataFrame({"id": [], "links": [], "root": []}).astype("int64")
    u, v = (np.concatenate(e) for e in zip(*ends, strict=True))
    root = _merge(len(ids), u, v)
    hit = links > 0
    return pd.DataFrame({"id": ids[hit], "links": links[hit], "root": ids[root[hit]]})


def _linked(vectors: DataFrame, dim: int, cosine: float, blocks: int, tile: int) -> DataFrame:
    """(id, links, root) rows, several per id, over distinct vectors (id, raw, many) of one length."""
    plan = Blocks(*_rotation(vectors, dim), blocks, cosine)
    places = [f"s{b}" for b in range(len(plan.columns))]

    def place(batches):
        for frame in batches:
            s = plan.slabs(_unit(frame["raw"], dim) @ plan.axes)
            yield pd.concat([frame.reset_index(drop=True), pd.DataFrame(s, columns=places)], axis=1)

    placed = stored(vectors.mapInPandas(place, "id long, raw binary, many long, " + ", ".join(f"{p} long" for p in places)), "placed-vectors")
    slab = F.explode(F.array(*[F.struct(F.lit(b).alias("b"), F.col(p).alias("s")) for b, p in enumerate(places)])).alias("at")
    each = placed.select("id", "raw", "many", slab).select("id", "raw", "many", "at.b", "at.s")
    # Unit vectors have at most 2 / width + 1 slabs a block, whatever their number.
    chunks = {(r[0], r[1]): -(-r[2] // tile) for r in each.groupBy("b", "s").count().collect()}
    if not chunks:
        return placed.sparkSession.createDataFrame([], FOUND)
    size = lambda s: F.coalesce(F.element_at(F.create_map(*[F.lit(x) for (b, k), n in chunks.items() for x in (f"{b}:{k}", n)]), F.concat_ws(":", "b", s)), F.lit(0))
    each = each.withColumns({"k": size(F.col("s")), "down": size(F.col("s") - 1), "up": size(F.col("s") + 1)})
    each = each.withColumn("c", F.pmod(F.xxhash64("id"), F.col("k")).cast("int"))
    none = F.array().cast("array<int>")
    upto = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(none)
    # A tile is a pair of chunks: of one slab, or of a slab and the next one up.
    mine = F.transform(upto(F.col("k")), lambda j: F.struct(F.col("s").alias("slab"), F.least(j, F.col("c")).alias("i"), F.greatest(j, F.col("c")).alias("j"), F.lit(False).alias("next"), (F.col("c") <= j).alias("left")))
    above = F.transform(upto(F.col("up")), lambda j: F.struct(F.col("s").alias("slab"), F.col("c").alias("i"), j.alias("j"), F.lit(True).alias("next"), F.lit(True).alias("left")))
    below = F.transform(upto(F.col("down")), lambda i: F.struct((F.col("s") - 1).alias("slab"), i.alias("i"), F.col("c").alias("j"), F.lit(True).alias("next"), F.lit(False).alias("left")))
    tiles = each.select("id", "raw", "many", "b", F.explode(F.concat(mine, above, below)).alias("t")).select("id", "raw", "many", "b", "t.*")

    def work(key, frame):
        b, _, i, j, next_ = key
        return _tile(frame, int(b), not next_ and i == j, plan, dim, cosine)

    return tiles.groupBy("b", "slab", "i", "j", "next").applyInPandas(work, FOUND)


def near_vectors(vectors: DataFrame, cosine: float = 0.9, blocks: int = 4, tile: int = 16384) -> DataFrame:
    """Vectors at a cosine of ``cosine`` or more: ``vec_id``, ``n_links``, ``component_id``, ``kept``.

    A pair that close has a squared distance of at most 2 - 2 * cosine as unit
    vectors, so in at least one block of rotated axes it stays within that
    block's share. Each block is a range join: slabs of the budget's width on
    its widest axis, each held against itself and the next. Slabs are cut into
    chunks, a pair of chunks is a task, so a crowded slab spreads. A pair is
    verified in double precision and counts only in the block that uses least
    of its budget, so tasks return a count and a root per vector, not pairs.

    Vectors that are null, empty, zero, or hold null or non-finite components
    link with nothing and are kept; so do vectors of unlike lengths with each
    other. Equal vectors are worked once. Rows that repeat an id count as
    copies. Other columns are ignored; no rows give no rows.
    """
    spark = vectors.sparkSession
    e = F.col("e")
    fit = e.isNotNull() & (F.size("e") > 0) & ~F.exists("e", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))) & F.exists("e", lambda v: v != 0)
    rows = vectors.select(F.col("vec_id"), F.col("embedding").cast("array<double>").alias("e"))
    rows = rows.withColumn("fit", F.coalesce(fit, F.lit(False)) & F.col("vec_id").isNotNull())
    h = F.when(F.col("fit"), F.struct(F.xxhash64("e").alias("h1"), F.xxhash64(F.lit(1), "e").alias("h2")))
    keyed = stored(rows.select("vec_id", "fit", h.alias("h")), "vector-hashes")
    reps = stored(keyed.where("fit").groupBy("h").agg(F.min("vec_id").alias("id"), F.count("*").alias("many")), "vector-reps")

    def packed(batches):
        for frame in batches:
            yield pd.DataFrame({"rid": frame["vec_id"], "dim": [len(v) for v in frame["e"]], "raw": [np.asarray(v, dtype="<f8").tobytes() for v in frame["e"]]})

    raw = rows.where("fit").select("vec_id", "e").mapInPandas(packed, "rid long, dim int, raw binary")
    raw = raw.join(reps.select("id", "many"), F.col("rid") == F.col("id")).dropDuplicates(["id"])
    distinct = stored(raw.select("id", "dim", "raw", "many"), "vectors")
    found = None
    for (dim,) in distinct.select("dim").distinct().collect():
        part = _linked(distinct.where(F.col("dim") == dim).select("id", "raw", "many"), dim, cosine, blocks, tile)
        found = part if found is None else found.unionByName(part)
    found = stored(found if found is not None else spark.createDataFrame([], FOUND), "vector-links")
    counts = found.groupBy("id").agg(F.sum("links").alias("links"))
    comps = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    known = reps.join(counts, "id", "left").join(comps, "id", "left")
    known = stored(known.select("h", (F.coalesce("links", F.lit(0)) + F.col("many") - 1).alias("links"), F.coalesce("component", "id").alias("component")), "vector-classes")
    out = keyed.join(known, "h", "left")
    component = F.coalesce("component", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


QUERIES = {"op9_embedding_dedup": op9_embedding_dedup}
SQL = {
    "op9_embedding_dedup": """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  AND list_cosine_similarity(a.e, b.e) >= 0.9),
reach AS (SELECT a AS vec_id, b AS other FROM links UNION SELECT r.vec_id, l.b FROM reach r JOIN links l ON l.a = r.other),
low AS (SELECT vec_id, min(other) AS low FROM reach GROUP BY 1),
n AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY 1)
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, least(e.vec_id, coalesce(low.low, e.vec_id)) AS component_id,
       e.vec_id = least(e.vec_id, coalesce(low.low, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN n ON n.vec_id = e.vec_id LEFT JOIN low ON low.vec_id = e.vec_id"""
}
