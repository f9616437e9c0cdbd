"""Toxicity by a counterfactually regularised classifier."""

from __future__ import annotations

import re
import tempfile
from collections.abc import Iterable, Mapping, Sequence

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.common import stored, table, whole

CELLS = 1 << 19
# In so many parts the sample comes to the driver.
PARTS = 32
_WORD = re.compile(r"[^\W_]+", re.UNICODE)
# Groups whose neutral mention must not move a score, by language, with the
# forms that sentences hold. A mention is swapped for every other of its row,
# and for none.
IDENTITY_TERMS = {
    "en": (
        ("women", "men", "woman", "man", "girls", "boys", "transgender", "nonbinary"),
        ("gay", "lesbian", "bisexual", "straight", "queer"),
        ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "muslims", "christians", "jews"),
        ("black", "white", "asian", "african", "latino", "european", "american", "mexican", "arab", "immigrants", "refugees"),
        ("old", "young", "elderly", "disabled", "blind", "deaf"),
    ),
    "fr": (
        ("femmes", "hommes", "femme", "homme", "filles", "garçons", "transgenre", "transgenres"),
        ("gay", "gays", "lesbienne", "lesbiennes", "bisexuel", "bisexuelle", "homosexuel", "homosexuelle", "hétérosexuel", "hétérosexuelle"),
        ("musulman", "musulmane", "musulmans", "chrétien", "chrétienne", "chrétiens", "juif", "juive", "juifs", "hindou", "hindous", "bouddhiste", "athée", "athées"),
        ("noir", "noire", "noirs", "blanc", "blanche", "blancs", "asiatique", "africain", "africaine", "africains", "européen", "européenne", "américain", "américaine", "arabe", "arabes", "immigrés", "réfugiés"),
        ("vieux", "vieille", "jeune", "jeunes", "âgé", "âgée", "handicapé", "handicapée", "aveugle", "sourd", "sourde"),
    ),
    "de": (
        ("frauen", "männer", "frau", "mann", "mädchen", "jungen", "transgender", "nichtbinär"),
        ("schwul", "schwule", "schwulen", "lesbisch", "lesbische", "bisexuell", "bisexuelle", "homosexuell", "homosexuelle", "heterosexuell", "heterosexuelle"),
        ("muslim", "muslime", "muslimisch", "muslimische", "christ", "christen", "christlich", "christliche", "jude", "juden", "jüdisch", "jüdische", "hindu", "hindus", "buddhist", "buddhisten", "atheist", "atheisten"),
        ("schwarze", "schwarzen", "weiße", "weißen", "asiatisch", "asiaten", "afrikanisch", "afrikaner", "europäisch", "europäer", "amerikaner", "araber", "arabisch", "türken", "einwanderer", "flüchtlinge"),
        ("alte", "alten", "junge", "ältere", "älteren", "behindert", "behinderte", "blind", "blinde", "gehörlos", "gehörlose"),
    ),
    "es": (
        ("mujeres", "hombres", "mujer", "hombre", "chicas", "chicos", "transgénero", "transexual"),
        ("gay", "gays", "lesbiana", "lesbianas", "bisexual", "bisexuales", "homosexual", "homosexuales", "heterosexual", "heterosexuales"),
        ("musulmán", "musulmana", "musulmanes", "cristiano", "cristiana", "cristianos", "judío", "judía", "judíos", "hindú", "hindúes", "budista", "budistas", "ateo", "atea", "ateos"),
        ("negro", "negra", "negros", "blanco", "blanca", "blancos", "asiático", "asiática", "africano", "africana", "africanos", "europeo", "europea", "americano", "americana", "mexicano", "mexicana", "árabe", "árabes", "inmigrantes", "refugiados"),
        ("viejo", "vieja", "joven", "jóvenes", "anciano", "anciana", "discapacitado", "discapacitada", "ciego", "ciega", "sordo", "sorda"),
    ),
}


def cell(word: str) -> int:
    return xxhash.xxh64_intdigest(word) % CELLS


def features(text: str) -> np.ndarray:
    """Cells of the distinct words of the whole text and of their first four and five letters."""
    words = set(_WORD.findall(text.lower()))
    stems = {w[:4] + "*" for w in words if len(w) > 4} | {w[:5] + "*" for w in words if len(w) > 5}
    words |= stems
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words)) % CELLS).astype(np.int64)


def train_part(id_col: str = "doc_id", parts: int = 3) -> Column:
    """Rows that labels may be learned from."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % parts != 1


def sample_labels(labels: DataFrame, most: int, seed: int = 5) -> DataFrame:
    """At most ``most`` labelled ids in a seeded random order; an id with unlike labels counts as toxic."""
    told = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & train_part())
    one = told.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    return one.orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(most)


class Spooled(Sequence):
    """Cells of rows, kept in a temporary file of the driver; memory holds a place and a label per row. Rows are in the order of their ids."""

    def __init__(self, rows: Iterable[tuple[int, int, bytes]]):
        self.file = tempfile.TemporaryFile()
        held, at = [], 0
        for key, label, raw in rows:
            self.file.write(raw)
            held.append((key, label, at, len(raw)))
            at += len(raw)
        held.sort()
        self.labels = np.array([r[1] for r in held], dtype=float)
        self.places = [r[2:] for r in held]

    def __len__(self) -> int:
        return len(self.places)

    def __getitem__(self, i: int) -> np.ndarray:
        at, size = self.places[i]
        self.file.seek(at)
        return np.frombuffer(self.file.read(size), dtype="<i4")


class Classifier:
    """Logistic regression on the presence of words and word stems, fitted by Adam on minibatches.

    Beside the log loss, weights have L1 (falling with the
    root of the sample's size) and L2 penalties, and each labelled sentence
    with identity terms has counterfactuals: the term swapped for the others of
    its row, or left out. The squared change of the score under a swap is
    penalised with ``swap``, so that the terms of a row get like weights, near
    that of no mention.
    """

    def __init__(self, terms: Mapping[str, Sequence[Sequence[str]]] = IDENTITY_TERMS, swap: float = 5.0, l1: float = 0.012, l2: float = 1e-6, least: int = 5, epochs: int = 20, batch: int = 256, rate: float = 0.05, seed: int = 3):
        # A term brings its word and its stems; the word tells a mention.
        self.groups = [[(cell(w), features(w)) for w in g] for rows in terms.values() for g in rows]
        self.swap, self.l1, self.l2, self.least, self.epochs, self.batch, self.rate, self.seed = swap, l1, l2, least, epochs, batch, rate, seed
        self.w, self.bias = np.zeros(CELLS), 0.0

    def fit(self, cells: Sequence[np.ndarray], y: np.ndarray) -> Classifier:
        """``cells`` holds the distinct cells of each row; they are read a row at a time, and at most a minibatch of them is held."""
        n = len(cells)
        if not n:
            return self
        rng = np.random.default_rng(self.seed)
        prior = (y.sum() + 0.5) / (n + 1)
        self.bias = float(np.log(prior / (1 - prior)))
        # The cells of at least ``least`` sentences and of the terms, numbered densely.
        times = np.zeros(CELLS, dtype=np.int64)
        for i in range(n):
            times[cells[i]] += 1
        seen = np.unique(np.concatenate([np.flatnonzero(times >= self.least), *[c for g in self.groups for _, c in g]]))
        place = np.full(CELLS, -1)
        place[seen] = np.arange(len(seen))
        groups = []
        for g in self.groups:
            own = [np.searchsorted(seen, c) for _, c in g]
            sizes = [len(c) for c in own]
            groups.append((np.searchsorted(seen, [w for w, _ in g]), np.concatenate(own), np.repeat(np.arange(len(g)), sizes)))
        w, bias = np.zeros(len(seen)), self.bias
        m, v, mb, vb, step = np.zeros(len(seen)), np.zeros(len(seen)), 0.0, 0.0, 0
        for epoch in range(self.epochs):
            order = rng.permutation(n)
            rate = self.rate / (1 + epoch / 4)
            for at in range(0, n, self.batch):
                rows = order[at : at + self.batch]
                held = [cells[i] for i in rows]
                flat = place[np.concatenate(held)]
                owner = np.repeat(np.arange(len(rows)), [len(c) for c in held])[flat >= 0]
                flat = flat[flat >= 0]
                z = bias + np.bincount(owner, weights=w[flat], minlength=len(rows))
                error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[rows]) / len(rows)
                g = np.bincount(flat, weights=error[owner], minlength=len(seen)) + self.l2 * w
                mentions = np.bincount(flat, minlength=len(seen))
                for word, own, term in groups:
                    # A swap changes the score by the difference of two terms, leaving one out by its own part.
                    x = np.bincount(term, weights=w[own], minlength=len(word))
                    push = self.swap * (mentions[word] + 1.0 / n) / len(rows) * (x - x.mean() + x)
                    np.add.at(g, own, push[term])
                step += 1
                m = 0.9 * m + 0.1 * g
                v = 0.999 * v + 0.001 * g * g
                gb = error.sum()
                mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
                a, c = 1 - 0.9**step, 1 - 0.999**step
                pace = rate / (np.sqrt(v / c) + 1e-8)
                w -= pace * (m / a)
                w = np.sign(w) * np.maximum(np.abs(w) - np.minimum(pace, 1e3 * rate) * self.l1 / n**0.5, 0)
                bias -= rate * (mb / a) / (np.sqrt(vb / c) + 1e-8)
        self.w[seen], self.bias = w, float(bias)
        return self

    def score(self, cells: np.ndarray) -> float:
        z = self.bias + self.w[cells].sum()
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def train(docs: DataFrame, labels: DataFrame, most: int = 20_000, **options) -> Classifier:
    """Fit on at most ``most`` labelled documents.

    The sample's ids are broadcast (``most`` rows at most), so that only its
    documents leave the scan, as word cells. They come to the driver a part
    after the other and go to a file there, so that its memory does not follow
    the length of the texts.
    """
    picked = stored(sample_labels(labels, most), "label-sample")
    rows = docs.select("doc_id", whole("text").alias("text")).join(F.broadcast(picked), "doc_id")

    def cells(batches):
        for frame in batches:
            yield pd.DataFrame({"doc_id": frame["doc_id"], "toxic": frame["toxic"], "cells": [features(t).astype("<i4").tobytes() for t in frame["text"]]})

    made = rows.select("doc_id", "toxic", "text").mapInPandas(cells, "doc_id long, toxic int, cells binary")
    parts = made.repartition(PARTS, "doc_id").dropDuplicates(["doc_id"])
    sample = Spooled(parts.toLocalIterator())
    return Classifier(**options).fit(sample, sample.labels)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, most: int = 20_000, **options) -> DataFrame:
    """Score every whole text: ``doc_id``, ``held_out``, ``score``, ``predicted``.

    Labels are learned only from rows that are not held out, from a seeded
    sample of at most ``most``; the text alone is scored. Null and empty texts
    get the score of no words. Null labels are not used; without labels every
    score is one half. Repeated rows are scored alike. Other columns are
    ignored; no rows give no rows.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, most, **options))

    def run(batches):
        c = model.value
        for frame in batches:
            made = frame[["doc_id", "held_out"]].reset_index(drop=True)
            yield made.assign(doc_id=made["doc_id"].astype("Int64"), score=[c.score(features(t)) for t in frame["text"]])

    rows = docs.select("doc_id", (~train_part()).alias("held_out"), whole("text").alias("text"))
    scored = rows.mapInPandas(run, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {"op10_toxicity": op10_toxicity}
SQL: dict[str, str] = {}
