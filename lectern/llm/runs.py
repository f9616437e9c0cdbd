"""Periodic runs of words: a stretch that repeats itself at least a given number of times."""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.common import table, whole
from lectern.llm.shingles import MIX

SPACE = "[\\x20\\x09-\\x0D]+"
#: Bytes of text that are looked through at once.
SLICE_BYTES = 4_000_000


def suffix_array(ids: np.ndarray) -> np.ndarray:
    """Order of the suffixes of dense word ids, by doubling; only ties are sorted again."""
    n = len(ids)
    rank = ids.astype(np.int64) + 1
    order = np.argsort(rank, kind="stable")
    width = 1
    while True:
        # rank: 1 + place of the first suffix of the tie, so that settled ones keep theirs
        first = np.empty(n, bool)
        first[0] = True
        key = rank[order]
        if width > 1:
            first[1:] = (key[1:] != key[:-1]) | (second[order][1:] != second[order][:-1])
        else:
            first[1:] = key[1:] != key[:-1]
        start = np.maximum.accumulate(np.where(first, np.arange(n), 0))
        rank = np.empty(n, np.int64)
        rank[order] = start + 1
        if first.all() or width > n:
            return order
        tied = ~(first & np.append(first[1:], True))
        at = order[tied]
        second = np.zeros(n, np.int64)
        second[: max(n - width, 0)] = rank[width:]
        order[tied] = at[np.lexsort((second[at], rank[at]))]
        width *= 2


def common_prefixes(ids: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each suffix in order with the one before it."""
    n = len(ids)
    before = np.empty(n, np.int64)
    before[order[0]] = -1
    before[order[1:]] = order[:-1]
    w = ids.tolist()
    w.append(-1)  # ends every comparison: of two suffixes one gets here first
    out, size = [0] * n, 0
    for i, j in enumerate(before.tolist()):
        if j < 0:
            size = 0
            continue
        while w[i + size] == w[j + size]:
            size += 1
        out[i] = size
        if size:
            size -= 1
    return np.array(out, np.int64)[order]


class Node:
    """Suffixes below an interval: all places, and places by the word to their left, both sorted."""

    __slots__ = ("all", "by")

    def __init__(self, place: int, left: int):
        self.all, self.by = [place], {left: [place]}

    def merge(self, other: Node) -> Node:
        small, large = (self, other) if len(self.all) < len(other.all) else (other, self)
        large.all = _merged(large.all, small.all)
        for left, places in small.by.items():
            have = large.by.get(left)
            large.by[left] = places if have is None else _merged(have, places)
        return large


def _merged(large: list[int], small: list[int]) -> list[int]:
    if len(small) > len(large):
        large, small = small, large
    if len(small) * 16 > len(large):
        large += small
        large.sort()
    else:
        for x in small:
            insort(large, x)
    return large


def _pairs(one: Node, two: Node, size: int, near: int, far: int) -> Iterator[tuple[int, int]]:
    """Places (p, p') of both sides with unlike left words and ``near <= |p - p'| <= far``.

    The smaller side asks; each place looks at the places nearby or at the
    left-word classes, whichever are fewer.
    """
    if len(one.all) > len(two.all):
        one, two = two, one
    for left, places in one.by.items():
        same = two.by.get(left)
        for p in places:
            lo, hi = bisect_left(two.all, p - far), bisect_right(two.all, p + far)
            if lo == hi:
                continue
            if hi - lo <= len(two.by):
                known = same or ()
                for x in two.all[lo:hi]:
                    if abs(x - p) >= near:
                        i = bisect_left(known, x)
                        if i == len(known) or known[i] != x:
                            yield p, x
            else:
                for other, at in two.by.items():
                    if other != left:
                        for x in at[bisect_left(at, p - far) : bisect_right(at, p + far)]:
                            if abs(x - p) >= near:
                                yield p, x


def word_runs(words: list, min_words: int = 24, min_repeats: int = 3) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start and period.

    A run is a maximal pair: two places ``period`` apart whose common stretch of
    ``size`` words goes on neither to the left (unlike left words) nor to the
    right (unlike children of an interval of common prefixes). It is as long as
    ``size + period``, so ``period <= size / (min_repeats - 1)`` and
    ``period >= min_words - size`` leave exactly the runs and, for multiples of
    a run's period, the same stretch again, of which the least period counts.
    """
    n = len(words)
    least = -(-min_words * (min_repeats - 1) // min_repeats)  # shortest common stretch a run can have
    if n < max(min_words, min_repeats):
        return []
    number: dict = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    order = suffix_array(ids)
    sizes = common_prefixes(ids, order).tolist()
    places = order.tolist()
    left = [-1, *ids[:-1].tolist()]
    found: dict[tuple[int, int], int] = {}

    def meet(one: Node, two: Node, size: int) -> Node:
        near, far = max(1, min_words - size), size // (min_repeats - 1)
        if near <= far:
            for p, x in _pairs(one, two, size, near, far):
                first, period = min(p, x), abs(p - x)
                key = (first, size + period)
                if found.get(key, n) > period:
                    found[key] = period
        return one.merge(two)

    # Intervals still open, outermost first: (common prefix, what is below). Those
    # shorter than ``least`` hold no run and are not kept.
    open_: list[tuple[int, Node]] = []
    for place, size in zip(places, [*sizes[1:], 0], strict=True):
        if not open_ and size < least:
            continue
        below = Node(place, left[place])
        while open_ and open_[-1][0] > size:
            height, node = open_.pop()
            below = meet(node, below, height)
        if size >= least:
            if open_ and open_[-1][0] == size:
                below = meet(open_.pop()[1], below, size)
            open_.append((size, below))
    return sorted((start, length, period) for (start, length), period in found.items())


def _suspects(parts: list[list[bytes]], least: int) -> np.ndarray:
    """Texts that hold some ``least`` words twice; the others have no run."""
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    n = int(sizes.sum())
    h = np.fromiter((xxhash.xxh64_intdigest(w) for words in parts for w in words), np.uint64, n)
    owner = np.repeat(np.arange(len(parts)), sizes)
    h ^= (owner.astype(np.uint64) + np.uint64(1)) * MIX
    width = 1
    while width < least:
        step = min(width, least - width)
        # words from i on and from i + step on cover width + step together
        if n <= step:
            return np.zeros(0, np.int64)
        h = (h[:-step] * MIX) ^ (h[step:] + np.uint64(width))
        h ^= h >> np.uint64(29)
        h *= MIX
        n -= step
        width += step
    ordered = np.sort(h)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(twice, h), len(twice) - 1)
    return np.unique(owner[: len(h)][twice[at] == h])


def _kept(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    return [w for w, x in zip(words, np.cumsum(gone[:-1]).tolist(), strict=True) if not x]


def periodic_runs(docs: DataFrame, min_words: int = 24, min_repeats: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Runs of words in each whole text, and the text with each run's repeats taken out.

    Words are what ASCII white space separates. A run is a stretch of at least
    ``min_words`` words and ``min_repeats`` (2 or more) periods in which words
    ``period`` apart are equal, for its least period, and that no neighbouring
    word extends. A word goes when a run holds it after that run's first
    period. Texts are worked one by one where they are, with no shuffle; only
    texts that hold some stretch twice build a tree of common prefixes.

    Returns one row per input row: the id, ``n_words``, ``runs`` (array of
    start, length, period, by start and period), ``collapsed`` (kept words
    joined by one space). Null, empty and blank texts have no words and no runs.
    Repeated rows each get their own; other columns are ignored.
    """
    least = -(-min_words * (min_repeats - 1) // min_repeats)
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        as_text = pc.CastOptions(target_type=pa.string(), allow_invalid_utf8=True)
        for batch in batches:
            at = 0
            texts = batch["text"].to_pylist()
            while at < len(texts):
                end, size = at, 0
                while end < len(texts) and (end == at or size + len(texts[end] or b"") <= SLICE_BYTES):
                    size += len(texts[end] or b"")
                    end += 1
                # bytes.split() takes exactly ASCII white space
                parts = [(t or b"").split() for t in texts[at:end]]
                runs: list[list[tuple[int, int, int]]] = [[] for _ in parts]
                kept = [b" ".join(words) for words in parts]
                for i in _suspects(parts, least).tolist():
                    runs[i] = word_runs(parts[i], min_words, min_repeats)
                    if runs[i]:
                        kept[i] = b" ".join(_kept(parts[i], runs[i]))
                rows = [[{"start": s, "length": n, "period": p} for s, n, p in r] for r in runs]
                yield pa.record_batch(
                    [batch["id"].slice(at, end - at), pa.array([len(p) for p in parts], pa.int64()), pa.array(rows, run_type), pc.cast(pa.array(kept, pa.binary()), options=as_text)],
                    names=["id", "n_words", "runs", "collapsed"],
                )
                at = end

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    work_on = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    return work_on.mapInArrow(work, schema).withColumnRenamed("id", id_col)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """A tenth of the texts, by a checksum of the id, repeat themselves from some word on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")
    words = F.when(h % 10 == 0, F.array_remove(F.split(whole("text"), SPACE, -1), ""))
    d = docs.select("doc_id", "text", words.alias("words"), g.alias("g"))
    n = F.size("words").cast("long")
    a = F.when(n > 0, F.col("g") % n).cast("int")
    p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + F.col("g") % 8))).cast("int")
    d = d.select("doc_id", "text", "words", n.cast("int").alias("n"), a.alias("a"), p.alias("p"))
    turns = F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")
    again = F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), turns))
    new = F.concat(F.slice("words", F.lit(1), F.col("a")), F.slice(again, F.lit(1), F.col("n") - F.col("a")))
    return d.select("doc_id", F.when(F.col("n") > 0, F.array_join(new, " ")).otherwise(F.col("text")).alias("text"))


def _greatest(runs: Column) -> Column:
    """The run with the greatest length / period, compared exactly; of equal ones the first in order."""
    best = F.aggregate(
        F.slice(runs, 2, F.greatest(F.size(runs), F.lit(1))),
        F.get(runs, F.lit(0)),
        lambda a, x: F.when(x["length"] * a["period"] > a["length"] * x["period"], x).otherwise(a),
    )
    return F.when(F.size(runs) > 0, best)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_planted_runs(table(spark, sf_dir, "documents")))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = F.col("best")
    return found.select("*", _greatest(F.col("runs")).alias("best")).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.expr("1000 * best.length DIV best.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


#: Maximal repetitions are not SQL; tests hold the query against a version that tries every period.
SQL = {}
QUERIES = {"op12_periodic_runs": op12_periodic_runs}
