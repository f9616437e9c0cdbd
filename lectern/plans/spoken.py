"""Words of videos as packs of bytes, and the rows that meet them.

A row per word costs the same at every step it takes, so words take one step as
rows: a task packs those it has at hand, batch by batch, and what follows moves
a pack's columns as bytes and reads those of a batch as arrays. A pack holds
words of one video from one stretch of ``STRETCH`` indices and one span of
``SPAN_S`` seconds, so rows that ask by time meet packs by span and rows that
ask by index meet them by stretch; a long video spreads over tasks either way.
Packs of one group may be many and in any order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lectern import session
from lectern.plans.packs import changes, nullable

#: Words of a video, and seconds of it, that are looked up together.
STRETCH = 1024
SPAN_S = 512
#: Spans from here on, and times that are no number, count as one.
FAR = 10**15


def _bytes(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """The values between the cuts, as bytes."""
    offsets = (cuts * values.itemsize).astype("int32")
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def _steps(values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Each value less the one before it; the first after a cut as it is. Regular values become equal ones."""
    out = values.copy()
    out[1:] -= values[:-1]
    out[cuts[:-1]] = values[cuts[:-1]]
    return out


def _millis(t: np.ndarray) -> np.ndarray | None:
    """Whole milliseconds that give back just these seconds, or None."""
    k = np.rint(t * 1000)
    return k.astype("int32") if (np.abs(k) < 2**30).all() and (k / 1000 == t).all() and not np.signbit(t[t == 0]).any() else None


def _numbers(c: pa.Array) -> np.ndarray:
    """The values, 0 for null."""
    return (c.fill_null(0) if c.null_count else c).to_numpy(zero_copy_only=False)


def _nulls(c: pa.Array) -> np.ndarray | None:
    return c.is_null().to_numpy(zero_copy_only=False) if c.null_count else None


def packs(words: DataFrame, key: str) -> DataFrame:
    """Words (``word_idx``, ``word``, ``start_s``, ``end_s``) in packs, written once: key, stretch, span, number and bytes.

    Words without an index have no stretch, those without a start no span.
    """
    rows = words.select(
        key, F.col("word_idx").cast("long").alias("i"), F.col("word").cast("string").alias("w"), F.col("start_s").cast("double").alias("a"), F.col("end_s").cast("double").alias("z")
    )
    longs = [T.StructField(c, T.LongType()) for c in ("stretch", "span", "n", "low")]
    bytes_ = [T.StructField(c, T.BinaryType()) for c in ("idx", "a", "z", "len", "text", "no_word", "no_end")]
    schema = T.StructType([T.StructField(key, nullable(rows.schema[key].dataType)), *longs, T.StructField("millis", T.BooleanType()), *bytes_])
    as_arrow = to_arrow_schema(schema)

    def grouped(t: pa.Table) -> tuple[pa.Table, np.ndarray]:
        i, a = t["i"].combine_chunks(), t["a"].combine_chunks()
        span = np.fmin(np.floor(_numbers(a) / SPAN_S), FAR)
        t = t.append_column("stretch", pa.array(np.floor_divide(_numbers(i), STRETCH), mask=_nulls(i)))
        t = t.append_column("span", pa.array(np.maximum(span, -FAR).astype("int64"), mask=_nulls(a)))
        by = [key, "stretch", "span"]
        cuts = np.flatnonzero(changes(t, by)) + 1
        if len(cuts) > 16 + t.num_rows // 64:
            t = t.take(pc.sort_indices(t, sort_keys=[(c, "ascending") for c in by]))
            cuts = np.flatnonzero(changes(t, by)) + 1
        return t, np.array([0, *cuts, t.num_rows], dtype="int64")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            t, cuts = grouped(pa.Table.from_batches([batch]))
            col = {c: t[c].combine_chunks() for c in t.column_names}
            firsts = pa.array(cuts[:-1])
            i, a, z = (_numbers(col[c]) for c in "iaz")
            ka, kz = _millis(a), _millis(z)
            millis = ka is not None and kz is not None
            word = col["w"].fill_null("") if col["w"].null_count else col["w"]
            text = pc.binary_join(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), word), " ")
            made = {c: col[c].take(firsts) for c in (key, "stretch", "span")}
            made |= {"n": pa.array(np.diff(cuts)), "low": pa.array(i[cuts[:-1]]), "millis": pa.array([millis] * len(firsts)), "idx": _bytes(_steps(i, cuts), cuts)}
            made |= {"a": _bytes(_steps(ka, cuts) if millis else a, cuts), "z": _bytes(_steps(kz, cuts) if millis else z, cuts)}
            # a space after the last word, too, so that texts follow on one another
            made |= {"len": _bytes(pc.binary_length(word).to_numpy(zero_copy_only=False), cuts), "text": pc.binary_join_element_wise(text, "", " ").view(pa.binary())}
            for name, c in (("no_word", "w"), ("no_end", "z")):
                made[name] = _bytes(_nulls(col[c]).view("uint8"), cuts) if col[c].null_count else pa.nulls(len(firsts), pa.binary())
            yield pa.RecordBatch.from_arrays([made[f.name].cast(f.type) for f in as_arrow], schema=as_arrow)

    return session.written(rows.mapInArrow(pack, schema), "words")


def _values(c: pa.Array, kind: str) -> np.ndarray:
    """What the rows' bytes hold, one after the other."""
    ends = np.frombuffer(c.buffers()[1], "int32", len(c) + 1, c.offset * 4) if len(c) else [0, 0]
    size = int(ends[-1] - ends[0])
    return np.frombuffer(c.buffers()[2], kind, size // np.dtype(kind).itemsize, int(ends[0])) if size else np.array([], kind)


def _summed(steps: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Values from their steps, for packs of ``n``."""
    out = np.cumsum(steps, dtype="int64")
    first = np.cumsum(n) - n
    return out - np.repeat(out[first] - steps[first], n)


class _Words:
    """The words of some packs, in their order; ``group`` tells the group of each."""

    def __init__(self, rows: pa.Table, group: np.ndarray):
        self.rows, self.n = {c: rows[c].combine_chunks() for c in rows.column_names}, rows["n"].to_numpy()
        self.group = np.repeat(group, self.n)
        self.idx = _summed(_values(self.rows["idx"], "int64"), self.n)
        self.a = self.times("a")

    def times(self, name: str) -> np.ndarray:
        millis = self.rows["millis"].to_numpy(zero_copy_only=False).astype(bool)
        out, of = np.empty(int(self.n.sum())), np.repeat(millis, self.n)
        if millis.any():
            out[of] = _summed(_values(self.rows[name].filter(pa.array(millis)), "int32"), self.n[millis]) / 1000
        if not millis.all():
            out[~of] = _values(self.rows[name].filter(pa.array(~millis)), "float64")
        return out

    def marks(self, name: str) -> np.ndarray:
        c, out = self.rows[name], np.zeros(int(self.n.sum()), bool)
        some = c.is_valid().to_numpy(zero_copy_only=False)
        out[np.repeat(some, self.n)] = _values(c.filter(pa.array(some)), "uint8").view(bool)
        return out


def _bounds(group: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Where each of ``count`` groups begins and ends among ascending ones."""
    return np.searchsorted(group, np.arange(count), "left"), np.searchsorted(group, np.arange(count), "right")


def _groups(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[tuple[pa.Table, np.ndarray, pa.Table, np.ndarray, int]]:
    """Sorted rows, packs (``__kind`` 0) before others: packs, their groups, others, their groups, and how many groups are complete.

    The last group of a batch may go on in the next one, which gets its packs again.
    """
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        t = (t if held is None else pa.concat_tables([held, t])).combine_chunks()
        group = np.append(0, np.cumsum(changes(t, by)))
        other = t["__kind"].to_numpy() == 1
        found, of = t.filter(pa.array(~other)), group[~other]
        yield found, of, t.filter(pa.array(other)), group[other], int(group[-1])
        held = found.slice(int(np.searchsorted(of, group[-1])))
    if held is not None and held.num_rows:
        yield held, np.zeros(held.num_rows, "int64"), held.slice(0, 0), np.array([], "int64"), 1


def _met(have: DataFrame, others: DataFrame, by: list[str]) -> DataFrame:
    """Packs and the rows that ask them, group by group."""
    both = have.withColumn("__kind", F.lit(0)).unionByName(others.withColumn("__kind", F.lit(1)), allowMissingColumns=True)
    return both.repartition(*by).sortWithinPartitions(*by, "__kind", "low")


def _starts(w: _Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The starts that occur in each group, ascending, the lowest index at each, and the groups."""
    t, i, g = w.a, w.idx, w.group
    if not ((t[1:] > t[:-1]) | (g[1:] > g[:-1])).all():
        order = np.lexsort((i, t, g))
        t, i, g = t[order], i[order], g[order]
        # NaN, after all others, differs from itself
        first = np.append(True, (g[1:] != g[:-1]) | ((t[1:] != t[:-1]) & ~(np.isnan(t[1:]) & np.isnan(t[:-1]))))
        t, i, g = t[first], i[first], g[first]
    return t, i, g


def _last_until(s: np.ndarray, e: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """For each ``e`` the last place from ``low`` to before ``high`` with ``s <= e``, or ``low - 1``."""
    lo, hi = low.copy(), high.copy()
    while (left := lo < hi).any():
        mid = (lo + hi) // 2
        up = left & (s[np.where(left, mid, 0)] <= e)
        lo, hi = np.where(up, mid + 1, lo), np.where(left & ~up, mid, hi)
    return lo - 1


def _closest(s: np.ndarray, i: np.ndarray, e: np.ndarray, low: np.ndarray, high: np.ndarray) -> pa.Array:
    """Index of the word closest to each ``e``, the lower one of two; null without one on both sides, from ``low`` to before ``high``."""
    p = _last_until(s, e, low, high)
    no = (p < low) | (p + 1 >= high)
    p = np.where(no, len(s), p)
    s, i = np.append(s, [0.0, 0.0]), np.append(i, [0, 0])
    before, after = np.abs(e - s[p]), np.abs(s[p + 1] - e)
    return pa.array(np.where(after < before, i[p + 1], np.where(before < after, i[p], np.minimum(i[p], i[p + 1]))), mask=no)


def _span(t: Column) -> Column:
    return F.when(t.isNotNull(), F.floor(F.greatest(F.lit(-float(FAR)), F.least(F.lit(float(FAR)), t / SPAN_S))))


def nearest_in_span(packs: DataFrame, rows: DataFrame, key: str, first: str, last: str) -> DataFrame:
    """Rows (in ``__row``, without the key) with ``__i`` and ``__j``, the indices of the words closest to the times ``first`` and ``last``.

    Each is null where not both sides have words of the time's span. A row with
    times of two spans comes twice; ``__asks`` is 0 if for the first time, 1 for
    the last, 2 for both. Rows without ``__row`` are the first and the last word of each span (``__t``,
    ``__i``): all that times of other spans can ask for. Written.
    """
    t, u = F.col(first).cast("double"), F.col(last).cast("double")
    none = F.lit(None).cast("double")

    def ask(which: int, span: Column, t: Column, u: Column) -> Column:
        return F.struct(F.lit(which).alias("__asks"), span.alias("span"), t.alias("__t"), u.alias("__u"))

    apart = F.array(ask(0, _span(t), t, none), ask(1, _span(u), none, u))
    where = F.when(_span(t).eqNullSafe(_span(u)), F.array(ask(2, _span(t), t, u))).otherwise(apart)
    asks = rows.select(key, F.struct(*[c for c in rows.columns if c != key]).alias("__row"), F.inline(where))
    have = packs.where(F.col(key).isNotNull() & F.col("span").isNotNull() & F.col("stretch").isNotNull()).select(key, "span", "n", "low", "millis", "idx", "a")
    types = {f.name: nullable(f.dataType) for f in asks.schema.fields}
    schema = T.StructType([T.StructField(key, types[key]), T.StructField("__t", T.DoubleType()), T.StructField("__i", T.LongType()), T.StructField("__j", T.LongType()), T.StructField("__asks", T.IntegerType()), T.StructField("__row", types["__row"])])
    as_arrow = to_arrow_schema(schema)

    def sent(*cols: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(cols, as_arrow)], schema=as_arrow)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found, of, others, group, done in _groups(batches, [key, "span"]):
            s, i, g = _starts(_Words(found, of))
            begin, end = _bounds(g, done + 1)
            some = np.flatnonzero(end[:done] > begin[:done])
            if len(some):
                places = np.stack([begin[some], end[some] - 1], 1).ravel()
                k = found[key].combine_chunks().take(pa.array(np.repeat(np.searchsorted(of, some), 2)))
                yield sent(k, pa.array(s[places]), pa.array(i[places]), pa.nulls(len(k)), pa.nulls(len(k)), pa.nulls(len(k), as_arrow.field(5).type))
            if not others.num_rows:
                continue
            low, high = begin[group], end[group]
            ij = (_closest(s, i, others[c].to_numpy(), low, high) for c in ("__t", "__u"))
            yield sent(*(others[c].combine_chunks() for c in (key, "__t")), *ij, *(others[c].combine_chunks() for c in ("__asks", "__row")))

    return session.written(_met(have, asks, [key, "span"]).mapInArrow(meet, schema), "near")


_SAID = [T.StructField("__n", T.LongType()), T.StructField("__text", T.StringType()), *[T.StructField(c, T.DoubleType()) for c in ("__a", "__z", "__start", "__end")]]


def _said(w: _Words, lo: np.ndarray, hi: np.ndarray, group: np.ndarray) -> list[pa.Array]:
    """What ``said`` adds."""
    if not len(w.idx):
        return [pa.array(np.zeros(len(lo), "int64")), pa.array([""] * len(lo)), *[pa.nulls(len(lo), pa.float64())] * 4]
    z, no_word, no_end = w.times("z"), w.marks("no_word"), w.marks("no_end")
    no_start = np.repeat(w.rows["span"].is_null().to_numpy(zero_copy_only=False), w.n)
    text = _values(w.rows["text"], "uint8").tobytes()
    ends = np.cumsum(_values(w.rows["len"], "int32").astype("int64") + 1) - 1
    begins = np.append(0, ends[:-1] + 1)
    count = int(max(group[-1], w.group[-1])) + 1
    left, right = _bounds(w.group, count)
    low = w.idx[np.where(right > left, left, 0)]
    size, base = (right - left)[group], left[group]
    p = np.clip(lo - low[group], 0, size)
    q = np.maximum(np.clip(hi - low[group] + 1, 0, size), p)
    some = q > p
    first, last = np.where(some, base + p, 0), np.where(some, base + q - 1, 0)
    cut = [text[x:y] for x, y in zip(begins[first].tolist(), np.where(some, ends[last], begins[first]).tolist())]
    no_a, no_z = ~some | no_start[first], ~some | no_end[last]
    out = [pa.array(q - p), pa.array(cut, pa.binary()).view(pa.string()), pa.array(w.a[first], mask=no_a), pa.array(z[last], mask=no_z)]
    out += [pa.array(w.a[first], mask=no_a | (w.idx[first] != lo)), pa.array(z[last], mask=no_z | (w.idx[last] != hi))]
    # groups in which a word is missing, repeated or null are read row by row
    odd = np.zeros(count, bool)
    odd[w.group[no_word]] = True
    odd[w.group[1:][(w.group[1:] == w.group[:-1]) & (w.idx[1:] - w.idx[:-1] != 1)]] = True
    if not odd[group].any():
        return out
    parts, place, rows = [], 0, _bounds(group, count)
    for g in np.flatnonzero(odd):
        x, y, u, v = int(rows[0][g]), int(rows[1][g]), int(left[g]), int(right[g])
        if x == y:
            continue
        words = [None if no else text[m:n] for m, n, no in zip(begins[u:v].tolist(), ends[u:v].tolist(), no_word[u:v].tolist())]
        times = ([None if no else t for t, no in zip(c[u:v].tolist(), m[u:v].tolist())] for c, m in ((w.a, no_start), (z, no_end)))
        parts += [[c.slice(place, x - place) for c in out], _said_of_any(w.idx[u:v].tolist(), words, *times, lo[x:y], hi[x:y])]
        place = y
    parts.append([c.slice(place) for c in out])
    return [pa.concat_arrays(c) for c in zip(*parts)]


def _said_of_any(index: list[int], word: list, a: list, z: list, lo: np.ndarray, hi: np.ndarray) -> list[pa.Array]:
    """The same for the words of one group, in any order, with gaps, repeats or nulls."""

    def rank(x: float | None) -> tuple:
        return (0, 0.0) if x is None else (2, 0.0) if x != x else (1, x)

    def most(values: list[float | None]) -> float | None:
        return max(values, key=rank, default=None)

    rows = sorted(zip(index, word, a, z), key=lambda r: (r[0], r[1] or b"", rank(r[2]), rank(r[3])))
    idx = np.array([r[0] for r in rows])
    out = []
    for x, y, left, right in zip(lo.tolist(), hi.tolist(), np.searchsorted(idx, lo, "left").tolist(), np.searchsorted(idx, hi, "right").tolist()):
        inside = rows[left:right]
        heard = [r for r in inside if r[1] is not None]
        start, end = most([r[2] for r in inside if r[0] == x]), most([r[3] for r in inside if r[0] == y])
        out.append((len(heard), b" ".join(r[1] for r in heard), heard[0][2] if heard else None, heard[-1][3] if heard else None, start, end))
    types = [pa.int64(), pa.binary(), *[pa.float64()] * 4]
    cols = [pa.array([r[k] for r in out], t) for k, t in enumerate(types)]
    return [cols[0], cols[1].view(pa.string()), *cols[2:]]


def said(packs: DataFrame, ranges: DataFrame, key: str, first: str, last: str) -> DataFrame:
    """Ranges, which lie by ``stretch``, with what words of that stretch from ``first`` to ``last`` say. Written.

    ``__n`` words that are not null make ``__text``; ``__a`` is where the first
    of them starts, ``__z`` where the last one ends; ``__start`` is where word
    ``first`` starts, ``__end`` where word ``last`` ends.
    """
    have = packs.where(F.col(key).isNotNull() & F.col("stretch").isNotNull())
    columns = ranges.columns
    schema = T.StructType([*[T.StructField(f.name, nullable(f.dataType)) for f in ranges.schema.fields], *_SAID])
    as_arrow = to_arrow_schema(schema)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found, of, others, group, _ in _groups(batches, [key, "stretch"]):
            if others.num_rows:
                made = _said(_Words(found, of), others[first].to_numpy(), others[last].to_numpy(), group)
                cols = [others[c].combine_chunks() for c in columns] + made
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(cols, as_arrow)], schema=as_arrow)

    return session.written(_met(have, ranges, [key, "stretch"]).mapInArrow(meet, schema), "said")
