"""A hierarchical Pitman-Yor language model over words."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.common import brief_shuffles, dropped, stored_by, table, whole
from lectern.llm.shingles import MIX
from lectern.session import written

# Tokens (some) of a stretch of texts whose pairs are counted at a time, and of the training texts in a bucket.
CHUNK, BUCKET = 1_000_000, 2_000_000
# Texts are scored in so many slices of the buckets, one after the other.
SLICES = 2
# Words are coded: frequent ones by their place in a list, all others by a hash with the top bit set.
START, END, FIRST, COLD = 0, 1, 2, np.uint64(1 << 63)
# Longer words are hashed one by one, others in windows of bytes.
LONG, WINDOW = 64, 1 << 17
RANGE = 2048
PACK = "kind int, bucket long, frm long, k binary, x binary, y binary, z binary, v binary"
COLUMNS = [c.split()[0] for c in PACK.split(", ")]
# Kinds of packs: cells, those seated again, words, contexts, messages between buckets, sums, texts.
CELLS, MANY, WORDS, ASKS, HOT_U, HOT_W, SUMS, STATS, CUSTOMERS, PARENT, TABLES, KEPT, CONTEXTS, ANSWERS, POSTS, UNSEEN, DOCS, DIGESTS = range(18)


def held_out(id_col: str, parts: int) -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % parts == 1


def _hashing():
    """A random number per byte (A-Z as a-z), white space, and the powers of an odd number and of its inverse."""
    values = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    values[65:91] = values[97:123]
    blank = np.zeros(256, dtype=bool)
    blank[[9, 10, 11, 12, 13, 32]] = True
    odd = 0x9E3779B97F4A7C13
    powers = [np.cumprod(np.full(WINDOW + LONG, p, dtype=np.uint64)) for p in (odd, pow(odd, -1, 1 << 64))]
    return values, blank, *powers


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * MIX
    return x ^ (x >> np.uint64(32))


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts in order, with the top bit set, and how many words each text has."""
    values, blank, powers, inverse = _hashing()
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    at = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(texts) or at[0] == at[-1]:
        return np.empty(0, dtype=np.uint64), np.zeros(len(texts), dtype=np.int64)
    data = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[at[0] : at[-1]]
    at = at - at[0]
    word = ~blank[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[at] = True
    first, last = word & edge[:-1], word & edge[1:]
    first[1:] |= word[1:] & ~word[:-1]
    last[:-1] |= word[:-1] & ~word[1:]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    out = np.empty(len(start), dtype=np.uint64)
    lengths = end - start
    cuts = np.searchsorted(start, np.arange(0, len(data) + WINDOW, WINDOW))
    for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        if a < b:
            lo = i * WINDOW
            part = values[data[lo : lo + WINDOW + LONG]] * powers[: len(data) - lo]
            total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(part)])
            s = start[a:b] - lo
            e = np.minimum(s + np.minimum(lengths[a:b], LONG), len(part))
            out[a:b] = (total[e] - total[s]) * inverse[s]
    out = _mixed(out + lengths.astype(np.uint64))
    for i in np.flatnonzero(lengths > LONG):
        out[i] = xxhash.xxh64_intdigest(data[start[i] : end[i]].tobytes().lower())
    return out | COLD, np.diff(np.searchsorted(start, at))


def _coded(hashes: np.ndarray, listed: np.ndarray) -> np.ndarray:
    if not len(listed):
        return hashes
    at = np.minimum(np.searchsorted(listed, hashes), len(listed) - 1)
    return np.where(listed[at] == hashes, (at + FIRST).astype(np.uint64), hashes)


def _with_context(texts: pa.Array, listed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word before, word, number of the text) of each token: START comes before the first word, END after the last."""
    hashes, counts = _words(texts)
    ends = np.cumsum(counts + 1) - 1
    w = np.empty(len(hashes) + len(counts), dtype=np.uint64)
    inner = np.ones(len(w), dtype=bool)
    inner[ends] = False
    w[inner], w[ends] = _coded(hashes, listed), END
    u = np.empty_like(w)
    u[1:] = w[:-1]
    u[ends - counts] = START
    return u, w, np.repeat(np.arange(len(counts)), counts + 1)


def _pair(u: np.ndarray, w: np.ndarray, salt: int = 0) -> np.ndarray:
    x = (u + np.uint64(salt)) * MIX
    x ^= x >> np.uint64(29)
    x = (x ^ w) * MIX
    return x ^ (x >> np.uint64(32))


def _home(x: np.ndarray, buckets: int) -> np.ndarray:
    return ((x * MIX) >> np.uint64(33)) % np.uint64(buckets)


def _by_home(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The homes of keys, and an order by home that keeps that of the keys within each."""
    home = _home(keys, buckets)
    return home, np.argsort(home.astype(np.uint16) if buckets <= 1 << 16 else home, kind="stable")


def _place(u: np.ndarray, w: np.ndarray, buckets: int) -> np.ndarray:
    """A cell lies with its word, or, since that may be most of all, by its pair where the word is listed."""
    return _home(np.where(w < COLD, _pair(u, w), w), buckets)


def _in_places(w: np.ndarray, place: np.ndarray) -> np.ndarray:
    """An order that puts cells of a place together, and there those of a word, which compress."""
    return np.argsort((place << np.uint64(48)) | np.where(w < COLD, w, w >> np.uint64(16)))


def _to_bytes(codes: np.ndarray) -> bytes:
    """Two bytes for most listed words and eight for others, in columns that compress."""
    parts = codes.astype("<u8").view("<u2").reshape(-1, 4)
    cold = codes >= COLD
    high = np.where(cold, 0xFFFF, parts[:, 1]).astype("<u2")
    return b"".join(x.tobytes() for x in (parts[:, 0], high, parts[cold][:, 1:]))


def _to_codes(raw: bytes, n: int) -> np.ndarray:
    x = np.frombuffer(raw, dtype="<u2")
    out = np.zeros((n, 4), dtype="<u2")
    out[:, 0], out[:, 1] = x[:n], x[n : 2 * n]
    out[out[:, 1] == 0xFFFF, 1:] = x[2 * n :].reshape(-1, 3)
    return out.reshape(-1).view("<u8")


def _firsts(*sorted_by: np.ndarray) -> np.ndarray:
    if not len(sorted_by[0]):
        return np.empty(0, dtype=np.int64)
    new = np.ones(len(sorted_by[0]), dtype=bool)
    new[1:] = np.logical_or.reduce([x[1:] != x[:-1] for x in sorted_by])
    return np.flatnonzero(new)


def _sorted(by: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
    order = np.argsort(by)
    return [v[order] for v in values]


def _sums(keys: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
    """Distinct keys in order, and the sums of the values of each."""
    order = np.argsort(keys)
    at = _firsts(keys[order])
    return [keys[order][at], *[np.add.reduceat(v[order], at) if len(at) else v[:0] for v in values]]


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the sorted keys hold what is wanted, and whether they do."""
    if not len(keys):
        return np.zeros(len(wanted), dtype=np.int64), np.zeros(len(wanted), dtype=bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def _ints(x: np.ndarray) -> bytes:
    """Integers in as few bytes each as the largest needs, after that number."""
    most = max(int(x.max(initial=0)), -1 - int(x.min(initial=0)))
    size = next(i for i in (1, 2, 4, 8) if most < 1 << (8 * i - 1))
    return bytes([size]) + x.astype(f"<i{size}").tobytes()


def _from_ints(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, dtype=f"<i{raw[0]}", offset=1).astype(np.int64)


def _row(kind: int, bucket: int, frm: int = 0, *columns: np.ndarray | bytes | None) -> tuple:
    cells = [x if x is None or isinstance(x, bytes) else _ints(x) if x.dtype == np.int64 else x.tobytes() for x in columns]
    return (kind, int(bucket), int(frm), *cells, *[None] * (5 - len(cells)))


def _dealt(kind: int, frm: int, buckets: int, keys: np.ndarray, *values: np.ndarray):
    """A pack for each home of cold keys, which keep their order within it."""
    home, order = _by_home(keys, buckets)
    at = _firsts(home[order])
    for part in np.split(order, at[1:]) if len(at) else []:
        yield _row(kind, home[part[0]], frm, keys[part], *[v[part] for v in values])


def _listed(kind: int, keys: np.ndarray, *values: np.ndarray):
    """Packs of the sums of listed words, by ranges of their places."""
    part = keys // np.uint64(RANGE)
    for at in np.split(np.arange(len(keys)), _firsts(part)[1:]) if len(keys) else []:
        yield _row(kind, part[at[0]], 0, keys[at], *[v[at].astype(np.int64) for v in values])


def _frame(rows) -> pd.DataFrame:
    return pd.DataFrame(list(rows), columns=COLUMNS)


def _column(group: pd.DataFrame, kind: int, name: str, dtype) -> np.ndarray:
    """One column of all packs of a kind, one after the other."""
    raw = group.loc[group["kind"] == kind, name]
    if dtype == np.int64:
        return np.concatenate([np.empty(0, dtype=np.int64), *map(_from_ints, raw)])
    return np.frombuffer(b"".join(raw), dtype=dtype) if len(raw) else np.empty(0, dtype=dtype)


def _by_key(group: pd.DataFrame, kind: int, *types) -> list[np.ndarray]:
    """The keys of all packs of a kind in order, and the columns beside them."""
    keys = _column(group, kind, "k", np.uint64)
    order = np.argsort(keys, kind="stable")
    return [keys[order], *[_column(group, kind, c, t)[order] for c, t in zip("xyzv", types, strict=False)]]


def _cells_of(group: pd.DataFrame, kind: int) -> list[np.ndarray]:
    rows = group[group["kind"] == kind]
    c = [_from_ints(x) for x in rows["y"]]
    n = [len(x) for x in c]
    u, w = (np.concatenate([np.empty(0, dtype=np.uint64), *[_to_codes(r, i) for r, i in zip(rows[name], n, strict=True)]]) for name in "kx")
    return [u, w, np.concatenate([np.empty(0, dtype=np.int64), *c])]


def seat(c: np.ndarray, p: np.ndarray, tables: float | np.ndarray, theta: float, d: float, rng: np.random.Generator) -> np.ndarray:
    """Tables that ``c`` customers of each dish open in one restaurant, seated one after the other.

    ``p`` is the parent's probability of the dish, ``tables`` the restaurant's
    tables in the last sweep. A first customer opens a table; another opens one
    with odds (theta + d * tables) * p against n - d * t. Beyond 32 customers of
    a dish they come in groups of a 32nd of those seated, whose odds are equal.
    """
    t = np.minimum(c, 1).astype(np.float64)
    fresh = (theta + d * tables) * p
    order = np.argsort(-c, kind="stable")
    n, most = 1.0, c.max(initial=0)
    sizes = c[order]
    while n < most:
        live = order[: np.searchsorted(-sizes, -n, side="left")]
        group = np.minimum(max(1, int(n / 32)), c[live] - n).astype(np.int64)
        odds = fresh[live] / (fresh[live] + n - d * t[live])
        t[live] += rng.binomial(group, np.clip(odds, 0, 1))
        n += max(1, int(n / 32))
    return np.minimum(t, c)


def _chunks(batches, listed: np.ndarray):
    """Stretches of texts: the batch, and (word before, word, number of the text) of each token."""
    held, size = [], 0
    for batch in filter(len, batches):
        held.append(batch)
        size += batch.column("text").nbytes
        if size >= 6 * CHUNK:
            rows = pa.Table.from_batches(held).combine_chunks()
            yield rows, *_with_context(rows.column("text").combine_chunks(), listed)
            held, size = [], 0
    if held:
        rows = pa.Table.from_batches(held).combine_chunks()
        yield rows, *_with_context(rows.column("text").combine_chunks(), listed)


def _distinct(u: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A token of each distinct pair, and the pair's number for each token."""
    pair = _pair(u, w)
    order = np.argsort(pair)
    at = _firsts(u[order], w[order])
    if len(at) != len(_firsts(pair[order])):
        order = np.lexsort((w, u, pair))
        at = _firsts(u[order], w[order])
    new = np.zeros(len(u), dtype=np.int64)
    new[at[1:]] = 1
    number = np.empty(len(u), dtype=np.int64)
    number[order] = np.cumsum(new)
    return order[at], number


def _batch(rows) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 5]
    columns = list(zip(*rows, strict=True)) or [[]] * len(COLUMNS)
    return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, kinds, strict=True)], names=COLUMNS)


def _often(share: int):
    """Words that make up 1 / ``share`` of a stretch of texts or more with their counts there; at 0 the number of all tokens."""

    def run(batches):
        for _, _, w, _ in _chunks(batches, np.empty(0, dtype=np.uint64)):
            words, counts = np.unique(w[w >= COLD], return_counts=True)
            most = counts * share >= len(w)
            yield pa.RecordBatch.from_arrays([pa.array(np.append(words[most].view(np.int64), 0)), pa.array(np.append(counts[most], len(w)))], names=["w", "c"])

    return run


def _count(listed: np.ndarray, buckets: int):
    """Counts of the cells of a stretch of texts at a time, dealt to buckets."""

    def run(batches):
        for _, u, w, _ in _chunks(batches, listed):
            one, number = _distinct(u, w)
            c = np.bincount(number)
            u, w = u[one], w[one]
            place = _place(u, w, buckets)
            order = _in_places(w, place)
            at = _firsts(place[order])
            yield _batch([_row(CELLS, place[x[0]], 0, _to_bytes(u[x]), _to_bytes(w[x]), c[x]) for x in np.split(order, at[1:])])

    return run


def _merge(buckets: int):
    """All cells of a bucket, and what they bring to their words and contexts."""

    def run(group):
        b = group["bucket"].iloc[0]
        u, w, c = _cells_of(group, CELLS)
        one, number = _distinct(u, w)
        total = np.zeros(len(one), dtype=np.int64)
        np.add.at(total, number, c)
        one, c = _sorted(w[one], one, total)
        u, w = u[one], w[one]
        once, many = (c == 1).astype(np.int64), c > 1
        rows = [_row(CELLS, b, 0, _to_bytes(u), _to_bytes(w), c), _row(MANY, b, 0, _to_bytes(u[many]), _to_bytes(w[many]), c[many], 0 * c[many])]
        word = _sums(w, c, once)
        cold = word[0] >= COLD
        rows.append(_row(WORDS, b, 0, *[x[cold] for x in word]))
        rows.extend(_listed(HOT_W, *[x[~cold] for x in word]))
        rows.append(_row(STATS, b, 0, np.array([cold.sum(), once.sum(), (c == 2).sum()], dtype=np.int64)))
        context = _sums(u, c, once)
        cold = context[0] >= COLD
        rows.extend(_dealt(ASKS, b, buckets, *[x[cold] for x in context]))
        rows.extend(_listed(HOT_U, *[x[~cold] for x in context]))
        return _frame(rows)

    return run


def _added(kind: int):
    """The sums by key of a kind of packs."""

    def run(group):
        sums = _sums(*[_column(group, kind, c, t) for c, t in (("k", np.uint64), ("x", np.int64), ("y", np.int64))])
        return _frame([_row(CONTEXTS if kind == ASKS else kind, group["bucket"].iloc[0], 0, *sums)])

    return run


def _value(keys: np.ndarray, hot: np.ndarray, cold: list[np.ndarray], absent: float) -> np.ndarray:
    """What is known of words: of listed ones by their place, of others by their key."""
    out = np.full(len(keys), absent, dtype=np.float64)
    is_hot = keys < COLD
    out[is_hot] = hot[keys[is_hot].astype(np.int64)]
    at, hit = _find(cold[0], keys)
    out[hit] = cold[1][at[hit]]
    return out


def _reseat(sweep: int, theta: float, d: float, seed: int, buckets: int, keep: bool, hot_tables: np.ndarray, hot_p: np.ndarray, to_p, base: float):
    """Seats a bucket's cells given the tables of their contexts and the parent's customers in the last sweep."""

    def run(group):
        b = group["bucket"].iloc[0]
        u, w, c = _cells_of(group, MANY)
        kept = _column(group, MANY, "z", np.int64)
        words, _, customers = _by_key(group, WORDS, np.int64, np.int64)
        p = to_p(_column(group, PARENT, "x", np.int64), _column(group, PARENT, "y", np.int64))
        p = _value(w, hot_p, [words, p] if len(p) else [words[:0], p], base)
        tables = _value(u, hot_tables, _by_key(group, TABLES, np.int64), 0.0)
        t = seat(c, p, tables, theta, d, np.random.default_rng([seed, sweep, int(b)])).astype(np.int64)
        rows = [_row(MANY, b, 0, _to_bytes(u), _to_bytes(w), c, kept + (t if keep else 0))]
        key, more = _sums(w, t)
        cold = key >= COLD
        rows.extend(_listed(HOT_W, key[~cold], more[~cold], 0 * more[~cold]))
        customers[_find(words, key[cold])[0]] += more[cold]
        rows.append(_row(CUSTOMERS, b, 0, None, customers))
        rows.append(_row(STATS, b, 0, np.array([(customers == 1).sum(), (customers == 2).sum(), customers.sum()], dtype=np.int64)))
        key, more = _sums(u, t)
        cold = key >= COLD
        rows.extend(_listed(HOT_U, key[~cold], more[~cold], 0 * more[~cold]))
        rows.extend(_dealt(SUMS, b, buckets, key[cold], more[cold]))
        return _frame(rows)

    return run


def _exchange(sweep: int, theta: float, d0: float, seed: int, opened: float, base: float, keep: bool, reply: bool):
    """Adds up the tables of contexts and tells them to the buckets that asked; seats the parent's customers."""

    def run(group):
        b = group["bucket"].iloc[0]
        keys, _, tables = _by_key(group, CONTEXTS, np.int64, np.int64)
        asked, more = _sums(_column(group, SUMS, "k", np.uint64), _column(group, SUMS, "x", np.int64))
        tables[_find(keys, asked)[0]] += more
        rows = [_row(KEPT, b, sweep, None, tables)] if keep else []
        if reply:
            for to, raw in group.loc[group["kind"] == SUMS, ["frm", "k"]].itertuples(index=False):
                wanted = np.frombuffer(raw, dtype=np.uint64)
                rows.append(_row(TABLES, to, b, wanted, tables[_find(keys, wanted)[0]]))
        c = _column(group, CUSTOMERS, "x", np.int64)
        t = seat(c, np.full(len(c), base), opened, theta, d0, np.random.default_rng([seed, sweep, int(b), 1])).astype(np.int64)
        rows += [_row(PARENT, b, sweep, None, c, t), _row(STATS, b, 0, np.array([t.sum(), 0, 0]))]
        return _frame(rows)

    return run


def _answer(kept: list[int]):
    """Tells the buckets that asked for contexts the customers and, in each sweep kept, the tables of each, in the order of the question."""

    def run(group):
        b = group["bucket"].iloc[0]
        keys, n, _ = _by_key(group, CONTEXTS, np.int64, np.int64)
        tables = [_column(group[group["frm"] == s], KEPT, "x", np.int64) for s in kept]
        rows = []
        for to, raw in group.loc[group["kind"] == ASKS, ["frm", "k"]].itertuples(index=False):
            at = _find(keys, np.frombuffer(raw, dtype=np.uint64))[0]
            rows.append(_row(ANSWERS, to, b, None, n[at], np.column_stack([t[at] for t in tables])))
        return _frame(rows)

    return run


class _Known:
    """What tasks need of a model besides packs: numbers, and the arrays of listed words."""

    def __init__(self, **fields):
        self.__dict__.update(fields)

    def left(self, n: np.ndarray, tables: np.ndarray) -> np.ndarray:
        """What contexts leave to their parent, a column per sweep kept."""
        return (self.theta + self.d * tables) / (self.theta + n)[:, None]

    def parent(self, sweep: int, customers, tables):
        return (customers - self.d0[sweep] * tables + self.rest[sweep]) / (self.theta + self.n[sweep])

    def words(self, group: pd.DataFrame) -> list[np.ndarray]:
        """Cold words of a bucket, their counts, and the parent's probability in each sweep kept."""
        keys, counts, _ = _by_key(group, WORDS, np.int64, np.int64)
        return [keys, counts, np.column_stack([self.parent(s, *[_column(group[group["frm"] == s], PARENT, c, np.int64) for c in "xy"]) for s in self.kept])]

    def of_words(self, w: np.ndarray, words: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        c, p = np.zeros(len(w), dtype=np.int64), np.tile(np.array(self.unknowns), (len(w), 1))
        hot = w < COLD
        place = w[hot].astype(np.int64)
        c[hot], p[hot] = self.hot_cw[place], self.hot_p[place]
        at, hit = _find(words[0], w)
        c[hit], p[hit] = words[1][at[hit]], words[2][at[hit]]
        return c, p

    def cells(self, group: pd.DataFrame, words: list[np.ndarray]) -> list[np.ndarray]:
        """A bucket's cells: context, word, their own part of the probability, and log10 of the whole."""
        u, w, c = _cells_of(group, CELLS)
        kept = np.full(len(c), len(self.kept), dtype=np.int64)
        kept[c > 1] = _column(group, MANY, "z", np.int64)
        n, a = np.zeros(len(u), dtype=np.int64), np.ones((len(u), len(self.kept)))
        hot = u < COLD
        place = u[hot].astype(np.int64)
        n[hot], a[hot] = self.hot_n[place], self.hot_left[place]
        keys, at = np.unique(u[~hot], return_inverse=True)
        _, order = _by_home(keys, self.buckets)
        group = group[group["kind"] == ANSWERS].sort_values("frm")
        counts, left = np.empty(len(keys), dtype=np.int64), np.empty((len(keys), len(self.kept)))
        counts[order] = _column(group, ANSWERS, "x", np.int64)
        left[order] = self.left(counts[order], _column(group, ANSWERS, "y", np.int64).reshape(-1, len(self.kept)))
        n[~hot], a[~hot] = counts[at], left[at]
        own = (c - self.d * kept / len(self.kept)) / (self.theta + n)
        return [u, w, own, np.log10(own + (a * self.of_words(w, words)[1]).mean(axis=1))]


def _post(listed: np.ndarray, buckets: int, part: int):
    """Which texts hold which cells how often, a stretch of texts at a time, for a slice of the buckets."""

    def run(batches):
        chunk = TaskContext.get().partitionId() << 20
        for rows, u, w, text in _chunks(batches, listed):
            out = [_row(DIGESTS, chunk % buckets, chunk, np.bitwise_xor.reduce(_pair(np.arange(len(w), dtype=np.uint64), w)))]
            if part == 0:
                ids = rows.column("doc_id").combine_chunks()
                flags = np.asarray(rows.column("held_out").fill_null(False)).astype(np.uint8) + 2 * np.asarray(ids.is_null()).astype(np.uint8)
                number = np.asarray(ids.fill_null(0)).astype(np.int64)
                out.append(_row(DOCS, chunk % buckets, chunk, np.arange(len(ids)), number, flags, np.bincount(text, minlength=len(ids))))
            place = _place(u, w, buckets)
            mine = np.flatnonzero(place % np.uint64(SLICES) == part)
            if len(mine):
                u, w, text, place = u[mine], w[mine], text[mine], place[mine]
                one, number = _distinct(u, w)
                order = _in_places(w[one], place[one])
                rank = np.empty(len(one), dtype=np.int64)
                rank[order] = np.arange(len(one))
                one = one[order]
                posts = np.sort(rank[number] * len(rows) + text)
                at = _firsts(posts)
                times = np.diff(np.append(at, len(posts)))
                cell, text = np.divmod(posts[at], len(rows))
                cuts = np.append(_firsts(place[one]), len(one))
                ends = np.searchsorted(cell, cuts)
                for a, b, i, j in zip(cuts[:-1], cuts[1:], ends[:-1], ends[1:], strict=True):
                    x = one[a:b]
                    out.append(_row(POSTS, place[x[0]], chunk, _to_bytes(u[x]), _to_bytes(w[x]), np.bincount(cell[i:j] - a), text[i:j], times[i:j]))
            yield _batch(out)
            chunk += 1

    return run


def _summed(buckets: int, ids, score, base, known):
    """Packs of the sums of texts, one for each stretch of texts, which are added up by stretch."""
    sums = _sums(ids, score, base, known)
    chunk = sums[0] >> 24
    for part in np.split(np.arange(len(chunk)), _firsts(chunk)[1:]) if len(chunk) else []:
        at = chunk[part[0]]
        yield _row(SUMS, at % buckets, at, *[x[part] for x in (sums[0] - (at << 24), *sums[1:])])


def _meet(known: _Known, buckets: int):
    """Scores what texts hold of a bucket's cells; of pairs without a cell only those of listed contexts, the others go to their context."""

    def run(group):
        docs = list(group.loc[group["kind"].isin([DOCS, DIGESTS]), COLUMNS].itertuples(index=False, name=None))
        if not (group["kind"] == POSTS).any():
            return _frame(docs)
        words = known.words(group)
        cu, cw, _, logs = known.cells(group, words)
        salt = 0
        while True:
            pair = _pair(cu, cw, salt)
            order = np.argsort(pair)
            if len(_firsts(pair[order])) == len(pair):
                break
            salt += 1
        pair = pair[order]
        done, unseen = [], []
        for chunk, k, x, y, z, v in group.loc[group["kind"] == POSTS, ["frm", "k", "x", "y", "z", "v"]].itertuples(index=False):
            n = _from_ints(y)
            u, w = _to_codes(k, len(n)), _to_codes(x, len(n))
            at, hit = _find(pair, _pair(u, w, salt))
            at = order[at] if len(order) else at
            if len(order):
                hit &= (cu[at] == u) & (cw[at] == w)
            c, p = known.of_words(w, words)
            score = np.zeros(len(n))
            score[hit] = logs[at[hit]]
            hot = ~hit & (u < COLD)
            score[hot] = np.log10((known.hot_left[u[hot].astype(np.int64)] * p[hot]).mean(axis=1))
            cell = np.repeat(np.arange(len(n)), n)
            ids, times = (chunk << 24) + _from_ints(z), _from_ints(v)
            base = np.log10((c + 0.5) / known.total)
            done.append(_sums(ids, times * score[cell], times * base[cell], times * (c > 0)[cell]))
            away = ~(hit | hot)[cell]
            unseen.append((u[cell[away]], ids[away], times[away], p[cell[away]]))
        rows = docs + list(_summed(buckets, *[np.concatenate(x) for x in zip(*done, strict=True)]))
        rows.extend(_dealt(UNSEEN, 0, buckets, *[np.concatenate(x) for x in zip(*unseen, strict=True)]))
        return _frame(rows)

    return run


def _back_off(known: _Known, buckets: int):
    """Scores pairs without a cell where their context is known."""

    def run(group):
        keys, n, _ = _by_key(group, CONTEXTS, np.int64, np.int64)
        left = known.left(n, np.column_stack([_column(group[group["frm"] == s], KEPT, "x", np.int64) for s in known.kept]) if len(keys) else np.empty((0, len(known.kept))))
        u, ids, times = (_column(group, UNSEEN, c, t) for c, t in (("k", np.uint64), ("x", np.int64), ("y", np.int64)))
        a = np.ones((len(u), len(known.kept)))
        at, hit = _find(keys, u)
        a[hit] = left[at[hit]]
        p = _column(group, UNSEEN, "z", np.float64).reshape(a.shape)
        none = np.zeros(len(u))
        return _frame(_summed(buckets, ids, times * np.log10((a * p).mean(axis=1)), none, none.astype(np.int64)))

    return run


def _texts(group: pd.DataFrame) -> pd.DataFrame:
    """One row per text, with the sums of all its packs; texts are known by their place, so each slice must have read the same."""
    read = group[group["kind"] == DIGESTS].groupby("frm")["k"]
    if (read.nunique() != 1).any() or (read.size() != SLICES).any():
        raise ValueError("the texts came in another order when they were read again; write them first")
    def ids_of(kind):
        rows = group[group["kind"] == kind]
        return np.concatenate([np.empty(0, dtype=np.int64), *[(frm << 24) + _from_ints(k) for frm, k in zip(rows["frm"], rows["k"], strict=True)]])

    ids, (number, flags, n) = ids_of(DOCS), (_column(group, DOCS, c, t) for c, t in (("x", np.int64), ("y", np.uint8), ("z", np.int64)))
    order = np.argsort(ids)
    keys, score, base, known = _sums(ids_of(SUMS), *[_column(group, SUMS, c, t) for c, t in (("x", np.float64), ("y", np.float64), ("z", np.int64))])
    at = _find(ids[order], keys)[0]
    place = order[at]
    out = pd.DataFrame({"doc_id": pd.array(number, dtype="Int64"), "held_out": flags % 2 == 1, "n_tokens": n, "n_known": 0 * n, "base_score": 0.0 * n, "score": 0.0 * n})
    out.loc[flags >= 2, "doc_id"] = pd.NA
    for name, x in (("n_known", known), ("base_score", base), ("score", score)):
        column = out[name].to_numpy(copy=True)
        column[place] = x
        out[name] = column
    return out


class PitmanYor:
    """Restaurants: one per context, which is the word before, all with the parent of no context.

    Every word is a context and a dish. Gibbs sweeps reseat each cell's
    customers given the tables of the last sweep; the tables of all contexts
    are the parent's customers, and its base is uniform over the words and one
    unknown word. Predictive probabilities are averaged over the sweeps after
    ``burn_in``. A cell with one customer has one table in every sweep, so only
    the others are seated again.

    Cells lie in buckets, a row of packed arrays for each; so rows are few and
    shuffles move bytes. A bucket has all cells of its words, and asks the
    buckets of their contexts for what it needs of them. Words that make up
    1 / ``listed`` of all tokens or more are known to all tasks, and their cells
    are spread over all buckets, so that no word makes one large. ``frequent``
    is the size of the extract ``symbol_probability`` only, and without
    ``extract`` the tables are deleted once texts are scored. Pairs need no
    list of their own, since a pair comes once per text that holds it;
    ``listed_pairs`` has no effect.
    """

    def __init__(self, train: DataFrame, frequent: int = 1023, listed: int = 1 << 17, sweeps: int = 5, burn_in: int = 2, theta: float = 1.0, seed: int = 11, listed_pairs: int = 1 << 19, extract: bool = True):
        self.theta, self.seed, self.frequent = theta, seed, frequent
        self.sweeps, self.burn_in = sweeps, burn_in
        self.spark, self.extract = train.sparkSession, extract
        with brief_shuffles(self.spark):
            self._build(train.select("text"), listed)
            self._sweep()

    def _packs(self, df: DataFrame, name: str) -> str:
        at = stored_by(df, name, "kind")
        self.made.append(at)
        return at

    def _read(self, at: str, *kinds: int) -> DataFrame:
        rows = self.spark.read.schema(f"{PACK.partition(', ')[2]}, kind int").parquet(at)
        return rows.where(F.col("kind").isin(*kinds)).select(*COLUMNS)

    @staticmethod
    def _grouped(run, *parts: DataFrame, schema: str = PACK) -> DataFrame:
        return reduce(DataFrame.unionByName, parts).groupBy("bucket").applyInPandas(run, schema)

    def _hot(self, at: str, kind: int) -> tuple[np.ndarray, np.ndarray]:
        out = np.zeros((2, len(self.listed) + FIRST), dtype=np.int64)
        for row in self._grouped(_added(kind), self._read(at, kind)).select("k", "x", "y").collect():
            out[:, np.frombuffer(row.k, dtype=np.int64)] = [_from_ints(c) for c in (row.x, row.y)]
        return out[0], out[1]

    def _stats(self, at: str) -> list[int]:
        rows = [_from_ints(r.k) for r in self._read(at, STATS).select("k").collect()]
        return np.sum([np.zeros(3, dtype=np.int64), *rows], axis=0).tolist()

    def _build(self, train: DataFrame, listed: int) -> None:
        self.made = []
        often = written(train.mapInArrow(_often(listed), "w long, c long").groupBy("w").agg(F.sum("c").alias("c")), "frequent-words")
        self.tokens = (often.where("w = 0").agg(F.sum("c")).first()[0]) or 0
        often = often.where((F.col("w") != 0) & (F.col("c") >= max(1, self.tokens // listed))).select("w").toArrow()
        self.listed = np.sort(often["w"].to_numpy().astype(np.int64).view(np.uint64))
        self.buckets = max(1, self.tokens // BUCKET)
        cells = train.mapInArrow(_count(self.listed, self.buckets), PACK)
        self.cells_at = self._packs(self._grouped(_merge(self.buckets), cells), "cells")
        self.hot_cw, self.hot_ones_w = self._hot(self.cells_at, HOT_W)
        self.hot_n, self.hot_ones_u = self._hot(self.cells_at, HOT_U)
        words, ones, twos = self._stats(self.cells_at)
        self.kinds = words + int((self.hot_cw > 0).sum())
        self.d = float(np.clip(ones / (ones + 2 * twos) if ones + twos else 0.5, 0.05, 0.95))
        self.contexts_at = self._packs(self._grouped(_added(ASKS), self._read(self.cells_at, ASKS)), "contexts")

    @property
    def total(self) -> float:
        return float(self.tokens + 0.5 * (self.kinds + 1))

    def _sweep(self) -> None:
        theta, d, seed, base = self.theta, self.d, self.seed, 1.0 / (self.kinds + 1)
        self.many_at, last, opened = self.cells_at, None, 0.0
        hot_tables, hot_p = np.zeros(len(self.listed) + FIRST), np.full(len(self.listed) + FIRST, base)
        self.known = known = _Known(buckets=self.buckets, theta=theta, d=d, total=self.total, hot_cw=self.hot_cw, hot_n=self.hot_n, d0={}, rest={}, n={}, kept=[])
        self.kept_at, lefts, parents = [], [], []
        to_p = lambda c, t: np.full(len(c), base)
        for sweep in range(self.sweeps):
            keep = sweep >= self.burn_in
            parts = [self._read(self.many_at, MANY), self._read(self.cells_at, WORDS)] + ([self._read(last, PARENT, TABLES)] if last else [])
            run = _reseat(sweep, theta, d, seed, self.buckets, keep, hot_tables, hot_p, to_p, base)
            seated = self._packs(self._grouped(run, *parts), "seated")
            dropped(self.spark, *([self.many_at] if self.many_at != self.cells_at else []), *([f"{last}/kind={TABLES}"] if last else []), *([last] if last and last not in self.kept_at else []))
            self.many_at = seated
            customers = self.hot_ones_w + self._hot(seated, HOT_W)[0]
            hot_tables = (self.hot_ones_u + self._hot(seated, HOT_U)[0]).astype(np.float64)
            one, two, n = np.array(self._stats(seated)) + [(customers == 1).sum(), (customers == 2).sum(), customers.sum()]
            d0 = float(np.clip(one / (one + 2 * two) if one + two else 0.5, 0.05, 0.95))
            run = _exchange(sweep, theta, d0, seed, opened, base, keep, sweep + 1 < self.sweeps)
            last = self._packs(self._grouped(run, self._read(self.contexts_at, CONTEXTS), self._read(seated, SUMS, CUSTOMERS)), "tables")
            dropped(self.spark, *[f"{seated}/kind={k}" for k in (SUMS, CUSTOMERS)])
            t = seat(customers, np.full(len(customers), base), opened, theta, d0, np.random.default_rng([seed, sweep]))
            opened = float(self._stats(last)[0] + t.sum())
            known.d0[sweep], known.rest[sweep], known.n[sweep] = d0, (theta + d0 * opened) * base, int(n)
            hot_p = known.parent(sweep, customers, t)
            to_p = lambda c, t, sweep=sweep: known.parent(sweep, c, t)
            if keep:
                known.kept.append(sweep)
                self.kept_at.append(last)
                lefts.append(hot_tables)
                parents.append(hot_p)
        known.unknowns = [known.rest[s] / (theta + known.n[s]) for s in known.kept]
        known.hot_p = np.column_stack(parents)
        known.hot_left = known.left(self.hot_n, np.column_stack(lefts))
        known.hot_left[self.hot_n == 0] = 1.0
        self.unknown = float(np.mean(known.unknowns))

    def _kept(self, kind: int) -> list[DataFrame]:
        return [self._read(at, kind) for at in self.kept_at]

    def _bucket_parts(self, part: Column) -> list[DataFrame]:
        """All packs of buckets: their cells, words, and answers to what they ask of contexts."""
        asks = self._read(self.cells_at, ASKS).withColumns({c: F.lit(None).cast("binary") for c in "xy"}).where(F.pmod("frm", F.lit(SLICES)) == part)
        answers = self._grouped(_answer(self.known.kept), asks, self._read(self.contexts_at, CONTEXTS), *self._kept(KEPT))
        own = [self._read(self.cells_at, CELLS, WORDS), self._read(self.many_at, MANY), *self._kept(PARENT)]
        return [answers, *[x.where(F.pmod("bucket", F.lit(SLICES)) == part) for x in own]]

    @property
    def cells(self) -> DataFrame:
        """One row per cell: its context and word, its own part of the probability, and log10 of the whole."""
        known = self.known

        def run(group):
            u, w, own, logs = known.cells(group, known.words(group))
            return pd.DataFrame({"u": u.view(np.int64), "w": w.view(np.int64), "own": own, "logp": logs})

        out = [self._grouped(run, *self._bucket_parts(F.lit(i)), schema="u long, w long, own double, logp double") for i in range(SLICES)]
        return reduce(DataFrame.unionByName, out)

    @property
    def words(self) -> DataFrame:
        """One row per word: its count, and the parent's probability in each sweep kept."""
        known, names = self.known, [f"p{i}" for i in range(len(self.known.kept))]

        def rows(w, c, p):
            return pd.DataFrame({"w": w.view(np.int64), "cw": c, **dict(zip(names, p.T, strict=True))})

        schema = "w long, cw long" + "".join(f", {x} double" for x in names)
        hot = np.flatnonzero(known.hot_cw)
        listed = self.spark.createDataFrame(rows(hot, known.hot_cw[hot], known.hot_p[hot]), schema)
        return self._grouped(lambda group: rows(*known.words(group)), self._read(self.cells_at, WORDS), *self._kept(PARENT), schema=schema).unionByName(listed)

    @property
    def contexts(self) -> DataFrame:
        """One row per context: its tokens, and what it leaves to its parent in each sweep kept."""
        known, names = self.known, [f"a{i}" for i in range(len(self.known.kept))]

        def rows(u, n, a):
            return pd.DataFrame({"u": u.view(np.int64), "n": n, **dict(zip(names, a.T, strict=True))})

        def run(group):
            keys, n, _ = _by_key(group, CONTEXTS, np.int64, np.int64)
            return rows(keys, n, known.left(n, np.column_stack([_column(group[group["frm"] == s], KEPT, "x", np.int64) for s in known.kept])))

        schema = "u long, n long" + "".join(f", {x} double" for x in names)
        hot = np.flatnonzero(known.hot_n)
        listed = self.spark.createDataFrame(rows(hot, known.hot_n[hot], known.hot_left[hot]), schema)
        return self._grouped(run, self._read(self.contexts_at, CONTEXTS), *self._kept(KEPT), schema=schema).unionByName(listed)

    @property
    def rare_words(self) -> DataFrame:
        """The parent's probability of each word."""
        k = len(self.known.kept)
        return self.words.select(F.col("w").alias("word"), F.col("cw").alias("c"), (sum(F.col(f"p{i}") for i in range(k)) / k).alias("p"))

    @property
    def symbol_probability(self) -> np.ndarray:
        """An extract: probabilities of the most frequent words and, last, of all others, after each of the most frequent contexts."""
        k = len(self.known.kept)
        words = self.words.orderBy(F.desc("cw"), "w").limit(self.frequent).toPandas()
        contexts = self.contexts.orderBy(F.desc("n"), "u").limit(self.frequent).toPandas()
        a = contexts[[f"a{i}" for i in range(k)]].to_numpy()
        p = words[[f"p{i}" for i in range(k)]].to_numpy()
        sums = self.words.agg(*[F.sum(f"p{i}") for i in range(k)]).first()
        other = np.array(sums, dtype=np.float64) + np.array(self.known.unknowns) - p.sum(axis=0)
        out = a @ np.vstack([p, other]).T / k
        row, col = ({x: i for i, x in enumerate(t)} for t in (contexts["u"].tolist(), words["w"].tolist()))
        shown = F.broadcast(self.spark.createDataFrame(pd.DataFrame({"u": list(row)}), "u long"))
        dish = F.when(F.col("w").isin(list(col)), F.col("w"))
        for u, w, own in self.cells.join(shown, "u").groupBy("u", dish.alias("w")).agg(F.sum("own")).collect():
            out[row[u], col[w] if w is not None else -1] += own
        return out

    def score(self, docs: DataFrame) -> DataFrame:
        """docs (doc_id, held_out, text) -> doc_id, held_out, n_tokens, n_known, base_score, score.

        Texts are read again for each slice of the buckets, and what they hold
        of its cells meets these there. They must come in the same order each
        time, as those of a written table do, else the job fails. A pair without a cell has its parent's
        probability. Without ``extract`` the model can score once only.
        """
        with brief_shuffles(self.spark):
            docs, made, found = docs.select("doc_id", "held_out", "text"), [], []
            for i in range(SLICES):
                posts = docs.mapInArrow(_post(self.listed, self.buckets, i), PACK)
                at = stored_by(self._grouped(_meet(self.known, self.buckets), posts, *self._bucket_parts(F.lit(i))), "scores", "kind")
                unseen = self._grouped(_back_off(self.known, self.buckets), self._read(at, UNSEEN), self._read(self.contexts_at, CONTEXTS), *self._kept(KEPT))
                more = stored_by(unseen, "row-sums", "kind")
                dropped(self.spark, f"{at}/kind={UNSEEN}")
                found += [self._read(at, SUMS, DOCS, DIGESTS), self._read(more, SUMS)]
            if not self.extract:
                dropped(self.spark, *self.made)
        return self._grouped(_texts, *found, schema="doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")


def score_documents(docs: DataFrame, parts: int = 5, **options) -> DataFrame:
    """Score every whole text by a model of the documents that are not held out.

    One row per input row: ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``,
    ``train_tokens``, ``base_score``, ``score`` (log10 probabilities), and
    ``perplexity`` of a token. Null and empty texts are one end token. A null
    id counts as the empty text when rows are dealt to the held-out part.
    Without training rows all words are unknown. Repeated rows are scored each.
    """
    rows = docs.select("doc_id", whole("text").alias("text"), held_out("doc_id", parts).alias("held_out"))
    model = PitmanYor(rows.where(~F.col("held_out")), **{"extract": False, **options})
    out = model.score(rows)
    return out.select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )


def op3_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))


QUERIES = {"op3_pitman_yor": op3_pitman_yor}
SQL: dict[str, str] = {}
