"""Packing token sequences into few sequences of a fixed length."""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.common import stored, table, whole
from lectern.llm.tokens import WordEncoder

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, size: int = 4096, end_id: int = 1, tokenizer: str | None = None) -> DataFrame:
    """Token pieces of every whole document: its ids, then ``end_id``; longer ones are cut every ``size``."""
    end = end_id.to_bytes(4, "little")

    def cut(batches):
        encoder = WordEncoder(tokenizer)
        for frame in batches:
            rows = []
            for doc_id, text in zip(frame["doc_id"], frame["text"], strict=True):
                ids = memoryview(encoder.encode(text) + end)
                doc_id = None if pd.isna(doc_id) else int(doc_id)
                for i, at in enumerate(range(0, len(ids), 4 * size)):
                    part = ids[at : at + 4 * size]
                    rows.append((doc_id, i, at // 4, len(part) // 4, zlib.crc32(part)))
            made = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            yield made.assign(doc_id=made["doc_id"].astype("Int64"))

    return docs.select("doc_id", whole("text").alias("text")).mapInPandas(cut, PIECES)


class _Bins:
    """Open bins by free room. Bins are lists of (length, item)."""

    def __init__(self, size: int):
        self.size, self.bins, self.by_room, self.rooms = size, [], {}, []

    def _file(self, b: int, room: int) -> None:
        at = self.by_room.setdefault(room, [])
        if not at:
            insort(self.rooms, room)
        at.append(b)

    def best(self, length: int) -> int | None:
        """Take out the bin with the least room that holds ``length``."""
        i = bisect_left(self.rooms, length)
        if i == len(self.rooms):
            return None
        room = self.rooms[i]
        b = self.by_room[room].pop()
        if not self.by_room[room]:
            self.rooms.pop(i)
        return b

    def put(self, item: tuple) -> None:
        b = self.best(item[0])
        if b is None:
            b = len(self.bins)
            self.bins.append([0, []])
        self.bins[b][0] += item[0]
        self.bins[b][1].append(item)
        self._file(b, self.size - self.bins[b][0])


class _Takers:
    """Underfull bins by the lengths they hold, 0 (nothing to give back) among them, and their room."""

    def __init__(self, size: int):
        self.size = size
        self.rooms = [[] for _ in range(size + 1)]  # by length: sorted (room, bin)
        self.reach = np.full(size + 1, -1, dtype=np.int64)  # by length: the longest that can come in its place

    def add(self, i: int, room: int, held: dict) -> None:
        for b in (0, *held):
            insort(self.rooms[b], (room, i))
            self.reach[b] = b + self.rooms[b][-1][0]

    def remove(self, i: int, room: int, held: dict) -> None:
        for b in (0, *held):
            at = self.rooms[b]
            at.pop(bisect_left(at, (room, i)))
            self.reach[b] = b + at[-1][0] if at else -1

    def best(self, held: dict) -> tuple | None:
        """(lengths to give, length to get back, bin): the step that moves most, to the bin it fills best."""
        one = np.fromiter(held, dtype=np.int64, count=len(held))
        i, j = np.triu_indices(len(one))
        many = np.fromiter(map(len, held.values()), dtype=np.int64, count=len(held))
        apart = (i != j) | (many[i] > 1)
        i, j = i[apart], j[apart]
        out = np.concatenate([one, one[i] + one[j]])
        # The shortest length in whose place so much can come.
        back = np.searchsorted(np.maximum.accumulate(self.reach), out)
        gain = np.where((back < out) & (out <= self.size), out - back, 0)
        k = int(gain.argmax())
        if gain[k] <= 0:
            return None
        b = int(back[k])
        at = self.rooms[b]
        taker = at[bisect_left(at, (int(gain[k]), -1))][1]
        k -= len(one)
        return ([int(one[k + len(one)])] if k < 0 else [int(one[i[k]]), int(one[j[k]])]), b, taker


def _improve(bins: list, size: int) -> list:
    """Local search among underfull bins; every step increases the sum of squared fills.

    From the emptiest on, each bin gives: it moves one or two items to a fuller
    bin, or exchanges them for a smaller item of it. A bin left without items is
    gone. The search ends when no bin has such a step left.
    """
    fills = [b[0] for b in bins]
    held: list[dict] = [{} for _ in bins]
    for h, (_, items) in zip(held, bins, strict=True):
        for x in items:
            h.setdefault(x[0], []).append(x)
    moved = True
    while moved:
        moved, takers = False, _Takers(size)
        live = [i for i, f in enumerate(fills) if 0 < f < size]
        for i in live:
            takers.add(i, size - fills[i], held[i])
        queue = [(fills[i], i) for i in live]
        heapify(queue)
        while queue:
            fill, give = heappop(queue)
            if fill != fills[give]:
                continue
            takers.remove(give, size - fill, held[give])
            while held[give] and (step := takers.best(held[give])):
                lengths, back, take = step
                takers.remove(take, size - fills[take], held[take])
                gone = [_pop(held[give], n) for n in lengths]
                if back:
                    held[give].setdefault(back, []).append(_pop(held[take], back))
                for x in gone:
                    held[take].setdefault(x[0], []).append(x)
                gain = sum(lengths) - back
                fills[give] -= gain
                fills[take] += gain
                if fills[take] < size:
                    takers.add(take, size - fills[take], held[take])
                    heappush(queue, (fills[take], take))
                moved = True
    return [[f, [x for at in h.values() for x in at]] for f, h in zip(fills, held, strict=True) if h]


def _pop(held: dict, length: int) -> tuple:
    x = held[length].pop()
    if not held[length]:
        del held[length]
    return x


def pack(items: list[tuple], size: int) -> list[list]:
    """Bins [fill, items] of (length, ...) items: best fit, largest first, then the local search."""
    b = _Bins(size)
    for item in sorted(items, key=lambda x: -x[0]):
        b.put(item)
    full = [x for x in b.bins if x[0] == size]
    return full + _improve([x for x in b.bins if x[0] < size], size)


def best_fit(rows: DataFrame, size: int = 4096, block: int = 20_000) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to (doc_id, piece, start, length, ids_crc32) rows.

    Rows are dealt at random into blocks of about ``block`` rows, each packed in
    memory. A block's full bins are final; items of its underfull bins are dealt
    anew into as many blocks as their number asks for, until one block is left
    or a round leaves more than three quarters of its rows, when all its bins
    are final. No task holds more than about ``block`` rows in any round.
    """
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    schema = f"{PIECES}, sequence_id long, offset long, done boolean"
    left, level, parts = stored(rows.select(*names), "pieces"), 0, []
    count = left.count()
    while True:
        n = max(1, -(-count // block))

        def run(batches, level=level):
            from pyspark import TaskContext

            items = [(int(x[3]), x) for frame in batches for x in frame[names].astype(object).itertuples(index=False, name=None)]
            out = []
            base = (level << 56) | (TaskContext.get().partitionId() << 32)
            for i, (fill, held) in enumerate(pack(items, size)):
                at = 0
                for length, x in held:
                    out.append((*x, base + i, at, fill == size))
                    at += length
            made = pd.DataFrame(out, columns=[*names, "sequence_id", "offset", "done"])
            yield made.assign(doc_id=made["doc_id"].astype("Int64"))

        # Dealt by the row's number, so that rows without an id or with one id do not meet.
        numbered = left.withColumn("deal", F.monotonically_increasing_id())
        # One block is a shuffle too: what is left is found by many tasks, and only that meets in one.
        dealt = numbered.repartition(n, F.xxhash64("deal", F.lit(level))) if n > 1 else left.repartition(1)
        packed = stored(dealt.mapInPandas(run, schema), "packed")
        left = packed.where("not done").select(*names)
        rest = left.count() if n > 1 else 0
        if n == 1 or 4 * rest > 3 * count:
            parts.append(packed.drop("done"))
            break
        parts.append(packed.where("done").drop("done"))
        if not rest:
            break
        count, level = rest, level + 1
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def pack_documents(docs: DataFrame, size: int = 4096, tokenizer: str | None = None) -> DataFrame:
    """Pack all documents into as few sequences of at most ``size`` tokens as the search finds.

    One row per piece: ``doc_id``, ``piece``, ``start``, ``length``,
    ``ids_crc32``, ``sequence_id``, ``offset``. A full piece is a sequence of
    its own. Null and empty texts are one end token. Repeated rows are packed
    each. Other columns are ignored; no rows give no rows.
    """
    cut = stored(pieces(docs, size, tokenizer=tokenizer), "token-pieces")
    whole_ones = cut.where(F.col("length") == size).select(
        "*", (F.lit(1 << 62) + F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    return whole_ones.unionByName(best_fit(cut.where(F.col("length") < size), size))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


QUERIES = {"op7_best_fit_packing": op7_best_fit_packing}
SQL: dict[str, str] = {}
