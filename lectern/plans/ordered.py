"""Ordered scans that survive hot keys.

Running sums, row numbers, last-value-before and next-value-after are window
functions over one key's whole history, and a plain window puts that history
in one task. Here the rows go once through a range exchange on key and order,
so a key of any size is spread over as many tasks as it fills. Each task walks
its sorted rows in Arrow batches, and writes them with what it knows so far,
besides one short record for the first and the last key it saw: the only keys
that other tasks can share. A window over those records, at most two a task,
gives what earlier and later tasks bring, and a join adds it to the rows of
those keys.

No sample of hot keys, no limit and no job but the write: the cut follows the
exchange, and any cut gives the same rows, since sums are of whole numbers.
Only rows equal in all order columns stay together.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

from lectern import session
from lectern.plans.packs import PART, changes, nullable, opened, packed

ROW_NUMBER = "__rn"


@dataclass
class Scan:
    """What an ordered scan should add; every entry is output name -> expression.

    ``sums``: running sum of whole numbers up to and including the row.
    ``prev``: last non-null value at or before the row.
    ``next``: first non-null value at or after the row.
    ``lead``: value on the very next row.
    ``row_number``: name of a 1-based position, or None.
    ``tie``: numeric column; among rows equal in the order columns its largest
    value counts as the nearest one, looking back as well as ahead.
    ``where``: the rows that want these columns; others have nulls in them.
    ``only``: write the rows of ``where`` alone.
    ``pack``: a number that grows with the order columns; rows with the same one
    travel as one, and stay together. For many narrow rows.
    """

    sums: Mapping[str, Column] = field(default_factory=dict)
    prev: Mapping[str, Column] = field(default_factory=dict)
    next: Mapping[str, Column] = field(default_factory=dict)
    lead: Mapping[str, Column] = field(default_factory=dict)
    row_number: str | None = None
    tie: str | None = None
    where: Column | None = None
    only: bool = False
    pack: Column | None = None


def _at(values: pa.Array, places: np.ndarray) -> pa.Array:
    """Values at the places, null where a place is negative."""
    return values.take(pa.array(places, pa.int64(), mask=places < 0))


class _Walk:
    """One task's sorted rows, as they come.

    Rows are held back only while what follows them is still unknown: the last
    row for ``lead``, and for ``next`` the rows since the last value.
    """

    def __init__(self, columns: list[str], keys: list[str], order: list[str], names: dict[str, list[str]], schema: pa.Schema, task: int, only: bool = False):
        self.only = only
        self.columns, self.keys, self.order, self.names, self.schema = columns, keys, order, names, schema
        self.task, self.held, self.last_key = task, None, None
        self.segment = -1  # number of the key last sent
        self.run: dict = {}  # its running values
        self.first: dict | None = None  # records of the first and the current key
        self.current: dict | None = None

    def add(self, rows: pa.Table, final: bool) -> Iterator[pa.RecordBatch]:
        t = rows if self.held is None else pa.concat_tables([self.held, rows])
        t = t.combine_chunks()
        n = t.num_rows
        if not n:
            return
        place = np.arange(n)
        new_key = np.empty(n, bool)
        new_key[1:] = changes(t, self.keys)
        new_key[0] = self.last_key is None or bool(changes(pa.concat_tables([self.last_key, t.select(self.keys).slice(0, 1)]), self.keys)[0])
        key = np.cumsum(new_key)  # 0: goes on from rows already sent
        begin = np.maximum.accumulate(np.where(new_key, place, 0))
        goes_on = key == 0
        col = {c: t[c].combine_chunks() for c in t.column_names}
        end, made = (n if final else n - bool(self.names["lead"])), {}

        made[ROW_NUMBER] = pa.array(place - begin + 1 + np.where(goes_on, self.run.get(ROW_NUMBER, 0), 0))
        for name in self.names["sums"]:
            v = col[f"__sums_{name}"]
            valid = v.is_valid().to_numpy(zero_copy_only=False)
            x = pc.fill_null(v, 0).to_numpy(zero_copy_only=False)
            total, seen = np.cumsum(x), np.cumsum(valid)
            carried = self.run.get(name)
            total = total - (total - x)[begin] + np.where(goes_on, carried or 0, 0)
            some = seen - (seen - valid)[begin] + (goes_on & (carried is not None))
            made[name] = pa.array(total, mask=some == 0)
        last: dict[str, np.ndarray] = {}
        for kind in ("prev", "next"):
            for name in self.names[kind]:
                valid = col[f"__{kind}_{name}"].is_valid().to_numpy(zero_copy_only=False)
                last[name] = np.maximum.accumulate(np.where(valid, place, -1))
        for name in self.names["prev"]:
            v, at = col[f"__prev_{name}"], np.where(last[name] >= begin, last[name], -1)
            if self.run.get(name) is not None:
                v, at = pa.concat_arrays([v, self.run[name]]), np.where((at < 0) & goes_on, n, at)
            made[name] = _at(v, at)
        ahead: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        if self.names["next"]:
            new_tie = new_key.copy()
            new_tie[0], new_tie[1:] = True, new_key[1:] | changes(t, self.order)
            tie, tie_begin = np.cumsum(new_tie) - 1, np.flatnonzero(new_tie)
            if not final:
                end = min(end, tie_begin[-1])  # rows equal to the last one may follow
            for name in self.names["next"]:
                v = col[f"__next_{name}"]
                valid = v.is_valid().to_numpy(zero_copy_only=False)
                best = np.maximum.reduceat(np.where(valid, place, -1), tie_begin)
                full = np.where(best >= 0, np.arange(len(best)), len(best))
                later = np.append(np.minimum.accumulate(full[::-1])[::-1][1:], len(best))
                at = np.append(best, -1)[later]
                at = np.where((at >= 0) & (key[at] == key[tie_begin]), at, -1)[tie]
                own = last[name] >= tie_begin[tie]
                at = np.where(own, last[name], at)
                if not final:
                    unknown = ~own & (key == key[-1]) & ((at < 0) | (at >= tie_begin[-1]))
                    end = min(end, int(tie_begin[tie[np.argmax(unknown)]]) if unknown.any() else end)
                made[name], ahead[name] = _at(v, at), (best, tie)
        for name in self.names["lead"]:
            same = np.append(~new_key[1:], False)
            made[name] = _at(col[f"__lead_{name}"], np.where(same, place + 1, -1))
        if end:
            yield self._sent(t, col, made, ahead, key, begin, int(end))
        self.held = t.slice(end) if end < n else None

    def _sent(self, t, col, made, ahead, key, begin, end) -> pa.RecordBatch:
        number = self.segment + key
        # records: from row ``low`` to before ``high`` of one key, ``low`` its first row or a continuation
        for record, low, high in (("first", 0, int(np.searchsorted(number[:end], 0, side="right"))), ("current", int(begin[end - 1]), end)):
            if low == high:
                continue
            r = getattr(self, record)
            if r is None or r["segment"] != number[low]:
                r = {"segment": int(number[low]), "key": t.select(self.keys).slice(low, 1), "next": {}, "lead": {c: col[f"__lead_{c}"].slice(low, 1) for c in self.names["lead"]}}
                setattr(self, record, r)
            r["run"] = {c: made[c].slice(high - 1, 1) for c in (ROW_NUMBER, *self.names["sums"], *self.names["prev"])}
            for c, (best, tie) in ahead.items():
                if c not in r["next"]:
                    hits = best[tie[low] : tie[high - 1] + 1]
                    if (hits >= 0).any():
                        r["next"][c] = col[f"__next_{c}"].slice(int(hits[np.argmax(hits >= 0)]), 1)
        run = self.current["run"]
        self.run = {c: run[c][0].as_py() for c in (ROW_NUMBER, *self.names["sums"])}
        self.run |= {c: run[c] if run[c][0].is_valid else None for c in self.names["prev"]}
        self.segment, self.last_key = int(number[end - 1]), t.select(self.keys).slice(end - 1, 1)
        out = {c: col[c].slice(0, end) for c in self.columns}
        wanted = col.get("__where")
        for c in made:
            if c in self.schema.names:
                out[c] = made[c].slice(0, end) if wanted is None else pc.if_else(wanted.slice(0, end), made[c].slice(0, end), None)
        out["__seg"] = pa.array((self.task << 32) + number[:end].astype(np.int64))
        sent = self._batch(out, end)
        return sent.filter(pc.fill_null(wanted.slice(0, end), False)) if self.only else sent

    def records(self) -> Iterator[pa.RecordBatch]:
        if self.current is None:
            return
        for r in [self.first] if self.current is self.first or self.current["segment"] == self.first["segment"] else [self.first, self.current]:
            values = {f"k{i}": r["key"][c].combine_chunks() for i, c in enumerate(self.keys)}
            values |= {"seg": pa.array([(self.task << 32) + r["segment"]])} | r["run"] | r["next"] | r["lead"]
            kind = self.schema.field("__edge").type
            parts = [pc.cast(values[f.name], f.type) if f.name in values else pa.nulls(1, f.type) for f in kind]
            yield self._batch({"__edge": pa.StructArray.from_arrays(parts, fields=list(kind))}, 1)

    def _batch(self, out: dict, n: int) -> pa.RecordBatch:
        cols = [pc.cast(out[f.name], f.type) if f.name in out else pa.nulls(n, f.type) for f in self.schema]
        return pa.RecordBatch.from_arrays(cols, schema=self.schema)


def _walked(
    df: DataFrame, keys: list[str], order: list[str], tie: list[str], names: dict[str, list[str]], columns: list[str], partitions: int | None,
    numbered: bool = True, extra: Sequence[Column] = (), only: bool = False, pack: Column | None = None,
) -> DataFrame:
    """Range exchange, local scan and write; see the module. ``extra`` is made from the sorted rows, it need not travel."""
    by = [*keys, *order]
    travel, cuts = (df, by) if pack is None else (packed(df, keys, pack), [*keys, PART])
    cut = travel.repartitionByRange(partitions, *cuts) if partitions else travel.repartitionByRange(*cuts)
    if pack is not None:
        cut = opened(cut, keys, [c for c in columns if c not in keys]).select(*columns)
    df = cut.sortWithinPartitions(*by, *tie).select("*", *extra)
    types = {f.name: nullable(f.dataType) for f in df.schema.fields}
    outs = [(ROW_NUMBER, T.LongType())]
    outs += [(c, T.LongType() if kind == "sums" else types[f"__{kind}_{c}"]) for kind in ("sums", "prev", "next", "lead") for c in names[kind]]
    edge = T.StructType([*[T.StructField(f"k{i}", types[k]) for i, k in enumerate(keys)], T.StructField("seg", T.LongType()), *[T.StructField(c, t) for c, t in outs]])
    added = [T.StructField(c, t) for c, t in [*outs[0 if numbered else 1 :], ("__seg", T.LongType()), ("__edge", edge)]]
    schema = T.StructType([T.StructField(c, types[c]) for c in columns] + added)
    as_arrow = to_arrow_schema(schema)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, none = _Walk(columns, keys, order, names, as_arrow, TaskContext.get().partitionId(), only), None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            none = rows.slice(0, 0)
            yield from w.add(rows, False)
        if none is not None:
            yield from w.add(none, True)
            yield from w.records()

    return session.written(df.mapInArrow(walk, schema), "scan")


def scan_parts(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], what: Scan, partitions: int | None = None
) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """The written rows of an ordered scan, and what completes the columns of those of them that need it."""
    keys, order = list(keys), list(order)
    kinds = ("sums", "prev", "next", "lead")
    names = {kind: list(getattr(what, kind)) for kind in kinds}
    value: dict[str, Callable[[Column], Column]] = {
        "sums": lambda e: e.cast("long"), "prev": lambda e: e, "next": lambda e: e, "lead": lambda e: F.struct(e.alias("v"))
    }
    extra = [value[kind](getattr(what, kind)[c]).alias(f"__{kind}_{c}") for kind in kinds for c in names[kind]]
    if what.where is not None:
        extra.append(what.where.alias("__where"))
    walked = _walked(df, keys, order, [what.tie] if what.tie else [], names, df.columns, partitions, bool(what.row_number), extra, what.only, what.pack)

    # What the parts of a key in earlier or later tasks bring: a window over at most two rows a task.
    edges = walked.where("__edge IS NOT NULL").select("__edge.*")
    of_key = Window.partitionBy(*[f"k{i}" for i in range(len(keys))])
    forward, back = of_key.orderBy("seg"), of_key.orderBy(F.col("seg").desc())
    so_far = (Window.unboundedPreceding, -1)
    carry = edges.select(
        F.col("seg").alias("__at"),
        F.sum(ROW_NUMBER).over(forward.rowsBetween(*so_far)).alias(f"__b_{ROW_NUMBER}"),
        *[F.sum(c).over(forward.rowsBetween(*so_far)).alias(f"__b_{c}") for c in names["sums"]],
        *[F.last(c, ignorenulls=True).over(forward.rowsBetween(*so_far)).alias(f"__b_{c}") for c in names["prev"]],
        *[F.last(c, ignorenulls=True).over(back.rowsBetween(*so_far)).alias(f"__b_{c}") for c in names["next"]],
        *[F.lead(c).over(forward).alias(f"__b_{c}") for c in names["lead"]],
        F.count(F.lit(1)).over(of_key).alias("__parts"),
    ).where("__parts > 1")
    # Written, so that Spark knows how small it is: the rows stay where they are.
    carry = session.written(carry, "carry")

    def both(kind: str, c: str) -> Column:
        here, there = F.col(c), F.col(f"__b_{c}")
        if kind == "sums":
            return F.when(here.isNull(), there).when(there.isNull(), here).otherwise(here + there)
        return F.coalesce(here, there)["v"] if kind == "lead" else F.coalesce(here, there)

    def complete(rows: DataFrame) -> DataFrame:
        return rows.join(carry, F.col("__seg") == F.col("__at"), "left").select(
            *df.columns,
            *([(F.col(ROW_NUMBER) + F.coalesce(f"__b_{ROW_NUMBER}", F.lit(0))).alias(what.row_number)] if what.row_number else []),
            *[both(kind, c).alias(c) for kind in kinds for c in names[kind]],
        )

    return walked.where("__seg IS NOT NULL"), complete


def scan(df: DataFrame, keys: Sequence[str], order: Sequence[str], what: Scan, partitions: int | None = None) -> DataFrame:
    """Add ordered-scan columns per key; ``order`` is ascending, nulls first.

    ``partitions`` is the number of range partitions, that of the session's
    shuffles if None; the rows are the same for any.
    """
    rows, complete = scan_parts(df, keys, order, what, partitions)
    return complete(rows)


def number_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, partitions: int | None = None) -> DataFrame:
    """1-based position inside each key, hot keys included."""
    return scan(df, keys, order, Scan(row_number=name), partitions)


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, name: str = "pos_in_key") -> DataFrame:
    """First ``k`` rows per key with their 1-based position.

    Spark cuts each task's rows to ``k`` per key before the exchange
    (WindowGroupLimit), so a hot key costs at most k rows per input task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w).cast("long")).where(F.col(name) <= k)
