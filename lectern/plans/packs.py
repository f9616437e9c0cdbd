"""Narrow rows packed into arrays before they are shuffled.

A word with its times is some fifty bytes as a row and a fraction of that in
arrays, whose equal-looking values compress. Each task packs the rows it has at
hand, batch by batch, so packing needs no shuffle of its own and never holds
more than a batch; rows of one group that come apart make several packs, and
whoever reads packs takes them as such.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Name of the group a pack's rows have in common beside their keys.
PART = "__part"


def changes(t: pa.Table, columns: Sequence[str]) -> np.ndarray:
    """Whether row i + 1 differs from row i in any of the columns; nulls are equal."""
    out = np.zeros(max(t.num_rows - 1, 0), bool)
    for c in columns:
        v = t[c].combine_chunks()
        a, b = v.slice(1), v.slice(0, len(v) - 1)
        same = pc.or_(pc.fill_null(pc.equal(a, b), False), pc.and_(pc.is_null(a), pc.is_null(b)))
        out |= ~same.to_numpy(zero_copy_only=False)
    return out


def nullable(t: T.DataType) -> T.DataType:
    """The type with nulls allowed at every depth."""
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f.name, nullable(f.dataType)) for f in t.fields])
    if isinstance(t, T.ArrayType):
        return T.ArrayType(nullable(t.elementType))
    if isinstance(t, T.MapType):
        return T.MapType(nullable(t.keyType), nullable(t.valueType))
    return t


def packed(df: DataFrame, keys: Sequence[str], part: Column) -> DataFrame:
    """One row for the rows of a batch with equal keys and ``part``: these, and an array of every other column."""
    by, rest = [*keys, PART], [c for c in df.columns if c not in keys]
    rows = df.select(*keys, part.alias(PART), *rest)
    types = {f.name: nullable(f.dataType) for f in rows.schema.fields}
    schema = T.StructType([T.StructField(c, types[c]) for c in by] + [T.StructField(c, T.ArrayType(types[c])) for c in rest])
    as_arrow = to_arrow_schema(schema)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch])
            if len(np.flatnonzero(changes(t, by))):
                t = t.take(pc.sort_indices(t, sort_keys=[(c, "ascending") for c in by])).combine_chunks()
            cuts = [0, *(np.flatnonzero(changes(t, by)) + 1).tolist(), t.num_rows]
            firsts, offsets = pa.array(cuts[:-1], pa.int64()), pa.array(cuts, pa.int32())
            cols = [t[c].combine_chunks().take(firsts) for c in by]
            cols += [pa.ListArray.from_arrays(offsets, t[c].combine_chunks()) for c in rest]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(cols, as_arrow)], schema=as_arrow)

    return rows.mapInArrow(pack, schema)


def opened(packs: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The rows again."""
    # the outer form: see functions/arrays.py; no pack is empty
    return packs.select(*keys, F.inline_outer(F.arrays_zip(*columns)))
