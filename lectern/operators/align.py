"""Word timing against scenes: nearest match, intervals, pace, segments."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.window import Window

from lectern import rules, session
from lectern.functions.num import clamp, ms, round_half_up
from lectern.plans import spoken
from lectern.plans.blocks import ROWS_PER_BLOCK, in_blocks
from lectern.plans.ordered import Scan, scan
from lectern.plans.packs import PART, packed


def nearest_word(
    points: DataFrame,
    words: DataFrame,
    key: str,
    at: str = "at",
    start: str = "start_s",
    idx: str = "word_idx",
    partitions: int | None = None,
) -> DataFrame:
    """Add ``nearest_idx``: the word whose start is closest to each point.

    Ties go to the lowest index; a key without words gives 0. Points and words
    meet in one ordered scan instead of a cross product.
    """
    return _nearest(_timeline(points, words, key, at, start, idx, partitions), points.columns, key)


#: Seconds of a video that travel together to the ordered scan.
SPAN_S = 128


def _timeline(points: DataFrame, words: DataFrame, key: str, at: str, start: str, idx: str, partitions: int | None) -> DataFrame:
    """Points (their columns in ``__row``) with the latest word at or before them and the earliest after them.

    Points and words meet in one ordered scan, which only the points leave.
    """
    t = F.col("__t")
    both = points.select(
        key,
        F.col(at).alias("__t"),
        F.lit(1).alias("__kind"),
        F.lit(None).cast("long").alias("__back"),
        F.struct(*[c for c in points.columns if c != key]).alias("__row"),
    ).unionByName(
        words.select(key, F.col(start).alias("__t"), F.lit(0).alias("__kind"), (-F.col(idx).cast("long")).alias("__back")),
        allowMissingColumns=True,
    )
    seconds = t.cast("double")
    # latest start at or before, earliest at or after; of equal starts the lowest index
    is_word = (F.col("__kind") == 0) & t.isNotNull()
    word_t, word_i = F.when(is_word, t), F.when(is_word, -F.col("__back"))
    what = Scan(
        prev={"__pt": word_t, "__pi": word_i},
        next={"__nt": word_t, "__ni": word_i},
        tie="__back",
        where=F.col("__kind") == 1,
        only=True,
        pack=F.when(F.isnan(seconds), seconds).otherwise(F.floor(seconds / SPAN_S).cast("double")),
    )
    return scan(both, [key], ["__t", "__kind"], what, partitions)


def _nearest(points: DataFrame, cols: Sequence[str], key: str) -> DataFrame:
    """Completed points of a timeline with the index of the word closest to them."""
    before, after = F.abs(F.col("__t") - F.col("__pt")), F.abs(F.col("__nt") - F.col("__t"))
    best = (
        F.when(F.col("__pi").isNull() | (after < before), F.col("__ni"))
        .when(F.col("__ni").isNull() | (before < after), F.col("__pi"))
        .otherwise(F.least("__pi", "__ni"))
    )
    return points.select(
        *[F.col(key) if c == key else F.col(f"__row.{c}").alias(c) for c in cols],
        F.coalesce(best, F.lit(0).cast("long")).alias("nearest_idx"),
    )


class _Exits:
    """What a stretch of candidates makes of the last kept time that enters it.

    Which candidate is kept first decides all that follow, so the stretch is a
    function given by rows (first kept, exit, how many are kept) in the order of
    ``first``: a time that enters takes the first row at least ``gap`` later,
    and passes unchanged where there is none. Only candidates less than a gap
    after the stretch's first one, and the next one after those, can be the
    first that is kept.
    """

    def __init__(self, first: np.ndarray, exit: np.ndarray, n: np.ndarray):
        self.first, self.exit, self.n = first, exit, n

    @classmethod
    def of(cls, t: np.ndarray, gap: float) -> _Exits:
        nxt = _next_kept(t, t, gap)
        end, n = np.arange(len(t)), np.ones(len(t), dtype="int64")
        for i in range(len(t) - 1, -1, -1):
            if nxt[i] < len(t):
                end[i], n[i] = end[nxt[i]], n[nxt[i]] + 1
        m = _firsts(t, gap)
        return cls(t[:m], t[end[:m]], n[:m])

    def after(self, last: np.ndarray, gap: float) -> tuple[np.ndarray, np.ndarray]:
        """(exit, kept) for every entering time."""
        at = _next_kept(self.first, last, gap)
        hit = at < len(self.first)
        at = np.minimum(at, len(self.first) - 1)
        return np.where(hit, self.exit[at], last), np.where(hit, self.n[at], 0)

    @classmethod
    def composed(cls, parts: list[_Exits], gap: float) -> _Exits:
        """One function for neighbouring stretches."""
        firsts = np.concatenate([p.first for p in parts])
        m = _firsts(firsts, gap)
        exits, counts, done = np.concatenate([p.exit for p in parts])[:m], np.concatenate([p.n for p in parts])[:m], 0
        for p in parts:
            # rows of earlier stretches go on through this one
            exits[:done], more = p.after(exits[:done], gap)
            counts[:done] += more
            done = min(m, done + len(p.first))
        return cls(firsts[:m], exits, counts)


def _next_kept(t: np.ndarray, last: np.ndarray, gap: float) -> np.ndarray:
    """Place of the first sorted ``t`` with ``t - last >= gap``, compared exactly as the rule does."""
    at = np.searchsorted(t, last + gap, side="left")
    while len(t):
        early = (at > 0) & (t[np.maximum(at - 1, 0)] - last >= gap)
        late = (at < len(t)) & (t[np.minimum(at, len(t) - 1)] - last < gap)
        if not (early.any() or late.any()):
            break
        at = at - early + late
    return at


def _firsts(t: np.ndarray, gap: float) -> int:
    """How many sorted times lead: those less than a gap after the first one, and one more."""
    return min(len(t), int(np.count_nonzero(t - t[0] < gap)) + 1) if len(t) else 0


def _greedy(t: np.ndarray, last: float, gap: float) -> np.ndarray:
    """Places kept from sorted times when the last kept one was ``last``."""
    nxt, kept = _next_kept(t, t, gap).tolist(), []
    i = int(_next_kept(t, np.array([last]), gap)[0])
    while i < len(t):
        kept.append(i)
        i = nxt[i]
    return np.array(kept, dtype="int64")


def _segments(rows: pa.Table, by: str) -> list[tuple[pa.Scalar, pa.Table]]:
    """Rows with equal ``by``, which lie together."""
    if not rows.num_rows:
        return []
    c = rows[by].combine_chunks()
    same = pc.fill_null(pc.equal(c.slice(1), c.slice(0, len(c) - 1)), False).to_numpy(zero_copy_only=False)
    cuts = [0, *(np.flatnonzero(~same) + 1).tolist(), len(c)]
    return [(c[i], rows.slice(i, j - i)) for i, j in zip(cuts, cuts[1:])]


def _repeated(values: list[pa.Scalar], sizes: list[int], type: pa.DataType) -> pa.Array:
    """Each value as often as its size says."""
    return pa.array([v.as_py() for v in values], type).take(pa.array(np.repeat(np.arange(len(sizes)), sizes), pa.int64()))


def _exit_rows(of: list[tuple[pa.Scalar, int, _Exits]], schema: pa.Schema) -> pa.Table:
    sizes = [len(e.first) for _, _, e in of]
    cols = [
        _repeated([k for k, _, _ in of], sizes, schema.field(0).type),
        pa.array(np.repeat(np.array([s for _, s, _ in of], dtype="int64"), sizes)),
        *[pa.array(np.concatenate([getattr(e, c) for _, _, e in of]) if of else np.array([])) for c in ("first", "exit", "n")],
    ]
    return pa.Table.from_arrays([c.cast(f.type) for c, f in zip(cols, schema)], schema=schema)


def _exits_of(rows: pa.Table) -> _Exits:
    rows = rows.sort_by("first")
    return _Exits(*(rows[c].to_numpy().copy() for c in ("first", "exit", "n")))


def scene_thin(
    candidates: DataFrame,
    totals: DataFrame,
    key: str,
    at: str = "ts_s",
    min_gap: float = rules.SCENE_GAP_S,
    tail: float = rules.SCENE_TAIL_S,
    rows: int = ROWS_PER_BLOCK,
    fan: int = 64,
) -> DataFrame:
    """Scene starts: 0.0, then each candidate at least ``min_gap`` after the last kept.

    Candidates in the final ``tail`` do not count. Greedy, so neither a lag nor a
    running sum gives it. Totals: key, total_s; every key there has a scene 0.

    Candidates are written in blocks of ``rows`` consecutive ones. A block
    chooses for every key as if it began there, which is right but for keys
    that began in an earlier block; for its first and last key, the only ones
    that other blocks can share, it also gives its exit for every entry. These
    maps are functions, so ``fan`` neighbours are composed into one, those
    again, until one is left for each key; down the same levels every block
    then gets its true entry, and the few that began wrong choose again. A
    composed map has no more rows than there are candidates within a gap.
    """
    # what comes sooner after scene 0 is never kept
    c = candidates.select(key, F.col(at).cast("double").alias("t")).where(F.col("t") - F.lit(0.0) >= min_gap)
    # written, since the range exchange works its input out twice
    c = _written(packed(c, [key], F.lit(0)), "candidates").join(totals.select(key, "total_s"), key)
    c = c.select(key, F.explode_outer(F.filter("t", lambda t: t <= F.col("total_s") - tail)).alias("t")).where("t IS NOT NULL")
    c = in_blocks(c, [key, "t"], rows, distinct=True)
    kt = c.schema[key].dataType.simpleString()
    key_type = to_arrow_type(c.schema[key].dataType)
    exits_type = pa.schema([(key, key_type), ("node", pa.int64()), ("first", pa.float64()), ("exit", pa.float64()), ("n", pa.int64())])
    exits_ddl = f"`{key}` {kt}, node long, first double, exit double, n long"
    scene_type = pa.schema([(key, key_type), ("block", pa.int64()), ("scene_idx", pa.int64()), ("start_s", pa.float64())])
    scene_ddl = f"`{key}` {kt}, block long, scene_idx long, start_s double"

    def picked(parts: list[tuple[pa.Scalar, int, np.ndarray, int]]) -> list[pa.Array]:
        sizes = [len(t) for _, _, t, _ in parts]
        return [
            _repeated([k for k, _, _, _ in parts], sizes, key_type),
            pa.array(np.repeat(np.array([b for _, b, _, _ in parts], dtype="int64"), sizes)),
            pa.array(np.concatenate([np.arange(i, i + len(t)) for _, _, t, i in parts]) if parts else np.array([], "int64")),
            pa.array(np.concatenate([t for _, _, t, _ in parts]) if parts else np.array([], "float64")),
        ]

    def first_look(block: pa.Table) -> pa.Table:
        block = block.sort_by([(key, "ascending"), ("t", "ascending")])
        number, chosen, edges = block["block"][0].as_py(), [], []
        segments = [(k, s["t"].to_numpy()) for k, s in _segments(block, key)]
        for i, (k, t) in enumerate(segments):
            chosen.append((k, number, t[_greedy(t, 0.0, min_gap)], 1))
            if i in (0, len(segments) - 1):
                edges.append((k, number, _Exits.of(t, min_gap)))
        a, b = picked(chosen), _exit_rows(edges, exits_type)
        left, right = pa.Table.from_arrays(a, schema=scene_type), b.rename_columns([key, "block", *b.column_names[2:]])
        return pa.concat_tables([left, right], promote_options="default").select([key, "block", "scene_idx", "start_s", "first", "exit", "n"])

    made = f"{scene_ddl}, first double, exit double, n long"
    looked = _written(c.groupBy("block").applyInArrow(first_look, made), "scenes")
    chosen = looked.where("scene_idx IS NOT NULL").select(key, "block", "scene_idx", "start_s")

    # Number the blocks of the keys that have more than one; narrow rows, one per block.
    edges = looked.where("first IS NOT NULL").select(key, "block", "first", "exit", "n")
    blocks = edges.select(key, "block").distinct()
    many = blocks.groupBy(key).count().where("count > 1").select(key)
    seq = (F.row_number().over(Window.partitionBy(key).orderBy("block")) - 1).cast("long")
    nodes = _written(blocks.join(many, key, "left_semi").withColumn("node", seq), "scene-nodes")
    most = nodes.agg(F.max("node")).first()[0]  # one number: how many levels there are
    result = chosen
    if most is not None:
        levels = [_written(edges.join(nodes, [key, "block"]).select(key, "node", "first", "exit", "n"), "exits-0")]

        def compose(rows: pa.Table) -> pa.Table:
            rows = rows.sort_by([("node", "ascending"), ("first", "ascending")])
            parts = [_exits_of(s) for _, s in _segments(rows, "node")]
            return _exit_rows([(rows[key][0], rows["node"][0].as_py() // fan, _Exits.composed(parts, min_gap))], exits_type)

        while most:
            most //= fan
            up = levels[-1].withColumn("parent", F.floor(F.col("node") / fan)).groupBy(key, "parent")
            levels.append(_written(up.applyInArrow(_without(compose, "parent"), exits_ddl), f"exits-{len(levels)}"))

        entry_ddl = f"`{key}` {kt}, node long, entry double, before long"

        def enter(children: pa.Table, parent: pa.Table) -> pa.Table:
            if not children.num_rows or not parent.num_rows:
                return pa.table({key: pa.array([], key_type), "node": pa.array([], pa.int64()), "entry": pa.array([], pa.float64()), "before": pa.array([], pa.int64())})
            children = children.sort_by([("node", "ascending"), ("first", "ascending")])
            last, kept, out = np.array([parent["entry"][0].as_py()]), parent["before"][0].as_py(), []
            for node, s in _segments(children, "node"):
                out.append((node.as_py(), float(last[0]), int(kept)))
                last, more = _exits_of(s).after(last, min_gap)
                kept += int(more[0])
            return pa.table(
                {key: pa.array([children[key][0].as_py()] * len(out), key_type), "node": pa.array([o[0] for o in out], pa.int64()), "entry": pa.array([o[1] for o in out], pa.float64()), "before": pa.array([o[2] for o in out], pa.int64())}
            )

        entry = levels.pop().select(key, "node").distinct().select(key, "node", F.lit(0.0).alias("entry"), F.lit(1).cast("long").alias("before"))
        for level in reversed(levels):
            down = level.withColumn("parent", F.floor(F.col("node") / fan)).groupBy(key, "parent")
            entry = _written(down.cogroup(entry.groupBy(key, "node")).applyInArrow(enter, entry_ddl), "entries")
        entry = _written(nodes.join(entry, [key, "node"]).where("node > 0").select(key, "block", "entry", "before"), "true-entries")

        def again(rows: pa.Table) -> pa.Table:
            t = np.sort(rows["t"].to_numpy())
            place = rows["before"][0].as_py()
            kept = t[_greedy(t, rows["entry"][0].as_py(), min_gap)]
            return pa.Table.from_arrays(picked([(rows[key][0], rows["block"][0].as_py(), kept, place)]), schema=scene_type)

        redone = c.join(entry, [key, "block"]).groupBy(key, "block").applyInArrow(again, scene_ddl)
        result = chosen.join(entry, [key, "block"], "left_anti").unionByName(redone)
    zero = totals.select(key, F.lit(0).alias("scene_idx"), F.lit(0.0).alias("start_s"))
    return zero.unionByName(result.select(key, F.col("scene_idx").cast("int").alias("scene_idx"), "start_s"))


def _without(fn, name: str):
    """``fn`` on rows less one column."""
    return lambda rows: fn(rows.drop_columns([name]))


def _written(df: DataFrame, name: str) -> DataFrame:
    return session.written(df, name)


def scene_intervals(
    scenes: DataFrame,
    totals: DataFrame,
    key: str,
    tail: float = rules.SCENE_TAIL_S,
    partitions: int | None = None,
) -> DataFrame:
    """End of each scene: the next start, for the last one the total less the tail."""
    nxt = scan(scenes, [key], ["start_s"], Scan(lead={"__next": F.col("start_s")}), partitions)
    end = F.coalesce("__next", F.greatest(F.lit(0.0), F.col("total_s") - tail))
    return nxt.join(totals, key).select(
        key,
        "scene_idx",
        "start_s",
        ms(end).alias("end_s"),
        ms(end - F.col("start_s")).alias("duration_s"),
        F.col("__next").isNull().alias("is_last"),
    )


def _edges(scenes: DataFrame, key: str, *keep: str) -> DataFrame:
    sides = F.array(
        F.struct(F.lit(0).alias("side"), F.col("start_s").alias("at")),
        F.struct(F.lit(1).alias("side"), F.col("end_s").alias("at")),
    )
    return scenes.select(key, "scene_idx", "start_s", "end_s", "is_last", *keep, F.inline(sides))


def _sides(near: DataFrame, key: str) -> DataFrame:
    """Edges with their nearest word as scenes with one of ``lo`` and ``hi``."""
    lo, hi = (F.when(F.col("side") == side, F.col("nearest_idx")).alias(c) for side, c in enumerate(("lo", "hi")))
    return near.select(key, "scene_idx", "start_s", "end_s", "is_last", lo, hi)


def _met_ranges(scenes: DataFrame, packs: DataFrame, n: DataFrame, key: str, partitions: int | None) -> DataFrame:
    """``slide_ranges`` for words in packs.

    Only edges without words of their span on both sides go through the ordered
    scan, with the first and the last word of each span.
    """
    met = spoken.nearest_in_span(packs, scenes.select(key, "scene_idx", "start_s", "end_s", "is_last"), key, "start_s", "end_s")
    asked = met.where("__row IS NOT NULL").select(key, "__row.*", F.col("__i").alias("lo"), F.col("__j").alias("hi"), "__asks")
    words = met.where("__row IS NULL").select(key, F.col("__t").alias("start_s"), F.col("__i").alias("word_idx"))
    unknown = F.when(F.col("side") == 0, F.col("lo").isNull() & (F.col("__asks") != 1)).otherwise(F.col("hi").isNull() & (F.col("__asks") != 0))
    left = _edges(asked.where("lo IS NULL OR hi IS NULL"), key, "lo", "hi", "__asks").where(unknown).drop("lo", "hi", "__asks")
    asked = asked.drop("__asks")
    return _range_rows(asked.unionByName(_sides(nearest_word(left, words, key, partitions=partitions), key)), n, key)


def _ranges(scenes: DataFrame, words: DataFrame, n: DataFrame, key: str, partitions: int | None) -> DataFrame:
    return _range_rows(_sides(nearest_word(_edges(scenes, key), words, key, partitions=partitions), key), n, key)


def _range_rows(near: DataFrame, n: DataFrame, key: str) -> DataFrame:
    both = near.groupBy(key, "scene_idx").agg(
        F.min("start_s").alias("start_s"),
        F.min("end_s").alias("end_s"),
        F.bool_or("is_last").alias("is_last"),
        F.max("lo").alias("lo"),
        F.max("hi").alias("hi"),
    )
    last = F.col("n_words") - 1
    lo = F.greatest(F.lit(0).cast("long"), F.least(F.col("lo"), last))
    end = F.greatest(lo, F.least(F.when(F.col("is_last"), last).otherwise(F.col("hi") - 1), last))
    return both.join(n, key, "left").fillna(0, ["n_words"]).select(
        key,
        "scene_idx",
        "start_s",
        "end_s",
        "n_words",
        lo.alias("word_start_index"),
        end.alias("word_end_index"),
        (~F.col("is_last") & (F.least(F.col("hi"), last) <= end)).alias("overlap"),
    )


def slide_ranges(scenes: DataFrame, words: DataFrame, key: str, partitions: int | None = None) -> DataFrame:
    """Word range of each scene, clamped to the words there are.

    Scenes follow on one another, so the word nearest to a scene's end is where
    the next one starts; ``overlap`` tells that clamping made both use it.
    """
    n = words.groupBy(key).agg(F.count(F.lit(1)).alias("n_words"))
    return _ranges(scenes, words, n, key, partitions)


#: Words of a video that are looked up together.
STRETCH = 256


def _stretches(words: DataFrame, key: str, *columns: str) -> tuple[DataFrame, DataFrame]:
    """Words (``word_idx`` and ``columns``) in packs of a stretch, written once, and their number per key.

    ``__whole`` marks packs that hold their indices in order and without gaps.
    """
    w = words.select(key, F.col("word_idx").cast("long").alias("word_idx"), *columns)
    base = F.get("word_idx", F.lit(0))
    whole = F.forall(F.transform("word_idx", lambda x, i: x - i), lambda x: x.eqNullSafe(base))
    packs = _written(packed(w, [key], F.floor(F.col("word_idx") / STRETCH)).withColumn("__whole", whole), "words")
    return packs, packs.groupBy(key).agg(F.sum(F.size("word_idx")).cast("long").alias("n_words"))


def _between(first: Column, last: Column, columns: Sequence[str]) -> Column:
    """The words of a pack from index ``first`` to ``last``, both included.

    Whole packs, the rule, are cut by place; the filter makes it right for any.
    """
    n, low = F.size("word_idx"), F.get("word_idx", F.lit(0))
    begin = F.when(F.col("__whole"), F.greatest(first - low, F.lit(0))).otherwise(F.lit(0)).cast("int")
    count = F.when(F.col("__whole"), F.greatest(last - low + 1 - begin, F.lit(0))).otherwise(n).cast("int")
    return F.filter(F.arrays_zip(*[F.slice(c, begin + 1, count).alias(c) for c in columns]), lambda w: w["word_idx"].between(first, last))


def _slides(scenes: DataFrame, words: DataFrame, key: str, partitions: int | None = None) -> DataFrame:
    """``slide_text`` with ``__start``, where the first word of the range starts, and ``__end``, where its last one ends.

    Words are packed and written once. Scene edges meet their starts by spans of
    time, ranges meet their text by stretches of words, so a long video spreads
    over tasks. A slide inside one stretch is complete there, only the parts of
    others move on.
    """
    packs = spoken.packs(words, key)
    n = packs.groupBy(key).agg(F.sum("n").alias("n_words"))
    ranges = _met_ranges(scenes, packs, n, key, partitions)
    kept = [c for c in ranges.columns if c not in (key, "scene_idx", "n_words")]
    first, last = (F.floor(F.col(c) / spoken.STRETCH) for c in ("word_start_index", "word_end_index"))
    # what has no words lies below all stretches, spread over some
    stretches = F.when(F.col("n_words") > 0, F.sequence(first, last)).otherwise(F.array(-1 - F.pmod(F.hash("scene_idx"), F.lit(1000)).cast("long")))
    parts = ranges.select(key, "scene_idx", *kept, F.size(stretches).alias("__parts"), F.explode_outer(stretches).alias("stretch"))
    parts = spoken.said(packs, parts, key, "word_start_index", "word_end_index")
    made = ["__n", "__text", "__a", "__z", "__start", "__end"]
    rest = parts.where("__parts > 1").groupBy(key, "scene_idx").agg(
        F.array_sort(F.collect_list(F.struct("stretch", *made))).alias("__w"), *[F.first(c).alias(c) for c in kept]
    )
    heard = F.filter("__w", lambda x: x["__n"] > 0)
    rest = rest.withColumn("__h", heard).select(
        key,
        "scene_idx",
        *kept,
        F.aggregate("__h.__n", F.lit(0).cast("long"), lambda x, y: x + y).alias("__n"),
        F.array_join("__h.__text", " ").alias("__text"),
        F.get("__h", F.lit(0))["__a"].alias("__a"),
        F.get("__h", F.size("__h") - 1)["__z"].alias("__z"),
        F.array_max("__w.__start").alias("__start"),
        F.array_max("__w.__end").alias("__end"),
    )
    s = parts.where("__parts = 1").select(rest.columns).unionByName(rest)
    return s.select(
        key,
        F.col("scene_idx").alias("slide_index"),
        ms(F.col("start_s")).alias("video_start"),
        ms(F.col("end_s")).alias("video_end"),
        ms(F.col("end_s") - F.col("start_s")).alias("video_duration"),
        "word_start_index",
        "word_end_index",
        F.col("__n").alias("word_count"),
        ms(F.coalesce("__a", "start_s")).alias("original_audio_start"),
        ms(F.coalesce("__z", "end_s")).alias("original_audio_end"),
        F.col("__text").alias("text"),
        "overlap",
        "__start",
        "__end",
    )


def slide_text(scenes: DataFrame, words: DataFrame, key: str, partitions: int | None = None) -> DataFrame:
    """Text, word count and spoken interval of each scene."""
    return _slides(scenes, words, key, partitions).drop("__start", "__end")


def _word_times(rows: DataFrame, words: DataFrame, key: str, ids: list[str], first: str, last: str) -> DataFrame:
    """``rows`` with start of word ``first`` and end of word ``last``, in one join.

    Both look-ups travel as rows on (key, stretch) with the row they are for,
    so words and rows are shuffled once and a long video spreads over tasks.
    """
    rest = [c for c in rows.columns if c not in ids]
    sides = F.array(F.struct(F.lit(0).alias("__side"), F.col(first).alias("__i")), F.struct(F.lit(1).alias("__side"), F.col(last).alias("__i")))
    want = rows.select(*ids, F.struct(*rest).alias("__row"), F.inline(sides)).withColumn(PART, F.floor(F.col("__i") / STRETCH))
    hit = _between(F.col("__i"), F.col("__i"), ["word_idx", "start_s", "end_s"])
    start, end = F.array_max("__hit.start_s"), F.array_max("__hit.end_s")
    found = want.join(words, [key, PART], "left").withColumn("__hit", hit).groupBy(*ids).agg(
        F.first("__row").alias("__row"),
        F.max(F.when(F.col("__side") == 0, start)).alias("__start"),
        F.max(F.when(F.col("__side") == 0, end)).alias("__first_end"),
        F.max(F.when(F.col("__side") == 1, end)).alias("__end"),
    )
    return found.select(*ids, "__row.*", "__start", "__first_end", "__end")


def slide_pace(slide_map: DataFrame, words: DataFrame, key: str, slide: str = "slide_index") -> DataFrame:
    """Speed factor that fits each slide's picture to its spoken words.

    A key without words keeps its video duration, factor 1.
    """
    w, n = _stretches(words, key, "start_s", "end_s")
    s = slide_map.join(n, key, "left").select(
        *slide_map.columns,
        F.least(F.col("word_start_index").cast("long"), F.col("n_words") - 1).alias("__ws"),
        F.least(F.col("word_end_index").cast("long"), F.col("n_words") - 1).alias("__we"),
    )
    return _paced(_word_times(s, w, key, [key, slide], "__ws", "__we"), slide_map.columns)


def paced_slides(scenes: DataFrame, words: DataFrame, key: str) -> DataFrame:
    """``slide_pace`` of ``slide_text``: the words of a slide are at hand when its text is made."""
    slides = _slides(scenes, words, key)
    return _paced(slides, [c for c in slides.columns if c not in ("__start", "__end")])


def _paced(j: DataFrame, columns: Sequence[str]) -> DataFrame:
    video = F.col("video_end") - F.col("video_start")
    spoken = F.col("__end") - F.col("__start")
    spoken = F.when(spoken.isNull() | (spoken < rules.PACE_FLOOR_S), video).otherwise(spoken)
    factor = clamp(F.coalesce(F.try_divide(video, spoken), F.lit(1.0)), rules.PACE_MIN, rules.PACE_MAX)
    return j.select(
        *columns,
        spoken.alias("tts_duration"),
        factor.alias("speed_factor"),
        (F.abs(factor - 1.0) >= rules.PACE_DEAD_BAND).alias("needs_adjust"),
    )


def segment_split(words: DataFrame, scripts: DataFrame, key: str) -> DataFrame:
    """Intro and main end times from expected word counts scaled to the heard ones.

    Scripts: key, intro_words, main_words, outro_words, total_duration.
    """
    w, n = _stretches(words, key, "start_s", "end_s")
    outro = F.when(F.coalesce("outro_words", F.lit(0)) == 0, F.lit(rules.OUTRO_WORDS)).otherwise(F.col("outro_words"))
    s = scripts.join(n, key, "left").fillna(0, ["n_words"])
    ratio = F.try_divide(F.col("n_words").cast("double"), (F.col("intro_words") + F.col("main_words") + outro).cast("double"))
    top = F.col("n_words") - 2
    s = s.withColumn("__r", ratio)
    s = s.withColumn("intro_end_idx", F.least(round_half_up(F.col("intro_words") * F.col("__r")) - 1, top))
    s = s.withColumn("main_end_idx", F.least(F.col("intro_end_idx") + round_half_up(F.col("main_words") * F.col("__r")), top))
    j = _word_times(s, w, key, [key], "intro_end_idx", "main_end_idx")
    return j.select(
        key,
        "n_words",
        "intro_end_idx",
        "main_end_idx",
        F.coalesce("__first_end", F.lit(0.0)).alias("intro_end"),
        F.coalesce("__end", "total_duration").alias("main_end"),
        "total_duration",
    )


def transcript_rollup(segments: DataFrame, key: str) -> DataFrame:
    """Duration, word and segment counts and the full text per video.

    Segments: key, seg_id, end_s, n_words, text. One aggregate, no look at words.
    """
    s = segments.groupBy(key).agg(
        F.max_by("end_s", "seg_id").alias("duration"),
        F.coalesce(F.sum("n_words"), F.lit(0)).alias("total_words"),
        F.count(F.lit(1)).alias("total_segments"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seg_id", "text"))), lambda x: x["text"]), " ").alias("full_text"),
    )
    return s.select(
        key,
        F.coalesce("duration", F.lit(0.0)).alias("duration"),
        F.col("total_words").cast("long").alias("total_words"),
        "total_segments",
        F.coalesce("full_text", F.lit("")).alias("full_text"),
    )


def track_timeline(tracks: DataFrame, key: str, order: Sequence[str] = ("pos",), partitions: int | None = None) -> DataFrame:
    """Start offset and fade-out point of each track in playing order.

    Tracks: key, the order columns, video_s, audio_s. The audio length counts where it is
    known and above zero.
    """
    eff = F.when(F.col("audio_s") > 0, F.col("audio_s")).otherwise(F.col("video_s"))
    t = tracks.withColumn("duration_s", eff)
    # Whole microseconds add up alike however a long list is cut.
    exact = (F.col("duration_s").cast("decimal(20,6)") * 1_000_000).cast("long")
    run = scan(t, [key], list(order), Scan(sums={"__sum": exact}), partitions)
    return run.select(
        *tracks.columns,
        "duration_s",
        (F.col("duration_s") < F.col("video_s") - rules.AUDIO_SHORT_S).alias("audio_short"),
        ((F.col("__sum") - exact) / 1_000_000).alias("offset_s"),
        F.greatest(F.lit(0.0), F.col("duration_s") - rules.FADE_S).alias("fade_out_s"),
    )
