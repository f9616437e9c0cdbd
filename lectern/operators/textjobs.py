"""Whole-table text jobs: scripts, emphasis, cleaning, chunking, instructions."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern import rules
from lectern.functions.arrays import open_rows
from lectern.functions.num import clamp
from lectern.functions.text import (
    SPACE,
    WIDE,
    WORD_END,
    WORD_START,
    clean,
    fill,
    number,
    split_count,
    strip_ansi,
    trim_space,
)
from lectern.plans.ordered import number_rows


# --- scripts ----------------------------------------------------------------


def rotation(df: DataFrame, keys: list[str], order: list[str], n: int, name: str, by: str = "position", partitions: int | None = None) -> DataFrame:
    """0-based choice among ``n`` variants that repeats run after run.

    ``position`` walks through the variants inside a group, so neighbours
    differ; ``hash`` picks by the row's own id and needs no shuffle at all.
    """
    if by == "hash":
        digest = F.substring(F.sha2(F.concat_ws("|", *[F.col(c).cast("string") for c in order]), 256), 1, 8)
        return df.withColumn(name, F.pmod(F.conv(digest, 16, 10).cast("long"), F.lit(n)))
    if by != "position":
        raise ValueError(f"by must be 'position' or 'hash', not {by!r}")
    pos = number_rows(df, keys, order, "__pos", partitions)
    return pos.withColumn(name, F.pmod(F.col("__pos") - 1, F.lit(n))).drop("__pos")


def _variant(templates: list[str], choice: Column, **values: Column) -> Column:
    out = F.when(choice == 0, fill(templates[0], **values))
    for i, t in enumerate(templates[1:], start=1):
        out = out.when(choice == i, fill(t, **values))
    return out


def build_scripts(
    docs: DataFrame,
    topics: DataFrame,
    key: str,
    channel: str,
    text: str = "text",
    by: str = "position",
    partitions: int | None = None,
) -> DataFrame:
    """Intro, unchanged main text and outro with word counts and durations.

    Topics: key, stream, subject, topic. Texts travel only after the choice of
    variants is made on the narrow topic rows.
    """
    t = topics.select(key, "stream", "subject", "topic")
    t = rotation(t, ["stream"], [key], len(rules.INTROS) * len(rules.OUTROS), "__v", by, partitions)
    j = docs.select(key, text).join(t, key, "left")
    topic, subject = F.coalesce("topic", F.lit(rules.UNKNOWN)), F.coalesce("subject", F.lit(rules.UNKNOWN))
    v = F.coalesce("__v", F.lit(0))
    n = len(rules.INTROS)
    values = {"channel": F.lit(channel), "topic": topic, "subject": subject}
    s = j.select(
        key,
        "stream",
        "subject",
        "topic",
        _variant(rules.INTROS, F.pmod(v, F.lit(n)), **values).alias("intro_text"),
        trim_space(F.col(text)).alias("main_text"),
        _variant(rules.OUTROS, F.pmod(F.floor(v / n) + v, F.lit(len(rules.OUTROS))), **values).alias("outro_text"),
    )
    parts = ("intro", "main", "outro")
    s = s.withColumns({f"{p}_words": split_count(F.col(f"{p}_text")).cast("long") for p in parts})
    return s.withColumns(
        {
            "full_script": F.concat_ws("\n\n", *[f"{p}_text" for p in parts]),
            "total_words": F.col("intro_words") + F.col("main_words") + F.col("outro_words"),
            **{f"{p}_s": F.ceil(F.col(f"{p}_words") / rules.WORDS_PER_SECOND).cast("long") for p in parts},
        }
    )


def script_budget(scripts: DataFrame) -> DataFrame:
    """Scripts, words and minutes per stream and subject."""
    secs = F.col("intro_s") + F.col("main_s") + F.col("outro_s")
    return scripts.groupBy("stream", "subject").agg(
        F.count(F.lit(1)).alias("scripts"),
        F.sum("total_words").alias("words"),
        F.round(F.sum(secs) / 60, 2).alias("minutes"),
    )


# --- emphasis ---------------------------------------------------------------


def _any(phrases: list[str]) -> str:
    return "|".join(phrases)


def _emphasis_rules() -> list[tuple[str, str, str, list[str], bool, str | int]]:
    """(kind, pattern, replacement, phrases, case matters, trace) in the order they apply.

    The trace is what one replacement adds to the text: so many characters, or
    one more of a string where the length stays.
    """
    out = [("suspense", rf"(?i)([,.]) ({_any(p)})", "$1 ...$2", p, False, 3) for p in rules.SUSPENSE_PHRASES]
    out += [
        ("exclaim", rf"(?i){WORD_START}({_any(p)})([^.!?]*)\.(?!{SPACE}*\.)", "$1$2!", p, False, "!")
        for p in rules.EXCLAIM_PHRASES
    ]
    ask, line, mid, show = rules.QUESTION_PHRASES, rules.LINE_CONNECTORS, rules.MID_CONNECTORS, rules.REVEAL_PHRASES
    out += [
        ("question", rf"(?i){WORD_START}({_any(ask)}){WORD_END}([^.!?]{{5,60}})\.", "$1$2?", ask, False, "?"),
        ("comma", rf"(?<![^\n\r\u2028\u2029])({_any(line)}) ([A-Z])", "$1, $2", [f"{w} " for w in line], True, 1),
        ("comma", rf"(?i){WORD_START}({_any(mid)}) ([a-z])", "$1, $2", mid, False, 1),
        ("dash", rf"(?i){WORD_START}({_any(show)}) ", "$1 — ", show, False, 2),
    ]
    out += [("upper", f"{WORD_START}{w}{WORD_END}", w.upper(), [w], True, w.upper()) for w in rules.UPPER_WORDS]
    return out


def _hits(before: str, after: str, trace: str | int) -> Column:
    """How often a rule replaced something, read from its traces instead of matching once more."""
    if isinstance(trace, int):
        return F.floor((F.length(after) - F.length(before)) / trace)
    without = [F.length(F.replace(F.col(c), F.lit(trace), F.lit(""))) for c in (before, after)]
    return F.floor((F.length(after) - without[1] - F.length(before) + without[0]) / len(trace))


EMPHASIS_KINDS = ["suspense", "exclaim", "question", "comma", "dash", "upper"]


@F.pandas_udf(T.LongType())
def _changes(a: pd.Series, b: pd.Series) -> pd.Series:
    """Differing positions plus the difference in length.

    Comparing letter by letter has no vectorized form in Spark: arrays of single
    letters cost about a hundred times as much as these arrays of code points.
    """

    def count(x: str | None, y: str | None) -> int:
        if x == y or x is None or y is None:
            return 0
        p, q = (np.frombuffer(s.encode("utf-32-le", "surrogatepass"), dtype="<u4") for s in (x, y))
        n = min(len(p), len(q))
        return int((p[:n] != q[:n]).sum()) + abs(len(p) - len(q))

    return pd.Series([count(x, y) for x, y in zip(a, b)], dtype="int64")


def emphasize(docs: DataFrame, text: str = "text", drift: float = rules.DRIFT_MAX) -> DataFrame:
    """Spoken-style punctuation and capitals; a text whose word count drifts reverts.

    Adds ``emphasized``, ``word_drift``, ``reverted``, ``n_changes`` and one hit
    count per kind of rule. Each rule sees the text the earlier ones left. A rule's
    pattern runs only on texts that hold one of its phrases at all; rules add
    punctuation or capitals and so never create a phrase, which makes one look at
    the original text enough.
    """
    cols = docs.columns
    table = _emphasis_rules()
    low = F.lower(text)
    holds = [
        reduce(lambda a, b: a | b, [(F.col(text) if exact else F.col("__low")).contains(p) for p in phrases]).alias(f"__g{i}")
        for i, (*_, phrases, exact, _) in enumerate(table)
    ]
    d = docs.withColumn("__low", low).select(*cols, F.col(text).alias("__t0"), *holds)
    hits: dict[str, list[Column]] = {k: [] for k in EMPHASIS_KINDS}
    for i, (kind, pattern, repl, *_, trace) in enumerate(table):
        hits[kind].append(F.when(F.col(f"__g{i}"), _hits(f"__t{i}", f"__t{i + 1}", trace)).otherwise(F.lit(0)))
        d = d.withColumn(
            f"__t{i + 1}",
            F.when(F.col(f"__g{i}"), F.regexp_replace(f"__t{i}", pattern, repl)).otherwise(F.col(f"__t{i}")),
        )
    final = F.col(f"__t{len(table)}")
    d = d.withColumns(
        {
            "__w0": split_count(trim_space(F.col(text))),
            "__out": final,
            **{f"hits_{k}": reduce(lambda a, b: a + b, v).cast("long") for k, v in hits.items()},
        }
    )
    d = d.withColumn("__w1", F.when(F.col("__out") == F.col(text), F.col("__w0")).otherwise(split_count(trim_space(F.col("__out")))))
    shift = F.abs(F.col("__w0") - F.col("__w1")) / F.col("__w0")
    d = d.withColumns({"word_drift": shift, "reverted": shift > drift})
    d = d.withColumn("emphasized", F.when(F.col("reverted"), F.col(text)).otherwise(F.col("__out")))
    differs = F.col(text) != F.col("emphasized")  # other texts do not travel to Python
    return d.select(
        *cols,
        "emphasized",
        "word_drift",
        "reverted",
        F.coalesce(_changes(F.when(differs, F.col(text)), F.when(differs, F.col("emphasized"))), F.lit(0).cast("long")).alias("n_changes"),
        *[f"hits_{k}" for k in EMPHASIS_KINDS],
    )


def emphasis_audit(emphasized: DataFrame, by: str, text: str = "text") -> DataFrame:
    return emphasized.groupBy(by).agg(
        F.count(F.lit(1)).alias("docs"),
        F.count_if(F.col("emphasized") != F.col(text)).alias("changed"),
        F.count_if("reverted").alias("reverted"),
        F.round(F.avg("word_drift"), 6).alias("mean_drift"),
        *[F.sum(f"hits_{k}").alias(f"hits_{k}") for k in EMPHASIS_KINDS],
    )


# --- cleaning ---------------------------------------------------------------


def clean_text(docs: DataFrame, text: str = "text") -> DataFrame:
    """Cleaned texts; rows left empty are dropped."""
    return docs.withColumn(text, clean(F.col(text))).where(F.col(text) != "")


def cleaning_report(docs: DataFrame, by: str, text: str = "text") -> DataFrame:
    d = docs.select(by, F.col(text).alias("__a"), clean(F.col(text)).alias("__b"))
    return d.groupBy(by).agg(
        F.count(F.lit(1)).alias("docs"),
        F.count_if(F.col("__a") != F.col("__b")).alias("changed"),
        F.sum(F.length("__a") - F.length("__b")).cast("long").alias("chars_removed"),
        F.count_if(F.col("__b") == "").alias("dropped"),
    )


# --- chunks and instructions ------------------------------------------------


def pack_chunks(docs: DataFrame, key: str, text: str = "text", limit_words: int = rules.CHUNK_WORDS, keep_tail: bool = True) -> DataFrame:
    """Sentences packed greedily into chunks of at most ``limit_words`` words.

    A longer sentence is a chunk of its own; a text without any sentence is one
    chunk. ``keep_tail`` keeps what follows the last full stop, which the plain
    sentence pattern drops. The fold keeps only chunk boundaries; the text
    itself is sliced once. Each document stays one row until its chunks leave.
    """
    pattern = rf"[^.!?]+[.!?]+{SPACE}*"
    if keep_tail:
        pattern = rf"{pattern}|[^.!?]+$"
    d = docs.select(key, text, F.regexp_extract_all(text, F.lit(pattern), 0).alias("__f"), F.col(text).rlike(WIDE).alias("__wide"))
    d = d.select(key, F.when(F.size("__f") == 0, F.array(text)).otherwise(F.col("__f")).alias("__s"), "__wide")

    def spoken(s: Column) -> Column:
        wide = F.when(trim_space(s) == "", F.lit(0)).otherwise(split_count(trim_space(s)))
        return F.when(F.col("__wide"), wide).otherwise(F.regexp_count(s, F.lit(r"\S+")))

    counts = F.transform("__s", spoken)
    d = d.select(key, "__s", counts.alias("__n"))
    zero = F.struct(F.lit(0).alias("i"), F.lit(0).alias("words"), F.array().cast("array<int>").alias("cuts"))

    def step(acc: Column, n: Column) -> Column:
        # a chunk in progress always holds words, except before its first sentence
        cut = (acc["words"] + n > limit_words) & (acc["words"] > 0)
        return F.struct(
            (acc["i"] + 1).alias("i"),
            F.when(cut, n).otherwise(acc["words"] + n).alias("words"),
            F.when(cut, F.concat(acc["cuts"], F.array(acc["i"]))).otherwise(acc["cuts"]).alias("cuts"),
        )

    cuts = F.aggregate("__n", zero, step, lambda acc: acc["cuts"])
    d = d.select(key, "__s", "__n", cuts.alias("__cuts")).select(
        key,
        "__s",
        "__n",
        F.concat(F.array(F.lit(0)), "__cuts").alias("__from"),
        F.concat("__cuts", F.array(F.size("__s"))).alias("__to"),
    )
    spans = F.arrays_zip(F.col("__from").alias("a"), F.col("__to").alias("z"))
    texts = F.transform(
        spans,
        lambda p: F.struct(
            trim_space(F.array_join(F.slice("__s", p["a"] + 1, p["z"] - p["a"]), "")).alias("text"),
            F.aggregate(F.slice("__n", p["a"] + 1, p["z"] - p["a"]), F.lit(0), lambda x, y: x + y).alias("n_words"),
        ),
    )
    kept = F.filter(texts, lambda c: c["text"] != "")
    d = d.select(key, kept.alias("__c"))
    return open_rows(d, [key, F.size("__c").alias("n_chunks")], "__c", "chunk_idx", "c").select(
        key, "chunk_idx", "n_chunks", F.col("c.text").alias("text"), F.col("c.n_words").alias("n_words"))


def speaking() -> dict[str, Column]:
    """Instruction and speed of a chunk by its relative position, from ``chunk_idx`` and ``n_chunks``."""
    pos = F.col("chunk_idx") / F.greatest(F.col("n_chunks") - 1, F.lit(1))
    text = speed = None
    for upper, t, s in rules.INSTRUCT_BANDS:
        if upper is None:
            text, speed = text.otherwise(F.lit(t)), speed.otherwise(F.lit(s))
        elif text is None:
            text, speed = F.when(pos < upper, F.lit(t)), F.when(pos < upper, F.lit(s))
        else:
            text, speed = text.when(pos < upper, F.lit(t)), speed.when(pos < upper, F.lit(s))
    return {"instruct": text, "speed": speed}


def default_instructions(chunks: DataFrame, key: str) -> DataFrame:
    """Instruction and speed by relative position of the chunk in its document.

    ``n_chunks`` from the packing step is used where present, otherwise counted.
    """
    c = chunks
    if "n_chunks" not in c.columns:
        c = c.join(chunks.groupBy(key).agg(F.count(F.lit(1)).alias("n_chunks")), key)
    return c.withColumns(speaking()).select(key, "chunk_idx", "instruct", "speed")


def attach_instructions(chunks: DataFrame, instructions: DataFrame, key: str) -> DataFrame:
    """Given instructions by chunk, the first one winning; defaults elsewhere.

    Instructions: key, chunk_idx, pos, instruct, speed (text or number).
    """
    first = instructions.groupBy(key, "chunk_idx").agg(
        F.min_by(F.struct("instruct", F.col("speed").cast("string").alias("speed")), "pos").alias("__f")
    )
    raw = number(F.col("__f.speed"))
    num = F.when(raw.isNull() | F.isnan(raw) | (raw == 0), F.lit(1.0)).otherwise(raw)
    got = F.col("__f").isNotNull()
    said = F.coalesce(F.nullif(F.col("__f.instruct"), F.lit("")), F.lit(rules.INSTRUCT_EMPTY))
    return chunks.join(first, [key, "chunk_idx"], "left").select(
        *chunks.columns,
        F.when(got, said).otherwise(F.lit(rules.INSTRUCT_MISSING)).alias("instruct"),
        F.when(got, clamp(num, rules.SPEED_MIN, rules.SPEED_MAX)).otherwise(F.lit(1.0)).alias("speed"),
    )


# --- logs as text -----------------------------------------------------------


def log_lines(logs: DataFrame, text: str = "message") -> DataFrame:
    """One row per non-blank line, terminal escapes removed; ``line_no`` from 0.

    Stateless, so it takes a batch or a stream.
    """
    plain = strip_ansi(F.col(text))
    return (
        open_rows(logs, ["*"], F.split(plain, "\n"), "line_no", "__line")
        .withColumn("line", trim_space(F.col("__line")))
        .where(F.col("line") != "")
        .drop("__line", text)
    )
