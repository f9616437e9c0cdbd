"""Alignment of two tokenizers over whole texts, with corpus counts of the token pairs that end together."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lectern.llm.common import stored, table

BYTE_BPE, PIECE_BPE = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Bytes of text that are worked at once.
SLICE_BYTES = 4_000_000
# Anything that either side could take for white space, and all controls: too
# many only make stretches longer.
_BLANK = "\x00-\x20\x7f-\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f\u2060\u3000\ufeff"
_ODD = f"^ | $| [{_BLANK}]|[{_BLANK}] "
_CUT = re.compile(f"(?<=[^{_BLANK}]) (?=[^{_BLANK}])")


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path(BYTE_BPE), public_tokenizers.path(PIECE_BPE)


def _byte_alphabet() -> dict[str, int]:
    """The letters that byte-level vocabularies write bytes with: printable ones for themselves, others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(other)}


class Pair:
    """Both tokenizers, their tokens' bytes and the decimal ids with each separator that may follow."""

    def __init__(self, path_a: str, path_b: str):
        import public_tokenizers
        import sentencepiece
        import tiktoken

        letters = _byte_alphabet()
        with open(path_a, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(letters[c] for c in token): i for token, i in spec["model"]["vocab"].items() if i not in special}
        # Ids of a byte-level vocabulary are the order of its merges, which is all this encoder asks for.
        self.a = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        bytes_a = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            bytes_a[i] = token
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        # Without a piece that holds a space after another letter, no token of B crosses a space.
        self.cuts = not any("▁" in p.lstrip("▁") for p in pieces)
        bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.bytes_a, self.bytes_b = pa.array(bytes_a, pa.binary()), pa.array(bytes_b, pa.binary())
        self.n_a, self.n_b = len(bytes_a), len(bytes_b)
        self.text = pa.array(
            [f"{i}{s}" for n, marks in ((self.n_a, ",|"), (self.n_b, (",", ";", ""))) for s in marks for i in range(n)], pa.string()
        )


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of each segment; empty segments give 0."""
    run = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return run[offsets[1:]] - run[offsets[:-1]]


def _lists(offsets: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def _offsets(lists: pa.ListArray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(), dtype=np.int64)])


def _stretches(texts: pa.Array, cut: bool) -> pa.ListArray:
    """Texts cut at every single space between letters, where both sides always end a token."""
    if not cut:
        return _lists(np.arange(len(texts) + 1), texts)
    odd = pc.match_substring_regex(texts, _ODD)
    if not pc.any(odd).as_py():
        return pc.split_pattern(texts, " ")
    even = pc.split_pattern(texts.filter(pc.invert(odd)), " ")
    hard = pa.array([_CUT.split(t) for t in texts.filter(odd).to_pylist()], pa.list_(pa.string()))
    order = np.argsort(np.argsort(odd.to_numpy(zero_copy_only=False), kind="stable"), kind="stable")
    return pa.concat_arrays([even, hard]).take(pa.array(order))


def _ends(lists: pa.ListArray, token_bytes: pa.Array) -> pa.Table:
    """(owner, end, at, id) of each token: its list, byte end inside it, place in the flat array, and id."""
    ids = lists.flatten()
    owner = pc.list_parent_indices(lists)
    sizes = pc.binary_length(token_bytes).take(ids)
    run = pc.cumulative_sum(pc.cast(sizes, pa.int64())).to_numpy()
    before = np.concatenate([[0], run])[_offsets(lists)[:-1]]
    ends = run - before[owner.to_numpy()]
    return pa.table({"owner": owner, "end": pa.array(ends), "at": pa.array(np.arange(len(ids))), "id": ids})


def _same_bytes(lists: pa.ListArray, token_bytes: pa.Array, want: pa.Array) -> pa.Array:
    joined = pc.binary_join(_lists(_offsets(lists), token_bytes.take(lists.flatten())), b"")
    return pc.equal(joined, want)


class Slice:
    """Texts of one slice: their stretches, and tokens and links of each distinct stretch.

    ``offsets`` cuts ``codes`` (a distinct stretch each) into texts; texts whose
    bytes are not given back by both sides have no stretches.
    """

    def __init__(self, texts: pa.Array, tok: Pair, cut: bool):
        parts = _stretches(texts, cut)
        code = parts.flatten().dictionary_encode()
        known, codes = code.dictionary, code.indices.to_numpy()
        offsets = _offsets(parts)
        words = known.to_pylist()
        self.a = pa.array([tok.a.encode_ordinary(f" {w}") for w in words], pa.list_(pa.int32()))
        self.b = pa.array(tok.b.encode(words, num_threads=1) if words else [], pa.list_(pa.int32()))
        want = pc.binary_join_element_wise(pa.scalar(b" "), known.cast(pa.binary()), pa.scalar(b""))
        good = pc.and_(_same_bytes(self.a, tok.bytes_a, want), _same_bytes(self.b, tok.bytes_b, want)).to_numpy(zero_copy_only=False)
        self.failed = _sums(~good[codes], offsets) > 0
        keep = np.repeat(~self.failed, np.diff(offsets))
        self.codes = codes[keep]
        self.offsets = np.concatenate([[0], np.cumsum(np.where(self.failed, 0, np.diff(offsets)))])
        left, right = _ends(self.a, tok.bytes_a), _ends(self.b, tok.bytes_b)
        links = left.join(right, ["owner", "end"], join_type="inner", right_suffix="_b", use_threads=False).sort_by("at")
        self.links = {c: links[c].to_numpy() for c in ("owner", "at", "at_b", "id", "id_b")}

    def counts(self) -> pa.Table:
        """(a, b, n): how many links of these texts hold the pair."""
        times = np.bincount(self.codes, minlength=len(self.a))[self.links["owner"]]
        t = pa.table({"a": self.links["id"], "b": self.links["id_b"], "n": times.astype(np.int64)})
        return t.filter(pc.field("n") > 0)

    def per_text(self, of_stretch: np.ndarray) -> np.ndarray:
        return _sums(of_stretch[self.codes], self.offsets)

    def per_stretch(self, of_link: np.ndarray) -> np.ndarray:
        order = np.searchsorted(self.links["owner"], np.arange(len(self.a) + 1))
        return _sums(of_link, order)

    def groups(self, tok: Pair) -> pa.Array:
        """``a1,a2|b1;a3|b2,b3`` per text: groups of A and B ids between common ends."""
        ids_a, ids_b = self.a.flatten().to_numpy(), self.b.flatten().to_numpy()
        ga, gb = self.links["at"], self.links["at_b"]  # last token of each group on either side
        of_a = np.searchsorted(ga, np.arange(len(ids_a)))
        of_b = np.searchsorted(gb, np.arange(len(ids_b)))
        ends_a = np.zeros(len(ids_a), np.int64)
        ends_a[ga] = 1
        ends_b = np.zeros(len(ids_b), np.int64)
        ends_b[gb] = 1
        ends_b[_offsets(self.b)[1:] - 1] = 2
        # A group's A tokens come after all tokens of earlier groups, its B tokens after those.
        b_before = np.concatenate([[0], gb + 1])
        a_until = np.concatenate([ga + 1, [len(ids_a)]])
        flat = np.empty(len(ids_a) + len(ids_b), np.int64)
        flat[np.arange(len(ids_a)) + b_before[of_a]] = ids_a + ends_a * tok.n_a
        flat[np.arange(len(ids_b)) + a_until[of_b]] = ids_b + ends_b * tok.n_b + 2 * tok.n_a
        words = pc.binary_join(_lists(_offsets(self.a) + _offsets(self.b), tok.text.take(pa.array(flat))), "")
        return pc.binary_join(_lists(self.offsets, words.take(pa.array(self.codes))), ";")


def _slices(batch: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of at most ``most`` bytes of text, one row at least."""
    run = np.cumsum(pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(run, (run[at - 1] if at else 0) + most, side="right")))
        yield batch.slice(at, end - at)
        at = end


def _worked(texts: pa.Array, tok: Pair) -> Iterator[tuple[np.ndarray, Slice]]:
    """(places of texts, their slice); texts that a stretch fails are worked whole."""
    first = Slice(texts, tok, tok.cuts)
    yield np.arange(len(texts)), first
    if tok.cuts and first.failed.any():
        again = np.flatnonzero(first.failed)
        yield again, Slice(texts.take(pa.array(again)), tok, False)


def _with_text(part: pa.RecordBatch) -> np.ndarray:
    """Rows whose text is neither null nor empty."""
    return np.flatnonzero(pc.fill_null(pc.greater(pc.binary_length(part["text"]), 0), False).to_numpy(zero_copy_only=False))


def _code(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a.astype(np.int64) << 32 | b


def pair_counts(docs: DataFrame, path_a: str, path_b: str, text_col: str = "text") -> DataFrame:
    """(a, b, n): links of each pair of ids over all texts; partial counts per task, merged by Spark."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, seen, rows = Pair(path_a, path_b), [], 0

        def merged() -> pa.Table:
            t = pa.concat_tables(seen).group_by(["a", "b"], use_threads=False).aggregate([("n", "sum")])
            return pa.table({"a": t["a"], "b": t["b"], "n": t["n_sum"]})

        for batch in batches:
            for part in _slices(batch, SLICE_BYTES):
                texts = part["text"].take(pa.array(_with_text(part)))
                for _, s in _worked(texts, tok):
                    seen.append(s.counts())
                    rows += len(seen[-1])
                if rows > 1_000_000:
                    seen = [merged()]
                    rows = len(seen[0])
        if seen:
            yield from merged().combine_chunks().to_batches()

    found = docs.select(F.col(text_col).alias("text")).mapInArrow(count, "a int, b int, n long")
    return found.groupBy("a", "b").agg(F.sum("n").alias("n"))


def align_tokenizers(
    docs: DataFrame, path_a: str | None = None, path_b: str | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Align the tokens of a byte-level vocabulary (A) with those of a piece vocabulary (B).

    Both encode a space and the text. Offsets where a token of both ends cut
    the tokens into groups; the two tokens that end there are a link. Texts are
    cut at single spaces between letters, where both sides always end a token,
    and equal stretches of a slice of ``SLICE_BYTES`` are encoded and joined
    once. Arrow does the work: flattened lists with parent indices, running sums
    of token bytes per stretch, a hash join on (stretch, end), and group-by
    counts that Spark merges.

    Texts are encoded twice, for the counts and for the rows, which costs less
    than to write and read every token. The counts go to all workers: of two
    tokens that end together one is a suffix of the other, so there are never
    more pairs than the bytes of both vocabularies, some 600,000, whatever the
    corpus.

    Returns one row per input row: the id, ``n_a``, ``n_b``, ``n_groups``,
    ``n_links``, ``n_best`` (links whose pair is the most frequent one of its B
    id), ``count_sum``, ``groups`` (``a1,a2|b1;a3|b2,b3``). Null and empty
    texts, and texts whose bytes one side does not give back, have zeros and an
    empty string. Repeated rows each count. Other columns are ignored.
    """
    spark = docs.sparkSession
    default = default_paths()
    path_a, path_b = path_a or default[0], path_b or default[1]
    counts = stored(pair_counts(docs, path_a, path_b, text_col), "pair-counts")
    best = counts.select("a", "b", "n", (F.col("n") == F.max("n").over(Window.partitionBy("b"))).alias("best")).toArrow()
    codes = _code(best["a"].to_numpy(), best["b"].to_numpy())
    order = np.argsort(codes)
    shared = spark.sparkContext.broadcast((codes[order], best["n"].to_numpy()[order], best["best"].to_numpy()[order]))
    columns = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = Pair(path_a, path_b)
        known, n, is_best = shared.value
        for batch in batches:
            for part in _slices(batch, SLICE_BYTES):
                at = _with_text(part)
                out = np.zeros((len(columns), part.num_rows), np.int64)
                groups = np.full(part.num_rows, "", dtype=object)
                for places, s in _worked(part["text"].take(pa.array(at)), tok):
                    hit = np.searchsorted(known, _code(s.links["id"], s.links["id_b"]))
                    hit = np.minimum(hit, max(len(known) - 1, 0))
                    ends = s.per_stretch(np.ones(len(hit), np.int64))
                    # A stretch that only failed texts hold has pairs nobody counted; it is in no text's sums.
                    of_stretch = (
                        pc.list_value_length(s.a).to_numpy(),
                        pc.list_value_length(s.b).to_numpy(),
                        ends,
                        ends,
                        s.per_stretch(is_best[hit] if len(known) else np.zeros(len(hit), bool)),
                        s.per_stretch(n[hit] if len(known) else np.zeros(len(hit), np.int64)),
                    )
                    for k, x in enumerate(of_stretch):
                        out[k, at[places]] = s.per_text(x.astype(np.int64))
                    groups[at[places]] = s.groups(tok).to_pylist()
                yield pa.record_batch(
                    [part["id"], *map(pa.array, out), pa.array(groups, pa.string())], names=["id", *columns, "groups"]
                )

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, {', '.join(f'{c} long' for c in columns)}, groups string"
    work = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return work.mapInArrow(rows, schema).withColumnRenamed("id", id_col)


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = align_tokenizers(table(spark, sf_dir, "documents"))
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise(F.lit(""))
    return out.withColumn("doc_id", F.col("doc_id").cast("long")).withColumn("groups_sha256", digest).drop("groups")


#: Token ids are not SQL; tests hold the query against a byte-by-byte version.
SQL = {}
QUERIES = {"op11_token_alignment": op11_token_alignment}
