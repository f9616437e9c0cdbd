"""WARC archives: an index first, then coalesced byte-range reads of what it selects."""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern import session
from lectern.llm.common import stored, table, whole

INDEX = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("offset", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("digest", T.StringType()),
        T.StructField("page_id", T.LongType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("payload_bytes", T.LongType()),
    ]
)
RECORD = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("refers_to", T.LongType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("payload", T.BinaryType()),
    ]
)
# Fixed values of the format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, so that any shared store works."""
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def _clean(url: str | None) -> str:
    return re.sub(r"[\r\n]", "", url or "")


def _record(page_id, url, kind: str, refers, payload: bytes, digest: str) -> bytes:
    block = HTTP_HEAD if kind == "revisit" else HTTP_HEAD + payload
    head = [
        VERSION,
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {_clean(url)}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"X-Page-Id: {'' if page_id is None else page_id}",
        f"X-Payload-Length: {len(payload)}",
        f"Content-Length: {len(block)}",
    ]
    if kind == "revisit":
        head[5:5] = [
            f"WARC-Profile: {REVISIT_PROFILE}",
            f"WARC-Refers-To: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{refers}')}>",
            f"X-Refers-To-Page-Id: {refers}",
        ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _member(data: bytes) -> bytes:
    z = zlib.compressobj(4, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


#: Bytes of archive that a task reads, about.
READ_BYTES = 64 << 20


def _whole_number(value):
    return None if value is None or value != value else int(value)


def with_kinds(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """pages with ``payload``, ``digest``, ``record_type`` and ``refers_to``.

    Of equal payloads of at least ``min_bytes``, the largest ``page_id`` is the
    response. The winner of a digest is a combining aggregate over narrow rows;
    only the join on ``page_id`` and digest moves pages.
    """
    payload = F.encode(whole("html"), "UTF-8")
    digest = F.sha1(payload)
    narrow = stored(pages.select("page_id", digest.alias("digest"), F.length(payload).cast("long").alias("payload_bytes")), "page-digests")
    first = stored(narrow.groupBy("digest", "payload_bytes").agg(F.max("page_id").alias("first")), "page-firsts")
    again = narrow.join(first, ["digest", "payload_bytes"]).where((F.col("page_id") != F.col("first")) & (F.col("payload_bytes") >= min_bytes))
    again = stored(again.select(F.col("page_id").alias("again_id"), F.col("digest").alias("again_digest"), "first").distinct(), "page-revisits")
    mine = pages.select("page_id", "url", payload.alias("payload"), digest.alias("hex"))
    same = (F.col("page_id") == F.col("again_id")) & (F.col("hex") == F.col("again_digest"))
    return mine.join(again, same, "left").select(
        "page_id",
        "url",
        "payload",
        "hex",
        F.when(F.col("first").isNull(), "response").otherwise("revisit").alias("record_type"),
        F.col("first").alias("refers_to"),
    )


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, roll_bytes: int = 256 << 20) -> DataFrame:
    """Write a record per page and return the index, stored as a table.

    Each task streams its rows to archives of its own, a new one after
    ``roll_bytes``; a record is its own gzip member. File names are unique per
    attempt and count only through the index rows of the attempt that
    succeeded, so lost or repeated tasks leave no wrong record.
    """

    def write(batches):
        out, path, at = None, "", 0
        for frame in batches:
            rows = []
            for p in frame.itertuples(index=False):
                if out is None or at >= roll_bytes:
                    if out is not None:
                        out.close()
                    path, at = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0
                    store, place = _opened(path)
                    store.create_dir(place.rpartition("/")[0], recursive=True)
                    out = store.open_output_stream(place, compression=None)
                page, refers, payload = _whole_number(p.page_id), _whole_number(p.refers_to), bytes(p.payload)
                digest = base64.b32encode(bytes.fromhex(p.hex)).decode()
                data = _member(_record(page, p.url, p.record_type, refers, payload, digest))
                out.write(data)
                rows.append((path, at, len(data), p.url, digest, page, p.record_type, len(payload)))
                at += len(data)
            made = pd.DataFrame(rows, columns=INDEX.names)
            yield made.assign(page_id=made["page_id"].astype("Int64"))
        if out is not None:
            out.close()

    return stored(with_kinds(pages, min_bytes).mapInPandas(write, INDEX), "warc-index")


def _parse(data: bytes) -> tuple:
    raw = zlib.decompress(data, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != VERSION:
        raise ValueError(f"not a record: {lines[0][:40]!r}")
    field = dict(x.split(": ", 1) if ": " in x else (x.rstrip(": "), "") for x in lines[1:])
    block = rest[: int(field["Content-Length"])]
    if rest[len(block) :] != b"\r\n\r\n":
        raise ValueError(f"record of page {field['X-Page-Id']} has a wrong length")
    payload, digest = None, field["WARC-Payload-Digest"].removeprefix("sha1:")
    if field["WARC-Type"] == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        if base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise ValueError(f"record of page {field['X-Page-Id']} has a wrong digest")
    number = lambda x: int(x) if x else None
    return (
        number(field["X-Page-Id"]), field["WARC-Target-URI"], field["WARC-Type"], number(field.get("X-Refers-To-Page-Id")),
        int(field["X-Payload-Length"]), digest, payload,
    )


def read_records(index: DataFrame, where: Column | None = None, gap: int = 64 << 10, span: int = 8 << 20, payloads: bool = True) -> DataFrame:
    """Read the records that ``where`` selects in the index, a few large reads each.

    Selected ranges are sorted within ``span``-sized stretches of a file and
    neighbours less than ``gap`` bytes apart become one read. A stretch is the
    unit of work, so a large archive spreads over tasks and a task holds one
    read at a time. Every record's length and digest are verified.
    """
    picked = index if where is None else index.where(where)
    picked = picked.select("file", "offset", "length", F.expr(f"offset div {int(span)}").alias("stretch"))
    # Rows are short, what they stand for is not: tasks follow the bytes to be read.
    size = picked.agg(F.sum("length")).first()[0] or 0
    ordered = picked.repartition(max(1, -(-size // READ_BYTES)), "file", "stretch").sortWithinPartitions("file", "stretch", "offset")

    def emit(store, place, run):
        start, end = run[0][0], run[-1][0] + run[-1][1]
        with store.open_input_file(place) as f:
            data = f.read_at(end - start, start)
        rows = [_parse(data[o - start : o - start + n]) for o, n in run]
        made = pd.DataFrame(rows if payloads else [(*r[:-1], None) for r in rows], columns=RECORD.names)
        return made.assign(page_id=made["page_id"].astype("Int64"), refers_to=made["refers_to"].astype("Int64"))

    def read(batches):
        file, run = None, []
        for frame in batches:
            for name, o, n in zip(frame["file"], frame["offset"].tolist(), frame["length"].tolist(), strict=True):
                if run and (name != file or o - (run[-1][0] + run[-1][1]) > gap or o + n - run[0][0] > span):
                    yield emit(*_opened(file), run)
                    run = []
                file = name
                run.append((o, n))
        if run:
            yield emit(*_opened(file), run)

    return ordered.mapInPandas(read, RECORD)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives of all pages, read back through their index.

    Null html is an empty payload, a null url an empty header. Repeated rows
    give a record each; a null ``page_id`` is never revisited nor a revisit.
    """
    index = write_archives(table(spark, sf_dir, "pages"), session.new_path(spark, "warc"))
    return read_records(index, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


QUERIES = {"op6_warc": op6_warc}
SQL = {
    "op6_warc": """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS h FROM pages),
k AS (SELECT *, max(page_id) OVER (PARTITION BY h, n) AS first FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         CAST(1 + ((CAST('0x' || substr(h, CAST(i // 4 * 5 + 1 AS INTEGER), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31) AS INTEGER), 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM k"""
}
