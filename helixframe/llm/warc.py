"""WARC archives with a two-level capture index.

Captures are dealt to archive files by ranges of their key (host name reversed, then path) and sorted by it, so a file
and its index run in the same order. The index of a file is a row of compressed blocks of captures; a sparse directory
keeps the first key and the place of each block. A look-up of URLs searches the directories by bisection for the blocks
that may hold each key; then each of these blocks is one row, so a key with many captures is spread over tasks: the block is
searched by bisection and the byte ranges of its records are read, neighbours in one read. ``read_archive`` walks the blocks
instead.

Records with the same payload of at least ``min_bytes`` bytes are stored once, as the response of the largest
page_id; the others are revisit records that name it. Rows that repeat the largest page_id are each a response. A null
html is an empty payload; a null page_id has no number in its record and reads back as null; a null url has an empty
key, which can be looked up. URLs that repeat are looked up once. Empty tables give an archive, and a result, without
records. A payload of any length is one record. Other columns of the input are ignored.

Files are written with pyarrow's file systems below the shared folder. A task writes under a name of its attempt and
moves the file to its final name, so a task that is repeated after a lost executor leaves the same files.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice
from types import SimpleNamespace

import pandas as pd
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from helixframe.llm.common import save

# Fixed values of the WARC format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"

MIN_BYTES = 1000
BLOCK_CAPTURES = 256
BLOCK_BYTES = 4_000_000

DIRECTORY = "first_key string, warc string, cdx string, position long, length int, captures int, start long, stop long"
COLUMNS = [c.split()[0] for c in DIRECTORY.split(", ")]
# What of a directory entry leads to its block.
PLACE = ["first_key", "warc", "cdx", "position", "length"]
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def capture_key(url: Column) -> Column:
    """Sort key of a URL: reversed host labels, ``)``, then port, path and query; empty for null."""
    rest = F.regexp_replace(F.lower(F.coalesce(url, F.lit(""))), r"^[a-z][a-z0-9+.-]*://", "")
    host = F.regexp_extract(rest, r"^([^/:?#]*)", 1)
    labels = F.array_join(F.reverse(F.split(host, r"\.")), ",")
    return F.when(url.isNull() | (url == ""), F.lit("")).otherwise(F.concat(labels, F.lit(")"), F.regexp_replace(rest, r"^[^/:?#]*|#.*$", "")))


def captures(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Rows for the writer: each page with its key, digest and payload, and a mark (no payload) for each revisit.

    Which payloads repeat is found from keys and digests alone; the marks then travel with the pages through the one
    exchange that moves payloads.
    """
    base = pages.select(
        "page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"), capture_key(F.col("url")).alias("key"),
    ).withColumn("digest", F.unhex(F.sha1("payload")))
    large = save(base.where(F.octet_length("payload") >= min_bytes).select("key", "page_id", "digest"), "payloads")
    # Only payloads that occur twice matter; hot ones are reduced to one row before the exchange.
    twice = (
        large.groupBy("digest").agg(F.count(F.lit(1)).alias("copies"), F.max("page_id").alias("newest"))
        .where((F.col("copies") > 1) & F.col("newest").isNotNull()).select("digest", "newest")
    )
    marks = large.join(twice, "digest").where(~F.col("page_id").eqNullSafe(F.col("newest"))).select(
        "key", "page_id", "digest", F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"),
        F.col("newest").alias("refers_to"))
    return base.select("key", "page_id", "digest", "url", "payload", F.lit(None).cast("long").alias("refers_to")).unionByName(marks)


def record(page_id: int | None, url: str | None, payload: bytes, digest: bytes, refers_to: int | None, date: str, nth: str) -> bytes:
    """One WARC record."""
    name = lambda n: f"<urn:page:{n}>"
    block = HTTP_HEAD.format(len(payload)).encode() + (payload if refers_to is None else b"")
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {name(page_id if page_id is not None else f'none:{nth}')}", f"WARC-Date: {date}",
        "WARC-Target-URI: " + (url or "").replace("\r", "%0D").replace("\n", "%0A"),
        "WARC-Payload-Digest: sha1:" + base64.b32encode(digest).decode(),
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        head[2:2] = [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {name(refers_to)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """Fields and payload of a record; a response whose payload does not match its digest is an error."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    http, _, payload = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    size = int(next(x for x in http.decode().split("\r\n") if x.startswith("Content-Length: ")).split(": ")[1])
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    kind = fields["WARC-Type"]
    if kind == "response" and (hashlib.sha1(payload).hexdigest() != digest or len(payload) != size):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    number = lambda s: int(s[10:-1]) if s and not s.startswith("<urn:page:none") else None
    return {
        "page_id": number(fields["WARC-Record-ID"]), "url": fields["WARC-Target-URI"], "payload": payload,
        "payload_bytes": size, "payload_digest": digest, "record_type": kind, "refers_to": number(fields.get("WARC-Refers-To")),
    }


def _gzip(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def write_archive(pages: DataFrame, root: str, date: str = "2000-01-01T00:00:00Z", files: int | None = None,
                  min_bytes: int = MIN_BYTES) -> DataFrame:
    """Write archives and their index below ``root``; returns the block directory, kept as a table there."""
    rows = captures(pages, min_bytes)
    files = files or max(1, pages.rdd.getNumPartitions())
    order = ["key", "page_id", "digest"]
    dealt = rows.repartitionByRange(files, *order).sortWithinPartitions(*order, F.desc_nulls_last("refers_to"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        store, folder = arrow_fs.FileSystem.from_uri(root)
        store.create_dir(folder, recursive=True)
        name, attempt = f"{folder}/captures-{part:06d}", uuid.uuid4().hex
        warc = cdx = None
        at = cdx_at = 0
        block: list[tuple[str, int, int]] = []
        entries: list[tuple] = []

        def close_block() -> None:
            nonlocal cdx_at
            if block:
                packed = _gzip("\n".join(json.dumps(x, ensure_ascii=False) for x in block).encode())
                cdx.write(packed)
                entries.append((block[0][0], f"{name}.warc.gz", f"{name}.cdx.gz", cdx_at, len(packed), len(block), block[0][1], at))
                cdx_at += len(packed)
                block.clear()

        mark: tuple | None = None  # (key, page_id, digest, refers_to) of the last mark; the pages it marks follow it
        for batch in batches:
            for row in (x for at_row in range(0, batch.num_rows, 64) for x in batch.slice(at_row, 64).to_pylist()):
                place = row["key"], row["page_id"], row["digest"]
                if row["refers_to"] is not None:
                    mark = *place, row["refers_to"]
                    continue
                refers_to = mark[3] if mark is not None and mark[:3] == place else None
                if warc is None:
                    warc = store.open_output_stream(f"{name}.{attempt}.warc", compression=None)
                    cdx = store.open_output_stream(f"{name}.{attempt}.cdx", compression=None)
                packed = _gzip(record(row["page_id"], row["url"], row["payload"], row["digest"], refers_to, date, f"{part}-{at}"))
                warc.write(packed)
                block.append((row["key"], at, len(packed)))
                at += len(packed)
                if len(block) >= BLOCK_CAPTURES or at - block[0][1] >= BLOCK_BYTES:
                    close_block()
        if warc is not None:
            close_block()
            for stream, kind in ((warc, "warc"), (cdx, "cdx")):
                stream.close()
                store.move(f"{name}.{attempt}.{kind}", f"{name}.{kind}.gz")
            with store.open_output_stream(f"{name}.{attempt}.dir", compression=None) as sparse:
                sparse.write(json.dumps([dict(zip(COLUMNS, x, strict=True)) for x in entries]).encode())
            store.move(f"{name}.{attempt}.dir", f"{name}.dir")
        if entries:
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(zip(*entries, strict=True), (
                    pa.string(), pa.string(), pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()), strict=True)],
                COLUMNS)

    dealt.mapInArrow(write, DIRECTORY).write.parquet(f"{root}/directory")
    return directory(pages.sparkSession, root)


def directory(spark: SparkSession, root: str) -> DataFrame:
    """The sparse block directory of an archive."""
    return spark.read.schema(DIRECTORY).parquet(f"{root}/directory")


def _range(store, path: str, start: int, length: int) -> bytes:
    with store.open_input_file(path) as file:
        return file.read_at(length, start)


def _block(store, entry) -> list[list]:
    return [json.loads(x) for x in zlib.decompress(_range(store, entry.cdx, entry.position, entry.length), 31).decode().split("\n")]


def read_archive(blocks: DataFrame, root: str) -> DataFrame:
    """Every record of the given blocks, by one range read of the archive per block."""

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, _ = arrow_fs.FileSystem.from_uri(root)
        for frame in frames:
            for entry in frame.itertuples():
                data = _range(store, entry.warc, entry.start, entry.stop - entry.start)
                found = [parse(zlib.decompress(data[at - entry.start : at - entry.start + length], 31)) for _, at, length in _block(store, entry)]
                out = pd.DataFrame(found)[["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]]
                yield out.astype({"page_id": "Int64", "refers_to": "Int64"})

    return blocks.repartition(max(1, blocks.rdd.getNumPartitions())).mapInPandas(read, RECORDS)


def blocks_of_keys(spark: SparkSession, root: str, keys: DataFrame) -> DataFrame:
    """The blocks that may hold captures with the given keys (column ``key``), each with its keys.

    What all tasks get is one first key per archive file; the directory of a file is read by the task that searches it.
    A block has a bounded number of captures, and so of keys.
    """
    heads = directory(spark, root).groupBy("cdx").agg(F.min("first_key").alias("first"))
    files = sorted((r["first"], r["cdx"]) for r in heads.collect())  # one row per file, not per capture
    firsts = [k for k, _ in files]

    def around(sorted_keys: list[str], key: str) -> range:
        """Positions that may hold a key: captures of it may begin before the first place that starts with it."""
        return range(max(0, bisect_left(sorted_keys, key) - 1), bisect_right(sorted_keys, key))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = arrow_fs.FileSystem.from_uri(root)

        @lru_cache(maxsize=64)
        def blocks_of(cdx: str) -> tuple[list[str], list[tuple]]:
            with store.open_input_stream(f"{cdx.removesuffix('.cdx.gz')}.dir", compression=None) as file:
                entries = [tuple(x[c] for c in PLACE) for x in json.loads(file.read())]
            return [e[0] for e in entries], entries

        def hits(names: list[str]) -> Iterator[tuple]:
            for name in names:
                for k in around(firsts, name):
                    first, entries = blocks_of(files[k][1])
                    for i in around(first, name):
                        yield name, *entries[i][1:]

        for batch in batches:
            found = hits(batch.column("key").to_pylist())
            while part := list(islice(found, 4096)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*part, strict=True), (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int32()), strict=True)],
                    ["key", *PLACE[1:]])

    named = keys.select("key").distinct().mapInArrow(search, "key string, warc string, cdx string, position long, length int")
    return named.groupBy(*PLACE[1:]).agg(F.collect_list("key").alias("keys"))


def lookup(spark: SparkSession, root: str, urls: DataFrame, with_payload: bool = True) -> DataFrame:
    """Captures of the given URLs (column ``url``), found through the index.

    With payload (page_id, url, record_type, html), else the columns of ``read_archive``.
    """
    wanted = ["page_id", "url", "record_type", "html"] if with_payload else [c.split()[0] for c in RECORDS.split(", ")]
    found = save(blocks_of_keys(spark, root, urls.select(capture_key(F.col("url")).alias("key"))), "blocks")
    # Each block is about as much work as any other.
    dealt = found.repartition(max(1, directory(spark, root).rdd.getNumPartitions()))

    def records(store, entry: SimpleNamespace) -> Iterator[dict]:
        rows = _block(store, entry)
        names = [r[0] for r in rows]
        hit = sorted(i for key in set(entry.keys) for i in range(bisect_left(names, key), bisect_right(names, key)))
        begin = 0
        for j in range(1, len(hit) + 1):
            if j < len(hit) and hit[j] == hit[j - 1] + 1:
                continue
            first, last = rows[hit[begin]], rows[hit[j - 1]]
            data = _range(store, entry.warc, first[1], last[1] + last[2] - first[1])
            for _, at, length in (rows[i] for i in hit[begin:j]):
                yield parse(zlib.decompress(data[at - first[1] : at - first[1] + length], 31))
            begin = j

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, _ = arrow_fs.FileSystem.from_uri(root)
        for frame in frames:
            for entry in frame.itertuples():
                found = [{**r, "html": r["payload"].decode()} if with_payload else r for r in records(store, entry)]
                out = pd.DataFrame(found, columns=wanted).astype({"page_id": "Int64"})
                yield out if with_payload else out.astype({"refers_to": "Int64"})

    return dealt.mapInPandas(read, "page_id long, url string, record_type string, html string" if with_payload else RECORDS)
