"""WARC archives with a two-level capture index.

Writing: one record per page, each a gzip member of its own. Of pages with equal payloads one is
a response, and the others are revisit records that name it and hold no payload. Each task
writes files of its own under new names, and only files named by the rows that a successful
task returned are ever read, so a task may run again.

Index: captures are range-sorted by their key, the URL with its host reversed, and page number.
A shard file holds them in compressed blocks, after these a sparse directory with the first key
of each block, and its place in the last bytes. The list of shards is the upper level, the
directory the lower. A lookup searches both by bisection, reads the bytes of the blocks
that may hold the key, and then those of the records.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import struct
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from faturaflow.llm.bitplanes import frugal
from faturaflow.llm.common import checkpointed, hot_lookup
from faturaflow.sources.stage import shared_root

#: The contract: payloads that revisits are made for.
LEAST_REVISIT = 1000
#: Captures of a block, and payload bytes after which a task starts the next file.
BLOCK, FILE_BYTES = 512, 256 << 20
#: Bytes of records that a task reads back.
READ_BYTES = 8 << 20
_TAIL, _TAIL_BYTES = "<QQ", 16
_CAPTURE = "file string, at long, size long"


def surt(url: Column) -> Column:
    """Lower-case host with its labels reversed, `)`, then the rest: all pages of a site are
    neighbours. A null URL is an empty key."""
    whole = F.coalesce(url, F.lit(""))
    rest = F.regexp_replace(whole, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(rest, r"^([^/?#]*)", 1))
    path = F.regexp_replace(rest, r"^[^/?#]*", "")
    labels = F.array_join(F.reverse(F.split(host, r"\.")), ",")
    return F.when(F.length(whole) == 0, "").otherwise(F.concat(labels, F.lit(")"), path))


def file_system(uri: str):
    """pyarrow file system and path; any that Arrow knows (file, hdfs, s3, gs)."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def _uri(root: str) -> str:
    """file:/x and file:///x alike."""
    return "file:///" + root[5:].lstrip("/") if root.startswith("file:") else root


def revisits(pages: DataFrame) -> DataFrame:
    """(page_id, digest, refers_to) of pages whose payload a page with a larger page_id has too. A null
    page_id is below all others.

    Only digests and ids are shuffled, a hot payload reduced in every task.
    """
    rows = pages.select("page_id", "digest", "payload_bytes").filter(
        F.col("payload_bytes") >= LEAST_REVISIT
    )
    groups = rows.groupBy("digest").agg(
        F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")
    )
    found = hot_lookup(rows, groups.filter("n > 1"), "digest", "n", pages.count(), "page_id")
    other = (F.col("page_id") < F.col("refers_to")) | (F.col("page_id").isNull() & F.col("refers_to").isNotNull())
    return found.filter(other).select("page_id", "digest", "refers_to").distinct()


def records(pages: DataFrame) -> DataFrame:
    """Pages (page_id, url, html) with digest, payload_bytes, record_type and refers_to.

    Rows with one page_id and equal payloads: the first is the response, the others revisit it. So it is
    with rows that all have a null page_id: their revisits refer to null.
    """
    body = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long"), "url", body.alias("payload"))
    rows = rows.withColumns(
        {"digest": F.sha1("payload"), "payload_bytes": F.length("payload").cast("long")}
    )
    known = revisits(rows)
    # All rows of a page meet; its page_id tells it from others.
    # Keys without nulls, so that the join and the numbering need one shuffle between them.
    key = {"_id": F.coalesce("page_id", F.lit(0)), "_none": F.col("page_id").isNull()}
    known = known.withColumns(key).drop("page_id")
    joined = rows.withColumns(key).join(known, ["_id", "_none", "digest"], "left")
    nth = F.row_number().over(W.partitionBy("_id", "_none", "digest").orderBy("url"))
    again = (F.col("payload_bytes") >= LEAST_REVISIT) & (F.col("nth") > 1)
    refers = F.coalesce("refers_to", F.when(again, F.col("page_id")))
    kind = F.when(F.col("refers_to").isNotNull() | again, "revisit").otherwise("response")
    joined = joined.withColumn("nth", nth).withColumn("record_type", kind).withColumn("refers_to", refers)
    # A revisit record has no payload.
    payload = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
    return joined.withColumn("payload", payload).drop("_id", "_none")


def record_bytes(row: dict) -> bytes:
    """One WARC record as a gzip member."""
    head = {
        "WARC-Type": row["record_type"],
        "WARC-Record-ID": f"<urn:page:{row['page_id']}:{row['nth']}>",
        "WARC-Date": "1970-01-01T00:00:00Z",
        "WARC-Target-URI": json.dumps(row["url"])[1:-1] if row["url"] is not None else None,
        "WARC-Payload-Digest": f"sha1:{row['digest']}",
        "WARC-Payload-Length": row["payload_bytes"],
        "WARC-Refers-To": f"<urn:page:{row['refers_to']}:1>" if row["record_type"] == "revisit" else None,
        "Content-Type": "text/html" if row["record_type"] == "response" else None,
        "Content-Length": len(row["payload"]),
    }
    lines = [f"{k}: {v}" for k, v in head.items() if v is not None]
    whole = "\r\n".join(["WARC/1.1", *lines, "", ""]).encode() + row["payload"] + b"\r\n\r\n"
    return gzip.compress(whole, 6, mtime=0)


def parse_record(member: bytes) -> tuple[dict[str, str], bytes]:
    whole = gzip.decompress(member)
    head, _, rest = whole.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]}")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    size = int(fields["Content-Length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError("a WARC record of another length than its header says")
    return fields, rest[:size]


def write_warc(pages: DataFrame, root: str) -> DataFrame:
    """Writes WARC files under `root`; (key, page_id, nth, file, at, size) of every record, checkpointed."""
    root = _uri(root)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = file_system(root)
        system.create_dir(folder, recursive=True)
        out, name, at = None, "", 0
        for batch in batches:
            for some in range(0, batch.num_rows, 256):
                part, rows = batch.slice(some, 256), []
                for row in part.to_pylist():
                    if out is None or at > FILE_BYTES:
                        if out is not None:
                            out.close()
                        name, at = f"pages-{uuid.uuid4().hex}.warc.gz", 0
                        out = system.open_output_stream(f"{folder}/{name}", compression=None)
                    member = record_bytes(row)
                    out.write(member)
                    rows.append((row["key"], row["page_id"], row["nth"], name, at, len(member)))
                    at += len(member)
                cols = list(zip(*rows))
                kinds = (pa.string(), pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(cols, kinds)],
                    ["key", "page_id", "nth", "file", "at", "size"],
                )
        if out is not None:
            out.close()

    rows = records(pages).withColumn("key", surt(F.col("url")))
    return checkpointed(rows.mapInArrow(frugal(run), f"key string, page_id long, nth int, {_CAPTURE}"))


def _packed(lines: list) -> bytes:
    return zlib.compress("\n".join(map(json.dumps, lines)).encode(), 6)


def _unpacked(data: bytes) -> list:
    return [json.loads(x) for x in zlib.decompress(data).decode().split("\n")]


def write_index(captures: DataFrame, root: str, block: int = BLOCK) -> DataFrame:
    """Writes the index shards under `root`; one row per shard: (shard, low, high), checkpointed."""
    root = _uri(root)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = file_system(root)
        system.create_dir(folder, recursive=True)
        name, out, at = f"index-{uuid.uuid4().hex}.blocks", None, 0
        held, directory, last = [], [], None

        def close_block() -> None:
            nonlocal at, held
            data = _packed(held)
            directory.append([held[0][0], at, len(data)])
            out.write(data)
            at, held = at + len(data), []

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    out = system.open_output_stream(f"{folder}/{name}", compression=None)
                held.append(row)
                last = row[0]
                if len(held) == block:
                    close_block()
        if out is None:
            return
        if held:
            close_block()
        data = _packed(directory)
        out.write(data + struct.pack(_TAIL, at, len(data)))
        out.close()
        yield pa.RecordBatch.from_arrays(
            [pa.array([x]) for x in (name, directory[0][0], last)], ["shard", "low", "high"]
        )

    order = ["key", "page_id", "nth"]
    rows = captures.select("key", "page_id", "nth", "file", "at", "size")
    # page_id splits a URL that many captures have over several shards.
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return checkpointed(dealt.mapInArrow(frugal(run), "shard string, low string, high string"))


class Shard:
    """One index shard, open for reading: its directory is read once, blocks when needed."""

    def __init__(self, system, path: str):
        self.file = system.open_input_file(path)
        end = self.file.size()
        at, size = struct.unpack(_TAIL, self._range(end - _TAIL_BYTES, _TAIL_BYTES))
        self.directory = _unpacked(self._range(at, size))
        self.firsts = [d[0] for d in self.directory]
        self.block: tuple[int, list] = (-1, [])

    def _range(self, at: int, size: int) -> bytes:
        self.file.seek(at)
        return self.file.read(size)

    def find(self, key: str) -> Iterator[list]:
        """Captures with the key: bisection in the directory, then in the blocks it names."""
        k = max(0, bisect_left(self.firsts, key) - 1)
        while k < len(self.firsts) and self.firsts[k] <= key:
            if self.block[0] != k:
                self.block = (k, _unpacked(self._range(*self.directory[k][1:])))
            lines = self.block[1]
            at = bisect_left(lines, key, key=lambda x: x[0])
            stop = bisect_right(lines, key, key=lambda x: x[0])
            yield from lines[at:stop]
            k += 1


def lookup(shards: DataFrame, root: str, keys: DataFrame) -> DataFrame:
    """(key, page_id, nth, file, at, size) of all captures of the keys (one column, `key`).

    Keys go to the shards whose range holds them; each task reads only blocks with its keys.
    """
    root = _uri(root)
    schema = f"key string, page_id long, nth int, {_CAPTURE}"
    names = ["key", "page_id", "nth", "file", "at", "size"]
    kinds = (pa.string(), pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = file_system(root)
        shard, name = None, None
        for batch in batches:
            rows = []
            for wanted, key in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if wanted != name:
                    if shard is not None:
                        shard.file.close()
                    shard, name = Shard(system, f"{folder}/{wanted}"), wanted
                for row in shard.find(key):
                    rows.append(row)
                    if len(rows) == 4096:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                        rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
        if shard is not None:
            shard.file.close()

    wanted = F.coalesce("key", F.lit("")).alias("key")
    asked = _shards_of(shards, keys.select(wanted).distinct())
    dealt = asked.repartition("shard").sortWithinPartitions("shard", "key")
    return dealt.mapInArrow(frugal(run), schema)


def _shards_of(shards: DataFrame, keys: DataFrame) -> DataFrame:
    """(shard, key): the upper level of the index, searched by bisection in every task. It has one
    row per shard, and there are as many shards as the index had partitions."""
    rows = sorted((r["low"], r["high"], r["shard"]) for r in shards.toLocalIterator())
    lows, highs, names = ([r[i] for r in rows] for i in range(3))
    table = keys.sparkSession.sparkContext.broadcast((lows, highs, names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lows, highs, names = table.value
        for batch in batches:
            out = []
            for key in batch.column(0).to_pylist():
                k = bisect_right(lows, key) - 1
                while k >= 0 and highs[k] >= key:
                    out.append((names[k], key))
                    k -= 1
            if out:
                cols = [pa.array(c, pa.string()) for c in zip(*out)]
                yield pa.RecordBatch.from_arrays(cols, ["shard", "key"])

    return keys.mapInArrow(frugal(run), "shard string, key string")


def read_records(captures: DataFrame, root: str) -> DataFrame:
    """Reads the records of (file, at, size) by byte ranges: page_id, record_type, refers_to,
    payload_digest, payload_bytes, payload. A payload whose digest is not its header's raises."""
    root = _uri(root)
    kinds = {"page_id": pa.int64(), "record_type": pa.string(), "refers_to": pa.int64(),
             "payload_digest": pa.string(), "payload_bytes": pa.int64(), "payload": pa.binary()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = file_system(root)
        source, name = None, None
        for batch in batches:
            for some in range(0, batch.num_rows, 256):
                rows = []
                for file, at, size in zip(*(c.to_pylist() for c in batch.slice(some, 256).columns)):
                    if file != name:
                        if source is not None:
                            source.close()
                        source, name = system.open_input_file(f"{folder}/{file}"), file
                    source.seek(at)
                    head, payload = parse_record(source.read(size))
                    digest, kind = head["WARC-Payload-Digest"].split(":")[1], head["WARC-Type"]
                    length = int(head["WARC-Payload-Length"])
                    if kind == "response" and (hashlib.sha1(payload).hexdigest(), len(payload)) != (digest, length):
                        raise ValueError(f"payload of {head['WARC-Record-ID']} has another digest")
                    page = lambda x: None if (p := x.split(":")[2]) == "None" else int(p)
                    refers = page(head["WARC-Refers-To"]) if "WARC-Refers-To" in head else None
                    rows.append((page(head["WARC-Record-ID"]), kind, refers, digest, length, payload))
                cols = [pa.array(c, k) for c, k in zip(zip(*rows), kinds.values())]
                yield pa.RecordBatch.from_arrays(cols, list(kinds))
        if source is not None:
            source.close()

    # Captures are a few bytes each: tasks are dealt out by the bytes of the records.
    places = checkpointed(captures.select("file", "at", "size"))
    total = places.agg(F.sum("size")).first()[0] or 0
    dealt = places.repartitionByRange(1 + total // READ_BYTES, "file", "at")
    return dealt.sortWithinPartitions("file", "at").mapInArrow(
        frugal(run),
        "page_id long, record_type string, refers_to long, payload_digest string, "
        "payload_bytes long, payload binary",
    )


def archive(pages: DataFrame, root: str | None = None) -> DataFrame:
    """Writes `pages` (page_id, url, html) as WARC files with an index under `root`, and reads them
    back through the index: the rows of read_records, one per row of `pages`.

    root: a folder that all executors share; a new one under spark.checkpoint.dir if not given.
    A null html is an empty payload, a null url an empty key. An empty table gives an empty
    result and no file.
    """
    root = root or f"{shared_root(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    captures = write_warc(pages, f"{root}/data")
    shards = write_index(captures, f"{root}/index")
    found = lookup(shards, f"{root}/index", pages.select(surt(F.col("url")).alias("key")))
    return read_records(found, f"{root}/data")


def op4_warc(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    return archive(pages.select("page_id", "url", "html")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes,
                  sha1(coalesce(html, '')) AS payload_digest FROM pages),
r AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS top,
             row_number() OVER (PARTITION BY payload_digest ORDER BY page_id DESC NULLS LAST) AS place FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND place > 1 THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND place > 1 THEN top END AS refers_to
FROM r
"""
