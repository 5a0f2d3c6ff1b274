r"""WARC archives with a two-level capture index.

Captures are range-partitioned and sorted by (reversed-host URL key, page
id).  Each partition becomes one archive file of gzip members, one per
record, an index file of compressed blocks of ``BLOCK`` sorted entries, and a
sparse block directory (first key, place and length of every block).  All lie
in a folder that the cluster shares.

A lookup is sorted like the archive: the file is found by binary search over
the files' first keys (one per write task, which bounds what the tasks are
handed), the block by binary search in that file's directory, the entry by
binary search in the block, and then only the record's byte range is read;
neighbouring records share a read.

Equal payloads (by SHA-1 and length) of at least ``min_bytes`` are stored
once: the one with the smallest page id is the response, the others are
revisits that name it and hold its HTTP header only.  Rows that repeat the
smallest id are responses too.

Defined results: a null payload is empty; a null URL has an empty key and an
empty target; null ids are written as such, sort first, and revisit a
non-null one with the same payload (all are responses if there is none);
repeated rows are separate records; an empty table makes an archive without
files; further columns are ignored.  A record is read and written whole in
memory.  A part is written under a name of its attempt and then renamed, so
a lost or repeated task leaves one complete file.
"""

from __future__ import annotations

import base64
import hashlib
import json
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from credlake.llm.common import filesystem, scratch, ship, stored, utf8

BLOCK = 512
SPAN = 4 << 20  # bytes of neighbouring records read at once
DATE = "2024-01-01T00:00:00Z"
NO_ID = -(1 << 63)  # the sort key of a null id
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def url_key(url: str | None) -> str:
    """The reversed-host key: ``com,example,www)/path?query``, host and scheme without case, no fragment."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host, port = (parts.hostname or "").rstrip("."), parts.port
    except ValueError:
        return url
    if not host:
        return url
    tail = parts.path or "/"
    return ",".join(reversed(host.split("."))) + (f":{port}" if port else "") + ")" + tail + (f"?{parts.query}" if parts.query else "")


def keyed(url: Column) -> Column:
    ship()

    @F.arrow_udf("string")
    def run(urls: pa.Array) -> pa.Array:
        return pa.array([url_key(u) for u in urls.to_pylist()], pa.string())
    return run(url)


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id, url: str | None, payload: bytes, refers_to, revisit: bool, date: str = DATE, digest: str | None = None) -> bytes:
    """One WARC/1.1 record; ids are URNs, so equal input makes equal bytes."""
    digest = digest or base32_sha1(payload)
    body = b"" if revisit else payload
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    target = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{page_id}:{digest}>",
            f"WARC-Date: {date}", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{digest}"]
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}:{digest}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(http) + len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + http + body + b"\r\n\r\n"


def parsed(raw: bytes) -> dict:
    """A record's page id, type, target, digest, the page it refers to, the payload's length and, in a response, the payload.

    A response's length and digest are those of the payload itself, which must
    be what the header states; only a revisit's are the header's.
    """
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:] if ": " in line)
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(next(x for x in http.decode().split("\r\n") if x.startswith("Content-Length: "))[16:])

    def page(urn: str | None):
        text = urn.split(":")[2] if urn else "None"
        return None if text == "None" else int(text)
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"][5:]
    if kind == "response":
        stated, size, digest = (size, digest), len(payload), base32_sha1(payload)
        if (size, digest) != stated:
            raise ValueError(f"{fields['WARC-Record-ID']}: payload of {size} bytes and SHA-1 {digest}, stated {stated[0]} and {stated[1]}")
    return {"page_id": page(fields["WARC-Record-ID"]), "record_type": kind, "url": fields.get("WARC-Target-URI", ""),
            "payload_digest": digest, "refers_to": page(fields.get("WARC-Refers-To")), "payload_bytes": size,
            "payload": payload if kind == "response" else None}


def _put(fs, path: str, attempt: str, data: bytes) -> None:
    with fs.open_output_stream(f"{path}.{attempt}") as f:
        f.write(data)
    fs.move(f"{path}.{attempt}", path)


def write(pages: DataFrame, folder: str | None = None, page_id: str = "page_id", url: str = "url", payload: str = "html", min_bytes: int = 0) -> str:
    """Write an archive of ``pages``; the folder that holds it."""
    ship()
    folder = folder or scratch(pages.sparkSession, "warc")
    sha = F.sha1(F.col("body"))
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), utf8(F.col(payload)).alias("body"))
    rows = rows.withColumn("sha", sha).withColumn("size", F.octet_length("body"))
    twins = (rows.where(F.col("size") >= min_bytes).groupBy("sha", "size").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
             .where((F.col("n") > 1) & F.col("first").isNotNull()).select(F.col("sha").alias("twin_sha"), F.col("size").alias("twin_size"), "first"))
    twins = stored(twins, "twins")
    marked = rows.join(twins, (F.col("sha") == F.col("twin_sha")) & (F.col("size") == F.col("twin_size")), "left").select(
        "page_id", "url", "body", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"))
    order = F.coalesce("page_id", F.lit(NO_ID))
    ranged = marked.withColumn("key", keyed(F.col("url"))).repartitionByRange("key", order).sortWithinPartitions("key", order)

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        task = TaskContext.get()
        name, attempt = f"part-{task.partitionId():06d}", str(task.taskAttemptId())
        fs, root = filesystem(folder)
        fs.create_dir(root, recursive=True)
        entries, at, out = [], 0, fs.open_output_stream(f"{root}/{name}.warc.gz.{attempt}")
        with out:
            for batch in batches:
                for r in batch.to_pylist():
                    digest = base32_sha1(r["body"])
                    revisit = r["refers_to"] is not None
                    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
                    member = packer.compress(record(r["page_id"], r["url"], r["body"], r["refers_to"], revisit, digest=digest)) + packer.flush()
                    out.write(member)
                    entries.append([r["key"], NO_ID if r["page_id"] is None else r["page_id"], at, len(member), "revisit" if revisit else "response", digest])
                    at += len(member)
        if not entries:
            fs.delete_file(f"{root}/{name}.warc.gz.{attempt}")
            return
        fs.move(f"{root}/{name}.warc.gz.{attempt}", f"{root}/{name}.warc.gz")
        index, directory = [], []
        place = 0
        for i in range(0, len(entries), BLOCK):
            packed = zlib.compress("\n".join(map(json.dumps, entries[i:i + BLOCK])).encode(), 1)
            directory.append([entries[i][0], entries[i][1], place, len(packed)])
            index.append(packed)
            place += len(packed)
        _put(fs, f"{root}/{name}.idx", attempt, b"".join(index))
        _put(fs, f"{root}/{name}.dir", attempt, json.dumps(directory).encode())
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([entries[0][0]]), pa.array([entries[0][1]], pa.int64()), pa.array([len(entries)], pa.int64())],
                                         ["part", "first_key", "first_id", "records"])

    parts = ranged.select("key", "page_id", "url", "body", "refers_to").mapInArrow(save, "part string, first_key string, first_id long, records long")
    parts.write.parquet(f"{folder}/parts")
    return folder


class Part:
    """A reader of one archive file through its directory and blocks."""

    def __init__(self, folder: str, name: str):
        self.fs, root = filesystem(folder)
        self.path = f"{root}/{name}"
        with self.fs.open_input_stream(f"{self.path}.dir") as f:
            self.directory = json.loads(f.read())
        self.firsts = [(k, i) for k, i, _, _ in self.directory]
        self.index = self.fs.open_input_file(f"{self.path}.idx")
        self.archive = self.fs.open_input_file(f"{self.path}.warc.gz")
        self.held, self.block = -1, []
        self.start, self.bytes = 0, b""

    def close(self) -> None:
        self.index.close()
        self.archive.close()

    def entries(self, number: int) -> list:
        if number != self.held:
            _, _, at, size = self.directory[number]
            self.held, self.block = number, [json.loads(x) for x in zlib.decompress(self.index.read_at(size, at)).split(b"\n")]
        return self.block

    def find(self, low: tuple[str, int], high: tuple[str, int]) -> Iterator[list]:
        """The entries from ``low`` to ``high`` (both included)."""
        number = max(0, bisect_left(self.firsts, low) - 1)
        while number < len(self.directory) and (self.firsts[number] <= high or not number):
            block = self.entries(number)
            for e in block[bisect_left(block, low, key=lambda e: (e[0], e[1])):]:
                if (e[0], e[1]) > high:
                    return
                yield e
            number += 1

    def read(self, entry: list) -> dict:
        """The record of an entry, from the bytes held or a new range that also takes in its neighbours."""
        at, size = entry[2], entry[3]
        if not self.start <= at or at + size > self.start + len(self.bytes):
            after = [e for e in self.block if e[2] >= at and e[2] + e[3] - at <= SPAN]
            stop = max([at + size, *(e[2] + e[3] for e in after)])
            self.start, self.bytes = at, self.archive.read_at(stop - at, at)
        return parsed(zlib.decompress(self.bytes[at - self.start:at - self.start + size], 31))


CAPTURE = ("key string, page_id long, record_type string, url string, payload_digest string, refers_to long, payload_bytes long, payload binary")
FIELDS = pa.schema([("key", pa.string()), ("page_id", pa.int64()), ("record_type", pa.string()), ("url", pa.string()), ("payload_digest", pa.string()),
                    ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload", pa.binary())])


def lookup(spark: SparkSession, folder: str, wanted: DataFrame, with_payload: bool = True) -> DataFrame:
    """The captures of ``wanted`` (url, page_id): those of the URL key with that page id.

    ``wanted`` may leave out page_id; then all captures of the URL come.
    Rows that ask for the same captures are asked once; null ids match null ids.
    """
    ship()
    parts = sorted(((r["first_key"], r["first_id"], r["part"]) for r in spark.read.schema("part string, first_key string, first_id long, records long")
                    .parquet(f"{folder}/parts").collect()))
    starts = [(k, i) for k, i, _ in parts]
    exact = "page_id" in wanted.columns
    ids = F.coalesce(F.col("page_id").cast("long"), F.lit(NO_ID)) if exact else F.lit(None).cast("long")
    asked = wanted.select(keyed(F.col("url")).alias("key"), ids.alias("id")).distinct()
    # As many ranges as the archive has files, since the keys are small next to the records that they stand for.
    asked = asked.repartitionByRange(max(1, len(parts)), "key", "id").sortWithinPartitions("key", "id")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held, part = [], -1, None
        for batch in batches:
            for key, number in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                low, high = ((key, number), (key, number)) if exact else ((key, NO_ID), (key, (1 << 63) - 1))
                # Equal captures may run over a border between files.
                for p in range(max(0, bisect_left(starts, low) - 1), bisect_right(starts, high)):
                    if p != held:
                        if part:
                            part.close()
                        held, part = p, Part(folder, parts[p][2])
                    for entry in part.find(low, high):
                        found = part.read(entry)
                        rows.append({"key": key, **found, "payload": found["payload"] if with_payload else None})
                        if len(rows) >= 1000:
                            yield pa.RecordBatch.from_pylist(rows, FIELDS)
                            rows = []
        if part:
            part.close()
        if rows:
            yield pa.RecordBatch.from_pylist(rows, FIELDS)

    return asked.mapInArrow(search, CAPTURE)
