"""Documents packed into blocks, and questions that blocks ask each other about names.

A block is one row: ids, sizes and the joined bodies of some documents, about
``block`` bytes.  To learn which of its names other blocks hold, every block
sends each distinct name once to the name's bucket; the task that gets a bucket
answers each block with bits in the order of the names it sent.  The answers
are written as one file per block in the shared folder and read by the task
that works on the block next.  A name that a third of all rows share costs its
bucket one entry per block, so no bucket depends on how often a name occurs.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from credlake.llm.common import filesystem, utf8

BLOCK = 8 << 20
BUCKET = 8 << 20  # bytes that a bucket is planned for
STEP = 1 << 18  # values hashed at a time


def randoms(seed: int, count: int) -> np.ndarray:
    """Fixed pseudo-random 64-bit values."""
    raw = hashlib.shake_256(f"names {seed}".encode()).digest(8 * count)
    return np.frombuffer(raw, np.uint64).copy()


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


class Names:
    """64-bit names of ranges of at most ``depth`` values: a polynomial modulo 2**64, mixed."""

    def __init__(self, seed: int, depth: int):
        self.depth = depth
        base = int(randoms(seed + 1000, 1)[0]) | 1
        back = pow(base, -1, 1 << 64)
        self.powers, self.inverse = (np.cumprod(np.array([1] + [b] * (STEP + depth), np.uint64), dtype=np.uint64) for b in (base, back))

    def at(self, values: Callable[[int, int], np.ndarray], size: int, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """A name for each range [start, stop), starts ascending; ``values(i, j)`` gives the values i to j as uint64."""
        out = np.empty(len(starts), np.uint64)
        lows = np.searchsorted(starts, np.arange(0, size + STEP, STEP))
        for i in range(len(lows) - 1):
            here = slice(lows[i], lows[i + 1])
            if here.start == here.stop:
                continue
            part = values(i * STEP, min(size, (i + 1) * STEP + self.depth))
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(part * self.powers[:len(part)], out=sums[1:])
            first = starts[here] - i * STEP
            out[here] = (sums[stops[here] - i * STEP] - sums[first]) * self.inverse[first]
        return mixed(out)


_KEPT: dict = {}


def names(seed: int, depth: int) -> Names:
    """Kept per worker."""
    if (seed, depth) not in _KEPT:
        _KEPT[seed, depth] = Names(seed, depth)
    return _KEPT[seed, depth]


def contained(values: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Which values are in ``of`` (sorted)."""
    if not len(of):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(of, values), len(of) - 1)
    return of[at] == values


def bits(raw: bytes, count: int, skip: int = 0) -> np.ndarray:
    return np.unpackbits(np.frombuffer(raw, np.uint8, offset=skip), count=count).astype(bool)


def runs(bucket: np.ndarray) -> list[tuple[int, slice]]:
    """(bucket, where) of an ascending array of buckets."""
    found, first = np.unique(bucket, return_index=True)
    return [(int(b), slice(i, j)) for b, i, j in zip(found, first, [*first[1:], len(bucket)])]


def narrow(h: np.ndarray, buckets: int) -> np.ndarray:
    """Ranks of names: the bucket in the upper half, 32 bits of the name in the lower; for filters, where a chance tie costs time only."""
    return ((h >> np.uint64(32)) % np.uint64(buckets) << np.uint64(32)) | (h & np.uint64(0xFFFFFFFF))


def narrow_parts(ranks: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """(bucket, data) of a block's ranks: the distinct ones, and which of them the block has twice."""
    values, counts = np.unique(ranks, return_counts=True)
    for bucket, at in runs(values >> np.uint64(32)):
        part = values[at].astype(np.uint32)
        yield bucket, struct.pack("<q", len(part)) + part.tobytes() + np.packbits(counts[at] > 1).tobytes()


def narrow_ties(sent: list[tuple[int, bytes]]) -> list[bytes | None]:
    """For each block's data, bits of the ranks that start at two places or more in all."""
    parts, every = [], []
    for _, raw in sent:
        (count,) = struct.unpack_from("<q", raw)
        part = np.frombuffer(raw, np.uint32, count, 8)
        parts.append(part)
        every += [part, part[bits(raw, count, 8 + 4 * count)]]
    ordered = np.sort(np.concatenate(every))
    ties = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    return [np.packbits(b).tobytes() if (b := contained(p, ties)).any() else None for p in parts]


def narrow_chosen(ranks: np.ndarray, answer: dict[int, bytes]) -> np.ndarray:
    """Which of a block's ranks the answer has a 1 for."""
    values = np.unique(ranks)
    out = [values[at][bits(answer[bucket], at.stop - at.start)] for bucket, at in runs(values >> np.uint64(32)) if bucket in answer]
    return contained(ranks, np.concatenate(out)) if out else np.zeros(len(ranks), bool)


def packed(df: DataFrame, key: str, text: str, block: int, path: str, ordered: bool, body: Callable[[bytes], bytes] | None = None) -> DataFrame:
    """The documents as rows (block, ids, sizes, body), written to the shared folder; ``ordered``: blocks and their documents ascend by key."""
    rows = df.select(F.col(key).alias("id"), utf8(F.col(text)).alias("body"))
    kind = df.schema[key].dataType.simpleString()
    if ordered:
        rows = rows.withColumn("tie", F.xxhash64("body")).repartitionByRange("id", "tie").sortWithinPartitions("id", "tie").select("id", "body")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        number, ids, bodies, size = TaskContext.get().partitionId() << 33, [], [], 0

        def row():
            return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([ids]), pa.array([[len(b) for b in bodies]], pa.list_(pa.int64())),
                                               pa.array([b"".join(bodies)], pa.binary())], ["block", "ids", "sizes", "body"])
        for batch in batches:
            for i, b in zip(batch.column(0), batch.column(1)):
                b = b.as_py()
                b = body(b) if body else b
                if bodies and size + len(b) > block:
                    yield row()
                    number, ids, bodies, size = number + 1, [], [], 0
                ids.append(i.as_py())
                bodies.append(b)
                size += len(b)
        if bodies:
            yield row()
    schema = f"block long, ids array<{kind}>, sizes array<bigint>, body binary"
    rows.mapInArrow(pack, schema).write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Array, np.ndarray, bytes]]:
    """(block, ids, sizes, body) of the blocks."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield (batch.column("block")[i].as_py(), batch.column("ids")[i].values, np.array(batch.column("sizes")[i].as_py(), np.int64),
                   batch.column("body")[i].as_py())


def save(folder: str, name: str, data: bytes) -> None:
    """Write a file of the shared folder in one step, whichever attempt of a task comes last."""
    from pyspark import TaskContext
    fs, root = filesystem(folder)
    fs.create_dir(root, recursive=True)
    attempt = f"{root}/{name}.{TaskContext.get().taskAttemptId()}"
    with fs.open_output_stream(attempt) as f:
        f.write(data)
    fs.move(attempt, f"{root}/{name}")


def load(folder: str, name: str) -> bytes | None:
    from pyarrow.fs import FileType
    fs, root = filesystem(folder)
    path = f"{root}/{name}"
    if fs.get_file_info(path).type == FileType.NotFound:
        return None
    with fs.open_input_stream(path) as f:
        return f.read()


def answers(folder: str, block: int) -> dict[int, bytes]:
    """What the buckets said to a block, by bucket; nothing from buckets without a 1 for it."""
    raw, out, at = load(folder, str(block)) or b"", {}, 0
    while at < len(raw):
        bucket, size = struct.unpack_from("<qq", raw, at)
        out[bucket] = raw[at + 16:at + 16 + size]
        at += 16 + size
    return out


def ask(blocks: DataFrame, send: Callable, judge: Callable, buckets: int, folder: str) -> int:
    """Have ``judge`` answer what ``send`` yields; returns how many blocks got an answer.

    ``send(number, ids, sizes, body)`` yields (bucket, data); ``judge`` gets a
    bucket's [(block, data)] in block order and returns bytes or None for each.
    """
    def sender(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, ids, sizes, body in rows_of(batches):
            parts = list(send(number, ids, sizes, body))
            for i in range(0, len(parts), 64):
                some = parts[i:i + 64]
                yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in some], pa.int64()), pa.array([number] * len(some), pa.int64()),
                                                  pa.array([d for _, d in some], pa.binary())], ["bucket", "block", "data"])

    def bucket(table: pa.Table) -> pa.Table:
        table = table.sort_by("block")
        number = table.column("block").to_pylist()
        said = judge(list(zip(number, table.column("data").to_pylist())))
        rows = [(n, b, d) for n, b, d in zip(number, table.column("bucket").to_pylist(), said) if d is not None]
        return pa.table([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.binary()))], names=["block", "bucket", "data"])

    def deliver(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, done = None, [], []

        def put():
            if held:
                save(folder, str(block), b"".join(held))
                done.append(block)
        for batch in batches:
            for n, b, data in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if n != block:
                    put()
                    block, held = n, []
                held.append(struct.pack("<qq", b, len(data)) + data)
        put()
        yield pa.RecordBatch.from_arrays([pa.array(done, pa.int64())], ["block"])
    # A task per bucket: what one task reads does not grow with the input.
    sent = blocks.mapInArrow(sender, "bucket long, block long, data binary").repartition(buckets, "bucket")
    said = sent.groupBy("bucket").applyInArrow(bucket, "block long, bucket long, data binary")
    got = f"{folder}-list"
    said.repartition("block").sortWithinPartitions("block", "bucket").mapInArrow(deliver, "block long").write.parquet(got)
    return blocks.sparkSession.read.schema("block long").parquet(got).count()


def whole_parts(bodies: list[bytes], buckets: int) -> Iterator[tuple[int, bytes]]:
    """(bucket, data) of a block's distinct SHA-256 digests, with a byte that says which it has twice."""
    seen: dict[bytes, int] = {}
    for b in bodies:
        digest = hashlib.sha256(b).digest()
        seen[digest] = seen.get(digest, 0) + 1
    by: dict[int, list[bytes]] = {}
    for digest, count in seen.items():
        by.setdefault(int.from_bytes(digest[:8], "little") % buckets, []).append(digest + bytes([min(count, 2)]))
    yield from ((bucket, b"".join(held)) for bucket, held in by.items())


def whole_copies(sent: list[tuple[int, bytes]]) -> list[bytes | None]:
    """For each block, its digests that occur twice or more in all, each with a byte: 1 where this block is the first to hold it."""
    count: dict[bytes, int] = {}
    first: dict[bytes, int] = {}
    split = [[(raw[i:i + 32], raw[i + 32]) for i in range(0, len(raw), 33)] for _, raw in sent]
    for at, parts in enumerate(split):
        for digest, times in parts:
            count[digest] = count.get(digest, 0) + times
            first.setdefault(digest, at)
    out = [b"".join(d + bytes([first[d] == at]) for d, _ in parts if count[d] > 1) for at, parts in enumerate(split)]
    return [o or None for o in out]


def copies(bodies: list[bytes], answer: dict[int, bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For each body whether another document equals it, and whether an earlier one does (in block order)."""
    again, later = np.zeros(len(bodies), bool), np.zeros(len(bodies), bool)
    if not answer:
        return again, later
    known = {raw[i:i + 32]: raw[i + 32] for raw in answer.values() for i in range(0, len(raw), 33)}
    met = set()
    for i, b in enumerate(bodies):
        digest = hashlib.sha256(b).digest()
        if digest in known:
            again[i], later[i] = True, not known[digest] or digest in met
            met.add(digest)
    return again, later
