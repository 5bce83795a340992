"""Documents in blocks of bounded size, one row each, and packed rows that are dealt to hash buckets.

A block row keeps all columns of its documents as compressed Arrow data, so that per-document
values can come back to a block by its number alone, also for repeated rows and equal ids.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import pyarrow.ipc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import slices, small_batches, tidy, utf8

#: What a null id counts as: larger than all.
LAST = (1 << 63) - 1
_IPC = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=6))


def pack_rows(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=_IPC) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpack_rows(data: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(data).read_next_batch()


def pack_numbers(*arrays: np.ndarray) -> bytes:
    """Arrays of one length, compressed by byte planes: the first bytes of all numbers, then the second."""
    planes = [np.ascontiguousarray(a).view(np.uint8).reshape(a.size, a.itemsize).T.tobytes() for a in arrays]
    return zstandard.ZstdCompressor(level=3).compress(b"".join(planes))


def unpack_numbers(data: bytes, *kinds: type) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    widths = [np.dtype(k).itemsize for k in kinds]
    n = raw.size // sum(widths)
    ends = np.cumsum(widths) * n
    return [np.ascontiguousarray(raw[e - w * n : e].reshape(w, n).T).view(k).reshape(n) for e, w, k in zip(ends, widths, kinds, strict=True)]


def gathered(batches: Iterator[pa.RecordBatch], text_col: str, block: int) -> Iterator[pa.RecordBatch]:
    """Batches whose texts have about ``block`` bytes together; a longer text stands alone."""
    held: list[pa.RecordBatch] = []
    size = 0
    joined = lambda: pa.Table.from_batches(held).combine_chunks().to_batches()[0]
    for batch in batches:
        lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(text_col)), 0).to_numpy()
        for i, j in slices(lengths, block):
            n = int(lengths[i:j].sum())
            if held and size + n > block:
                yield joined()
                held, size = [], 0
            held.append(batch.slice(i, j - i))
            size += n
    if sum(map(len, held)):
        yield joined()


def blocks(docs: DataFrame, id_col: str, text_col: str, block: int, least: int = 0) -> DataFrame:
    """One row per block: block, n_bytes, ids, keys (hash of each text, null below ``least`` bytes),
    data (the rows with all their columns)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for one in gathered(batches, text_col, block):
            texts = [utf8(t) for t in one.column(text_col).to_pylist()]
            keys = [xxhash.xxh3_128_digest(t) if len(t) >= least else None for t in texts]
            ids = one.column(id_col).cast(pa.int64()).fill_null(LAST)
            row = {"block": [number], "n_bytes": [sum(map(len, texts))], "ids": [ids.to_pylist()], "keys": [keys], "data": [pack_rows(one)]}
            yield pa.RecordBatch.from_pydict(row, schema=schema)
            number += 1

    small_batches(docs.sparkSession)
    schema = pa.schema([("block", pa.int64()), ("n_bytes", pa.int64()), ("ids", pa.list_(pa.int64())), ("keys", pa.list_(pa.binary())), ("data", pa.binary())])
    return docs.mapInArrow(tidy(run), "block long, n_bytes long, ids array<long>, keys array<binary>, data binary")


def by_bucket(rows: DataFrame, settle: Callable[[pa.Table], Iterator[pa.RecordBatch]], schema: str, buckets: int) -> DataFrame:
    """Rows of one bucket together, as a list of record batches, in a task that has the bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            bucket = batch.column("bucket").to_numpy()
            first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if bucket.size else []
            for i, j in zip(first, [*first[1:], len(bucket)], strict=True):
                part = batch.slice(i, j - i)
                if held and held[0].column("bucket")[0] != part.column("bucket")[0]:
                    yield from settle(pa.Table.from_batches(held))
                    held = []
                held.append(part)
        if held:
            yield from settle(pa.Table.from_batches(held))

    return rows.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(tidy(run), schema)
