"""Blocks of rows, and sets of hashes that travel between blocks and buckets.

A block is a row that holds many input rows, compressed, so that tasks can combine what the rows of a block have in
common before anything is shuffled. Blocks are written once to the shared folder: their numbers are fixed, whatever is lost
and run again. A block asks buckets about hashes (one row per block and bucket, hashes sorted and compressed), a bucket
compares what all blocks asked and answers each. A hash that a third of all rows have is one entry per block."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame

from mercato.llm.text import payloads, release
from mercato.sources.tables import stage

BLOCK_BYTES = 6_000_000
BLOCK_ROWS = 8_192


def cut(batch: pa.RecordBatch, column: str, most_bytes: int = BLOCK_BYTES, most_rows: int = BLOCK_ROWS) -> Iterator[pa.RecordBatch]:
    """Slices of at most so many bytes of the column (or one row) and rows."""
    sizes = np.cumsum([len(x) for x in payloads(batch[column])])
    start = 0
    while start < batch.num_rows:
        before = sizes[start - 1] if start else 0
        stop = min(max(int(np.searchsorted(sizes, before + most_bytes, "right")), start + 1), start + most_rows)
        yield batch.slice(start, stop - start)
        start = stop


def blocks(docs: DataFrame, text: str = "text", name: str = "blocks", most_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(block bigint, content binary), stored. A block has at most so many bytes of text, or one text."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << 32
        for batch in batches:
            for b in cut(batch, text, most_bytes):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, b.schema) as out:
                    out.write_batch(b)
                body = zstandard.ZstdCompressor(level=1).compress(sink.getvalue())
                yield pa.RecordBatch.from_arrays([pa.array([task], pa.int64()), pa.array([body], pa.binary())], ["block", "content"])
                task += 1
        release()

    return stage(docs.mapInArrow(packed, "block bigint, content binary"), name)


def unpack(content: bytes) -> pa.RecordBatch:
    table = pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(content)).read_all().combine_chunks()
    return table.to_batches()[0] if table.num_rows else pa.RecordBatch.from_pylist([], table.schema)


def pack_sorted(values: np.ndarray) -> bytes:
    """Sorted unsigned 64-bit integers: differences, byte planes, compressed."""
    steps = np.diff(values, prepend=np.zeros(1, values.dtype))
    return pack_any(steps)


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack_any(data), dtype=np.uint64)


def pack_any(values: np.ndarray) -> bytes:
    planes = values.astype("<u8", copy=False).view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack_any(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").ravel()


def bucket_count(stored: DataFrame) -> int:
    """About one bucket per block: a power of two."""
    return 1 << max(3, stored.count().bit_length() - 1)
