"""WARC archives as seekable Zstandard bundles.

A bundle is a file of independent Zstandard frames, each of some ``FRAME_BYTES`` of whole records, and at its end a seek table
in a skippable frame (sizes of all frames, then a footer that says how many), as the public seekable format lays down. An index
maps each record to its bundle, frame, and offset in the frame's contents, so one record is read by one ranged read and one
frame's decompression; ordinary Zstandard tools read a bundle as one stream.

Records with equal payloads of ``REVISIT_BYTES`` or more: the one with the smallest page_id is a response, others are revisits
of it and carry no payload. Rows that repeat the smallest page_id are all responses. A null html is an empty payload, a null url
an empty one; a page without id is never referred to. Bundles are named at random in the given folder, which all executors must
see; the index names the bundles of tasks that succeeded, so whatever a lost task left is never read."""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.tables import lookup
from mercato.llm.text import payloads
from mercato.sources.tables import stage

REVISIT_BYTES = 100
FRAME_BYTES = 1_000_000
BUNDLE_BYTES = 256_000_000
#: Records that one task reads back, in bytes.
TASK_BYTES = 64_000_000
LEVEL = 3
DATE = "1970-01-01T00:00:00Z"
#: Payloads that repeat, when so few, are sent to all tasks; pages are shuffled to them otherwise.
BROADCAST_REPEATS = 200_000
# fixed values of the seekable format
SKIPPABLE, FOOTER = 0x184D2A5E, 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_id(page_id: int | None) -> str:
    return f"<{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}').urn}>"


def record(page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Page-ID: {'' if page_id is None else page_id}", f"WARC-Target-URI: {' '.join(url.split())}", f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        head += [f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Refers-To-Page-ID: {refers_to}", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(data: bytes) -> tuple[dict[str, str], int, bytes]:
    """Header fields, payload length by the HTTP header, and payload (empty for a revisit)."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    http, _, payload = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    return fields, int(http.rpartition(b"Content-Length: ")[2]), payload


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """(compressed, decompressed) sizes as the closing skippable frame."""
    body = b"".join(struct.pack("<II", *x) for x in frames) + struct.pack("<IBI", len(frames), 0, FOOTER)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def read_seek_table(file) -> list[tuple[int, int, int]]:
    """(start, compressed, decompressed) of each frame, from the end of an open bundle."""
    size = file.size()
    n, _, magic = struct.unpack("<IBI", file.read_at(9, size - 9))
    if magic != FOOTER:
        raise ValueError("no seek table")
    entries = struct.iter_unpack("<II", file.read_at(8 * n, size - 9 - 8 * n))
    out, start = [], 0
    for packed, plain in entries:
        out.append((start, packed, plain))
        start += packed
    return out


def with_types(pages: DataFrame) -> DataFrame:
    """page_id, url, html, payload_digest, refers_to (null: response)."""
    body = F.coalesce("html", F.lit(""))
    pages = pages.select("page_id", "url", "html", F.sha2(body, 256).alias("payload_digest"), F.octet_length(body).alias("size"))
    large = pages.filter(F.col("size") >= REVISIT_BYTES)
    first = large.groupBy("payload_digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("rows"))
    joined = pages.join(lookup(first.filter("rows > 1").drop("rows"), BROADCAST_REPEATS), "payload_digest", "left")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.select("page_id", "url", "html", "payload_digest", F.when(again, F.col("first")).alias("refers_to"))


INDEX = "page_id bigint, bundle string, frame int, frame_start bigint, frame_bytes bigint, offset bigint, length bigint"


def write(pages: DataFrame, folder: str) -> DataFrame:
    """Writes bundles of all pages to the folder and returns the stored index: one row per record."""
    names = [x.split()[0] for x in INDEX.split(", ")]

    def bundles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        pack = zstandard.ZstdCompressor(level=LEVEL)
        out, name, frames, start, held, size, rows = None, "", [], 0, [], 0, []

        def flush() -> None:
            nonlocal start, size
            body = pack.compress(b"".join(x for _, x in held))
            at = 0
            for page, x in held:
                rows.append((page, name, len(frames), start, len(body), at, len(x)))
                at += len(x)
            out.write(body)
            frames.append((len(body), size))
            start += len(body)
            held.clear()
            size = 0

        def close() -> None:
            if held:
                flush()
            out.write(seek_table(frames))
            out.close()

        def taken() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], pa.schema([
                ("page_id", pa.int64()), ("bundle", pa.string()), ("frame", pa.int32()), *[(n, pa.int64()) for n in names[3:]],
            ]))
            rows.clear()
            return batch

        for b in batches:
            columns = b["page_id"].to_pylist(), b["url"].to_pylist(), payloads(b["html"]), b["payload_digest"].to_pylist(), b["refers_to"].to_pylist()
            for page, url, html, digest, refers in zip(*columns):
                if out is None:
                    name, frames, start = f"{uuid.uuid4().hex}.warc.zst", [], 0
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                held.append((page, record(page, url or "", html, digest, refers)))
                size += len(held[-1][1])
                if size >= FRAME_BYTES:
                    flush()
                    if start >= BUNDLE_BYTES:
                        close()
                        out = None
                        yield taken()
        if out is not None:
            close()
            yield taken()

    return stage(with_types(pages).mapInArrow(bundles, INDEX), "warc-index")


def fetch(index: DataFrame, folder: str) -> DataFrame:
    """The records of index rows: page_id, record_type, refers_to, payload_bytes, payload_digest (of the header), payload
    (null for a revisit). A frame is read once for all its records."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        unpack = zstandard.ZstdDecompressor()
        name, file, at, frame = None, None, None, b""
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        for batch in batches:
            rows, size = [], 0
            for r in batch.to_pylist():
                if r["bundle"] != name:
                    if file:
                        file.close()
                    name, at = r["bundle"], None
                    file = store.open_input_file(f"{root}/{name}")
                if r["frame_start"] != at:
                    at = r["frame_start"]
                    frame = unpack.decompress(file.read_at(r["frame_bytes"], at))
                head, n, payload = parsed(frame[r["offset"] : r["offset"] + r["length"]])
                refers = head.get("WARC-Refers-To-Page-ID")
                page = head["WARC-Page-ID"]
                rows.append((
                    int(page) if page else None, head["WARC-Type"], int(refers) if refers else None, n,
                    head["WARC-Payload-Digest"].removeprefix("sha256:"), None if refers else payload,
                ))
                size += len(payload)
                if size > 16 * FRAME_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds)], FETCHED_NAMES)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds)], FETCHED_NAMES)

    # the index is small beside what it points to: tasks are sized by the records, not by index rows
    size = index.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    placed = index.repartition(1 + size // TASK_BYTES, "bundle", "frame").sortWithinPartitions("bundle", "frame_start", "offset")
    return placed.mapInArrow(read, FETCHED)


FETCHED = "page_id bigint, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string, payload binary"
FETCHED_NAMES = [x.split()[0] for x in FETCHED.split(", ")]


def read_back(index: DataFrame, folder: str) -> DataFrame:
    """Of every record: page_id, payload_bytes, payload_digest, record_type, refers_to. Responses are measured and hashed
    anew; a payload that does not match its header is an error."""
    got = fetch(index, folder)
    fits = (F.sha2("payload", 256) == F.col("payload_digest")) & (F.octet_length("payload") == F.col("payload_bytes"))
    checked = F.when(F.col("payload").isNull() | fits, F.col("payload_digest")).otherwise(
        F.raise_error(F.concat(F.lit("payload of page "), F.col("page_id").cast("string"), F.lit(" does not match its digest")))
    )
    return got.select("page_id", "payload_bytes", checked.alias("payload_digest"), "record_type", "refers_to")
