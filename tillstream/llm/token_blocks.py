"""Token ids in patched frame-of-reference blocks.

Ids are cut into blocks. A block stores its minimum, then every id less that
minimum in as many bits as the chosen percentile of them needs; ids that need
more keep their low bits there and stand whole in the block's exception list.
An index of block starts allows to read any one block.

A segment is one binary value:

    magic "PFB1", block size, ids, blocks              4 unsigned 32-bit numbers
    minimum, start (byte in the body) of each block    unsigned 32-bit each
    exceptions of each block                           unsigned 16-bit each
    width of each block                                unsigned 8-bit each
    body: for each block its packed ids, then exception places (8-bit) and values (32-bit)

All numbers are little-endian. The last block is filled up with its minimum.

Segments are rows of a table that Spark writes, so they lie in any store that
Spark reaches and a lost executor's files are written again. Documents are in
ascending doc_id order (null first, equal ids by text), a part for each range
of ids, segments within a part; a document is never split among segments.
A null or empty text gives the end id alone; an empty table gives no segment.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillstream.llm.common import chunks, task_count, text_bytes
from tillstream.llm.token_ids import word_bpe

BLOCK = 256
SEGMENT_IDS = 1 << 18
MAGIC = int.from_bytes(b"PFB1", "little")

SEGMENTS = (
    "part int, segment int, part_start bigint, n_ids bigint, "
    "doc_ids array<bigint>, lengths binary, ids binary"
)
DOCUMENT_IDS = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


def _bits(values: np.ndarray) -> np.ndarray:
    """Bits that each value below 2**32 needs."""
    return np.frexp(values.astype(np.float64))[1].astype(np.uint8)


def pack(values: np.ndarray, percentile: float = 0.95) -> bytes:
    """A segment of unsigned 32-bit values."""
    count = len(values)
    blocks = -(-count // BLOCK)
    table = np.zeros((blocks, BLOCK), np.uint32)
    table.reshape(-1)[:count] = values
    if count % BLOCK:
        table[-1, count % BLOCK :] = table[-1, : count % BLOCK].min()
    least = table.min(axis=1) if blocks else np.zeros(0, np.uint32)
    table -= least[:, None]
    rank = min(BLOCK - 1, int(percentile * BLOCK))
    widths = _bits(np.partition(table, rank, axis=1)[:, rank]) if blocks else np.zeros(0, np.uint8)
    over = (table >> np.minimum(widths, 31)[:, None] > 0) & (widths < 32)[:, None]
    over[widths == 31] = table[widths == 31] >> 31 > 0
    exceptions = over.sum(axis=1).astype("<u2")
    sizes = BLOCK // 8 * widths.astype(np.int64) + 5 * exceptions.astype(np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    body = np.zeros(starts[-1], np.uint8)
    for width in np.unique(widths[widths > 0]):
        rows = np.flatnonzero(widths == width)
        raw = table[rows].astype("<u4").view(np.uint8)
        bits = np.unpackbits(raw, axis=1, bitorder="little").reshape(len(rows), BLOCK, 32)
        packed = np.packbits(bits[:, :, :width].reshape(len(rows), -1), axis=1, bitorder="little")
        body[starts[rows][:, None] + np.arange(packed.shape[1])] = packed
    rows, places = np.nonzero(over)
    if len(rows):
        nth = np.arange(len(rows)) - np.repeat(
            np.cumsum(exceptions.astype(np.int64)) - exceptions, exceptions
        )
        head = starts[rows] + BLOCK // 8 * widths[rows].astype(np.int64)
        body[head + nth] = places
        at = head + exceptions[rows] + 4 * nth
        whole = table[rows, places].astype("<u4").view(np.uint8).reshape(-1, 4)
        body[at[:, None] + np.arange(4)] = whole
    head = np.array([MAGIC, BLOCK, count, blocks], "<u4")
    parts = (head, least.astype("<u4"), starts[:-1].astype("<u4"), exceptions, widths, body)
    return b"".join(part.tobytes() for part in parts)


def _opened(data: bytes):
    magic, size, count, blocks = np.frombuffer(data, "<u4", 4).tolist()
    if magic != MAGIC:
        raise ValueError("not a segment of token blocks")
    at = 16
    least = np.frombuffer(data, "<u4", blocks, at)
    starts = np.frombuffer(data, "<u4", blocks, at + 4 * blocks).astype(np.int64)
    exceptions = np.frombuffer(data, "<u2", blocks, at + 8 * blocks).astype(np.int64)
    widths = np.frombuffer(data, np.uint8, blocks, at + 10 * blocks)
    body = np.frombuffer(data, np.uint8, offset=at + 11 * blocks)
    return size, count, least, starts, exceptions, widths, body


def _blocks(opened, rows: np.ndarray) -> np.ndarray:
    """The chosen blocks, one a row."""
    size, _, least, starts, exceptions, widths, body = opened
    out = np.zeros((len(rows), size), np.uint32)
    for width in np.unique(widths[rows]):
        if width:
            mine = np.flatnonzero(widths[rows] == width)
            raw = body[starts[rows[mine]][:, None] + np.arange(size // 8 * int(width))]
            bits = np.unpackbits(raw, axis=1, bitorder="little").reshape(len(mine), size, width)
            wide = np.zeros((len(mine), size, 32), np.uint8)
            wide[:, :, :width] = bits
            packed = np.packbits(wide.reshape(len(mine), -1), axis=1, bitorder="little")
            out[mine] = packed.view("<u4")
    for row in np.flatnonzero(exceptions[rows]):
        block = rows[row]
        n, at = exceptions[block], starts[block] + size // 8 * int(widths[block])
        places = body[at : at + n]
        out[row, places] = np.frombuffer(body[at + n : at + 5 * n].tobytes(), "<u4")
    return out + least[rows][:, None].astype(np.uint32)


def unpack(data: bytes) -> np.ndarray:
    """All values of a segment."""
    opened = _opened(data)
    return _blocks(opened, np.arange(len(opened[2]))).reshape(-1)[: opened[1]]


def unpack_block(data: bytes, block: int) -> np.ndarray:
    """One block of a segment, found by the index of block starts."""
    opened = _opened(data)
    count = min(opened[0], opened[1] - block * opened[0])
    return _blocks(opened, np.array([block]))[0][:count]


def encode_documents(docs: DataFrame, end: int = 1, tokenizer: str | None = None) -> DataFrame:
    """Segments (``SEGMENTS``) of all documents in ascending doc_id order."""
    parts = task_count(text_bytes(docs))
    dealt = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
        .repartitionByRange(parts, F.asc_nulls_first("doc_id"))
        .sortWithinPartitions(F.asc_nulls_first("doc_id"), F.asc_nulls_first("text"))
        .select(F.spark_partition_id().alias("part"), "doc_id", "text")
    )

    def make(batches):
        encoder = word_bpe(tokenizer)
        segment = start = size = 0
        ids: list[int | None] = []
        held: list[bytes] = []

        def close():
            nonlocal segment, start, size, ids, held
            lengths = np.array([len(x) // 4 for x in held], np.uint32)
            values = np.frombuffer(b"".join(held), "<u4")
            row = [[part], [segment], [start], [len(values)], [ids], [pack(lengths)], [pack(values)]]
            segment, start, size, ids, held = segment + 1, start + len(values), 0, [], []
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
            arrays = [pa.array(x, t) for x, t in zip(row, (*kinds, pa.binary(), pa.binary()), strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names)

        for batch in chunks(batches):
            part = batch.column("part")[0].as_py()
            texts = batch.column("text").to_pylist()
            encoded = encoder.encode(texts, end)
            for doc_id, found in zip(batch.column("doc_id").to_pylist(), encoded, strict=True):
                ids.append(doc_id)
                held.append(found)
                size += len(found) // 4
                if size >= SEGMENT_IDS:
                    yield close()
        if held:
            yield close()

    names = [field.split()[0] for field in SEGMENTS.split(", ")]
    return dealt.mapInArrow(make, SEGMENTS)


def write_documents(docs: DataFrame, path: str, **options) -> None:
    """Write the segments of all documents as the table ``path``."""
    encode_documents(docs, **options).write.parquet(path)


def read_documents(segments: DataFrame) -> DataFrame:
    """For each document of written segments, what its ids are (``DOCUMENT_IDS``).

    The parts' own lengths, one number for each part, are summed up in one task.
    """
    def make(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids, lengths = unpack(row["ids"]).astype("<u4"), unpack(row["lengths"])
                ends = np.cumsum(lengths.astype(np.int64))
                data = memoryview(ids.tobytes())
                starts = ends - lengths
                sums = [
                    zlib.crc32(data[4 * a : 4 * b])
                    for a, b in zip(starts.tolist(), ends.tolist(), strict=True)
                ]
                arrays = [
                    pa.array([row["part"]] * len(ends), pa.int32()),
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(starts + row["part_start"], pa.int64()),
                    pa.array(lengths.astype(np.int64), pa.int64()),
                    pa.array(sums, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names)

    names = ["part", *[field.split()[0] for field in DOCUMENT_IDS.split(", ")]]
    read = segments.mapInArrow(make, f"part int, {DOCUMENT_IDS}")
    parts = segments.groupBy("part").agg(F.sum("n_ids").alias("ids_of_part"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        "part", F.coalesce(F.sum("ids_of_part").over(before), F.lit(0)).alias("offset")
    )
    start = (F.col("start") + F.col("offset")).alias("start")
    return read.join(offsets, "part").select("doc_id", start, "n_tokens", "ids_crc32")
