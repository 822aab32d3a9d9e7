"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillstream.session import materialize

#: Bytes of text that a Python worker handles at once; a longer single text goes alone.
CHUNK_BYTES = 4 << 20
#: Bytes of text for one task, where an operator deals rows out itself.
TASK_BYTES = 16 << 20
#: Bytes that separate words: space, tab, newline, vertical tab, form feed, return.
WORD_GAPS = " \\x09-\\x0D"

__all__ = ["CHUNK_BYTES", "TASK_BYTES", "materialize"]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``CHUNK_BYTES`` of text."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0)
        start, size = 0, 0
        for row, length in enumerate(lengths.to_pylist()):
            if size and size + length > CHUNK_BYTES:
                yield batch.slice(start, row - start)
                start, size = row, 0
            size += length
        if batch.num_rows > start:
            yield batch.slice(start)
        give_back()


#: The C library's call that gives the system what a process no longer uses, where it has one.
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Arrow and the C library keep the memory of what is gone unless told."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


#: What this worker keeps from task to task, for speed only: the step, and how it is dropped.
_kept: list[tuple[str, Callable[[], None]]] = []


def only_keep(step: str, drop: Callable[[], None] | None = None) -> None:
    """Drop what tasks of other steps have left in this worker; ``drop`` does so for this one's."""
    for _, old in [own for own in _kept if own[0] != step]:
        old()
    give_back()
    _kept[:] = [(step, drop)] if drop else []


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    """UTF-8 bytes of all texts."""
    return docs.agg(F.sum(F.octet_length(text).cast("long"))).first()[0] or 0


def task_count(total_bytes: int, task_bytes: int = TASK_BYTES) -> int:
    """Tasks among which ``total_bytes`` of text are dealt out."""
    return max(1, -(-total_bytes // task_bytes))


def unit_interval(key: Column, name: str) -> Column:
    """A repeatable number in (0, 1) for a key, different for each name.

    It takes 52 bits of an MD5 digest, so that other engines can give the same.
    """
    digest = F.md5(F.concat_ws(":", F.lit(name), key.cast("string")))
    bits = F.conv(F.substring(digest, 1, 13), 16, 10).cast("double")
    return (bits + F.lit(0.5)) / F.lit(float(1 << 52))


def unused(columns: list[str], name: str) -> str:
    """``name``, made longer until no column has it, whatever the case."""
    taken = {column.lower() for column in columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_text_columns(
    docs: DataFrame,
    schema: str,
    function: Callable[[list[bytes | None]], list],
    text: str = "text",
) -> DataFrame:
    """``docs`` with columns that Python makes of whole texts, a chunk at a time.

    ``function`` takes UTF-8 texts and gives one list for each field of
    ``schema``. A column of the same name is replaced.
    """
    new = StructType.fromDDL(schema)
    names = {field.name.lower() for field in new}
    read = unused([*docs.columns, *new.names], "_read")
    if text.lower() in names:
        # the new text takes the old one's place in the result
        docs = docs.select("*", F.col(text).alias(read))
        text = read
    kept = [field for field in docs.schema if field.name.lower() not in names]

    def make(batches):
        only_keep("texts")
        for batch in chunks(batches, text):
            made = function(batch.column(text).cast(pa.binary()).to_pylist())
            arrays = [batch.column(field.name) for field in kept if field.name != read]
            yield pa.RecordBatch.from_arrays(
                arrays + [pa.array(x, t) for x, t in zip(made, kinds, strict=True)], columns
            )

    out = StructType([field for field in kept if field.name != read] + list(new))
    columns = out.names
    kinds = [ARROW_TYPES[field.dataType.simpleString()] for field in new]
    return docs.select(*[field.name for field in kept]).mapInArrow(make, out)


def set_aside(docs: DataFrame, needed: tuple[str, ...]) -> tuple[DataFrame, list[Column]]:
    """``docs`` with columns that are not needed under names that clash with none.

    The columns to select at the end give back the input's own names and order.
    """
    names = [name if name in needed else f"_aside_{k}" for k, name in enumerate(docs.columns)]
    back = [F.col(own).alias(name) for own, name in zip(names, docs.columns, strict=True)]
    return docs.toDF(*names), back


#: Arrow's types for the fields that these operators make.
ARROW_TYPES = {
    "bigint": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "boolean": pa.bool_(),
    "string": pa.string(),
    "binary": pa.binary(),
    "array<bigint>": pa.list_(pa.int64()),
    "array<int>": pa.list_(pa.int32()),
}


def words_of(text: bytes) -> list[bytes]:
    """Words between ASCII white space: the split of bytes knows just these six."""
    return text.split()


_IS_WORD = ~np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
_CRC_STEP = np.array([zlib.crc32(bytes([0xFF ^ k])) ^ 0xFF000000 for k in range(256)], np.uint32)
#: The same for two bytes, the first one in the lower half.
_CRC_TWO_STEPS = np.arange(1 << 16, dtype=np.uint32)
for _ in range(2):
    _CRC_TWO_STEPS = (_CRC_TWO_STEPS >> np.uint32(8)) ^ _CRC_STEP[_CRC_TWO_STEPS & np.uint32(0xFF)]
#: Words of more bytes are hashed one by one.
_LONG_WORD = 64
#: Bytes of text whose words are hashed at once, which stay in the processor's cache.
_HASHED_BYTES = 1 << 18


def word_crcs(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """CRC-32 of every word of ``words_of`` (null: none), and each text's number of words."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(), dtype=np.int64)
    cuts = np.flatnonzero(np.diff(sizes // _HASHED_BYTES)) + 1
    parts = [
        _word_crcs(texts.slice(a, b - a))
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(texts)], strict=True)
    ]
    crcs, counts = zip(*parts, strict=True)
    return np.concatenate(crcs), np.concatenate(counts)


def _word_crcs(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All words take their next two bytes at once, those of odd length their last one alone."""
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    if not len(texts):
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    _, places, data = texts.buffers()
    places = np.frombuffer(places, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data or b"", np.uint8)[places[0] : places[-1]]
    places = places - places[0]
    # a word starts after a gap or where a text starts, and ends likewise
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = _IS_WORD.take(data)
    starts, ends = inside[1:] & ~inside[:-1], inside[:-1] & ~inside[1:]
    cuts = places[inside[places] & inside[places + 1]]
    starts[cuts] = ends[cuts] = True
    starts = np.flatnonzero(starts)
    lengths = np.flatnonzero(ends) - starts
    counts = np.diff(np.searchsorted(starts, places))
    short = np.minimum(lengths, _LONG_WORD + 1).astype(np.uint8)
    order = np.argsort(_LONG_WORD + 1 - short, kind="stable")
    at, active = starts[order], np.cumsum(np.bincount(short, minlength=_LONG_WORD + 2)[::-1])[::-1]
    crc = np.full(len(order), 0xFFFFFFFF, np.uint32)
    pairs = data.astype(np.uint16)
    pairs[:-1] |= pairs[1:] << np.uint16(8)
    for byte in range(0, _LONG_WORD, 2):
        longer, whole = active[byte + 2], active[byte + 1]
        if not whole:
            break
        own = crc[:longer]
        step = own ^ pairs.take(at[:longer] + byte)
        step &= np.uint32(0xFFFF)
        own >>= np.uint32(16)
        own ^= _CRC_TWO_STEPS.take(step)
        own = crc[longer:whole]
        step = own ^ data.take(at[longer:whole] + byte)
        step &= np.uint32(0xFF)
        own >>= np.uint32(8)
        own ^= _CRC_STEP.take(step)
    crcs = np.empty(len(order), np.uint32)
    crcs[order] = ~crc
    for k in np.flatnonzero(lengths > _LONG_WORD):
        crcs[k] = zlib.crc32(data[starts[k] : starts[k] + lengths[k]])
    return crcs, counts


_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def lower_ascii(text: bytes) -> bytes:
    """A-Z in lower case, all other bytes as they are."""
    return text.translate(_LOWER)


#: White space by its Unicode property, for a character class.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Characters that Python, but not Unicode, counts as white space.
SEPARATORS = re.compile("[\x1c-\x1f]")
