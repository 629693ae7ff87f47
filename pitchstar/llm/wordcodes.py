"""Texts as slices of word codes, shared by the counting and scoring operators.

A slice is a run of documents of about ``SLICE`` bytes of text. Its words are
coded exactly, by an Arrow dictionary of the slice's own distinct words, so a
word's text is stored and shuffled once for each slice and not once for each
occurrence. ``coded`` writes two kinds of rows:

* kind "word": slice, code, word, n (and ``extra`` counts)
* kind "text": slice, codes and whatever the operator keeps for its documents

A slice never holds more than the one document that overflows it, so both the
rows of a slice and its arrays are bounded by ``SLICE`` and the longest document.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pitchstar.session import ensure_checkpoint_dir

SLICE = 8 << 20
#: Bytes of a slice that are looked at together; a document is never parted.
LOOK = 1 << 20


def words_of(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The spans of a UTF-8 buffer as strings; spans don't overlap and stand in
    order, and no byte outside them is looked at."""
    size = end - start
    inside = np.zeros(len(data) + 1, np.int8)
    inside[start] += 1
    inside[end] -= 1
    bytes_ = data[np.cumsum(inside[:-1], dtype=np.int8).view(bool)]
    offsets = np.zeros(len(start) + 1, np.int64)
    np.cumsum(size, out=offsets[1:])
    return pa.Array.from_buffers(pa.large_string(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(bytes_))])


def code_words(parts: list) -> tuple[np.ndarray, pa.Array]:
    """(code of each word, the distinct words) of some arrays of words."""
    coded = pa.chunked_array(parts, pa.large_string()).dictionary_encode()
    if not coded.num_chunks:
        return np.zeros(0, np.int64), pa.array([], pa.large_string())
    # all chunks share one dictionary
    return np.concatenate([c.indices.to_numpy() for c in coded.chunks]).astype(np.int64), coded.chunk(coded.num_chunks - 1).dictionary


def spans(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the maximal runs of bytes that are no separators; rows,
    given by their offsets, end a run."""
    n = len(data)
    space = separator[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before, after = np.ones(n, bool), np.ones(n, bool)
    before[1:], after[:-1] = space[:-1], space[1:]
    word = ~space
    return np.flatnonzero(word & (before | edge[:n])), np.flatnonzero(word & (after | edge[1:])) + 1


def pack(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).tobytes()


def unpack(value: bytes, dtype=np.int64) -> np.ndarray:
    return np.frombuffer(value, dtype)


def squeeze(values: np.ndarray) -> bytes:
    """As ``pack``, compressed: first bytes of all values, then second bytes and so on."""
    flat = np.ascontiguousarray(values).reshape(-1)
    planes = flat.view(np.uint8).reshape(-1, flat.itemsize).T
    return pa.compress(np.ascontiguousarray(planes).reshape(-1), codec="zstd", asbytes=True)


def expand(value, dtype=np.int64) -> np.ndarray:
    raw = pa.CompressedInputStream(pa.BufferReader(value), "zstd").read()
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, -1).T).reshape(-1).view(dtype)


def written(df: DataFrame, by: str, keep: list | None = None) -> DataFrame:
    """As ``common.cut``, with a folder for each value of ``by``: a plan that
    wants one kind of rows opens only its files."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/llm-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").partitionBy(by).parquet(path)
    if keep is not None:
        keep.append(path)
    return spark.read.schema(df.schema).parquet(path)
