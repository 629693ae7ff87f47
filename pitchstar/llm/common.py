"""Helpers the operators share: tables, lineage cuts, hashing of words.

Word hashing works on the UTF-8 bytes of a slice of rows at once: the text
buffer of an Arrow column is cut into words (maximal runs of bytes other than
space and 0x09-0x0D), and every word gets a 64-bit polynomial hash, mixed.
UTF-8 continuation bytes are never separators, so words of bytes are the words
of characters.
"""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchstar.session import ensure_checkpoint_dir

#: Words are maximal runs of characters outside this class.
WORD = "[^\\x20\\x09-\\x0D]+"
#: Bytes of text that a task hashes at once.
SLICE_BYTES = 1 << 21
#: A null id sorts after every other id.
NULL_ID = 2**63 - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def cut(df: DataFrame, keep: list | None = None) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    The plan is executed once and its lineage ends at files that every executor
    can read, so a lost executor costs a re-read and no recomputation. ``keep``
    collects paths for ``drop``.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/llm-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    if keep is not None:
        keep.append(path)
    return spark.read.schema(df.schema).parquet(path)


def drop(spark: SparkSession, paths: list) -> None:
    """Delete written tables that no later plan reads."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)
    paths.clear()


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop shuffle files of finished plans now; it acts
    when the driver's JVM finds their plans unreachable."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


# ------------------------------------------------------------------ hashing

_MUL = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: For words of letters and digits: every other ASCII byte separates.
MARKS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
#: For lines.
BREAKS = np.zeros(256, bool)
BREAKS[[10, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64."""
    x = x + _MUL[0]
    x = (x ^ (x >> np.uint64(30))) * _MUL[1]
    x = (x ^ (x >> np.uint64(27))) * _MUL[2]
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(256, dtype=np.uint64) + np.uint64(77))
_BASE = np.uint64(0xD6E8FEB86659FD93)
_BASE_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64."""
    got = _powers.get(int(base))
    if got is None or len(got) < n:
        got = np.full(max(n, SLICE_BYTES + 1), base, np.uint64)
        got[0] = 1
        _powers[int(base)] = got = np.cumprod(got, dtype=np.uint64)
    return got[:n]


def prefix_hash(values: np.ndarray, base: np.uint64) -> np.ndarray:
    """n + 1 prefix sums of values[i] * base ** i."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(base, len(values)), out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray, base=_BASE, inverse=_BASE_INV) -> np.ndarray:
    """Hash of values[start:end], whatever stands around them."""
    return mix((prefix[end] - prefix[start]) * powers(inverse, len(prefix))[start] + (end - start).astype(np.uint64))


_BASE2 = np.uint64(0xA0761D6478BD642F)
_BASE2_INV = np.uint64(pow(int(_BASE2), -1, 1 << 64))


def second_hash(prefix2: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """As span_hash over prefix_hash(values, BASE2): independent of it."""
    return span_hash(prefix2, start, end, _BASE2, _BASE2_INV)


BASE, BASE2 = _BASE, _BASE2


class Words:
    """The words of some rows: their hash, their row and where they stand.

    ``first[r]:first[r + 1]`` are the words of row ``r``.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False, separators: np.ndarray = _SPACE):
        self.data = _LOWER[data] if lower else data
        self.offsets = offsets
        n = len(data)
        space = separators[data]
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        before, after = np.ones(n, bool), np.ones(n, bool)
        before[1:], after[:-1] = space[:-1], space[1:]
        word = ~space
        self.start = np.flatnonzero(word & (before | edge[:n]))
        self.end = np.flatnonzero(word & (after | edge[1:])) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.hash = span_hash(prefix_hash(_BYTE[self.data], _BASE), self.start, self.end)

    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def at(self, i: int) -> bytes:
        return self.data[self.start[i]:self.end[i]].tobytes()


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):  # no chunk or several
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_string())
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def slices(batch, column: str = "text", most: int = SLICE_BYTES) -> Iterator:
    """Cut a batch or table into runs of rows with about ``most`` bytes of text."""
    _, offsets = text_buffers(batch.column(column))
    at, n = 0, batch.num_rows
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def ids_of(column) -> np.ndarray:
    """Long ids; a null id counts as the largest."""
    return np.asarray(column.cast(pa.int64()).fill_null(NULL_ID).to_numpy())


def total_bytes(df: DataFrame, column: str = "text") -> int:
    return df.agg(F.coalesce(F.sum(F.octet_length(column)), F.lit(0))).first()[0]


# --------------------------------------------------------------- components

def components(links: DataFrame) -> DataFrame:
    """(id, component) of undirected links (a, b); component is the smallest id
    that can be reached. Large-star and small-star steps alternate, each a
    group-by with map-side minimum, until no link changes; paths shrink by
    half or more in a round.
    """
    spark = links.sparkSession
    old: list = []
    edges = cut(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), old)
    seen = None
    while True:
        # large star: neighbours above u go to the smallest neighbour of u (or u)
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        # small star: neighbours below u, and u, go to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        new: list = []
        edges = cut(small, new)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        drop(spark, old)
        old = new
        if tuple(now) == seen:
            break
        seen = tuple(now)
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
