"""Operator 5. Removal of repeated word windows across a corpus, by recompression.

A word goes when some window of ``window`` consecutive words that covers it has
the same words as a window that starts earlier (smaller id, or same id and
earlier start). Windows are judged on the input.

Method. Recompression names runs of equal words, then, round after round,
pairs of neighbours whose left symbol falls in one class of names and whose
right symbol falls in the other. A name is a 64-bit hash of what it stands
for, so it is global without a dictionary. Whether two symbols are joined
depends on them alone, so for every symbol of the last round we know the words
it depends on: equal windows hold equal symbols wherever those words lie
inside the window ("interior" symbols). The steps are

1. every chunk of documents sends the names (with their context) of its
   symbols to the bucket of the name; the bucket answers with one bit each:
   does the name occur elsewhere;
2. windows with an unshared interior symbol cannot repeat. All others are
   verified: the chunk sends the 96-bit hash of the whole window with its
   position to a bucket, which answers whether an earlier equal one exists;
3. the chunk removes the words those windows cover.

The texts are shuffled once (the three uses share one exchange); names and
windows travel as packed arrays, 6 and 16 bytes each, deduplicated within a
chunk, so that a passage held by a third of all documents weighs at most one
entry per chunk. Answers are bit masks. Nothing is collected or broadcast, and
no row of one bucket is ever paired with another.

Defined cases: a null text has no words and gives an empty kept text; a null id
sorts after all others and is returned as null; rows that share an id are one
document for the order, so equal positions do not remove each other; texts of
fewer than ``window`` words are kept whole; an empty table gives no rows.
Other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BASE, BASE2, Words, ids_of, mix, partitions, prefix_hash, second_hash, span_hash, table, text_buffers, total_bytes
from .common import _SPACE as SPACES

ROUNDS = 4
#: Text in a chunk: more of it per chunk means fewer, fuller messages.
CHUNK_BYTES = (1 << 20, 8 << 20)
BUCKET_BYTES = 24 << 20
ONE = np.uint64(1)


# ------------------------------------------------------------- recompression

def symbols(words: Words, window: int, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """(from, to) of the words that the last round's symbols depend on, for
    those that fit into a window."""
    n = len(words.hash)
    doc = words.row()
    name = words.hash
    # runs of equal words become one symbol; where a run ends depends on both neighbours
    new = np.ones(n, bool)
    new[1:] = (name[1:] != name[:-1]) | (doc[1:] != doc[:-1])
    start = np.flatnonzero(new)
    end = np.append(start[1:], n)
    name = np.where(end - start > 1, mix(name[start] + (end - start).astype(np.uint64)), name[start])
    doc, low, high = doc[start], start - 1, end + 1
    for r in range(rounds):
        m = len(name)
        if m < 2:
            break
        left = (mix(name + np.uint64(r)) >> np.uint64(63)).astype(bool)
        same = doc[1:] == doc[:-1]
        pair = np.zeros(m, bool)
        pair[:-1] = left[:-1] & ~left[1:] & same
        joined = np.zeros(m, bool)  # right halves
        joined[1:] = pair[:-1]
        # a symbol left alone looked at one neighbour, which might have taken it
        reach_low, reach_high = low.copy(), high.copy()
        alone = ~pair & ~joined
        to_right = np.flatnonzero(alone[:-1] & left[:-1] & same)
        reach_high[to_right] = np.maximum(high[to_right], high[to_right + 1])
        to_left = np.flatnonzero(alone[1:] & ~left[1:] & same) + 1
        reach_low[to_left] = np.minimum(low[to_left], low[to_left - 1])
        p = np.flatnonzero(pair)
        reach_low[p] = np.minimum(low[p], low[p + 1])
        reach_high[p] = np.maximum(high[p], high[p + 1])
        name = name.copy()
        name[p] = mix(name[p] * np.uint64(3) + mix(name[p + 1]))
        keep = ~joined
        name, doc, low, high = name[keep], doc[keep], reach_low[keep], reach_high[keep]
    # dependence that leaves the document never lies inside a window
    fits = (high - low <= window) & (low >= words.first[doc]) & (high <= words.first[doc + 1])
    low, high = low[fits], high[fits]
    if len(low):
        fresh = np.ones(len(low), bool)
        fresh[1:] = (low[1:] != low[:-1]) | (high[1:] != high[:-1])
        low, high = low[fresh], high[fresh]
    return low, high


class Chunk:
    """One chunk of documents in the order of their ids, with its symbols."""

    separators = SPACES

    def __init__(self, rows: pa.Table, window: int, buckets: int):
        ids = ids_of(rows.column("id"))
        order = np.argsort(ids, kind="stable")
        rows = rows.take(pa.array(order))
        self.ids, self.window, self.buckets = ids[order], window, buckets
        self.null = np.asarray(rows.column("id").is_null())
        self.rest = rows.column("rest") if "rest" in rows.schema.names else None
        self.words = Words(*text_buffers(rows.column("text")), separators=self.separators)
        self.prefix = prefix_hash(self.words.hash, BASE)
        self.low, self.high = self.interior()
        h = span_hash(self.prefix, self.low, self.high)
        self.keys, self.key_of, self.times = np.unique(h, return_inverse=True, return_counts=True)

    def interior(self) -> tuple[np.ndarray, np.ndarray]:
        """[from, to) of unit spans that every equal window holds as well."""
        return symbols(self.words, self.window)

    def kept(self, row: int, gone: np.ndarray) -> bytes:
        w = self.words
        words = w.data[w.offsets[row]:w.offsets[row + 1]].tobytes().split()
        return b" ".join(words if not gone.any() else [x for x, out in zip(words, gone.tolist()) if not out])

    def messages(self) -> Iterator[tuple[int, bytes]]:
        """(bucket, sorted 48-bit names)."""
        for b, at in by_bucket(self.keys, self.buckets):
            yield b, pack48(self.keys[at])

    def windows(self, answers: dict[int, bytes]) -> None:
        """Find the windows that no unshared symbol rules out."""
        shared = self.times > 1
        for b, at in by_bucket(self.keys, self.buckets):
            if b in answers:
                shared[at] |= bits(answers[b], len(at))
        w = self.window
        at = self.possible(shared[self.key_of])
        h1 = span_hash(self.prefix, at, at + w)
        h2 = second_hash(prefix_hash(self.words.hash, BASE2), at, at + w) >> np.uint64(32)
        order = np.lexsort((h2, h1))  # stable: equal windows stay in the order of their positions
        at, h1, h2 = at[order], h1[order], h2[order]
        head = np.ones(len(at), bool)
        head[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        self.at, self.h1, self.h2, self.head = at, h1, h2, np.flatnonzero(head)
        self.group = np.cumsum(head) - 1
        first = self.words.first
        doc = np.searchsorted(first, at, "right") - 1
        self.doc, self.pos = doc, at - first[doc]

    def possible(self, shared: np.ndarray) -> np.ndarray:
        """Starts of the windows without an unshared interior symbol."""
        w, n, first = self.window, len(self.words.hash), self.words.first
        mark = np.zeros(n + 1, np.int32)
        np.add.at(mark, np.maximum(self.high[~shared] - w, 0), 1)
        np.add.at(mark, self.low[~shared] + 1, -1)
        fits = np.arange(n) + w <= np.repeat(first[1:], np.diff(first))
        return np.flatnonzero((np.cumsum(mark[:n]) == 0) & fits)

    def window_messages(self) -> Iterator[tuple[int, bytes]]:
        """(bucket, arrays): distinct windows by position, with hashes."""
        f = self.head
        for b, at in by_bucket(self.h1[f], self.buckets):
            i = f[at]
            i = i[np.argsort(self.at[i], kind="stable")]
            ids, counts = np.unique(self.ids[self.doc[i]], return_counts=True)
            yield b, b"".join((np.array([len(ids), len(i)], np.int64).tobytes(), ids.tobytes(), counts.astype(np.uint32).tobytes(),
                               self.pos[i].astype(np.uint32).tobytes(), self.h1[i].tobytes(), self.h2[i].astype(np.uint32).tobytes()))

    def removed(self, answers: dict[int, bytes]) -> np.ndarray:
        """Flags of the words that go."""
        f = self.head
        later = np.zeros(len(f), bool)
        for b, at in by_bucket(self.h1[f], self.buckets):
            if b in answers:
                by_place = at[np.argsort(self.at[f[at]], kind="stable")]
                later[by_place] = bits(answers[b], len(at))
        lead = f[self.group]
        own = (self.ids[self.doc] > self.ids[self.doc[lead]]) | (self.pos > self.pos[lead])
        at = self.at[later[self.group] | own] if len(f) else self.at
        mark = np.zeros(len(self.words.hash) + 1, np.int32)
        np.add.at(mark, at, 1)
        np.add.at(mark, at + self.window, -1)
        return np.cumsum(mark[:-1]) > 0


def by_bucket(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Positions of sorted keys by bucket, ascending in each."""
    if not len(keys):
        return
    b = (mix(keys) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(b, kind="stable")
    cuts = np.flatnonzero(np.diff(b[order])) + 1
    for at in np.split(order, cuts):
        yield int(b[at[0]]), at


def pack48(keys: np.ndarray) -> bytes:
    """The top 48 bits of each; a name that two contents share by chance only
    costs the verification of a few windows."""
    return keys.view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()


def unpack48(blob: bytes) -> np.ndarray:
    out = np.zeros((len(blob) // 6, 8), np.uint8)
    out[:, 2:] = np.frombuffer(blob, np.uint8).reshape(-1, 6)
    return out.reshape(-1).view(np.uint64)


def bits(blob: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(blob, np.uint8), count=n).astype(bool)


# ------------------------------------------------------------- bucket answers

ANSWER = "chunk long, kind int, bucket int, mask binary"


def _masks(kind: int, bucket: int, chunks: list, flags: np.ndarray, sizes: list[int]) -> pa.Table:
    out, at = [], 0
    for c, n in zip(chunks, sizes):
        own = flags[at:at + n]
        at += n
        if own.any():
            out.append((c, kind, bucket, np.packbits(own).tobytes()))
    cols = list(zip(*out)) or [[], [], [], []]
    return pa.table({"chunk": pa.array(cols[0], pa.int64()), "kind": pa.array(cols[1], pa.int32()),
                     "bucket": pa.array(cols[2], pa.int32()), "mask": pa.array(cols[3], pa.binary())})


def _shared(rows: pa.Table) -> pa.Table:
    """Which names of a bucket occur in more than one chunk or place."""
    keys = [unpack48(x) for x in rows.column("body").to_pylist()]
    all_keys = np.concatenate(keys)
    order = np.argsort(all_keys, kind="stable")
    k = all_keys[order]
    twin = np.zeros(len(k), bool)
    twin[1:] = k[1:] == k[:-1]
    twin[:-1] |= twin[1:]
    flags = np.empty(len(k), bool)
    flags[order] = twin
    return _masks(0, rows.column("bucket")[0].as_py(), rows.column("chunk").to_pylist(), flags, [len(x) for x in keys])


def _later(rows: pa.Table) -> pa.Table:
    """Which windows of a bucket have an equal one that starts earlier."""
    parts, sizes = [], []
    for x in rows.column("body").to_pylist():
        n_ids, n = np.frombuffer(x, np.int64, 2)
        at = 16
        got = []
        for dtype, count in ((np.int64, n_ids), (np.uint32, n_ids), (np.uint32, n), (np.uint64, n), (np.uint32, n)):
            got.append(np.frombuffer(x, dtype, count, at))
            at += count * np.dtype(dtype).itemsize
        parts.append((np.repeat(got[0], got[1]), *got[2:]))
        sizes.append(int(n))
    ids, pos, h1, h2 = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((pos, ids, h2, h1))
    a, b = order[1:], order[:-1]
    head = np.ones(len(order), bool)
    head[1:] = (h1[a] != h1[b]) | (h2[a] != h2[b])
    lead = order[np.flatnonzero(head)][np.cumsum(head) - 1]
    flags = np.empty(len(order), bool)
    flags[order] = (ids[order] != ids[lead]) | (pos[order] != pos[lead])
    return _masks(1, rows.column("bucket")[0].as_py(), rows.column("chunk").to_pylist(), flags, sizes)


def _by_kind(answers: pa.Table) -> list[dict[int, bytes]]:
    out: list[dict[int, bytes]] = [{}, {}]
    for k, b, m in zip(*(answers.column(c).to_pylist() for c in ("kind", "bucket", "mask"))):
        out[k][b] = m
    return out


# ------------------------------------------------------------------ operator

def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20) -> DataFrame:
    """Return (id, n_words, n_removed, kept_text, removed): kept words joined by
    one space, and the removed [from, to) word spans of each document."""
    return run(docs, Chunk, id_col, text_col, window).select("id", F.col("n_units").alias("n_words"), "n_removed", "kept_text", "removed")


def run(docs: DataFrame, kind: type, id_col: str, text_col: str, window: int, keep: bool = False) -> DataFrame:
    """(id, n_units, n_removed, kept_text, removed), and with ``keep`` the row
    itself without its text as the struct ``rest``."""
    spark = docs.sparkSession
    own = [F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")]
    others = [c for c in docs.columns if c != text_col]
    docs = docs.select(*own, *([F.struct(*others).alias("rest")] if keep else []))
    size = total_bytes(docs)
    per_chunk = min(max(size // 512, CHUNK_BYTES[0]), CHUNK_BYTES[1])
    chunks = size // per_chunk + 1
    # 16 bytes a window, one window a word, a word in 6 bytes: the most a bucket can get
    buckets = max(partitions(spark), size * 16 // 6 // BUCKET_BYTES)
    chunk = F.pmod(F.xxhash64("id", "text"), F.lit(chunks)).alias("chunk")
    texts = docs.select(*docs.columns, chunk).repartition(partitions(spark), "chunk")

    def names(rows: pa.Table) -> pa.Table:
        return _messages(rows, kind(rows, window, buckets).messages())

    def whole(rows: pa.Table, answers: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return _messages(rows, iter(()))
        c = kind(rows, window, buckets)
        c.windows(_by_kind(answers)[0])
        return _messages(rows, c.window_messages())

    def finish(rows: pa.Table, answers: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return _result(None, None, rows.schema.field("rest").type if keep else None)
        c = kind(rows, window, buckets)
        got = _by_kind(answers)
        c.windows(got[0])
        return _result(c, c.removed(got[1]), rows.schema.field("rest").type if keep else None)

    message = "bucket int, chunk long, body binary"
    shared = texts.groupBy("chunk").applyInArrow(names, message).groupBy("bucket").applyInArrow(_shared, ANSWER)
    later = (texts.groupBy("chunk").cogroup(shared.groupBy("chunk")).applyInArrow(whole, message)
             .groupBy("bucket").applyInArrow(_later, ANSWER))
    out = T.StructType.fromDDL("id long, n_units long, n_removed long, kept_text string, removed array<struct<start:long,end:long>>")
    if keep:
        out = out.add("rest", docs.schema["rest"].dataType)
    return texts.groupBy("chunk").cogroup(shared.unionByName(later).groupBy("chunk")).applyInArrow(finish, out)


SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])


def _messages(rows: pa.Table, messages: Iterator[tuple[int, bytes]]) -> pa.Table:
    got = list(messages)
    return pa.table({"bucket": pa.array([b for b, _ in got], pa.int32()),
                     "chunk": pa.array([rows.column("chunk")[0].as_py()] * len(got) if got else [], pa.int64()),
                     "body": pa.array([x for _, x in got], pa.binary())})


def _result(c: Chunk | None, gone: np.ndarray | None, rest: pa.DataType | None) -> pa.Table:
    out = []
    for r in range(len(c.ids) if c else 0):
        a, b = int(c.words.first[r]), int(c.words.first[r + 1])
        own = gone[a:b]
        edges = np.flatnonzero(np.diff(np.concatenate(([False], own, [False])).astype(np.int8))).tolist()
        out.append((None if c.null[r] else int(c.ids[r]), b - a, int(own.sum()), c.kept(r, own), [{"start": x, "end": y} for x, y in zip(edges[::2], edges[1::2])]))
    ids, n, k, texts, spans = zip(*out) if out else ((),) * 5
    cols = {"id": pa.array(ids, pa.int64()), "n_units": pa.array(n, pa.int64()), "n_removed": pa.array(k, pa.int64()),
            "kept_text": pa.array(texts, pa.binary()).cast(pa.string()), "removed": pa.array(spans, pa.list_(SPAN))}
    if rest is not None:
        cols["rest"] = c.rest if c else pa.array([], rest)
    return pa.table(cols)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of 20 words over every whole text of documents."""
    out = remove_repeats(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


OP5_SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), p AS (
  SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20
), h AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 19], ' ')) AS k FROM p
), f AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS r FROM h
), gone AS (
  SELECT doc_id, list(DISTINCT j) AS gone FROM (SELECT doc_id, unnest(range(i, i + 20)) AS j FROM f WHERE r > 1) GROUP BY doc_id
), t AS (
  SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS j FROM d
), kept AS (
  SELECT t.doc_id, string_agg(t.w[t.j], ' ' ORDER BY t.j) AS s FROM t
  LEFT JOIN (SELECT doc_id, unnest(gone) AS j FROM gone) g ON g.doc_id = t.doc_id AND g.j = t.j
  WHERE g.j IS NULL GROUP BY t.doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed, sha256(coalesce(s, '')) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
