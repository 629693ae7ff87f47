"""Operator 10. Benchmark decontamination: rare words as seeds, then alignment.

Words are runs of letters and digits, lower-cased by Unicode. A document is
contaminated by a benchmark item when the Smith-Waterman score of the item's
words against some passage of the document (``MATCH`` for equal words,
``MISMATCH`` and ``GAP`` otherwise) reaches ``least`` of the score of a full
copy. So edited and partly paraphrased copies count, chance overlaps do not.

Method. Every pair that counts is found; the filters only leave out what
cannot reach the score. A score of ``least`` takes ``equal`` equal words, in a
passage of at most ``span`` words. So of any ``size - equal + j`` words of the
item at least j must be among the equal ones: the item's words are counted
over all documents and the rarest so many become seeds (j is ``SEEDS``, or
fewer for short items). Windows of two spans that step by one span hold every
such passage; a window with j seeds, then with ``equal`` words of the item, is
aligned. The counts only choose cheap seeds, no result depends on them.

Both passes read the documents once and in place; texts are never shuffled.
The seeds are a broadcast table, cut by a hash of the item into blocks of at
most ``BLOCK`` words, so the broadcast has a fixed bound and a larger
benchmark only takes more passes.

Defined cases: null texts and items have no words and match nothing; items
with fewer than ``n`` words match only where all their words stand in a row;
null ids come back as null; rows or items that repeat are judged each by
itself; an empty table or benchmark gives no matches; other columns stay,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import MARKS, Words, slices, table, text_buffers

N, SEEDS, BLOCK = 3, 5, 1_000_000
MATCH, MISMATCH, GAP = 1.0, -0.5, -0.5
LEAST = 0.5
#: Places of seeds that a task holds at once, but for a single document.
PLACES = 1 << 21
#: Cells of passages that are aligned side by side.
ALIGN = 1 << 16


def words_of(column: pa.Array) -> Words:
    return Words(*text_buffers(pc.utf8_lower(column.cast(pa.large_string()))), separators=MARKS)


def blocks_of(items: DataFrame) -> list[DataFrame]:
    """Items in blocks of at most about BLOCK words each."""
    words = F.length("text") / 2 + 1  # no text has more
    total = items.agg(F.coalesce(F.sum(words), F.lit(0.0))).first()[0]
    k = int(total // BLOCK) + 1
    return [items.where(F.pmod(F.xxhash64("nr"), F.lit(k)) == i) for i in range(k)] if k > 1 else [items]


class Seeds:
    """One block of items with its words; the rarest of each item are seeds."""

    def __init__(self, rows: pa.Table, n: int, least: float):
        self.nr = rows.column("nr").to_pylist()
        words = words_of(rows.column("text"))
        self.hash, self.first = words.hash, words.first
        self.keys, self.key_of = np.unique(self.hash, return_inverse=True)
        self.size = np.diff(self.first)
        self.bags: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        #: Score that counts, equal words it takes, most words of its passage.
        self.need = np.where(self.size < n, 1.0, least) * self.size * MATCH
        self.equal = np.ceil(self.need / MATCH - 1e-9).astype(np.int64)
        self.span = self.size + ((self.size * MATCH - self.need) / -max(GAP, MISMATCH)).astype(np.int64) + 1

    def choose(self, times: np.ndarray, most: int = SEEDS) -> None:
        """Take so many of each item's rarest words that any passage that
        counts holds ``least_seeds`` of them."""
        self.least_seeds = np.minimum(most, self.equal)
        row = np.repeat(np.arange(len(self.size)), self.size)
        order = np.lexsort((self.key_of, times[self.key_of], row))
        rank = np.arange(len(row)) - self.first[row]
        order = order[rank < (self.size - self.equal + self.least_seeds)[row]]
        pair, self.seed_times = np.unique(np.stack((self.key_of[order], row[order])), axis=1, return_counts=True)
        self.seed_row = pair[1]
        used, self.seed_first = np.unique(pair[0], return_index=True)
        self.seed_past = np.append(self.seed_first[1:], pair.shape[1])
        self.seed = self.keys[used]

    def item(self, r: int) -> np.ndarray:
        return self.hash[self.first[r]:self.first[r + 1]]

    def common(self, r: int, passage: np.ndarray) -> int:
        """Words that item and passage both hold, each as often as both do;
        ``passage`` are places in ``keys``."""
        if r not in self.bags:
            self.bags[r] = np.unique(self.key_of[self.first[r]:self.first[r + 1]], return_counts=True)
        words, times = self.bags[r]
        to = words.searchsorted(passage)
        to[to == len(words)] = 0
        return int(np.minimum(np.bincount(to[words[to] == passage], minlength=len(words)), times).sum())


def find(sorted_keys: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions in keys, positions in sorted_keys) of common values. A table
    of hashed bits rules out nearly all keys before they are searched."""
    if not len(sorted_keys) or not len(keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    bits = max(16, min(24, len(sorted_keys).bit_length() + 4))
    shift = np.uint64(64 - bits)
    maybe = np.zeros(1 << bits, bool)
    maybe[sorted_keys >> shift] = True
    at = np.flatnonzero(maybe[keys >> shift])
    to = np.minimum(np.searchsorted(sorted_keys, keys[at]), len(sorted_keys) - 1)
    hit = sorted_keys[to] == keys[at]
    return at[hit], to[hit]


def align(item: np.ndarray, passage: np.ndarray) -> tuple[float, int]:
    """Smith-Waterman score and the passage word where the best match ends."""
    best, end = align_all([item], [passage])
    return float(best[0]), int(end[0])


def align_all(items: list[np.ndarray], passages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """``align`` of each item with its passage, side by side in blocks of like lengths."""
    best, end = np.zeros(len(items)), np.zeros(len(items), np.int64)
    size = np.array([(len(p), len(i)) for i, p in zip(items, passages)], np.int64).reshape(-1, 2)
    order, at = np.lexsort((size[:, 1], size[:, 0])), 0
    while at < len(order):
        some = order[at:at + max(1, ALIGN // (int(size[order[at], 0]) + 1))]
        some = some[:max(1, int(np.searchsorted(size[some, 0], 2 * size[some[0], 0], "right")))]
        at += len(some)
        n = int(size[some, 0].max())
        item, text = np.full((len(some), size[some, 1].max()), 1, np.uint64), np.full((len(some), n), 2, np.uint64)  # these differ
        for k, x in enumerate(some.tolist()):
            item[k, :size[x, 1]], text[k, :size[x, 0]] = items[x], passages[x]
        line, new = np.zeros((len(some), n + 1)), np.zeros((len(some), n + 1))
        step = GAP * np.arange(n + 1)
        for x in item.T:
            np.maximum(line[:, :-1] + np.where(text == x[:, None], MATCH, MISMATCH), line[:, 1:] + GAP, out=new[:, 1:])
            np.maximum(new, 0, out=new)
            # gaps along the passage: the best of all earlier cells, less their distance
            line = np.maximum.accumulate(new - step, axis=1) + step
            top = line.max(axis=1)
            more = np.flatnonzero(top > best[some])
            best[some[more]], end[some[more]] = top[more], line[more].argmax(axis=1)
    return best, end


def windows(words: Words, seeds: Seeds) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(first word, item) of the windows that hold enough seeds of the item."""
    at, to = find(seeds.seed, words.hash)
    if not len(at):
        return
    begin = words.first[np.searchsorted(words.first, at, "right") - 1]
    n = seeds.seed_past[to] - seeds.seed_first[to]
    before = np.cumsum(n) - n
    starts = np.flatnonzero(np.append(True, begin[1:] != begin[:-1]))
    starts = starts[np.append(True, np.diff(before[starts] // PLACES) > 0)]  # whole documents
    for a, b in zip(starts, np.append(starts[1:], len(at))):
        m = n[a:b]
        seed = np.repeat(seeds.seed_first[to[a:b]], m) + np.arange(m.sum()) - np.repeat(before[a:b] - before[a], m)
        span, top = seeds.span[seeds.seed_row[seed]], np.repeat(begin[a:b], m)
        step = (np.repeat(at[a:b], m) - top) // span
        # a place lies in the window of its step and in the one before
        start = np.concatenate((top + step * span, (top + (step - 1) * span)[step > 0]))
        seed = np.concatenate((seed, seed[step > 0]))
        size = len(seeds.seed_row)
        held, times = np.unique(start * size + seed, return_counts=True)
        start, seed = held // size, held % size
        size = len(seeds.size)
        held, of = np.unique(start * size + seeds.seed_row[seed], return_inverse=True)
        total = np.bincount(of, np.minimum(times, seeds.seed_times[seed]))
        held = held[total >= seeds.least_seeds[held % size]]
        yield held // size, held % size


def matches(words: Words, seeds: Seeds) -> Iterator[tuple[int, int, float, int]]:
    """(row, item, share of a full copy's score, word where the match ends)."""
    at, keys = find(seeds.keys, words.hash)
    for starts, items in windows(words, seeds):
        rows = np.searchsorted(words.first, starts, "right") - 1
        ends = np.minimum(starts + 2 * seeds.span[items], words.first[rows + 1])
        a, b = np.searchsorted(at, starts), np.searchsorted(at, ends)
        # with fewer equal words than the score needs there is nothing to align
        some = np.flatnonzero(b - a >= seeds.equal[items])
        spans: list[tuple[int, int, int, int]] = []  # row, item, first and past word
        last: dict[tuple[int, int], int] = {}
        for lo, r, hi, row, x, y in zip(*(v[some].tolist() for v in (starts, items, ends, rows, a, b))):
            if seeds.common(r, keys[x:y]) < seeds.equal[r]:
                continue
            k = last.get((row, r))
            if k is not None and lo <= spans[k][3]:
                spans[k] = (row, r, spans[k][2], hi)
            else:
                last[row, r] = len(spans)
                spans.append((row, r, lo, hi))
        score, end = align_all([seeds.item(r) for _, r, _, _ in spans], [words.hash[lo:hi] for _, _, lo, hi in spans])
        best: dict[tuple[int, int], tuple[float, int]] = {}
        for (row, r, lo, _), s, e in zip(spans, score.tolist(), end.tolist()):
            if s >= seeds.need[r] and s > best.get((row, r), (0.0, 0))[0]:
                best[row, r] = s, lo - int(words.first[row]) + e
        for (row, r), (s, e) in best.items():
            yield row, r, s / (float(seeds.size[r]) * MATCH), e


def prepare(docs: DataFrame, items: DataFrame, text_col: str, n: int, least: float) -> Iterator:
    """Broadcast seeds, block by block."""
    spark = docs.sparkSession
    texts = docs.select(F.col(text_col).alias("text"))
    for block in blocks_of(items):
        rows = block.toArrow()
        seeds = Seeds(rows, n, least)
        known = spark.sparkContext.broadcast(seeds.keys)

        def count(batches: Iterator[pa.RecordBatch], known=known) -> Iterator[pa.RecordBatch]:
            keys = known.value
            total = np.zeros(len(keys), np.int64)
            for b in batches:
                for part in slices(b):
                    total += np.bincount(find(keys, words_of(part.column("text")).hash)[1], minlength=len(keys))
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used])], ["nr", "times"])

        times = np.zeros(len(seeds.keys), np.int64)
        counted = texts.mapInArrow(count, "nr int, times long").groupBy("nr").agg(F.sum("times").alias("times")).toArrow()
        times[counted.column("nr").to_numpy()] = counted.column("times").to_numpy()
        seeds.choose(times)
        yield spark.sparkContext.broadcast(seeds)


def numbered(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return items.select(F.col(id_col).cast("long").alias("nr"), F.col(text_col).alias("text"))


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", n: int = N, least: float = LEAST) -> DataFrame:
    """(id, item_id, score, end_word) of every document and item that match."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    found = []
    for seeds in prepare(docs, numbered(items, item_id_col, item_text_col), text_col, n, least):
        def look(batches: Iterator[pa.RecordBatch], seeds=seeds) -> Iterator[pa.RecordBatch]:
            s = seeds.value
            for b in batches:
                for part in slices(b):
                    got = list(matches(words_of(part.column("text")), s))
                    ids = part.column("id").to_pylist()
                    yield pa.RecordBatch.from_arrays([pa.array([ids[x[0]] for x in got], pa.int64()), pa.array([s.nr[x[1]] for x in got], pa.int64()),
                                                      pa.array([x[2] for x in got], pa.float64()), pa.array([x[3] for x in got], pa.int64())], ["id", "item_id", "score", "end_word"])
        found.append(rows.mapInArrow(look, "id long, item_id long, score double, end_word long"))
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def clean_rows(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", n: int = N, least: float = LEAST) -> DataFrame:
    """The table without its contaminated rows."""
    out = docs
    for seeds in prepare(docs, numbered(items, item_id_col, item_text_col), text_col, n, least):
        def stay(batches: Iterator[pa.RecordBatch], seeds=seeds) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for part in slices(b, text_col):
                    ok = np.ones(part.num_rows, bool)
                    ok[[x[0] for x in matches(words_of(part.column(text_col)), seeds.value)]] = False
                    yield part.filter(pa.array(ok))
        out = out.mapInArrow(stay, docs.schema)
    return out


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document against every benchmark item."""
    out = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select(F.col("id").alias("doc_id"), "item_id", "score", "end_word")
