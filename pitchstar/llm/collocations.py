"""Operator 11. Phrase collocations by direct-address pair tiles.

Texts, A-Z lower-cased, are split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and those
into words ``[^\\x20\\x09]+``. Within a language n counts all words and f(phrase)
all contiguous occurrences inside pieces, overlaps included. Candidates are the
phrases of 2 to ``longest`` words with f >= ``least``. A cut after k words gives
floor(1000 * f(phrase) * n / (f(first part) * f(rest))); the lowest cut counts,
ties to the smallest k. A candidate goes when some longer candidate holds its
words contiguously with 100 * f(longer) >= ``within`` * f. The best ``top`` of each
language stay, by score, f (both descending) and phrase.

Method. Words are counted exactly and the frequent ones (f >= least; no other word
can stand in a candidate) get ids by frequency, so that small ids are frequent.
Each slice of texts becomes a stream of ids. The pairs of neighbours in a stream
are split into tiles of ``TILE`` x ``TILE`` ids: a tile with many pairs is counted by
one dense bincount, its cell being the pair's address; the pairs of thin tiles by
sorting coordinates. Spark adds up the cells of all slices. The pairs that may be
frequent are ranked by frequency again and their ranks form the next stream, in which
neighbours overlap by all but one word: a pair of m-word phrases is one of m + 1
words. So the same step, repeated, counts phrases of any length.

Which pairs may be frequent is told before any cell is sent: every task adds its
cells up in hashed buckets, and a pair whose bucket stays below ``least`` in the whole
corpus is neither sent nor ranked. Ranks are a slice's own and cells carry the ids of
all their words, so a slice never asks back for the ids of its pairs. Buckets decide
about work only; what a bucket lets through is counted exactly. There are four buckets
for every ``least`` words of the corpus, 2 ** ``BITS`` at most, which bounds the filter
that tasks get (8 MB); a larger corpus sends more cells. f of all first and last parts is joined
from level to level among frequent phrases.

Counts are added before every shuffle: a frequent word is one row for each task, a
frequent pair one cell. The cells of a task, at most those of its last slice and
``GATHER`` more at a time, are dealt by hash to blocks, about one for each 2 ** ``CELLS`` words
of the corpus, and one block of a task is a row; a block's rows meet in one task and
only frequent pairs leave it as rows. A cell stands for one or more words of its
slice, so no level has more cells than the corpus has words.
Streams, cells and buckets are moved compressed; a level's files go when the next has
been written. Ids of words come from a range-partitioned numbering; dictionaries are joined,
not collected, and only words whose bucket holds a frequent word are sent to that join.

Defined cases: null language: ``und``; null text: empty; an empty table gives an
empty result; repeated rows count each; scores are exact (decimals of 38 digits, so
1000 * f * n must stay below 10 ** 38); other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitchstar.operators.numbering import number_rows

from .common import cut, drop, mix, release, slices, table, text_buffers
from .wordcodes import LOOK, SLICE, code_words, expand, pack, spans, squeeze, unpack, words_of, written

TILE = 256
#: Pairs that make a tile dense.
DENSE = TILE * TILE // 4
#: Text held over all languages while slices fill.
HELD = 4 * SLICE
#: The largest filter has 2 ** BITS buckets, sent in blocks of BLOCK.
BITS, BLOCK = 26, 1 << 16
#: Tasks whose buckets are added up at once.
PARTS = 256
#: Words of the corpus, as a power of 2, for each block of cells.
CELLS = 21
#: Cells that a task adds up before it sends them.
GATHER = 1 << 20

_MARK = np.zeros(256, bool)
_MARK[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
_SEPARATOR = _MARK.copy()
_SEPARATOR[[9, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_CODED = pa.schema([("kind", pa.string()), ("slice", pa.int64()), ("lang", pa.string()), ("code", pa.int32()),
                    ("word", pa.string()), ("n", pa.int64()), ("stream", pa.binary())])


# ------------------------------------------------------------------ slices

def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words, and whether each is the last of its piece."""
    data, offsets = text_buffers(texts)
    data = _LOWER[data]
    start, end = spans(data, offsets, _SEPARATOR)
    marks = np.zeros(len(data) + 1, np.int32)
    np.cumsum(_MARK[data], out=marks[1:], dtype=np.int32)
    last = np.ones(len(start), bool)
    last[:-1] = (np.diff(np.searchsorted(offsets, start, "right")) > 0) | (marks[start[1:]] > marks[end[:-1]])
    return words_of(data, start, end), last


def _code_slice(number: int, lang: str, texts: list):
    """One row for each distinct word, one for the stream of codes + 1; 0 ends a piece."""
    looked = [_words(part.column("text")) for t in texts for part in slices(pa.table({"text": t}), most=LOOK)]
    codes, words = code_words([w for w, _ in looked])
    if not len(codes):
        return
    ends = np.concatenate([last for _, last in looked])
    del looked
    stream = np.full(len(codes) + int(ends.sum()), -1, np.int32)
    stream[np.arange(len(codes)) + np.cumsum(ends) - ends] = codes
    m = len(words)
    fixed = lambda value, type_, k: pa.array([value], type_).take(pa.array(np.zeros(k, np.int64)))
    yield pa.RecordBatch.from_arrays(
        [fixed("word", pa.string(), m), fixed(number, pa.int64(), m), fixed(lang, pa.string(), m), pa.array(np.arange(m), pa.int32()),
         words.cast(pa.string()), pa.array(np.bincount(codes, minlength=m), pa.int64()), pa.nulls(m, pa.binary())], schema=_CODED)
    yield pa.RecordBatch.from_pylist([{"kind": "text", "slice": number, "lang": lang, "stream": squeeze(stream + 1)}], schema=_CODED)


def code_texts(batches):
    """Fill one slice for each language of a partition."""
    first, made = TaskContext.get().partitionId() << 32, 0
    texts: dict[str, list] = {}
    size: dict[str, int] = {}

    def flush(lang):
        nonlocal made
        made += 1
        size.pop(lang)
        yield from _code_slice(first + made, lang, texts.pop(lang))

    for batch in batches:
        for part in slices(batch, most=SLICE):
            for lang in pc.unique(part.column("lang")).to_pylist():
                own = part.filter(pc.equal(part.column("lang"), lang)).column("text").cast(pa.large_string())
                texts.setdefault(lang, []).append(own)
                size[lang] = size.get(lang, 0) + (pc.sum(pc.binary_length(own)).as_py() or 0)
                if size[lang] >= SLICE:
                    yield from flush(lang)
            while sum(size.values()) > HELD:
                yield from flush(max(size, key=size.get))
    for lang in list(texts):
        yield from flush(lang)


# ------------------------------------------------------------------- pairs

def count_pairs(stream: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(x, y, n) of the neighbours in a stream, 0 being no id."""
    ids, place = np.unique(stream, return_inverse=True)
    both = (stream[:-1] > 0) & (stream[1:] > 0)
    x, y = place[:-1][both], place[1:][both]
    wide = -(-len(ids) // TILE)
    tile = (x // TILE) * wide + y // TILE
    if wide * wide <= 1 << 20:
        tiles, size = np.arange(wide * wide), np.bincount(tile, minlength=wide * wide)
        of = tile
    else:
        tiles, of, size = np.unique(tile, return_inverse=True, return_counts=True)
    dense = size >= DENSE
    xs, ys, ns = [], [], []
    if dense.any():
        slot = np.cumsum(dense) - 1
        at = dense[of]
        cells = np.bincount(slot[of[at]] * TILE * TILE + (x[at] % TILE) * TILE + y[at] % TILE)
        full = np.flatnonzero(cells)
        own = tiles[dense][full // (TILE * TILE)]
        xs.append(own // wide * TILE + full // TILE % TILE)
        ys.append(own % wide * TILE + full % TILE)
        ns.append(cells[full])
        x, y = x[~at], y[~at]
    key = np.sort(x * len(ids) + y)
    new = np.flatnonzero(np.diff(key, prepend=-1))
    xs.append(key[new] // max(len(ids), 1))
    ys.append(key[new] % max(len(ids), 1))
    ns.append(np.diff(new, append=len(key)))
    return ids[np.concatenate(xs)], ids[np.concatenate(ys)], np.concatenate(ns)


def tight(stream: np.ndarray) -> np.ndarray:
    """Without ids that have no neighbour, runs parted by one 0."""
    some = np.concatenate([[False], stream > 0, [False]])
    keep = some[1:-1] & (some[:-2] | some[2:])
    gap = np.concatenate([[False], keep[:-1]]) & ~keep
    out = np.where(keep, stream, 0)
    return out[keep | gap]


def cells(stream: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(x, y, n) of the pairs of a stream and the word ids of each; ``words[i - 1]``
    are those of id i."""
    x, y, n = count_pairs(stream)
    return x, y, n, np.concatenate([words[x - 1], words[y - 1][:, -1:]], axis=1)


def buckets(ids: np.ndarray, bits: int) -> np.ndarray:
    h = np.zeros(len(ids), np.uint64)
    for column in ids.T:
        h = mix(h + column.astype(np.uint64))
    return (h >> np.uint64(64 - bits)).astype(np.int64)


def _rows(batches, size: int):
    """(slice, stream, words) of the rows of a level of ``size``-word phrases."""
    for batch in batches:
        for number, stream, words in zip(batch.column("slice").to_pylist(), batch.column("stream"), batch.column("words")):
            yield number, expand(stream.as_buffer(), np.int32).astype(np.int64), expand(words.as_buffer()).reshape(-1, size)


def tally(size: int, bits: int, least: int):
    """Cells of a task added up in buckets; counts stop at ``least``."""
    def run(batches):
        total = np.zeros(1 << bits, np.min_scalar_type(least))
        for _, stream, words in _rows(batches, size):
            _, _, n, ids = cells(stream, words)
            at = buckets(ids, bits)
            order = np.argsort(at)
            at, n = at[order], n[order]
            if len(at):
                new = np.flatnonzero(np.diff(at, prepend=-1))
                total[at[new]] = np.minimum(total[at[new]] + np.add.reduceat(n, new), least)
        wide = min(BLOCK, 1 << bits)
        part = TaskContext.get().partitionId() // PARTS
        for block, counts in enumerate(total.reshape(-1, wide)):
            if counts.any():
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([part], pa.int32()), *_filled(counts)], schema=_TALLY)
    return run


_TALLY = pa.schema([("block", pa.int32()), ("part", pa.int32()), ("gaps", pa.binary()), ("counts", pa.binary())])


def _filled(counts: np.ndarray) -> list:
    """The buckets of a block that are not empty, each by its distance from the one before, and their counts."""
    at = np.flatnonzero(counts)
    return [pa.array([squeeze(np.diff(at, prepend=0).astype(np.uint16))], pa.binary()), pa.array([squeeze(counts[at])], pa.binary())]


def added(least: int, wide: int, last: bool):
    """One block of some tasks; at last one bit for each of its ``wide`` buckets that reaches ``least``."""
    def run(rows: pa.Table) -> pa.Table:
        kind = np.min_scalar_type(least)
        total = np.zeros(wide, np.int64)
        for gaps, counts in zip(rows.column("gaps"), rows.column("counts")):
            at = np.cumsum(expand(gaps.as_buffer(), np.uint16), dtype=np.int64)
            total[at] = np.minimum(total[at] + expand(counts.as_buffer(), kind), least)
        made = [pa.array([b""], pa.binary()), pa.array([pack(np.packbits(total >= least, bitorder="little"))], pa.binary())] if last else _filled(total.astype(kind))
        return pa.Table.from_arrays([rows.column("block")[:1], rows.column("part")[:1], *made], schema=_TALLY)
    return run


def passing(level: DataFrame, size: int, bits: int, least: int) -> np.ndarray:
    """Buckets, as bits, that hold ``least`` pairs of the level; 2 ** bits / 8 bytes."""
    kind = "block int, part int, gaps binary, counts binary"
    wide = min(BLOCK, 1 << bits)
    sums = level.mapInArrow(tally(size, bits, least), kind)
    if level.rdd.getNumPartitions() > PARTS:
        sums = sums.groupBy("block", "part").applyInArrow(added(least, wide, False), kind)
    out = np.zeros((1 << bits) // 8, np.uint8)
    for block, _, _, got in sums.groupBy("block").applyInArrow(added(least, wide, True), kind).collect():
        out[block * wide // 8:(block + 1) * wide // 8] = np.frombuffer(got, np.uint8)
    return out


def frequent(level: DataFrame, at, bits: int) -> np.ndarray:
    """Buckets, as bits, of the rows of a level; ``at`` counts them from 1."""
    out = np.zeros((1 << bits) // 8, np.uint8)
    wide = 1 << 12  # bytes of a bitmap; there may be less buckets than its bits
    marks = level.select(at.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("m"))
    for b, m in marks.collect():
        out[(b - 1) * wide:b * wide] = np.frombuffer(m, np.uint8)[:len(out)]
    return out


def sought(seen: np.ndarray):
    """Rows whose bucket ``at``, counted from 1, is marked; without that column."""
    def run(batches):
        for batch in batches:
            keep = pa.array(_marked(batch.column("at").to_numpy() - 1, seen))
            yield batch.select([c for c in batch.schema.names if c != "at"]).filter(keep)
    return run


def _passed(ids: np.ndarray, bits: int, seen: np.ndarray) -> np.ndarray:
    return _marked(buckets(ids, bits), seen)


def _marked(at: np.ndarray, seen: np.ndarray) -> np.ndarray:
    return (seen[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def _sum_cells(parts: list) -> np.ndarray:
    """Cells, by column with n last, in the order of their ids; equal ones added up."""
    cells_ = np.concatenate(parts, axis=1)
    cells_ = cells_[:, np.lexsort(cells_[-2::-1])]
    new = np.flatnonzero(np.concatenate([[True], (cells_[:-1, 1:] != cells_[:-1, :-1]).any(axis=0)])[:cells_.shape[1]])
    if not len(new):
        return cells_
    return np.concatenate([cells_[:-1, new], np.add.reduceat(cells_[-1], new)[None]])


def _dealt(parts: list, deal: int):
    """One row for each of 2 ** ``deal`` blocks that the cells fall in."""
    cells_ = _sum_cells(parts)
    block = buckets(cells_[:-1].T, deal)
    order = np.argsort(block, kind="stable")
    block, cells_ = block[order], cells_[:, order]
    edges = [*np.flatnonzero(np.diff(block, prepend=-1)).tolist(), len(block)]
    return pa.RecordBatch.from_arrays([pa.array(block[edges[:-1]], pa.int64()), pa.array([squeeze(cells_[:, i:j]) for i, j in zip(edges, edges[1:])], pa.binary())],
                                      ["block", "cells"])


def counter(size: int, bits: int, seen: np.ndarray, deal: int):
    """Cells that pass, of one or more slices of a task, in blocks: the ids of size + 1 words and n, by column."""
    def run(batches):
        parts, held = [], 0
        for _, stream, words in _rows(batches, size):
            _, _, n, ids = cells(stream, words)
            keep = _passed(ids, bits, seen)
            parts.append(np.concatenate([ids[keep].T, n[keep][None]]))
            held += parts[-1].shape[1]
            if held >= GATHER:
                yield _dealt(parts, deal)
                parts, held = [], 0
        if held:
            yield _dealt(parts, deal)
    return run


def summed(size: int, least: int):
    """The pairs of a block that all slices together hold ``least`` times, with f."""
    def run(rows: pa.Table) -> pa.Table:
        every = _sum_cells([expand(c.as_buffer()).reshape(size + 2, -1) for c in rows.column("cells")])
        return pa.table([pa.array(c) for c in every[:, every[-1] >= least]], names=[*(f"w{i}" for i in range(1, size + 2)), "f"])
    return run


def advance(size: int, bits: int, seen: np.ndarray):
    """The next level: ranks of the pairs that pass, and their words."""
    def run(batches):
        for number, stream, words in _rows(batches, size):
            x, y, n, ids = cells(stream, words)
            keep = np.flatnonzero(_passed(ids, bits, seen))
            keep = keep[np.argsort(-n[keep], kind="stable")]
            if len(keep):
                yield from _streams(number, ranked(stream, x[keep], y[keep]), ids[keep]).to_batches()
    return run


_STREAM = pa.schema([("slice", pa.int64()), ("stream", pa.binary()), ("words", pa.binary())])


def _streams(number: int, stream: np.ndarray, words: np.ndarray) -> pa.Table:
    stream = tight(stream)
    return pa.table({"slice": [number], "stream": [squeeze(stream.astype(np.int32))], "words": [squeeze(words)]} if len(stream) else {"slice": [], "stream": [], "words": []}, schema=_STREAM)


def _first_stream(text: pa.Table, words: pa.Table) -> pa.Table:
    """The stream of a slice: its frequent words ranked, 1 being the most frequent."""
    if not text.num_rows or not words.num_rows:
        return _STREAM.empty_table()
    codes = expand(text.column("stream")[0].as_buffer(), np.int32)
    ids, of = words.column("id").to_numpy(), words.column("code").to_numpy()
    order = np.argsort(ids)
    ranks = np.zeros(max(int(codes.max()), int(of.max()) + 1) + 1, np.int64)
    ranks[of[order] + 1] = np.arange(1, len(ids) + 1)
    return _streams(text.column("slice")[0].as_py(), ranks[codes], ids[order].reshape(-1, 1))


def ranked(stream: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The rank, from 1, of the pair that starts at each place, or 0."""
    ids, place = np.unique(stream, return_inverse=True)
    known = np.searchsorted(ids, x) * len(ids) + np.searchsorted(ids, y)
    order = np.argsort(known)
    known = known[order]
    key = place[:-1] * len(ids) + place[1:]
    at = np.minimum(np.searchsorted(known, key), len(known) - 1)
    return np.where(known[at] == key, order[at] + 1, 0)


# --------------------------------------------------------------- operator

def collocations(docs: DataFrame, least: int = 100, longest: int = 5, within: int = 100, top: int = 2000) -> DataFrame:
    """Return (lang, rank, phrase, a, l, r, n, score)."""
    spark = docs.sparkSession
    paths: list = []
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    coded = written(texts.mapInArrow(code_texts, "kind string, slice long, lang string, code int, word string, n long, stream binary"), "kind", paths)
    words = coded.where("kind = 'word'").select("slice", "lang", "code", "word", "n")
    sizes = cut(words.groupBy("lang").agg(F.sum("n").alias("n")))
    counts = words.groupBy("lang", "word").agg(F.sum("n").alias("f")).where(F.col("f") >= least)
    levels = [cut(number_rows(counts, [F.desc("f"), "lang", "word"], "w1")
                  .select("w1", "lang", F.array("word").alias("words"), "f", F.array("f").alias("first"), F.array("f").alias("last")))]
    del counts  # and the shuffle that its plan holds
    every_word = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    bits = min(max(16, int(4 * every_word // least).bit_length()), BITS)
    at = F.pmod(F.xxhash64("lang", "word"), F.lit(1 << bits)) + 1
    seen = frequent(levels[0].select("lang", F.col("words")[0].alias("word")), at, bits)
    words = words.select("slice", "lang", "code", "word", at.alias("at")).mapInArrow(sought(seen), "slice long, lang string, code int, word string")
    known = words.join(levels[0].select(F.col("w1").alias("id"), "lang", F.col("words")[0].alias("word")), ["lang", "word"]).select(F.col("slice").alias("of"), "code", "id")
    kind = "slice long, stream binary, words binary"
    release(spark)
    streams: list = []
    stream = cut(coded.where("kind = 'text'").select("slice", "stream").groupBy("slice").cogroup(known.groupBy("of"))
                 .applyInArrow(_first_stream, kind), streams)
    drop(spark, paths)
    release(spark)
    deal = max(1, int(every_word >> CELLS).bit_length())
    for size in range(2, longest + 1):
        seen = passing(stream, size - 1, bits, least)
        key = [f"w{i}" for i in range(1, size + 1)]
        counts = (stream.mapInArrow(counter(size - 1, bits, seen, deal), "block long, cells binary")
                  .groupBy("block").applyInArrow(summed(size - 1, least), ", ".join(f"{c} long" for c in key) + ", f long"))
        part = levels[-1]
        head = part.select(*key[:-1], "lang", F.col("words").alias("head"), "first")
        tail = part.select(*[F.col(a).alias(b) for a, b in zip(key[:-1], key[1:])], F.element_at("words", -1).alias("end"), "last")
        levels.append(cut(counts.join(head, key[:-1]).join(tail, key[1:]).select(
            *key, "lang", F.concat("head", F.array("end")).alias("words"), "f",
            F.concat("first", F.array("f")).alias("first"), F.concat("last", F.array("f")).alias("last"))))
        if size < longest:
            new: list = []
            stream = cut(stream.mapInArrow(advance(size - 1, bits, seen), kind), new)
            drop(spark, streams)
            streams = new
        # files of this level's shuffles go before the next level writes its own
        release(spark)
    drop(spark, streams)

    scored = []
    for size, level in enumerate(levels[1:], 2):
        if size < longest:  # a longer candidate reaches as far as one a word longer that it holds
            key = [f"w{i}" for i in range(1, size + 2)]
            ends = [levels[size].select(*[F.col(c).alias(k) for c, k in zip(part, key)], F.col("f").alias("most")) for part in (key[:-1], key[1:])]
            longer = ends[0].union(ends[1]).groupBy(*key[:-1]).agg(F.max("most").alias("most"))
            level = level.join(longer, key[:-1], "left").where(~F.coalesce(100 * F.col("most") >= within * F.col("f"), F.lit(False)))
        cuts = F.array(*[F.struct(F.lit(k).alias("k"), F.col("first")[k - 1].alias("l"), F.col("last")[size - k - 1].alias("r")) for k in range(1, size)])
        rows = level.select("lang", F.array_join("words", " ").alias("phrase"), F.col("f").alias("a"), F.explode(cuts).alias("c")).select("lang", "phrase", "a", "c.*")
        rows = (rows.join(sizes, "lang")
                .withColumn("score", F.expr("(cast(1000 as decimal(4,0)) * cast(a as decimal(15,0)) * cast(n as decimal(17,0))) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")))
        scored.append(rows)
    every = scored[0]
    for rows in scored[1:]:
        every = every.unionByName(rows)
    lowest = every.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("m")).select("lang", "phrase", "m.*")
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return lowest.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 best collocations of each language of documents."""
    return collocations(table(spark, sf_dir, "documents"))


OP11_SQL = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents
), w AS (
  SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces
), total AS (
  SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang
), grams AS (
  SELECT lang, m, w[i:i + m - 1] AS g
  FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM w, range(1, 6) t(m) WHERE len(w) >= m)
), f AS (
  SELECT lang, m, g, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100
), inside AS (
  SELECT lang, g[i:i + s - 1] AS g, max(f) AS most
  FROM (SELECT lang, m, g, f, s, unnest(range(1, m - s + 2)) AS i FROM f, range(2, 5) t(s) WHERE s < m) GROUP BY ALL
), cuts AS (
  SELECT c.lang, c.g, c.f AS a, k, l.f AS l, r.f AS r, n,
         CAST((CAST(1000 AS HUGEINT) * c.f * n) // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, m)) AS k FROM f WHERE m >= 2) c
  JOIN f l ON l.lang = c.lang AND l.g = c.g[1:k] JOIN f r ON r.lang = c.lang AND r.g = c.g[k + 1:]
  JOIN total ON total.lang = c.lang
), lowest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1
), ranked AS (
  SELECT c.lang, array_to_string(c.g, ' ') AS phrase, a, l, r, n, score,
         row_number() OVER (PARTITION BY c.lang ORDER BY score DESC, a DESC, array_to_string(c.g, ' ')) AS rank
  FROM lowest c LEFT JOIN inside i ON i.lang = c.lang AND i.g = c.g WHERE most IS NULL OR 100 * most < 100 * a
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""
