"""Operator 13. Hard negatives by Strassen products of anchor and candidate tiles.

Vectors become integers, floor(scale * x) per component. Anchors are the rows
whose id is divisible by ``every``; a row's score is its integer inner product
with the anchor, higher first, ties by smaller id. An anchor's positives are its
first ``positives`` other rows of the same label. For each anchor and positive
the negatives are the first ``negatives`` rows of another label with
low * positive_score <= 100 * negative_score <= high * positive_score.

Method. Rows are dealt to label buckets and those, by a hash of the id, to
blocks of bounded size, so neither a label nor copies of one vector fill one
task. A task holds one block of anchors and one of candidates and multiplies
them tile by tile with Strassen's recursion: sides are padded with zeros to even
length, seven half-size products replace eight, and every addition is one of
integers. Additions may wrap around 2**64: the ring modulo 2**64 gives the right
product as long as that itself fits. Below ``LEAF`` the plain product is taken,
in doubles where a checked bound says that it is exact. Tiles whose scores might
leave the range of a long are multiplied in Python integers.

Tiles feed heaps that merge: the best positives of an anchor, then, with their
scores known, the best rows in each positive's window. The first pass meets only
anchors and candidates of one label bucket; the second all. A task keeps its
heaps over all its tiles and sends at most ``positives`` or ``negatives`` rows for
each; Spark merges those by windows with a row limit. The driver sees a count for
each of at most ``BUCKETS`` label buckets.

Defined cases: rows with a null id, label or vector, or a null or non-finite
component, take no part; an empty vector scores 0; shorter vectors count as padded
with zeros; rows sharing an id count once, with the smallest (label, vector);
components and scores beyond the range of a long are held at its ends (the window
is tested on scores so held); an anchor without positives, or a positive without
rows in its window, gives no row; a window below zero is empty; other columns are
ignored, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, table
from .topk_search import matrix

#: Rows in a block of anchors; rows at most in one of candidates; rows in a tile.
ANCHORS, BLOCK, TILE = 1024, 65536, 4096
#: Sides at which the recursion ends.
LEAF = 48
#: Label buckets at most; they shape the blocks, not the result.
BUCKETS = 4096
LOW, HIGH = np.iinfo(np.int64).min, np.iinfo(np.int64).max


# ----------------------------------------------------------------- product

def _even(x: np.ndarray) -> np.ndarray:
    out = np.zeros((x.shape[0] + x.shape[0] % 2, x.shape[1] + x.shape[1] % 2), x.dtype)
    out[:x.shape[0], :x.shape[1]] = x
    return out


def strassen(a: np.ndarray, b: np.ndarray, bound: int) -> np.ndarray:
    """a @ b over integers; ``bound`` is at least every |entry| of both.

    int64 input gives the product modulo 2**64, object input the exact one.
    """
    n, m, p = a.shape[0], a.shape[1], b.shape[1]
    if min(n, m, p) <= LEAF:
        if a.dtype != object and bound * bound * max(m, 1) < 2**53:
            return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
        return a @ b if m else np.zeros((n, p), a.dtype)
    a, b = _even(a), _even(b)
    i, j, k = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :k], b[:j, k:], b[j:, :k], b[j:, k:]
    two = 2 * bound
    m1 = strassen(a11 + a22, b11 + b22, two)
    m2 = strassen(a21 + a22, b11, two)
    m3 = strassen(a11, b12 - b22, two)
    m4 = strassen(a22, b21 - b11, two)
    m5 = strassen(a11 + a12, b22, two)
    m6 = strassen(a21 - a11, b11 + b12, two)
    m7 = strassen(a12 - a22, b21 + b22, two)
    out = np.empty((2 * i, 2 * k), a.dtype)
    out[:i, :k] = m1 + m4 - m5 + m7
    out[:i, k:] = m3 + m5
    out[i:, :k] = m2 + m4
    out[i:, k:] = m1 - m2 + m3 + m6
    return out[:n, :p]


def scores(a: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products of the rows of two int64 matrices, held within a long."""
    dims = max(a.shape[1], c.shape[1])
    a, c = (np.pad(x, ((0, 0), (0, dims - x.shape[1]))) for x in (a, c))
    # |min long| is no long, so the largest size is taken in Python integers
    top = [max(int(x.max(initial=0)), -int(x.min(initial=0))) for x in (a, c)]
    if top[0] * top[1] * dims <= HIGH:
        return strassen(a, c.T, max(top))
    return np.clip(strassen(a.astype(object), c.T.astype(object), max(top)), LOW, HIGH).astype(np.int64)


# ------------------------------------------------------------------- heaps

class Heaps:
    """The ``k`` best (score, id) of each of ``n`` slots, merged tile by tile."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.slot, self.score, self.id = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.worst, self.n = np.full(n, LOW, np.int64), n

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        slot, score, ids = (np.concatenate(x) for x in ((self.slot, slot), (self.score, score), (self.id, ids)))
        order = np.lexsort((ids, ~score, slot))
        slot, score, ids = slot[order], score[order], ids[order]
        rank = np.arange(len(slot)) - np.searchsorted(slot, slot)
        keep = rank < self.k
        self.slot, self.score, self.id = slot[keep], score[keep], ids[keep]
        last = rank == self.k - 1
        self.worst[slot[last]] = score[last]


def _offer(heaps: Heaps, slots: np.ndarray, s: np.ndarray, ok: np.ndarray, ids: np.ndarray) -> None:
    """Add to heap slots[i] the entries of row i of ``s`` that are ok and may
    still enter: no worse than the heap's last and the row's own kth best."""
    ok &= s >= heaps.worst[slots][:, None]
    live = np.flatnonzero(ok.any(axis=1))
    if not len(live):
        return
    s, ok, slots = s[live], ok[live], slots[live]
    if s.shape[1] > heaps.k:
        held = np.where(ok, s, LOW)
        ok &= s >= np.partition(held, s.shape[1] - heaps.k, axis=1)[:, [s.shape[1] - heaps.k]]
    row, col = np.nonzero(ok)
    heaps.add(slots[row], s[row, col], ids[col])


_FOUND = pa.schema([("anchor_id", pa.int64()), ("slot", pa.int32()), ("score", pa.int64()), ("id", pa.int64())])


def _rows(heaps: Heaps, anchor: np.ndarray, slot: np.ndarray) -> pa.Table:
    return pa.table([anchor[heaps.slot], slot[heaps.slot].astype(np.int32), heaps.score, heaps.id], schema=_FOUND)


def _tiles(block: pa.Table):
    for at in range(0, block.num_rows, TILE):
        part = block.slice(at, TILE)
        yield matrix(part.column("c_v")), part.column("c_label").to_numpy(), part.column("c_id").to_numpy()


# --------------------------------------------------------------- operator

def hard_negatives(vectors: DataFrame, label: str = "label", every: int = 100, scale: int = 256, positives: int = 5, negatives: int = 10,
                   low: int = 30, high: int = 90, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Return (anchor_id, positive_id, rank, negative_id, positive_score, negative_score)."""
    spark = vectors.sparkSession
    finite = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    ints = (vectors.where(F.col(id_col).isNotNull() & F.col(label).isNotNull() & F.coalesce(finite, F.lit(False)))
            .select(F.col(id_col).cast("long").alias("id"), F.col(label).cast("long").alias("label"),
                    F.transform(vector_col, lambda x: F.floor(x.cast("double") * scale)).alias("v")))
    # rows sharing an id count once; the bucket of a label is its hash
    one = ints.groupBy("id").agg(F.min(F.struct("label", "v")).alias("r")).select("id", "r.label", "r.v")
    placed = cut(one.withColumn("bucket", F.pmod(F.xxhash64("label"), F.lit(BUCKETS)).cast("int")))

    is_anchor = F.col("id") % every == 0
    sizes = placed.groupBy("bucket").agg(F.count("*").alias("n"), F.count(F.when(is_anchor, 1)).alias("a")).orderBy("bucket").collect()
    total = sum(r.n for r in sizes)
    rows = min(BLOCK, max(1024, 32 * math.isqrt(total)))
    # neighbouring small buckets share a block group, so that blocks are full
    group_of, blocks, anchors = {}, [], []
    room = 0
    for r in sizes:
        if not blocks or room + r.n > rows:
            blocks.append(0), anchors.append(0)
            room = 0
        room += r.n
        group_of[r.bucket] = len(blocks) - 1
        blocks[-1] += r.n
        anchors[-1] += r.a
    blocks, anchors = [-(-n // rows) for n in blocks], [-(-n // ANCHORS) for n in anchors]
    groups = spark.createDataFrame(
        [(b, g, blocks[g], sum(blocks[:g]), anchors[g], sum(anchors[:g])) for b, g in group_of.items()],
        "bucket int, grp int, blocks int, first_block int, a_blocks int, first_a int")
    dealt = placed.join(F.broadcast(groups), "bucket")  # at most BUCKETS rows
    deal = lambda n, salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.greatest(F.col(n), F.lit(1)).cast("long")).cast("int")
    span = lambda first, n: F.explode(F.sequence(F.lit(first) if isinstance(first, int) else F.col(first), (F.lit(first) if isinstance(first, int) else F.col(first)) + n - 1))
    # own names for the candidates' columns: both sides come from one table
    data = dealt.withColumn("c", F.col("first_block") + deal("blocks", 1)).select(
        F.col("c").alias("to"), F.col("id").alias("c_id"), F.col("label").alias("c_label"), F.col("v").alias("c_v"),
        F.col("a_blocks").alias("n_a"), F.col("first_a").alias("f_a"))
    asked = dealt.where(is_anchor).withColumn("a", F.col("first_a") + deal("a_blocks", 2))

    def best_positives(left: pa.Table, right: pa.Table) -> pa.Table:
        q, own, ids = matrix(left.column("v")), left.column("label").to_numpy(), left.column("id").to_numpy()
        heaps = Heaps(len(ids), positives)
        for v, lab, cand in _tiles(right):
            ok = (own[:, None] == lab[None, :]) & (ids[:, None] != cand[None, :])
            if ok.any():
                _offer(heaps, np.arange(len(ids)), scores(q, v), ok, cand)
        return _rows(heaps, ids, np.zeros(len(ids), np.int64))

    found = "anchor_id long, slot int, score long, id long"
    near = (asked.select(span("first_block", F.col("blocks")).alias("c"), "a", "id", "label", "v").groupBy("a", "c")
            .cogroup(data.where("n_a > 0").select(span("f_a", F.col("n_a")).alias("by"), "to", "c_id", "c_label", "c_v").groupBy("by", "to"))
            .applyInArrow(best_positives, found))
    order = [F.desc("score"), "id"]
    rank = F.row_number().over(Window.partitionBy("anchor_id").orderBy(*order))
    best = cut(near.withColumn("p", rank).where(F.col("p") <= positives)
               .groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("p", "score", "id"))).alias("p")))

    def best_negatives(left: pa.Table, right: pa.Table) -> pa.Table:
        q, own, ids = matrix(left.column("v")), left.column("label").to_numpy(), left.column("id").to_numpy()
        listed = [[x["score"] for x in p] for p in left.column("p").to_pylist()]
        at = np.repeat(np.arange(len(ids)), [len(p) for p in listed])
        slot = np.concatenate([np.arange(len(p)) for p in listed]) if len(at) else at
        flat = [s for p in listed for s in p]
        # the window in whole scores: ceil(low * p / 100) to floor(high * p / 100)
        least = np.array([min(max(-(-low * s // 100), LOW), HIGH) for s in flat], np.int64)
        most = np.array([min(max(high * s // 100, LOW), HIGH) for s in flat], np.int64)
        heaps = Heaps(len(at), negatives)
        for v, lab, cand in _tiles(right):
            s = scores(q, v)
            other = own[:, None] != lab[None, :]
            for k in range(positives):
                rows_k = np.flatnonzero(slot == k)
                if len(rows_k):
                    t = s[at[rows_k]]
                    _offer(heaps, rows_k, t, other[at[rows_k]] & (t >= least[rows_k][:, None]) & (t <= most[rows_k][:, None]), cand)
        return _rows(heaps, ids[at] if len(at) else ids[:0], slot)

    n_blocks, n_anchors = sum(blocks), sum(anchors)
    known = asked.join(best.withColumnRenamed("anchor_id", "id"), "id")
    far = (known.select(span(0, F.lit(max(n_blocks, 1))).alias("c"), "a", "id", "label", "v", "p").groupBy("a", "c")
           .cogroup(data.select(span(0, F.lit(max(n_anchors, 1))).alias("by"), "to", "c_id", "c_label", "c_v").groupBy("by", "to"))
           .applyInArrow(best_negatives, found))
    rank = F.row_number().over(Window.partitionBy("anchor_id", "slot").orderBy(*order))
    kept = far.withColumn("rank", rank).where(F.col("rank") <= negatives)
    named = best.select("anchor_id", F.posexplode("p").alias("slot", "p"))
    return kept.join(named, ["anchor_id", "slot"]).select(
        "anchor_id", F.col("p.id").alias("positive_id"), "rank", F.col("id").alias("negative_id"),
        F.col("p.score").alias("positive_score"), F.col("score").alias("negative_score"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten hard negatives for each of five positives of every 100th vector;
    where vec_id is divisible by 7 the label moves on by one of ten first."""
    rows = table(spark, sf_dir, "embeddings").select(
        "vec_id", "embedding", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"))
    return hard_negatives(rows)


OP13_SQL = """
WITH v AS (
  SELECT vec_id, min(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END) AS label,
         arg_min(list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)),
                 CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND label IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  GROUP BY vec_id
), s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
         CAST(list_sum(list_transform(list_zip(a.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND c.vec_id <> a.vec_id
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), r AS (
  SELECT anchor_id, positive_id, s.vec_id AS negative_id, positive_score, s.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
  FROM p JOIN s USING (anchor_id)
  WHERE NOT s.same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM r WHERE rank <= 10
"""
