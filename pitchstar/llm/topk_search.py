"""Operator 1. Exact top-k inner-product search by dual cover trees.

Vectors become integers, floor(scale * x) per component. Every row whose id is
divisible by ``every`` is a query against all rows but its own; the score is
the integer inner product; ties go to the smaller id.

Method. Queries and data are indexed together. The upper level is a net of at
most ``CELLS`` centres, picked farthest-first from a sample of at most
``SAMPLE`` rows (the sample only shapes the index; every row is indexed and
the answer is exact). Each row joins the nearest centre; a cell is cut into
blocks of about ``BLOCK`` rows by a hash of the id, so copies of one vector
spread over many blocks. Query groups are cut from the same cells. First each
group meets one block of its own cell, which gives every query a kth score to
beat; cells whose ball cannot reach the group's worst kth score go. Then each
remaining block builds a cover tree over its rows and one over the queries that
reached it, and descends both: a node pair is dropped when
<cq, cp> + |cq| rp + |cp| rq + rq rp, the largest product of two points of the
balls, is below the worst kth score among the node's queries.

The driver sees the sample and one row per cell; queries are sent to the blocks
that may answer them, in groups of bounded size.

Defined cases: vectors that are null or hold a null or non-finite component
take no part; an empty vector scores 0; shorter vectors count as padded with
zeros; components and scores beyond the range of a long are held at its ends;
rows with a null id take no part; rows sharing a query's id are its own; other
repeated rows are candidates each; fewer than k candidates give as many rows;
an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, table

SAMPLE, CELLS, BLOCK, GROUP, SUPER = 2048, 48, 4096, 512, 4096
LEAF, FANOUT = 48, 12
LOW = np.iinfo(np.int64).min


def matrix(column, dims: int = 0) -> np.ndarray:
    """Rows of a list<long> column, padded with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.asarray(column.value_lengths().fill_null(0))
    flat = np.asarray(column.flatten())
    dims = max(dims, int(lengths.max()) if len(lengths) else 0, 1)
    out = np.zeros((len(lengths), dims), np.int64)
    out[np.arange(dims) < lengths[:, None]] = flat
    return out


class CoverTree:
    """Nodes in breadth-first order: centre, covering radius, children, points."""

    def __init__(self, points: np.ndarray):
        self.points = points.astype(np.float64)
        self.centre, self.radius, self.kids, self.members = [], [], [], []
        queue = [np.arange(len(points))]
        k = 0
        while k < len(queue):
            own = queue[k]
            p = self.points[own]
            c = p.mean(axis=0)
            r = float(np.sqrt(((p - c) ** 2).sum(axis=1).max())) if len(own) else 0.0
            self.centre.append(c)
            self.radius.append(r * (1 + 1e-9) + 1e-6)
            self.members.append(own)
            kids: list[int] = []
            if len(own) > LEAF and r > 0:
                for part in _net(p, r / 2):
                    kids.append(len(queue))
                    queue.append(own[part])
            self.kids.append(kids)
            k += 1
        self.centre, self.radius = np.array(self.centre), np.array(self.radius)
        self.norm = np.sqrt((self.centre ** 2).sum(axis=1))


def _net(p: np.ndarray, radius: float) -> list[np.ndarray]:
    """Split points among centres picked farthest-first until they cover
    everything within ``radius``, or FANOUT of them exist."""
    near, owner = np.full(len(p), np.inf), np.zeros(len(p), np.int64)
    at = 0
    for k in range(FANOUT):
        d = ((p - p[at]) ** 2).sum(axis=1)
        closer = d < near
        near[closer], owner[closer] = d[closer], k
        at = int(near.argmax())
        if near[at] <= radius * radius and k:
            break
    return [x for x in (np.flatnonzero(owner == k) for k in range(FANOUT)) if len(x)]


class Search:
    """Answers for the queries of one block; ``worst`` holds scores to reach."""

    def __init__(self, q: np.ndarray, q_ids: np.ndarray, p: np.ndarray, p_ids: np.ndarray, k: int, worst: np.ndarray):
        dims = max(q.shape[1], p.shape[1])
        q, p = (np.pad(x, ((0, 0), (0, dims - x.shape[1]))) for x in (q, p))
        top = lambda x: float(np.abs(x.astype(np.float64)).max(initial=0))
        self.exact = top(q) * top(p) * dims < 2**52
        self.q, self.p = (q.astype(np.float64), p.astype(np.float64)) if self.exact else (q.astype(object), p.astype(object))
        self.q_ids, self.p_ids, self.k, self.floor = q_ids, p_ids, k, worst
        self.score = np.full((len(q), k), LOW, np.int64)
        self.found = np.full((len(q), k), np.iinfo(np.int64).max, np.int64)
        self.filled = np.zeros((len(q), k), bool)
        self.kth = worst.copy()
        if len(q) and len(p):
            self.queries, self.data = CoverTree(q), CoverTree(p)
            self.visit(0, np.array([0]))

    def reach(self, qn: int, nodes: np.ndarray) -> np.ndarray:
        t, d = self.queries, self.data
        bound = d.centre[nodes] @ t.centre[qn] + t.norm[qn] * d.radius[nodes] + d.norm[nodes] * t.radius[qn] + t.radius[qn] * d.radius[nodes]
        return bound + np.abs(bound) * 1e-9 + 1

    def visit(self, qn: int, nodes: np.ndarray) -> None:
        own = self.queries.members[qn]
        nodes = nodes[self.reach(qn, nodes) >= self.kth[own].min()]
        kids = self.queries.kids[qn]
        if kids:
            nodes = np.array([x for n in nodes for x in (self.data.kids[n] or [n])], np.int64)
            for c in kids:
                if len(nodes):
                    self.visit(c, nodes)
            return
        leaves = []
        while len(nodes):
            leaves += [n for n in nodes if not self.data.kids[n]]
            nodes = np.array([x for n in nodes for x in self.data.kids[n]], np.int64)
            if len(nodes):
                nodes = nodes[self.reach(qn, nodes) >= self.kth[own].min()]
        if not leaves:
            return
        leaves = np.array(leaves)
        bound = self.reach(qn, leaves)
        order = np.argsort(-bound)
        leaves, bound = leaves[order], bound[order]
        for a in range(0, len(leaves), 8):
            go = bound[a:a + 8] >= self.kth[own].min()
            if not go.any():
                break
            self.compare(own, np.concatenate([self.data.members[n] for n in leaves[a:a + 8][go]]))

    def compare(self, own: np.ndarray, at: np.ndarray) -> None:
        s = self.q[own] @ self.p[at].T
        s = s.astype(np.int64) if self.exact else np.clip(s, LOW, -LOW - 1).astype(np.int64)
        ok = (self.q_ids[own][:, None] != self.p_ids[at][None, :]) & (s >= self.kth[own][:, None])
        use = ok.any(axis=0)
        if not use.any():
            return
        s, ok, ids = s[:, use], ok[:, use], np.broadcast_to(self.p_ids[at[use]], (len(own), int(use.sum())))
        score, found, filled = (np.concatenate(x, axis=1) for x in ((self.score[own], s), (self.found[own], ids), (self.filled[own], ok)))
        order = np.lexsort((found, -score.astype(np.float64) if self.exact else ~score, ~filled), axis=1)[:, :self.k]
        self.score[own], self.found[own], self.filled[own] = (np.take_along_axis(x, order, 1) for x in (score, found, filled))
        full = self.filled[own].all(axis=1)
        self.kth[own] = np.where(full, np.maximum(self.floor[own], self.score[own][:, -1]), self.floor[own])


def top_k(vectors: DataFrame, k: int = 10, every: int = 100, scale: int = 1024, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Return (query_id, rank, vec_id, score)."""
    spark = vectors.sparkSession
    finite = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    ints = vectors.where(F.col(id_col).isNotNull() & F.coalesce(finite, F.lit(False))).select(
        F.col(id_col).cast("long").alias("id"), F.transform(vector_col, lambda x: F.floor(x.cast("double") * scale)).alias("v"))
    sample = ints.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).toArrow()
    seen = matrix(sample.column("v")).astype(np.float64)
    centres = seen[_farthest(seen)]

    def assign(batches):
        for b in batches:
            p = matrix(b.column("v"), centres.shape[1]).astype(np.float64)
            c = np.pad(centres, ((0, 0), (0, p.shape[1] - centres.shape[1])))
            d = ((p ** 2).sum(1)[:, None] - 2 * p @ c.T + (c ** 2).sum(1)[None, :]) if len(c) else np.zeros((len(p), 1))
            cell = d.argmin(1)
            far = np.sqrt(((p - c[cell]) ** 2).sum(1)) if len(c) else np.zeros(len(p))
            yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), pa.array(far), b.column("id"), b.column("v")], ["cell", "far", "id", "v"])

    placed = cut(ints.mapInArrow(assign, "cell int, far double, id long, v array<long>"))
    is_query = F.col("id") % every == 0
    cells = placed.groupBy("cell").agg(F.count("*").alias("n"), F.count(F.when(is_query, 1)).alias("q"), F.max("far").alias("r")).collect()
    n, q, radius = ({c.cell: c[x] for c in cells} for x in ("n", "q", "r"))
    blocks = {c: -(-n[c] // BLOCK) for c in n}
    groups = {c: -(-q[c] // GROUP) for c in n}
    base, total = {}, 0
    for c in sorted(groups):
        base[c], total = total, total + groups[c]
    supers = max(1, -(-sum(q.values()) // SUPER))
    lookup = lambda values, default=0: F.element_at(F.array(*[F.lit(int(values.get(c, default))) for c in range(max(len(centres), 1))]), F.col("cell") + 1)
    data = placed.withColumn("block", F.pmod(F.xxhash64("id"), F.greatest(lookup(blocks), F.lit(1))).cast("int"))
    queries = (placed.where(is_query).dropDuplicates(["id", "v"])
               .withColumn("grp", (lookup(base) + F.pmod(F.xxhash64("id", F.lit(7)), F.greatest(lookup(groups), F.lit(1)))).cast("int"))
               .withColumn("super", (F.col("grp") * supers / max(total, 1)).cast("int")))
    ids = sorted(n)

    def first_look(qs: pa.Table, block: pa.Table) -> pa.Table:
        """kth scores within one block, and the cells that may still matter."""
        if not qs.num_rows:
            return pa.table({x: pa.array([], t) for x, t in _LOOKED})
        v, own = matrix(qs.column("v"), centres.shape[1]), qs.column("id").to_numpy()
        s = Search(v, own, matrix(block.column("v")), block.column("id").to_numpy(), k, np.full(len(own), LOW, np.int64))
        kth = np.where(s.filled.all(axis=1), s.score[:, -1], LOW)
        f = v.astype(np.float64)
        mid = f.mean(axis=0)
        r = np.sqrt(((f - mid) ** 2).sum(1).max()) * (1 + 1e-9) + 1e-6
        c = np.pad(centres, ((0, 0), (0, v.shape[1] - centres.shape[1])))[ids]
        rc = np.array([radius[x] for x in ids]) * (1 + 1e-9) + 1e-6
        bound = c @ mid + np.linalg.norm(mid) * rc + np.linalg.norm(c, axis=1) * r + r * rc
        live = [x for x, ok in zip(ids, bound + np.abs(bound) * 1e-9 + 1 >= kth.min()) if ok]
        m = len(own)
        return pa.table({"id": own, "v": qs.column("v"), "super": qs.column("super"), "kth": kth, "cells": pa.array([live] * m, pa.list_(pa.int32()))})

    _LOOKED = (("id", pa.int64()), ("v", pa.list_(pa.int64())), ("super", pa.int32()), ("kth", pa.int64()), ("cells", pa.list_(pa.int32())))
    seeds = (data.where("block = 0").withColumn("grp", F.explode(F.sequence(F.lit(0), F.greatest(lookup(groups) - 1, F.lit(0)))))
             .withColumn("grp", (F.col("grp") + lookup(base)).cast("int")).where(lookup(groups) > 0).select("grp", "id", "v"))
    looked = cut(queries.groupBy("grp").cogroup(seeds.groupBy("grp")).applyInArrow(first_look, "id long, v array<long>, super int, kth long, cells array<int>"))
    sent = (looked.select("id", "v", "super", "kth", F.explode("cells").alias("cell"))
            .withColumn("block", F.explode(F.sequence(F.lit(0), F.greatest(lookup(blocks), F.lit(1)) - 1))))
    pairs = looked.select(F.col("super").alias("to_super"), F.explode("cells").alias("to_cell")).distinct()
    asked = data.join(pairs, F.col("cell") == F.col("to_cell")).select(F.col("cell").alias("c"), F.col("block").alias("b"), F.col("to_super").alias("s"), "id", "v")

    def answer(qs: pa.Table, block: pa.Table) -> pa.Table:
        s = Search(matrix(qs.column("v")), qs.column("id").to_numpy(), matrix(block.column("v")), block.column("id").to_numpy(), k, qs.column("kth").to_numpy())
        row, col = np.nonzero(s.filled)
        return pa.table({"query_id": s.q_ids[row], "vec_id": s.found[row, col], "score": s.score[row, col]},
                        schema=pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())]))

    key = ["cell", "block", "super"]
    hits = (sent.select(*key, "id", "v", "kth").groupBy(*key).cogroup(asked.groupBy("c", "b", "s"))
            .applyInArrow(answer, "query_id long, vec_id long, score long"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _farthest(points: np.ndarray) -> list[int]:
    """At most CELLS positions, each the farthest from those before."""
    if not len(points):
        return []
    at, near = [0], ((points - points[0]) ** 2).sum(1)
    while len(at) < CELLS and near.max() > 0:
        at.append(int(near.argmax()))
        near = np.minimum(near, ((points - points[at[-1]]) ** 2).sum(1))
    return at


def op1_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten nearest rows of every 100th vector of embeddings."""
    return top_k(table(spark, sf_dir, "embeddings"))


OP1_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
