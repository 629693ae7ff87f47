"""Operator 6. Near-duplicate documents by an inverted join of MinHash coordinates.

Two documents are linked when their sets of ``shingle``-word shingles (A-Z
lower-cased, whole texts) have a Jaccard similarity of at least ``percent`` %.
Documents with fewer words have one shingle, the whole word sequence; those
without words have none and link with nothing.

Method. Every document gets ``COORDINATES`` MinHash values, posted as tokens
(coordinate, value). Partners at the similarity asked for share at least
``MATCHES`` tokens but for a chance of about 1 in 10,000 at exactly 80 %.

1. Documents with equal sets form a class and are represented by their
   smallest id, so copies are never paired.
2. Prefix merging: two documents with ``MATCHES`` tokens in common share one
   among the ``COORDINATES - MATCHES + 1`` rarest tokens of either. Only these
   are posted; tokens without a second document never are, and the most
   frequent ones are skipped.
3. First pass: each document is compared with the one document that is the
   smallest of most of its posting lists, if so many of all coordinates agree that
   a link misses by a chance of about 1 in 10 ** 9. A group of near copies becomes
   one component after as many comparisons as it has members.
4. Second pass: posting lists that still span several components hold what is
   left; pairs inside a component cannot change the result and are skipped, no
   others are. Lists of up to ``SMALL`` documents give pairs, at most
   (``SMALL`` - 1) / 2 for each posting. Longer ones are cut into blocks; the
   documents of smaller components visit the blocks, and what comes out is one row
   for a document and a component in which some member reaches the match threshold,
   not one for each such member. There ``EXTRA`` more coordinates of one byte count too:
   a group whose members resemble each other too little to link meets in its lists
   all the same, and half of ``COORDINATES`` does not tell such pairs from links.
5. Links are confirmed on the full sets: pairs one by one, a document against a
   component of several by visiting blocks of its members until the first link.
   Components follow. Only texts of documents that a pair or a visit names are
   shuffled: a bounded filter of their ids (``ID_BITS``) is asked where texts are read.

Defined cases: a null text is an empty one; a null id sorts after all others
and comes back as null; rows that share an id are one document, linked as
either of them is; ties have one result, as components do not depend on order;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BASE, NULL_ID, Words, components, cut, drop, ids_of, mix, prefix_hash, release, slices, span_hash, table, text_buffers

COORDINATES, MATCHES = 32, 16
EXTRA = 96
SMALL, BLOCK = 4, 512
#: A filter of ids has 2 ** ID_BITS bits at most, 8 MB.
ID_BITS = 26
_A = mix(np.arange(COORDINATES + EXTRA, dtype=np.uint64) + np.uint64(1000)) | np.uint64(1)
_B = mix(np.arange(COORDINATES + EXTRA, dtype=np.uint64) + np.uint64(2000))
_COORDINATE = mix(np.arange(COORDINATES, dtype=np.uint64) + np.uint64(3000))


def shingle_sets(column: pa.Array, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets): sorted distinct shingle hashes of each text."""
    w = Words(*text_buffers(column), lower=True)
    n, size = len(w.hash), np.diff(w.first)
    last = np.repeat(w.first[1:], size)
    at = np.arange(n)
    at = at[(at + shingle <= last) | ((np.repeat(size, size) < shingle) & (at == np.repeat(w.first[:-1], size)))]
    doc = np.searchsorted(w.first, at, "right") - 1
    h = span_hash(prefix_hash(w.hash, BASE), at, np.minimum(at + shingle, w.first[doc + 1]))
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    h, doc = h[new], doc[new]
    return h, np.searchsorted(doc, np.arange(len(column) + 1))


SIGNED = "id long, n long, digest binary, tokens array<long>, extra binary"


def signer(shingle: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield _sign(part, shingle)
    return sign


def _sign(part: pa.RecordBatch, shingle: int) -> pa.RecordBatch:
    h, at = shingle_sets(part.column("text"), shingle)
    n = np.diff(at)
    full = np.flatnonzero(n)
    tokens = np.zeros((len(full), COORDINATES), np.uint64)
    for k in range(COORDINATES if len(full) else 0):
        least = np.minimum.reduceat(h * _A[k] + _B[k], at[full])
        tokens[:, k] = mix(least ^ _COORDINATE[k])
    extra = np.zeros((len(full), EXTRA), np.uint8)
    for k in range(EXTRA if len(full) else 0):
        least = np.minimum.reduceat(h * _A[COORDINATES + k] + _B[COORDINATES + k], at[full])
        extra[:, k] = (mix(least) >> np.uint64(56)).astype(np.uint8)
    extras = np.full(len(n), None, object)
    extras[full] = [e.tobytes() for e in extra]
    digests = [hashlib.blake2b(h[at[r]:at[r + 1]].tobytes(), digest_size=16).digest() if n[r] else None for r in range(len(n))]
    offsets = np.concatenate(([0], np.cumsum(np.where(n > 0, COORDINATES, 0)))).astype(np.int32)
    return pa.RecordBatch.from_arrays([pa.array(ids_of(part.column("id"))), pa.array(n, pa.int64()), pa.array(digests, pa.binary()),
                                       pa.ListArray.from_arrays(pa.array(offsets), pa.array(tokens.ravel().view(np.int64))), pa.array(extras, pa.binary())],
                                      ["id", "n", "digest", "tokens", "extra"])


def confirmer(shingle: int, percent: int):
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text_a"):
                (x, at), (y, to) = shingle_sets(part.column("text_a"), shingle), shingle_sets(part.column("text_b"), shingle)
                hit = []
                for r in range(part.num_rows):
                    a, b = x[at[r]:at[r + 1]], y[to[r]:to[r + 1]]
                    both = len(np.intersect1d(a, b, assume_unique=True))
                    hit.append(100 * both >= percent * (len(a) + len(b) - both) and both > 0)
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], ["a", "b"]).filter(pa.array(hit, pa.bool_()))
    return confirm


def sure(percent: int, deviations: float = 3.72, least: int = MATCHES) -> int:
    """Of all coordinates, so many agree but for a chance of about 1 in 10,000."""
    n, p = COORDINATES + EXTRA, percent / 100
    return max(least, int(n * p - deviations * (n * p * (1 - p)) ** 0.5))


def resembler(matches: int, enough: int):
    """Pairs with ``matches`` tokens in common and ``enough`` of all coordinates."""
    def resemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sa, sb = (np.asarray(b.column(c).flatten()).reshape(-1, COORDINATES) for c in ("sa", "sb"))
            ea, eb = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint8).reshape(-1, EXTRA) for c in ("ea", "eb"))
            same = (sa == sb).sum(axis=1)
            near = (same >= matches) & (same + (ea == eb).sum(axis=1) >= enough)
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], ["a", "b"]).filter(pa.array(near, pa.bool_()))
    return resemble


def _places(ids: np.ndarray, bits: int) -> np.ndarray:
    return (mix(ids.astype(np.int64).view(np.uint64)) >> np.uint64(64 - bits)).astype(np.int64)


def id_filter(ids: DataFrame) -> tuple[int, np.ndarray]:
    """(bits, filter) of the column ``id``: 2 ** bits bits, about eight for each
    id, added up by Spark; 2 ** ID_BITS / 8 bytes at most come to the driver."""
    bits = min(max(10, int(8 * ids.count()).bit_length()), ID_BITS)

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = _places(ids_of(b.column("id")), bits)
            yield pa.RecordBatch.from_arrays([pa.array(at >> 6), pa.array((np.uint64(1) << (at & 63).astype(np.uint64)).view(np.int64))], ["word", "mask"])

    got = ids.select("id").mapInArrow(words, "word long, mask long").groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()
    out = np.zeros(1 << (bits - 6), np.int64)
    out[got.column("word").to_numpy()] = got.column("mask").to_numpy()
    return bits, out


def asked(bits: int, seen: np.ndarray):
    """Rows whose id may be one of the filter's."""
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = _places(ids_of(b.column("id")), bits)
            yield b.filter(pa.array((seen[at >> 6] >> (at & 63) & 1).astype(bool), pa.bool_()))
    return ask


def meeter(percent: int):
    """Documents that reach the match threshold with a member of a larger component."""
    enough = sure(percent)
    def meet(guests: pa.Table, hosts: pa.Table) -> pa.Table:
        out: set[tuple[int, int, int]] = set()
        hosts = hosts.rename_columns([c.removeprefix("h_") for c in hosts.schema.names])
        if guests.num_rows and hosts.num_rows:
            g, h = ({c: t.column(c).to_numpy() for c in ("rep", "n", "component", "size")} for t in (guests, hosts))
            sg, sh = (np.asarray(t.column("sign").combine_chunks().flatten()).reshape(-1, COORDINATES) for t in (guests, hosts))
            pg, ph = ((t.column("posted").to_numpy()[:, None] >> np.arange(COORDINATES) & 1).astype(bool) for t in (guests, hosts))
            eg, eh = (np.frombuffer(b"".join(t.column("extra").to_pylist()), np.uint8).reshape(-1, EXTRA) for t in (guests, hosts))
            mark = guests.column("mark")[0].as_py()
            for i in range(guests.num_rows):
                ok = (h["size"] > g["size"][i]) | ((h["size"] == g["size"][i]) & (h["component"] > g["component"][i]))
                ok &= 100 * np.minimum(h["n"], g["n"][i]) >= percent * np.maximum(h["n"], g["n"][i])
                at = np.flatnonzero(ok)
                same = sh[at] == sg[i]
                here = (same & ph[at] & pg[i]).argmax(axis=1) == (sg[i] == mark).argmax()
                equal = same.sum(axis=1)
                near = (equal >= MATCHES) & here
                at, equal = at[near], equal[near]
                at = at[equal + (eh[at] == eg[i]).sum(axis=1) >= enough]
                out.update((int(g["rep"][i]), int(h["component"][j]), int(h["size"][j])) for j in at)
        x, c, n = zip(*out) if out else ((), (), ())
        return pa.table({"x": pa.array(x, pa.int64()), "component": pa.array(c, pa.int64()), "size": pa.array(n, pa.int64())})
    return meet


def visitor(shingle: int, percent: int):
    """For each guest its first link to one of the hosts, if there is any."""
    def visit(guests: pa.Table, hosts: pa.Table) -> pa.Table:
        found = []
        hosts = hosts.rename_columns([c.removeprefix("h_") for c in hosts.schema.names])
        if guests.num_rows and hosts.num_rows:
            (x, at), (y, to) = shingle_sets(guests.column("text"), shingle), shingle_sets(hosts.column("text"), shingle)
            size = np.diff(to)
            owner = np.repeat(np.arange(hosts.num_rows), size)
            order = np.argsort(y, kind="stable")
            y, owner = y[order], owner[order]
            a, b = guests.column("id").to_numpy(), hosts.column("id").to_numpy()
            for i in range(guests.num_rows):
                own = x[at[i]:at[i + 1]]
                lo, hi = np.searchsorted(y, own), np.searchsorted(y, own, "right")
                n = hi - lo
                places = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
                both = np.bincount(owner[places], minlength=hosts.num_rows)
                hit = np.flatnonzero((both > 0) & (100 * both >= percent * (size + len(own) - both)) & (b != a[i]))
                if len(hit):
                    found.append((int(a[i]), int(b[hit[0]])))
        a, b = zip(*found) if found else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
    return visit


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """Return (id, n_shingles, component) for every row of ``docs``."""
    spark = docs.sparkSession
    docs = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("id"), F.col(text_col).alias("text"))
    old: list = []
    signed = cut(docs.mapInArrow(signer(shingle), SIGNED))
    classes = signed.where("n > 0").groupBy("digest").agg(F.min("id").alias("rep"))

    # a set of fewer than `least` shingles has no partner but its equals
    least = next(n for n in range(1, 101) if 100 * n >= percent * (n + 1))
    members = signed.where(F.col("n") >= least)
    reps = members.join(classes, "digest").where("id = rep").select("rep", "n", "tokens", "extra", "digest").dropDuplicates(["rep", "digest"])
    posted = reps.select("rep", "n", F.explode("tokens").alias("token"))
    shared = posted.groupBy("token").agg(F.count("*").alias("many")).where("many > 1")
    rare = (posted.join(shared, "token").groupBy("rep", "n").agg(F.sort_array(F.collect_list(F.struct("many", "token"))).alias("l"))
            .where(F.size("l") >= MATCHES)
            .select("rep", "n", F.explode(F.slice("l", F.lit(1), F.size("l") - (MATCHES - 1))).alias("p")))
    posts = cut(rare.select("rep", "n", F.col("p.token").alias("token")), old)
    release(spark)
    signs = reps.select("rep", F.transform("tokens", lambda x: F.xxhash64(x).bitwiseAND(0x7FFFFFFF).cast("int")).alias("sign"), "extra")

    def resembling(pairs: DataFrame, matches: int) -> DataFrame:
        a, b = (signs.select(F.col("rep").alias(c), F.col("sign").alias(f"s{c}"), F.col("extra").alias(f"e{c}")) for c in "ab")
        return (pairs.join(a, "a").join(b, "b").select("a", "b", "sa", "sb", "ea", "eb")
                .mapInArrow(resembler(matches, sure(percent, 6, 0)), "a long, b long").distinct())

    def texts_of(ids: DataFrame) -> DataFrame:
        wanted = cut(ids.distinct(), old)
        return cut(docs.mapInArrow(asked(*id_filter(wanted)), "id long, text string").join(wanted, "id", "left_semi"), old)

    def near(pairs: DataFrame, texts: DataFrame) -> DataFrame:
        a = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
        b = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
        return cut(pairs.join(a, "a").join(b, "b").select("a", "b", "text_a", "text_b").mapInArrow(confirmer(shingle, percent), "a long, b long"))

    alike = 100 * F.least("n", "n_pivot") >= percent * F.greatest("n", "n_pivot")
    pivots = posts.groupBy("token").agg(F.min(F.struct("rep", "n")).alias("p")).select("token", F.col("p.rep").alias("pivot"), F.col("p.n").alias("n_pivot"))
    tried = cut(posts.join(pivots, "token").where(F.col("rep") != F.col("pivot")).where(alike)
                .groupBy("rep", "pivot").agg(F.count("*").alias("votes"))
                .groupBy("rep").agg(F.max(F.struct("votes", -F.col("pivot"))).alias("best"))
                .select((-F.col("best.col2")).alias("a"), F.col("rep").alias("b")), old)
    release(spark)
    tried = cut(resembling(tried, 0), old)
    release(spark)
    links = near(tried, texts_of(tried.select(F.explode(F.array("a", "b")).alias("id"))))
    joined = cut(components(links))
    release(spark)

    # what is left: lists that span several components
    placed = (posts.join(joined.withColumnRenamed("id", "rep"), "rep", "left")
              .select("token", "rep", "n", F.coalesce("component", "rep").alias("component")))
    sizes = placed.groupBy("component").agg(F.countDistinct("rep").alias("size"))
    open_lists = placed.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("many")).where("lo < hi").select("token", "many")
    left = cut(placed.join(open_lists, "token").join(sizes, "component").select("token", "many", "rep", "n", "component", "size"))
    drop(spark, old)
    release(spark)

    def pairs_of(lists: DataFrame) -> DataFrame:
        other = lists.select("token", F.col("rep").alias("b"), F.col("n").alias("n_b"), F.col("component").alias("c_b"))
        return (lists.join(other, "token").where((F.col("rep") < F.col("b")) & (F.col("component") != F.col("c_b"))
                                                 & (100 * F.least("n", "n_b") >= percent * F.greatest("n", "n_b")))
                .select(F.col("rep").alias("a"), "b"))

    # two documents meet in the first coordinate that both post to a long open list, and only there
    blocks = F.ceil(F.col("many") / BLOCK).cast("int")
    long_lists = left.where(F.col("many") > SMALL).withColumn("mark", F.xxhash64("token").bitwiseAND(0x7FFFFFFF).cast("int"))
    marks = long_lists.groupBy("rep").agg(F.collect_set("mark").alias("marks")).join(signs, "rep")
    bits = "aggregate(transform(sign, (x, i) -> if(array_contains(marks, x), shiftleft(1L, i), 0L)), 0L, (a, b) -> a | b)"
    marks = marks.select("rep", "sign", "extra", F.expr(bits).alias("posted"))
    long_lists = cut(long_lists.join(marks.withColumnRenamed("rep", "r"), F.col("rep") == F.col("r")).drop("r"), old)
    there = long_lists.withColumn("block", F.pmod(F.xxhash64("rep"), blocks).cast("int"))
    top = long_lists.groupBy("token").agg(F.max(F.struct("size", "component")).alias("top")).select(F.col("token").alias("t"), F.col("top.component").alias("top"))
    visiting = (long_lists.join(top, (F.col("token") == F.col("t")) & (F.col("component") != F.col("top"))).drop("t", "top")
                .withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1))))
    kept = ["token", "block", "rep", "n", "component", "size", "sign", "extra", "posted", "mark"]
    there = there.select(*[F.col(c).alias(f"h_{c}") for c in kept])
    meets = cut(visiting.select(*kept).groupBy("token", "block").cogroup(there.groupBy("h_token", "h_block"))
                .applyInArrow(meeter(percent), "x long, component long, size long").distinct())
    drop(spark, old)
    release(spark)
    member = left.select(F.col("rep").alias("y"), F.col("component").alias("c")).distinct()
    few = meets.where("size = 1").join(member, F.col("component") == F.col("c")).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    pairs = pairs_of(left.where(F.col("many") <= SMALL)).union(few).distinct()
    counted = cut(resembling(pairs, MATCHES), old)
    release(spark)
    large = meets.where("size > 1")
    of_large = member.join(large.select(F.col("component").alias("l")).distinct(), F.col("c") == F.col("l")).select(F.col("y").alias("id"))
    texts = texts_of(counted.select(F.explode(F.array("a", "b")).alias("id")).union(large.select(F.col("x").alias("id"))).union(of_large))
    more = near(counted, texts)
    parts = F.ceil(F.col("size") / BLOCK).cast("int")
    hosts = (member.join(large.select(F.col("component").alias("l"), "size").distinct(), F.col("c") == F.col("l"))
             .join(texts, F.col("id") == F.col("y")).select(F.col("c").alias("h_c"), F.pmod(F.xxhash64("y"), parts).cast("int").alias("h_block"), F.col("id").alias("h_id"), F.col("text").alias("h_text")))
    guests = (large.join(texts, F.col("id") == F.col("x")).withColumn("block", F.explode(F.sequence(F.lit(0), parts - 1)))
              .select(F.col("component").alias("c"), "block", "id", "text"))
    visits = cut(guests.groupBy("c", "block").cogroup(hosts.groupBy("h_c", "h_block")).applyInArrow(visitor(shingle, percent), "a long, b long"))
    more = more.union(visits)
    found = cut(components(links.union(more)))
    drop(spark, old)
    release(spark)
    where = classes.join(found.withColumnRenamed("id", "rep"), "rep", "left").select("digest", F.coalesce("component", "rep").alias("component"))
    own = signed.select("id", "n", "digest").join(where, "digest", "left").select("id", "n", F.coalesce("component", "id").alias("component"))
    own = _one_component_an_id(own)
    null = lambda c: F.when(F.col(c) != NULL_ID, F.col(c))
    return own.select(null("id").alias("id"), F.col("n").alias("n_shingles"), null("component").alias("component"))


def _one_component_an_id(own: DataFrame) -> DataFrame:
    """Rows that share an id take the smallest of their components."""
    lowest = own.groupBy("id").agg(F.min("component").alias("lo"))
    return own.drop("component").join(lowest, "id").withColumnRenamed("lo", "component")


def op6_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-word shingles, 80 %, over all documents."""
    out = near_duplicates(table(spark, sf_dir, "documents"), shingle=2, percent=80)
    return out.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"), F.col("id").eqNullSafe(F.col("component")).alias("kept"))


OP6_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), s AS (
  SELECT doc_id, w, CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(w) < 2 THEN w
    ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS g FROM d
), x AS (
  SELECT doc_id, unnest(g) AS g FROM s
), n AS (
  SELECT doc_id, len(g) AS n FROM s
), class AS (
  SELECT doc_id, min(doc_id) OVER (PARTITION BY md5(array_to_string(list_sort(g), chr(10)))) AS rep FROM s WHERE len(g) > 0
), xr AS (
  SELECT x.doc_id, x.g FROM x JOIN class USING (doc_id) WHERE doc_id = rep
), c AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM xr a JOIN xr b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
), l AS (
  SELECT a, b FROM c JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * k >= 80 * (na.n + nb.n - k)
  UNION ALL SELECT rep, doc_id FROM class WHERE rep <> doc_id
), e AS (
  SELECT a, b FROM l UNION ALL SELECT b, a FROM l
), r AS (
  SELECT doc_id AS a, doc_id AS b FROM s UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a
), m AS (
  SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY 1
)
SELECT m.doc_id, CAST(n.n AS BIGINT) AS n_shingles, component_id, m.doc_id = component_id AS kept FROM m JOIN n USING (doc_id)
"""
