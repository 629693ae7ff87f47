"""Operator 4. Mixing sources to target weights with a hypergeometric splitting tree.

Sources in code-point order (null last) weigh 1, 2, 3, 1, 2, 3, ... and share
the words of the whole table; a target stops at ``repeat`` times its source's
words and what it cannot take is shared by weight among the others.

A source whose target is t times its size is drawn floor(t) times whole, and
the rest from a permutation of its documents fixed by a hash: the permutation
is a line of buckets (the leading bits of the hash), and the line is walked in
three steps - 256 buckets of the whole, 256 of the bucket where the target
falls, the documents of the last one - so that no step sorts more than 256 rows
of a source, or one 65,536th of its documents. A document that does not fit is
left out and the rest of the line is walked in the same way with what is left
of the target, by the documents that are no larger than that, until no undrawn
document of the source fits. The smallest undrawn one is then drawn too if that
comes nearer to the target.

Blocks (pieces of that line, of about ``BLOCK_WORDS`` words) are then dealt to
the output shards: a binary tree over the shards splits the exact block counts
of all sources by the multivariate hypergeometric law, so every shard gets a
fair random share and every block goes to exactly one shard. A source's blocks
are permuted and cut along the quotas; rows are put in hash order within their
shard. Everything follows from ``seed``, so reruns agree.

The driver holds three sums per round of sharing; sources, quotas and blocks
stay tables.

Defined cases: a null text has size 0; documents of size 0 take 0 words; a
null source is a source of its own, the last; rows that share an id are told
apart by text and, if equal, drawn alike; an empty table gives no rows; other
columns are kept by ``mix`` and may have any names but those it adds.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitchstar.operators.numbering import number_rows

from .common import WORD, cut, release, table

BLOCK_WORDS = 1 << 16
RADIX = 256
#: Past every place of the line.
LINE_END = (1 << 63) - 1
WEIGHTS = (1, 2, 3)


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def line_of(id_col: str, text_col: str, seed: int) -> Column:
    """Place of a document in the permutation of its source."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)), 1)


def targets(sized: DataFrame, weights: tuple = WEIGHTS, repeat: int = 3) -> DataFrame:
    """(source, source_size, target) of a table with source and size."""
    sizes = cut(sized.groupBy("source").agg(F.sum("size").alias("source_size")))
    named = number_rows(sizes.withColumn("is_null", F.col("source").isNull()).withColumn("key", F.coalesce("source", F.lit(""))), ["is_null", "key"], "place")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1).cast("int"))
    s = cut(named.select("source", "source_size", weight.alias("w")))
    cap = F.col("source_size") * float(repeat)
    total, all_w = s.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.sum("w")).first()
    level = total / all_w if all_w else 0.0
    stopped = -1
    while True:  # the level rises until no further source is above its cap
        above = F.col("w") * level > cap
        held, n, free = s.agg(F.coalesce(F.sum(F.when(above, cap)), F.lit(0.0)), F.count(F.when(above, 1)), F.sum(F.when(~above, F.col("w")))).first()
        if n == stopped or not free:
            break
        stopped, level = n, (total - held) / free
    return s.select("source", "source_size", F.least(F.col("w") * level, cap).alias("target"))


def walk(units: DataFrame, state: DataFrame) -> DataFrame:
    """One walk of each source along its line, from behind ``after``, by the
    units of at most ``gap`` words, up to the first that overflows the gap:
    (s, after, upto, most, gap), where units of at most ``most`` words in
    ``after < line <= upto`` are drawn and ``gap`` is what they leave; ``upto``
    is LINE_END where all fit. Sources without such units have no row."""
    top, mid = F.shiftright("line", 55).cast("int"), (F.shiftright("line", 47).bitwiseAND(RADIX - 1)).cast("int")
    free = (units.join(state, F.col("source").eqNullSafe(F.col("s"))).where((F.col("line") > F.col("after")) & (F.col("words") <= F.col("gap")))
            .select("s", "line", "words", "after", F.col("gap").alias("most"), F.col("gap").alias("rest")))

    def crossing(sums: DataFrame, at: str) -> DataFrame:
        """Per source the first bucket in which the words exceed ``rest``."""
        w = Window.partitionBy("s").orderBy(at)
        run = sums.withColumn("before", F.sum("words").over(w) - F.col("words"))
        hit = run.where((F.col("before") <= F.col("rest")) & (F.col("before") + F.col("words") > F.col("rest")))
        return hit.select(F.col("s").alias("c"), F.col(at).alias(f"{at}_cross"), (F.col("rest") - F.col("before")).alias("rest_in"))

    def inside(rows: DataFrame, at: str, hit: DataFrame) -> DataFrame:
        return (rows.join(hit, F.col("s").eqNullSafe(F.col("c")) & (F.col(at) == F.col(f"{at}_cross")))
                .drop("c", "rest").withColumnRenamed("rest_in", "rest"))

    by_top = cut(free.withColumn("top", top).groupBy("s", "after", "most", "rest", "top").agg(F.sum("words").alias("words")))
    whole = by_top.groupBy("s", "after", "most").agg(F.sum("words").alias("all")).where(F.col("all") <= F.col("most"))
    one = inside(free.withColumn("top", top).withColumn("mid", mid), "top", cut(crossing(by_top, "top")))
    by_mid = one.groupBy("s", "rest", "mid").agg(F.sum("words").alias("words"))
    last = inside(one, "mid", cut(crossing(by_mid, "mid")))
    w = Window.partitionBy("s").orderBy("line")
    run = last.withColumn("sum", F.sum("words").over(w))
    fits = F.col("sum") <= F.col("rest")
    begin = F.col("top_cross").cast("long") * (1 << 55) + F.col("mid_cross").cast("long") * (1 << 47) - 1
    part = (run.groupBy("s", "after", "most", "rest", begin.alias("begin")).agg(F.max(F.when(fits, F.col("line"))).alias("end"), F.max(F.when(fits, F.col("sum"))).alias("fitted"))
            .select("s", "after", F.greatest("after", "begin", "end").alias("upto"), "most", (F.col("rest") - F.coalesce("fitted", F.lit(0))).alias("gap")))
    return cut(part.unionByName(whole.select("s", "after", F.lit(LINE_END).alias("upto"), "most", (F.col("most") - F.col("all")).alias("gap"))))


def draws(docs: DataFrame, seed: int = 1, weights: tuple = WEIGHTS, repeat: int = 3, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(id, line, source, size, source_size, target, copies): how often each
    document is drawn. ``line`` is its place in the permutation of its source."""
    line = line_of(id_col, text_col, seed)
    sized = cut(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), words(F.col(text_col)).alias("size"), line.alias("line")))
    t = targets(sized, weights, repeat)
    per = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    t = t.withColumn("whole", F.floor(per + 1e-12).cast("long")).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    t = cut(t)
    # documents on one place of the line are a unit: drawn alike, as long as they fit
    units = cut(sized.where("size > 0").groupBy("source", "line").agg(F.sum("size").alias("words")))
    gaps = cut(t.where("rest > 0").select(F.col("source").alias("s"), F.lit(-1).cast("long").alias("after"), F.col("rest").alias("gap")))
    state, walks = gaps, None
    while state.take(1):  # every walk draws a unit of each of its sources, or is the last
        done = walk(units, state)
        release(docs.sparkSession)
        walks = done if walks is None else walks.unionByName(done)
        state = done.where((F.col("upto") < LINE_END) & (F.col("gap") >= 1)).select("s", F.col("upto").alias("after"), "gap")
    if walks is None:
        walks = gaps.select("s", "after", F.col("after").alias("upto"), F.col("gap").alias("most"), "gap")
    walks = walks.groupBy("s").agg(F.collect_list(F.struct("after", "upto", "most")).alias("walks"), F.min("gap").alias("left")).withColumnRenamed("s", "w")
    drawn = cut(gaps.join(walks, F.col("s").eqNullSafe(F.col("w")), "left").select("s", F.coalesce("left", "gap").alias("gap"), "walks"))
    hit = F.coalesce(F.exists("walks", lambda x: (F.col("line") > x["after"]) & (F.col("line") <= x["upto"]) & (F.col("words") <= x["most"])), F.lit(False))
    marked = units.join(drawn, F.col("source").eqNullSafe(F.col("s"))).withColumn("hit", hit)
    off = F.abs(F.col("words") - F.col("gap"))
    near = (marked.where(~F.col("hit") & (off < F.col("gap"))).groupBy("s").agg(F.min(F.struct(off.alias("off"), "line")).alias("one"))
            .select(F.col("s").alias("n"), F.col("one.line").alias("near")))
    extra = marked.join(cut(near), F.col("s").eqNullSafe(F.col("n")), "left").where(F.col("hit") | (F.col("line") == F.col("near"))).select(F.col("s").alias("es"), F.col("line").alias("eline"))
    rows = sized.join(t.withColumnRenamed("source", "ts"), F.col("source").eqNullSafe(F.col("ts")))
    out = rows.join(extra, F.col("source").eqNullSafe(F.col("es")) & (F.col("line") == F.col("eline")), "left")
    return out.select("id", "line", "source", "size", "source_size", "target",
                      F.when(F.col("size") > 0, F.col("whole") + F.col("eline").isNotNull().cast("int")).otherwise(0).cast("long").alias("copies"))


# ------------------------------------------------------------------- shards

def quotas(blocks: DataFrame, shards: int, seed: int = 1) -> DataFrame:
    """(source, shard, first, past): block ranks of each source per shard, from
    (source, blocks). One tree node splits at a time; a node's children get a
    multivariate hypergeometric draw of its counts."""

    def split(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("source", na_position="last", kind="stable")
        out, todo = [], [(0, shards, rows["blocks"].to_numpy(np.int64), 1)]
        while todo:
            lo, hi, counts, node = todo.pop()
            if hi - lo == 1:
                out.append(pd.DataFrame({"source": rows["source"].to_numpy(), "shard": lo, "n": counts}))
                continue
            mid = (lo + hi) // 2
            total = int(counts.sum())
            rng = np.random.default_rng([seed, node])
            left = rng.multivariate_hypergeometric(counts, total * (mid - lo) // (hi - lo), method="marginals") if total else counts
            todo += [(mid, hi, counts - left, 2 * node + 1), (lo, mid, left, 2 * node)]
        return pd.concat(out)

    cut_up = blocks.groupBy(F.lit(0).alias("root")).applyInPandas(lambda rows: split(rows), "source string, shard int, n long")
    w = Window.partitionBy("source").orderBy("shard")
    return cut_up.withColumn("past", F.sum("n").over(w)).select("source", "shard", (F.col("past") - F.col("n")).alias("first"), "past").where("past > first")


def mix(docs: DataFrame, shards: int | None = None, seed: int = 1, weights: tuple = WEIGHTS, repeat: int = 3, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", drawn: DataFrame | None = None) -> DataFrame:
    """The mixed rows: every drawn copy of a document with ``copy`` and
    ``shard``, each shard in one partition and in the order of its hash.
    ``drawn``: the ``draws`` of these documents, if the caller has them."""
    if drawn is None:
        drawn = cut(draws(docs, seed, weights, repeat, id_col, text_col, source_col))
    total = drawn.agg(F.coalesce(F.sum(F.col("size") * F.col("copies")), F.lit(0))).first()[0]
    bits = min(max(int(total // BLOCK_WORDS).bit_length(), 0), 20)
    shards = shards or max(1, min(int(total // (BLOCK_WORDS * 64)) + 1, 4096))
    block = F.shiftrightunsigned("line", 63 - bits) if bits else F.lit(0).cast("long")
    copies = drawn.where("copies > 0").select("id", "line", "source", block.alias("block"), F.explode(F.sequence(F.lit(0), F.col("copies").cast("int") - 1)).alias("copy"))
    used = copies.groupBy("source", "block", "copy").agg(F.count("*").alias("rows"))
    # ranks of the (copy, block) pairs of a source: a hash orders them
    order = Window.partitionBy("source").orderBy(F.xxhash64(F.lit(seed), "source", "copy", "block"), "copy", "block")
    ranked = cut(used.withColumn("rank", F.row_number().over(order) - 1).select("source", "block", "copy", "rank"))
    deal = quotas(ranked.groupBy("source").agg(F.count("*").alias("blocks")), shards, seed)
    # the shard of a rank is that of the last quota that starts at or before it
    starts = deal.select("source", F.lit(None).cast("long").alias("block"), F.lit(None).cast("int").alias("copy"), F.col("first").alias("rank"), "shard")
    w = Window.partitionBy("source").orderBy("rank", F.col("block").isNotNull())
    placed = (ranked.withColumn("shard", F.lit(None).cast("int")).unionByName(starts)
              .withColumn("shard", F.last("shard", ignorenulls=True).over(w)).where("block is not null").select("source", "block", "copy", "shard"))
    p = placed.select(F.col("source").alias("s"), F.col("block").alias("b"), F.col("copy").alias("c"), "shard")
    lines = (copies.distinct().join(p, F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b")) & (F.col("copy") == F.col("c")))
             .select(F.col("id").alias("mix_id"), F.col("line").alias("mix_line"), F.col("source").alias("mix_source"), F.col("copy"), "shard"))
    line = line_of(id_col, text_col, seed)
    rows = docs.withColumn("mix_at", line).join(lines, (F.col("mix_at") == F.col("mix_line")) & F.col(id_col).eqNullSafe(F.col("mix_id")) & F.col(source_col).eqNullSafe(F.col("mix_source")))
    rows = rows.where(words(F.col(text_col)) > 0)
    return (rows.repartition(shards, "shard").sortWithinPartitions("shard", F.xxhash64(F.lit(seed + 1), "mix_at", "copy"), "copy")
            .select(*docs.columns, "copy", "shard"))


def op4_source_mix(spark: SparkSession, sf_dir: str, seed: int = 1) -> DataFrame:
    """Words that the mix takes of every document: its copies are counted in the
    shards that the splitting tree dealt them to."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    d = cut(draws(docs, seed))
    mixed = mix(docs.withColumn("line", line_of("doc_id", "text", seed)), seed=seed, drawn=d)
    # rows alike in id, text and source are drawn alike: each holds every copy
    held = mixed.groupBy(F.col("doc_id").alias("h_id"), F.col("line").alias("h_line"), F.col("source").alias("h_source")).agg(
        F.countDistinct("copy").alias("held"))
    out = d.join(held, F.col("id").eqNullSafe(F.col("h_id")) & (F.col("line") == F.col("h_line")) & F.col("source").eqNullSafe(F.col("h_source")), "left")
    return out.select(F.col("id").alias("doc_id"), "size", "source_size", "target",
                      (F.col("size") * F.coalesce("held", F.lit(0))).alias("taken"))
