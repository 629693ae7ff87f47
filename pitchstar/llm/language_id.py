"""Operator 3. Language identification by fusion of Bayesian evidence.

Each row's posterior over ``languages`` and "und" (none of them) is the product of
  - the text: a naive Bayes model of letter trigrams (hashed), fitted by counting
    all rows whose declared language is among ``languages``;
  - the declared markup language, given the language of the text;
  - the address suffix, given the language of the text;
  - a prior of the host, smoothed towards its domain, which is smoothed towards
    the whole table (weights ``SMOOTH``).
The last three are grouped counts over all rows, keyed by the language that the
text alone suggests; a row's own count is taken out of its host's before use.

Texts stay where they are: the model is one small matrix (languages x
``BUCKETS``), what leaves a task are counts and one row of scores per text.
Counts per declared language, suffix, domain and host are tables, joined by
their keys; Spark splits a hot host when it joins.

Defined cases: a text without letters (also null or empty) has no language of
its own and is "und", whatever its address says; a null or unknown declared
language, suffix or host is a value of its own; with nothing to fit, all
languages are alike and every row is "und"; rows that repeat
count each; an empty table gives no rows; other columns are ignored by
``identify`` and kept by ``keep_identified``, whatever their names. The declared
language of a page is that of the first html tag that has one, wherever it stands.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import _LOWER, MARKS, cut, slices, table, text_buffers

LANGUAGES = ("de", "en", "es", "fr")
UND = "und"
BUCKETS = 8192
#: Decides ties between the flat model and a language.
UND_BONUS = 1e-6
#: Neighbouring trigrams are not independent: their logarithms count this much.
TEMPER = 0.25
SMOOTH = {"host": 5.0, "domain": 20.0}


def trigrams(column: pa.Array, markup: bool) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, row) of each letter trigram; a space stands for the edge of a word.
    With ``markup``, what lies between < and > does not count."""
    data, offsets = text_buffers(column)
    n = len(data)
    if n < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.arange(n)
    letter = ~MARKS[data] & ~((data >= 48) & (data <= 57))
    if markup:
        opened = np.maximum.accumulate(np.where(data == 60, at, -1))
        closed = np.maximum.accumulate(np.where(data == 62, at, -1))
        letter &= opened <= closed
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    x = np.where(letter, _LOWER[data], 32).astype(np.uint64)
    ok = letter[1:-1] & (row[2:] == row[:-2])
    code = (x[:-2] | x[1:-1] << np.uint64(8) | x[2:] << np.uint64(16))[ok]
    return _BUCKET(code), row[1:-1][ok]


def _BUCKET(code: np.ndarray) -> np.ndarray:
    return ((code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 13)).astype(np.int64) % BUCKETS


def fit_text(rows: DataFrame, languages: tuple, markup: bool) -> np.ndarray:
    """Log probabilities, languages + und by buckets."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(languages), BUCKETS), np.int64)
        place = {x: i for i, x in enumerate(languages)}
        for b in batches:
            for part in slices(b):
                bucket, row = trigrams(part.column("text"), markup)
                lang = np.array([place[x] for x in part.column("declared").to_pylist()], np.int64)
                total += np.bincount(lang[row] * BUCKETS + bucket, minlength=total.size).reshape(total.shape)
        lang, bucket = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(lang, pa.int32()), pa.array(bucket, pa.int32()), pa.array(total[lang, bucket])], ["lang", "bucket", "n"])

    got = (rows.where(F.col("declared").isin(*languages)).select("text", "declared").mapInArrow(count, "lang int, bucket int, n long")
           .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow())  # at most languages x BUCKETS rows
    total = np.zeros((len(languages), BUCKETS))
    total[got.column("lang").to_numpy(), got.column("bucket").to_numpy()] = got.column("n").to_numpy()
    total += 0.5
    flat = np.full((1, BUCKETS), 1 / BUCKETS)
    return np.log(np.concatenate([total / total.sum(axis=1, keepdims=True), flat]))


def scorer(model: np.ndarray, markup: bool):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in slices(b):
                bucket, row = trigrams(part.column("text"), markup)
                n = np.bincount(row, minlength=part.num_rows)
                ll = np.stack([np.bincount(row, model[k][bucket], minlength=part.num_rows) for k in range(len(model))], axis=1).astype(float)  # no trigram: integers
                ll[:, -1] += UND_BONUS
                best = np.where(n > 0, ll.argmax(axis=1), len(model) - 1)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(part.num_rows + 1) * len(model), pa.int32()), pa.array((ll * TEMPER).ravel()))
                others = [c for c in part.schema.names if c != "text"]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in others), pa.array(n, pa.int64()), pa.array(best, pa.int32()), lists], [*others, "n", "best", "ll"])
    return score


def identify(rows: DataFrame, languages: tuple = LANGUAGES, markup: bool = True) -> DataFrame:
    """(key, language, probability, text_language) from rows with key, text,
    declared, suffix, domain and host."""
    rows = rows.withColumns({c: F.coalesce(c, F.lit("")) for c in ("declared", "suffix", "domain", "host")})
    model = fit_text(rows, languages, markup)
    if (model == model[-1]).all():
        return rows.select("key", F.lit(UND).alias("language"), F.lit(1.0).alias("probability"), F.lit(UND).alias("text_language"))
    names = (*languages, UND)
    k = len(names)
    key_type = rows.schema["key"].dataType.simpleString()
    scored = cut(rows.select("key", "declared", "suffix", "domain", "host", "text").mapInArrow(
        scorer(model, markup), f"key {key_type}, declared string, suffix string, domain string, host string, n long, best int, ll array<double>"))
    # a text without letters says nothing about its host
    told = scored.where("n > 0")

    def counts(by: str) -> DataFrame:
        return told.groupBy(by).agg(F.array(*[F.sum((F.col("best") == i).cast("double")) for i in range(k)]).alias(f"c_{by}"))

    whole = told.agg(*[F.coalesce(F.sum((F.col("best") == i).cast("double")), F.lit(0.0)) for i in range(k)]).first()
    base = np.array(whole) + 1.0
    base = base / base.sum()
    base_col = F.array(*[F.lit(float(x)) for x in base])
    total = F.array(*[F.lit(float(x)) for x in whole])
    zero = F.array(*[F.lit(0.0)] * k)
    out = scored
    for by in ("declared", "suffix", "domain", "host"):
        c = counts(by).withColumnRenamed(by, f"k_{by}")
        out = out.join(c, F.col(by) == F.col(f"k_{by}"), "left").drop(f"k_{by}").withColumn(f"c_{by}", F.coalesce(f"c_{by}", zero))
    own = lambda c: F.transform(c, lambda x, i: F.greatest(x - ((i == F.col("best")) & (F.col("n") > 0)).cast("double"), F.lit(0.0)))
    added = lambda c: F.aggregate(c, F.lit(0.0), lambda s, x: s + x)
    for level, above in (("domain", base_col), ("host", F.col("p_domain"))):
        out = out.withColumn("own", own(F.col(f"c_{level}"))).withColumn("sum", added(F.col("own")))
        out = out.withColumn(f"p_{level}", F.zip_with("own", above, lambda c, p: (c + SMOOTH[level] * p) / (F.col("sum") + SMOOTH[level])))
    # P(value | language) for the declared language and the suffix, add-one against the table's share
    rows_all = float(sum(whole)) or 1.0
    share = lambda by: (added(F.col(f"c_{by}")) + 1.0) / (rows_all + 1.0)
    for by in ("declared", "suffix"):
        out = out.withColumn("share", share(by)).withColumn(f"l_{by}", F.zip_with(own(F.col(f"c_{by}")), total, lambda c, t: F.log((c + F.col("share")) / (t + 1.0))))
    logs = F.transform("ll", lambda x, i: x + F.log(F.element_at("p_host", i + 1)) + F.element_at("l_declared", i + 1) + F.element_at("l_suffix", i + 1))
    out = out.withColumn("logs", logs).withColumn("top", F.array_max("logs"))
    place = F.array_position("logs", F.col("top")).cast("int")
    named = F.element_at(F.array(*[F.lit(x) for x in names]), place)
    certain = 1 / F.aggregate("logs", F.lit(0.0), lambda s, x: s + F.exp(x - F.col("top")))
    text_best = F.element_at(F.array(*[F.lit(x) for x in names]), F.col("best") + 1)
    return out.select("key", F.when(F.col("n") > 0, named).otherwise(F.lit(UND)).alias("language"),
                      F.when(F.col("n") > 0, certain).otherwise(F.lit(1.0)).alias("probability"), text_best.alias("text_language"))


def code(c: Column) -> Column:
    return F.lower(F.regexp_extract(c, "^\\s*([A-Za-z]{2,3})(?:[-_].*)?\\s*$", 1))


def host_parts(host: Column) -> tuple[Column, Column]:
    """(suffix, domain): the last label and the last two."""
    return F.substring_index(host, ".", -1), F.substring_index(host, ".", -2)


def pages_evidence(pages: DataFrame) -> DataFrame:
    """Evidence columns of raw pages (page_id, url, html)."""
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), "^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1))
    suffix, domain = host_parts(host)
    return pages.select(F.col("page_id").alias("key"), F.col("html").alias("text"),
                        code(F.regexp_extract(F.coalesce("html", F.lit("")), "(?i)<html[^>]*\\slang\\s*=\\s*[\"']?([A-Za-z_-]+)", 1)).alias("declared"),
                        suffix.alias("suffix"), domain.alias("domain"), host.alias("host"))


def keep_identified(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", languages: tuple = LANGUAGES) -> DataFrame:
    """Rows of a documents table whose language is known, with that language in
    ``lang_col``. The declared language and the source are the evidence beside the text."""
    own = [F.col(f"`{c}`") for c in docs.columns]
    key = F.concat_ws(":", F.xxhash64(*own).cast("string"), F.xxhash64(F.lit(1), *reversed(own)).cast("string"))
    source = F.coalesce(F.col(source_col), F.lit(""))
    named = identify(docs.select(key.alias("key"), F.col(text_col).alias("text"), code(F.coalesce(F.col(lang_col), F.lit(""))).alias("declared"),
                                 F.lit("").alias("suffix"), source.alias("domain"), source.alias("host")), languages, markup=False)
    known = named.where(F.col("language") != UND).dropDuplicates(["key"]).select("key", "language")
    rows = docs.select(key.alias("key"), F.struct(*own).alias("row")).join(known, "key")
    return rows.select(*[F.col("language").alias(c) if c == lang_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page: its language, from html text, html lang, address and host."""
    out = identify(pages_evidence(table(spark, sf_dir, "pages")))
    return out.select(F.col("key").alias("page_id"), "language", F.round("probability", 6).alias("probability"), "text_language")
