"""From raw documents to a training mix, in five stages.

Each stage takes (spark, docs, sf_dir), works on all its predecessor kept and
returns the columns of documents, but for the last, which returns the rows of
the mix: the drawn copies with their ``copy`` number and output ``shard``.

1. language_id: rows in no known language go; the others carry the language found
2. line_dedup: runs of three or more lines that start earlier are deleted from texts
3. minhash_dedup: of each group of near copies the smallest doc_id stays
4. decontaminate: rows that hold a benchmark item go
5. source_mix: sources are drawn to their target weights

Defined cases: a null doc_id is the largest id, and of several rows with a null
id in one group all stay; rows sharing an id stay or go together in stage 3;
everything else is as the operators' docstrings say. ``n_chars`` follows the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchstar.llm.common import cut, release, table
from pitchstar.llm.decontaminate import clean_rows
from pitchstar.llm.language_id import keep_identified
from pitchstar.llm.line_dedup import keep_rows
from pitchstar.llm.minhash_dedup import near_duplicates
from pitchstar.llm.source_mix import mix


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_identified(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_rows(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def minhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    groups = near_duplicates(docs, shingle=5, percent=80)
    gone = groups.where(F.col("id").isNotNull() & F.col("component").isNotNull() & (F.col("id") != F.col("component"))).select(F.col("id").alias("gone_id")).distinct()
    return docs.join(gone, F.col("doc_id") == F.col("gone_id"), "left_anti")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return clean_rows(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix(docs)


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("minhash_dedup", minhash_dedup), ("decontaminate", decontaminate), ("source_mix", source_mix)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
        release(spark)
    return STAGES[-1][1](spark, docs, sf_dir)


#: The language model, the alignment and the draws are not SQL; tests hold each
#: stage against a plain version instead.
ORACLE_SQL = None
