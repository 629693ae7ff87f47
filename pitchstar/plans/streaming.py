"""The refresh scenario run as a stream of file drops: the stored (older)
matches arrive first, then this run's collection batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.raw import scratch_root, write_rows
from ..streaming.refresh import ingest
from . import incremental as P


def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_root(spark)
    drops = f"{root}/drops/matches"
    write_rows(P.base_matches(spark, sf_dir), drops, overwrite=True, table="matches")
    write_rows(P.batch_matches(spark, sf_dir), drops, overwrite=False, table="matches")
    return ingest(spark, drops, f"{root}/state", "matches", max_files_per_batch=2)
