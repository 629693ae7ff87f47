"""Reading the driver's Parquet tables with only the columns a job needs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """Parquet scan of ``{sf_dir}/{name}.parquet``; selecting columns here
    keeps the scan's ReadSchema narrow even before Catalyst prunes."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*cols) if cols else df
