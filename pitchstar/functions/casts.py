"""Typed projections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from .text import strip_spaces


def typed(df: DataFrame, schema: StructType, untrusted: bool = True, keep: list[str] = ()) -> DataFrame:
    """Cast every column of ``schema`` to its declared type, in schema
    order. Text columns cast to non-text types use ``try_cast`` when
    ``untrusted`` (bad text -> NULL instead of a failed job under ANSI).
    Columns of ``keep`` follow as they are."""
    cols = []
    for f in schema.fields:
        c = F.col(f.name)
        src = df.schema[f.name].dataType
        if untrusted and isinstance(src, StringType) and not isinstance(f.dataType, StringType):
            cols.append(strip_spaces(c).try_cast(f.dataType).alias(f.name))
        else:
            cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols, *keep)


def project(df: DataFrame, mapping: dict) -> DataFrame:
    """C20: rename / pass through / compute: {output: input column name or
    Column}. Output order follows the mapping."""
    return df.select(*[(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in mapping.items()])
