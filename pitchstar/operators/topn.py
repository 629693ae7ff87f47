"""H1/H2/H3: ordered top-N.

``orderBy(...).limit(n)`` plans as TakeOrderedAndProject: each partition
keeps its own n best rows and only those meet in the final merge, so no
task ever holds more than n rows per input partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_rows(df: DataFrame, order: list, n: int) -> DataFrame:
    """H1: first n rows of a total order (callers include a tie-break)."""
    return df.orderBy(*order).limit(n) if n and n > 0 else df


def top_members(detail: DataFrame, member_cols: list[str], measure: str, n: int,
                tie_cols: list[str] | None = None) -> DataFrame:
    """H2: pick the top-n members by their total of ``measure`` (summed over
    the finer grain of ``detail``), then return the detail rows of those
    members. ``detail`` is already aggregated, so it is small per member;
    the winners list has n rows and is broadcast by construction. ``n <= 0``
    keeps all members, without a ranking."""
    if not n or n <= 0:
        return detail
    tie_cols = tie_cols or member_cols
    totals = detail.groupBy(*member_cols).agg(F.sum(measure).alias("_total"))
    order = [F.desc("_total")] + [F.col(c).asc_nulls_first() for c in tie_cols]
    winners = top_rows(totals, order, n).select(*member_cols)
    cond = [detail[c].eqNullSafe(winners[c]) for c in member_cols]
    return detail.join(F.broadcast(winners), cond, "left_semi")


def cap_rows(df: DataFrame, n: int, order: list) -> DataFrame:
    """H3: ``n > 0`` keeps the first n rows in ``order``; 0 keeps all."""
    return top_rows(df, order, n) if n > 0 else df
