"""Dimension lookups and membership joins.

A broadcast hint is placed only on a side that is small by construction
(``small=True``: one row per season or phase). Everywhere else the choice is
Spark's, from size statistics and measured shuffle sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def lookup_fk(fact: DataFrame, dim: DataFrame, fact_col: str, dim_col: str,
              dim_key: str, out_col: str | None = None,
              small: bool = False) -> DataFrame:
    """Left-join ``fact`` to ``dim`` on ``fact_col = dim_col`` and append the
    dimension key as ``out_col``. Unmatched or NULL natural keys give NULL.
    ``small``: bounded by construction (hint)."""
    out_col = out_col or dim_key
    d = dim.select(F.col(dim_col).alias("_nk"), F.col(dim_key).alias(out_col))
    if small:
        d = F.broadcast(d)
    return fact.join(d, fact[fact_col] == d["_nk"], "left").drop("_nk")


def lookup_roles(fact: DataFrame, dim: DataFrame, dim_col: str, dim_key: str,
                 roles: dict[str, str], small: bool = False) -> DataFrame:
    """E2 role-playing dimension: ``roles`` maps a fact column to the output
    key column, e.g. {"home_team": "home_team_id", "away_team": "away_team_id"}."""
    for fact_col, out_col in roles.items():
        fact = lookup_fk(fact, dim, fact_col, dim_col, dim_key, out_col, small=small)
    return fact


def orphans(child: DataFrame, parent: DataFrame, child_cols, parent_cols=None) -> DataFrame:
    """E5 / Q3: rows of ``child`` whose non-NULL key has no parent row."""
    child_cols = [child_cols] if isinstance(child_cols, str) else list(child_cols)
    parent_cols = child_cols if parent_cols is None else (
        [parent_cols] if isinstance(parent_cols, str) else list(parent_cols))
    keys = parent.select(*[F.col(p).alias(f"_k{i}") for i, p in enumerate(parent_cols)]).distinct()
    nn = child
    for c in child_cols:
        nn = nn.filter(F.col(c).isNotNull())
    cond = [nn[c] == keys[f"_k{i}"] for i, c in enumerate(child_cols)]
    return nn.join(keys, cond, "left_anti")
