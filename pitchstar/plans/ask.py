"""K0: a small relationship-driven query helper over the star.

``ask`` takes a base fact, measures, dimension fields, filters and an
optional top-N, and composes the joins from the declared relationships:
every hop goes from a table's foreign key to the parent's key. Dimension
keys are unique by construction; a fact that serves as parent (event ->
match) is reduced to one row per key, so a hop can never fan rows out.
``role.field`` reads the dimension through a role-playing key, as in
``home_team.team_name`` (its output column is ``home_team_team_name``).
A field that no relationship reaches raises ValueError, and so do seasons of
which none is held.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.topn import top_members, top_rows
from .catalogue import refuse_seasons

# The relationships of the star (child, fk, parent, pk).
RELATIONSHIPS = [
    ("fct_match_events", "match_id", "fct_matches", "match_id"),
    ("fct_match_events", "player_id", "dim_players", "player_id"),
    ("fct_match_events", "team_id", "dim_teams", "team_id"),
    ("fct_team_matches", "match_id", "fct_matches", "match_id"),
    ("fct_team_matches", "season_id", "dim_seasons", "season_id"),
    ("fct_team_matches", "phase_id", "dim_phases", "phase_id"),
    ("fct_team_matches", "team_id", "dim_teams", "team_id"),
    ("fct_matches", "season_id", "dim_seasons", "season_id"),
    ("fct_matches", "phase_id", "dim_phases", "phase_id"),
    ("fct_standings", "season_id", "dim_seasons", "season_id"),
    ("fct_standings", "phase_id", "dim_phases", "phase_id"),
    ("fct_standings", "team_id", "dim_teams", "team_id"),
]
# Role -> (fk, parent, pk).
ROLES = {
    "home_team": ("home_team_id", "dim_teams", "team_id"),
    "away_team": ("away_team_id", "dim_teams", "team_id"),
    "opponent": ("opponent_id", "dim_teams", "team_id"),
}
# Questions the data cannot answer, with the reason given back.
NOT_AVAILABLE = {
    "attendance": "crowd sizes are not on the pages that are collected",
    "assists": "only the scorer of a goal is published",
    "possession": "there is no ball-by-ball record of a match",
    "shots": "attempts that were no goal leave no trace",
    "age": "players are known by name alone",
    "player_position": "line-ups do not say who played where",
    "saves": "nothing is recorded for goalkeepers",
    "referee": "officials are not named",
}
AGGS = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max, "count_distinct": F.countDistinct}

OPERATORS = {
    "like": lambda c, v: c.like(v),
    "between": lambda c, v: c.between(*v),
    "<": lambda c, v: c < v, "<=": lambda c, v: c <= v,
    ">": lambda c, v: c > v, ">=": lambda c, v: c >= v, "<>": lambda c, v: c != v,
}


def column_of(field: str) -> str:
    return field.replace(".", "_")


def condition(field: str, value) -> Column:
    """``value``: one value, a list of them, or (operator, operand)."""
    c = F.col(column_of(field))
    if isinstance(value, tuple):
        op, operand = value
        return OPERATORS[op](c, operand)
    return c.isin(value if isinstance(value, list) else [value])


def _path(star, table: str, field: str, depth: int = 2):
    """Shortest hops [(fk, parent, pk)] from ``table`` to a table holding ``field``."""
    role = ROLES.get(field.split(".")[0]) if "." in field else None
    if role and role[0] in star[table].columns:
        return [role]
    if field in star[table].columns:
        return []
    if depth == 0:
        return None
    found = []
    for child, fk, parent, pk in RELATIONSHIPS:
        if child == table:
            rest = _path(star, parent, field, depth - 1)
            if rest is not None:
                found.append([(fk, parent, pk)] + rest)
    return min(found, key=len, default=None)   # the shortest, the first declared of equals


def _joins(star, base: str, df: DataFrame, fields: list[str]) -> DataFrame:
    """Join every parent needed by ``fields`` once, with all the columns
    any field needs from it (parents are reduced to one row per key)."""
    need: dict[str, list] = {}        # hop chain -> [fk, parent, pk, cols]
    for field in fields:
        if field in df.columns:
            continue
        if field in NOT_AVAILABLE:
            raise ValueError(f"{field}: {NOT_AVAILABLE[field]}")
        hops = _path(star, base, field)
        if hops is None:
            raise ValueError(f"{field}: no relationship from {base} reaches this field")
        chain = base
        for i, (fk, parent, pk) in enumerate(hops):
            chain = f"{chain}>{fk}>{parent}"
            entry = need.setdefault(chain, [fk, parent, pk, []])
            col, name = (field.split(".")[-1], column_of(field)) if i == len(hops) - 1 else (hops[i + 1][0],) * 2
            if (col != pk or "." in field) and (col, name) not in entry[3]:
                entry[3].append((col, name))
    for i, (fk, parent, pk, cols) in enumerate(need.values()):   # parents before children
        k = f"_pk{i}"
        p = star[parent].select(F.col(pk).alias(k), *[F.col(c).alias(name) for c, name in cols])
        if parent.startswith("fct_"):
            p = p.dropDuplicates([k])
        df = df.join(p, df[fk] == p[k], "left").drop(k)
    return df


def ask(star, base: str, measures: dict, dims: list[str], filters: dict | None = None,
        top: tuple | None = None) -> DataFrame:
    """``measures``: {alias: (agg, column)}; ``filters``: {field: value, list
    or (operator, operand)}; ``top``: (n, measure alias) keeps the n best
    groups (ties broken by the dimension values), (n, measure alias, fields)
    all groups of the n members with the greatest totals."""
    filters = filters or {}
    if not isinstance(filters.get("season_name", ()), tuple):
        refuse_seasons(star, filters["season_name"])
    df = star[base]
    # filters on the base table first, so they reach the scan
    for f, v in filters.items():
        if f in df.columns:
            df = df.filter(condition(f, v))
    df = _joins(star, base, df, list(filters) + list(dims))
    for f, v in filters.items():
        df = df.filter(condition(f, v))
    dims = [column_of(d) for d in dims]
    aggs = [AGGS[a](F.col(c)).alias(alias) for alias, (a, c) in measures.items()]
    out = df.groupBy(*dims).agg(*aggs) if dims else df.agg(*aggs)
    if top and len(top) == 3:
        n, m, members = top
        out = top_members(out, [column_of(d) for d in members], m, n)
    elif top:
        n, m = top
        out = top_rows(out, [F.desc(m)] + [F.asc_nulls_first(d) for d in dims], n)
    return out
