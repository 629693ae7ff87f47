"""Declared schemas of the raw tables (never inferred)."""

from pyspark.sql.types import (DateType, LongType, StringType, StructField,
                               StructType, TimestampNTZType)


def _s(*cols):
    return StructType([StructField(n, t, True) for n, t in cols])


S, L, D, TS = StringType(), LongType(), DateType(), TimestampNTZType()

# Column order equals the header order of the raw files.
STANDINGS = _s(
    ("season", S), ("phase", S), ("competition_group", S), ("competition", S),
    ("position", L), ("team", S), ("played", L), ("won", L), ("drawn", L),
    ("lost", L), ("goals_for", L), ("goals_against", L),
    ("goal_difference", L), ("points", L), ("standings_url", S),
    ("scraped_at", TS),
)

MATCHES = _s(
    ("season", S), ("phase", S), ("competition_group", S), ("competition", S),
    ("match_date", D), ("match_time", S), ("home_team", S), ("away_team", S),
    ("home_score", L), ("away_score", L), ("venue", S), ("match_url", S),
    ("scraped_at", TS),
)

MATCH_EVENTS = _s(
    ("season", S), ("match_url", S), ("match_date", D), ("home_team", S),
    ("away_team", S), ("home_logo", S), ("away_logo", S), ("event_type", S),
    ("event_subtype", S), ("team", S), ("player_name", S), ("minute", L),
    ("scraped_at", TS),
)

RUN_SUMMARY = _s(
    ("data_type", S), ("season", S), ("gender", S), ("competition", S),
    ("phase", S), ("status", S), ("row_count", L), ("notes", S),
    ("scraped_at", S),
)

RAW = {"standings": STANDINGS, "matches": MATCHES, "match_events": MATCH_EVENTS,
       "run_summary": RUN_SUMMARY}

# Upsert keys of the raw tables (last row per key wins).
UPSERT_KEYS = {
    "standings": ["season", "competition", "team"],
    "matches": ["match_url"],
    "match_events": ["match_url", "player_name", "minute", "event_type"],
    "run_summary": ["data_type", "season", "competition"],
}
