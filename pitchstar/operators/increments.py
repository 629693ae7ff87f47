"""Incremental selection (A8-A12): high-water mark, event work list,
completed-match keys, day pruning and the run-summary table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import match_text_key
from ..functions.text import gender_of, phase_of, prefix
from ..schemas import RUN_SUMMARY
from .topn import cap_rows
from .upsert import upsert

NOTE_LIMIT = 100


# A8
def last_collected_date(matches: DataFrame, full_refresh: bool = False) -> DataFrame:
    """One row ``last_collected``: greatest first-10-characters of the
    collection time (the date), NULL when there are no rows or a full
    refresh is asked for (then nothing is pruned)."""
    day = prefix(F.col("scraped_at").cast("string"), 10)
    if full_refresh:
        return matches.sparkSession.range(1).select(F.lit(None).cast("string").alias("last_collected"))
    return matches.agg(F.max(day).alias("last_collected"))


# A9
def select_event_work(matches: DataFrame, events: DataFrame, since: str | None,
                      current_season: str) -> DataFrame:
    """Matches whose event pages should be (re)collected, with a ``decision``:
    'selected', 'forced_retry' (selected: current season, before ``since``,
    no events stored yet), 'skipped_before_since', or 'no_url' (a result
    without a URL: counted, never fetched). Only rows with both scores take
    part."""
    urls = (events.select(F.col("match_url").alias("_u"))
            .filter(F.col("_u").isNotNull() & (F.col("_u") != "")).distinct()
            .withColumn("_has_events", F.lit(True)))
    m = matches.filter(F.col("home_score").isNotNull() & F.col("away_score").isNotNull())
    m = m.join(urls, m.match_url == urls._u, "left")
    has_events = F.coalesce(F.col("_has_events"), F.lit(False))
    if since:
        before = F.coalesce(F.col("match_date") < F.lit(since).cast("date"), F.lit(True))
    else:
        before = F.lit(False)
    skip = before & (has_events | (F.coalesce(F.col("season"), F.lit("")) != current_season))
    has_url = F.col("match_url").isNotNull() & (F.col("match_url") != "")
    decision = (F.when(skip, F.lit("skipped_before_since"))
                .when(~has_url, F.lit("no_url"))
                .when(before, F.lit("forced_retry"))
                .otherwise(F.lit("selected")))
    forced = before & ~skip
    return m.select("match_url", "season", "match_date", decision.alias("decision"),
                    forced.alias("forced"))


def event_work(decided: DataFrame, limit: int = 0) -> DataFrame:
    """The (url, season) list to fetch; ``limit > 0`` keeps the first
    ``limit`` by (match_date, match_url) (H3), 0 keeps all."""
    work = decided.filter(F.col("decision").isin("selected", "forced_retry"))
    work = cap_rows(work, limit, [F.asc_nulls_first("match_date"), F.asc("match_url")])
    return work.select("match_url", "season")


def event_work_counters(decided: DataFrame) -> DataFrame:
    """One row: to_fetch, skipped_before_since, forced_retry."""
    d = F.col("decision")
    return decided.agg(
        F.count_if(d.isin("selected", "forced_retry")).cast("bigint").alias("to_fetch"),
        F.count_if(d == "skipped_before_since").cast("bigint").alias("skipped_before_since"),
        # a forced retry is counted before the URL test, as the collector does
        F.count_if(F.col("forced")).cast("bigint").alias("forced_retry"))


# A10
def completed_keys(matches: DataFrame) -> DataFrame:
    """Distinct ``season_date_home_vs_away`` keys of matches with both scores."""
    done = matches.filter(F.col("home_score").isNotNull() & F.col("away_score").isNotNull())
    return done.select(match_text_key("season", "match_date", "home_team", "away_team")
                       .alias("match_key")).distinct()


def pending(matches: DataFrame, keys: DataFrame, full_refresh: bool = False) -> DataFrame:
    """Matches whose key is not in the completed set (all of them on a full
    refresh)."""
    m = matches.withColumn("match_key", match_text_key("season", "match_date", "home_team", "away_team"))
    if full_refresh:
        return m
    return m.join(keys, "match_key", "left_anti")


# A11
def prune_days(days: DataFrame, since: str | None, col: str = "match_day",
               retry_days: DataFrame | None = None) -> DataFrame:
    """Keep days on or after ``since`` (all when ``since`` is None). On a
    table stored by day this is partition pruning.

    Days before ``since`` are never revisited, so a result missing then
    stays missing; ``retry_days`` (one ``col`` column, e.g. the days of
    matches whose status is 'Missing result') adds those days back."""
    if not since:
        return days
    kept = days.filter(F.col(col) >= F.lit(since).cast("date"))
    if retry_days is not None:
        back = days.join(retry_days.select(col).distinct(), col, "left_semi")
        kept = kept.unionByName(back).distinct()
    return kept


def missing_result_days(int_matches: DataFrame, col: str = "match_day") -> DataFrame:
    """Days that still have a match with status 'Missing result'."""
    return int_matches.filter(F.col("match_status") == "Missing result") \
        .select(F.col("match_date").alias(col)).distinct()


# A12
def summary_rows(results: DataFrame, at: str) -> DataFrame:
    """Result rows (data_type, season, competition, status, row_count, error)
    -> run-summary rows. Event results are one 'All' row."""
    comp = F.coalesce(F.col("competition"), F.lit(""))
    is_events = F.col("data_type") == "match_events"
    failed = F.col("status") == "failed"
    note = (F.when(is_events, F.when(F.col("status") == "complete",
                                     F.concat(F.lit("Scraped "), F.coalesce(F.col("matches_scraped"), F.lit(0)).cast("string"),
                                              F.lit(" matches")))
                   .otherwise(F.coalesce(F.col("error"), F.lit(""))))
            .when(failed, F.substring(F.coalesce(F.col("error"), F.lit("")), 1, NOTE_LIMIT))
            .otherwise(F.lit("")))
    return results.select(
        F.col("data_type"),
        F.when(is_events, F.lit("All")).otherwise(F.col("season")).alias("season"),
        F.when(is_events, F.lit("All")).otherwise(gender_of(comp)).alias("gender"),
        F.when(is_events, F.lit("All")).otherwise(comp).alias("competition"),
        F.when(is_events, F.lit("")).otherwise(phase_of(comp)).alias("phase"),
        F.col("status"),
        F.when(failed & ~is_events, F.lit(0)).otherwise(F.coalesce(F.col("row_count"), F.lit(0)))
        .cast("bigint").alias("row_count"),
        note.alias("notes"),
        F.lit(at).alias("scraped_at"),
    ).select(*RUN_SUMMARY.fieldNames())


def run_summary(results: DataFrame, existing: DataFrame | None, at: str) -> DataFrame:
    """Upsert this run's summary rows into the stored summary on
    (data_type, season, competition)."""
    new = summary_rows(results, at)
    if existing is None:
        existing = new.limit(0)
    return upsert(existing, new, ["data_type", "season", "competition"], ["scraped_at"])
