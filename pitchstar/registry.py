"""Registered queries: name -> Spark callable and name -> oracle SQL.

Parameters are fixed values chosen to hit populated parts of the driver
fixture (see FIXTURES.md): a season, a competition, a team, a card colour.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .plans import models as M
from .plans import incremental as A
from .plans import ask as AK
from .plans import catalogue as CT
from .plans import expressions as XP
from .plans import extraction as X
from .plans import loading as LD
from .plans import quality as Q
from .plans import streaming as ST
from .plans import questions as K
from .sources.fixtures import raw_tables, stored_tables

PARAMS = {
    "season": "1997-1998",
    "competition": "League Mens Premier BUILDING",
    "team": "NATION_11",
    "colour": "Yellow",
    "seasons": ["1996-1997", "1997-1998", "1998-1999"],
    "profile_competitions": ["League Womens Premier MACHINERY", "League Womens Division MACHINERY"],
    "gender": "Mens",
    "tiers": [1, 2],
    "top_n": 10,
    "as_of": "1998-06-01",
    # a level that ends with a season: its later competitions are unknown
    "ending_levels": [("Premier", 1, None, "1996-1997"), ("Division", 2, "1993-1994", None)],
    "asked_seasons": ["1980-1981", "1997-1998", "2020-2021"],
}


def star_of(spark: SparkSession, sf_dir: str) -> M.Star:
    return M.build_star(raw_tables(spark, sf_dir))


def _model(name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return star_of(spark, sf_dir)[name]
    return run


def _question(fn, *args, **kw):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(star_of(spark, sf_dir), *args, **kw)
    return run


def _checked(fn, *args):
    """A report that reads most models: they are made from stored raw tables."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(M.CheckedStar(stored_tables(spark, sf_dir)), *args)
    return run


def spark_queries() -> dict:
    p = PARAMS
    q = {name: _model(name) for name in M.MODEL_NAMES}
    q.update({
        "top_scorers": _question(K.top_scorers, p["season"], p["competition"], p["top_n"]),
        "league_table": _question(K.league_table, p["season"], p["competition"]),
        "team_results": _question(K.team_results, p["season"], p["competition"], p["team"]),
        "most_goals": _question(K.most_goals, p["season"], 1),
        "team_record": _question(K.team_record, p["team"], p["season"]),
        "goal_split": _question(K.goal_split),
        "best_goal_difference": _question(K.best_goal_difference, "%Mens%", 1),
        "home_away_counts": _question(K.home_away_counts),
        "upcoming": _question(K.upcoming, p["competition"]),
        "movement": _question(K.movement),
        "card_count": _question(K.card_count, p["colour"], p["season"]),
        "highest_scoring": _question(K.highest_scoring, 5),
        "division_results": _question(K.division_results, p["competition"]),
        "scorer_consistency": _question(K.scorer_consistency, p["seasons"]),
        "scorer_profile": _question(K.scorer_profile, p["profile_competitions"], p["season"]),
        "goal_share": _question(K.goal_share, p["season"]),
        "tier_shortlist": _question(K.tier_shortlist, p["gender"], p["tiers"], p["season"], p["top_n"]),
        "team_journey": _question(K.team_journey, p["team"]),
        "competition_catalogue": _question(CT.catalogue),
        "unknown_competitions": _question(CT.unknown_competitions, p["ending_levels"]),
        "season_coverage": _question(CT.season_coverage, p["asked_seasons"]),
        "dq_not_null": _question(Q.not_null_report),
        "dq_unique": _question(Q.unique_report),
        "dq_relationships": _checked(Q.relationships_report),
        "dq_accepted_values": _question(Q.accepted_values_report),
        "dq_future_results": _question(Q.future_results, p["as_of"]),
        "dq_tbc_teams": _question(Q.tbc_teams),
        "dq_summary": _checked(Q.summary, p["as_of"]),
        "gate_decision": _checked(Q.gate_decision, p["as_of"]),
        "gate_clean": LD.gate_clean,
        "dq_unexpected_values": _question(Q.unexpected_values, "fct_match_events", "event_subtype", ["FG", "Green"]),
        "capped_rows": _question(K.capped_matches, 50),
        "upsert_matches": A.upserted_matches,
        "upsert_counts": A.matches_upsert_counts,
        "high_water_mark": A.high_water_mark,
        "event_work": A.event_work,
        "event_work_counters": A.event_work_counters,
        "pending_matches": A.pending_matches,
        "days_since": A.days_since,
        "run_summary": A.run_summary,
        "csv_round_trip": LD.csv_round_trip,
        "raw_counts": LD.raw_counts,
        "load_overwrite": LD.load_overwrite,
        "count_diff": LD.count_diff,
        "source_lookup": LD.source_lookup,
        "promote_round_trip": LD.promote_round_trip,
        "publish_versions": LD.publish_versions,
        "merge_parts": LD.merge_parts,
        "sequenced_upsert": LD.sequenced_upsert,
        "raw_rejects": LD.raw_rejects,
        "page_elements": X.article_elements,
        "page_sections": X.article_sections,
        "page_rows": X.parsed_matches,
        "page_standings": X.parsed_standings,
        "page_header": X.parsed_headers,
        "page_events": X.parsed_events,
        "page_dedupe": X.dedupe_matches,
        "page_cap": X.capped_matches,
        "page_total_cap": X.total_capped_matches,
        "page_first_match": X.page_headings,
        "page_missing": X.missing_pages,
        "page_days": X.match_days,
        "expr_names": XP.names,
        "expr_phase_gender": XP.phase_gender,
        "expr_ints": XP.ints,
        "expr_minute": XP.minutes,
        "expr_icon": XP.icons,
        "expr_player": XP.players,
        "expr_dates": XP.dates,
        "ask_goals_by_team": _question(AK.ask, "fct_match_events", {"goals": ("count", "event_id")},
                                       ["season_name", "team_name"], {"event_type": "goal"}),
        "ask_home_team": _question(AK.ask, "fct_matches", {"scored": ("sum", "home_score"), "matches": ("count", "match_id")},
                                   ["season_name", "home_team.team_name"], {"competition_name": ("like", "%Premier%")}),
        "ask_opponent": _question(AK.ask, "fct_team_matches", {"matches": ("count", "team_match_id")},
                                  ["team_name", "opponent.team_name"],
                                  {"season_name": ("between", ("1996-1997", "1998-1999")), "opponent.team_name": ("like", "%_1%")}),
        "ask_top_members": _question(AK.ask, "fct_match_events", {"goals": ("count", "event_id")},
                                     ["player_name", "season_name"], {"event_type": "goal", "minute": (">=", 10)},
                                     (5, "goals", ["player_name"])),
        "stream_upsert": ST.stream_upsert,
    })
    return q


def oracle_queries() -> dict:
    from oracle import models as OM
    from oracle import expressions as OE
    from oracle import extraction as OX
    from oracle import incremental as OI
    from oracle import loading as OL
    from oracle import quality as OD
    from oracle import questions as OQ
    p = PARAMS
    o = {name: OM.model_sql(name) for name in M.MODEL_NAMES}
    o.update({
        "top_scorers": OQ.top_scorers(p["season"], p["competition"], p["top_n"]),
        "league_table": OQ.league_table(p["season"], p["competition"]),
        "team_results": OQ.team_results(p["season"], p["competition"], p["team"]),
        "most_goals": OQ.most_goals(p["season"], 1),
        "team_record": OQ.team_record(p["team"], p["season"]),
        "goal_split": OQ.goal_split(),
        "best_goal_difference": OQ.best_goal_difference("%Mens%", 1),
        "home_away_counts": OQ.home_away_counts(),
        "upcoming": OQ.upcoming(p["competition"]),
        "movement": OQ.movement(),
        "card_count": OQ.card_count(p["colour"], p["season"]),
        "highest_scoring": OQ.highest_scoring(5),
        "division_results": OQ.division_results(p["competition"]),
        "scorer_consistency": OQ.scorer_consistency(p["seasons"]),
        "scorer_profile": OQ.scorer_profile(p["profile_competitions"], p["season"]),
        "goal_share": OQ.goal_share(p["season"]),
        "tier_shortlist": OQ.tier_shortlist(p["gender"], p["tiers"], p["season"], p["top_n"]),
        "team_journey": OQ.team_journey(p["team"]),
        "competition_catalogue": OQ.competition_catalogue(),
        "unknown_competitions": OQ.unknown_competitions(p["ending_levels"]),
        "season_coverage": OQ.season_coverage(p["asked_seasons"]),
        "dq_not_null": OD.not_null_sql(),
        "dq_unique": OD.unique_sql(),
        "dq_relationships": OD.relationships_sql(),
        "dq_accepted_values": OD.accepted_values_sql(),
        "dq_future_results": OD.future_sql(p["as_of"]),
        "dq_tbc_teams": OD.tbc_sql(),
        "dq_summary": OD.summary_sql(p["as_of"]),
        "gate_decision": OD.gate_sql(p["as_of"]),
        "gate_clean": OL.gate_clean(),
        "dq_unexpected_values": OD.unexpected_sql("fct_match_events", "event_subtype", ["FG", "Green"]),
        "capped_rows": OQ.capped_matches(50),
        "upsert_matches": OI.upsert_matches(),
        "upsert_counts": OI.upsert_counts(),
        "high_water_mark": OI.high_water_mark(),
        "event_work": OI.event_work(),
        "event_work_counters": OI.event_work_counters(),
        "pending_matches": OI.pending_matches(),
        "days_since": OI.days_since(),
        "run_summary": OI.run_summary(),
        "csv_round_trip": OL.csv_round_trip(),
        "raw_counts": OL.raw_counts(),
        "load_overwrite": OL.load_overwrite(),
        "count_diff": OL.count_diff(),
        "source_lookup": OL.source_lookup(),
        "promote_round_trip": OL.promote_round_trip(),
        "publish_versions": OL.publish_versions(),
        "merge_parts": OL.merge_parts(),
        "sequenced_upsert": OL.sequenced_upsert(),
        "raw_rejects": OL.raw_rejects(),
        "page_elements": OX.page_elements(),
        "page_sections": OX.page_sections(),
        "page_rows": OX.page_rows(),
        "page_standings": OX.page_standings(),
        "page_header": OX.page_header(),
        "page_events": OX.page_events(),
        "page_dedupe": OX.page_dedupe(),
        "page_cap": OX.page_cap(),
        "page_total_cap": OX.page_total_cap(),
        "page_first_match": OX.page_first_match(),
        "page_missing": OX.page_missing(),
        "page_days": OX.page_days(),
        "expr_names": OE.names(),
        "expr_phase_gender": OE.phase_gender(),
        "expr_ints": OE.ints(),
        "expr_minute": OE.minutes(),
        "expr_icon": OE.icons(),
        "expr_player": OE.players(),
        "expr_dates": OE.dates(),
        "ask_goals_by_team": OQ.ask_goals_by_team(),
        "ask_home_team": OQ.ask_home_team(),
        "ask_opponent": OQ.ask_opponent(),
        "ask_top_members": OQ.ask_top_members(),
        "stream_upsert": OI.upsert_matches(),
    })
    return o
