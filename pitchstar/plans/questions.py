"""The analytic questions (K1-K18) as parameterised DataFrame queries on
the star. Each takes a ``Star`` (see plans.models) and returns a lazy
DataFrame with aliased, stable column names.

Join path for season filters: event -> match -> season (the event fact has
no season). Season lookups use ``left_semi`` joins so a repeated match_id
cannot fan events out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import share, total_goals
from .catalogue import competitions_of
from ..operators.topn import cap_rows, top_members, top_rows
from .models import Star


def _listify(x):
    return [x] if isinstance(x, str) else list(x)


def season_ids(star: Star, seasons) -> DataFrame:
    """Ids of the named seasons (one row per season: bounded, broadcast)."""
    return F.broadcast(star["dim_seasons"].filter(F.col("season_name").isin(_listify(seasons)))
                       .select("season_id"))


def matches_in(star: Star, seasons) -> DataFrame:
    return star["fct_matches"].join(season_ids(star, seasons), "season_id", "left_semi")


def events_in(star: Star, seasons=None, competitions=None, event_type=None) -> DataFrame:
    """Events filtered on the event fact first (pushed down), then by season
    through the match."""
    e = star["fct_match_events"]
    if event_type is not None:
        e = e.filter(F.col("event_type") == event_type)
    if competitions is not None:
        e = e.filter(F.col("competition_name").isin(_listify(competitions)))
    if seasons is not None:
        e = e.join(matches_in(star, seasons).select("match_id"), "match_id", "left_semi")
    return e


def match_seasons(star: Star, seasons=None) -> DataFrame:
    """match_id -> season_name, one row per match_id (the id hashes the
    season, so repeats of an id share it); only the given seasons if any."""
    m = star["fct_matches"] if seasons is None else matches_in(star, seasons)
    ms = m.select("match_id", "season_id").dropDuplicates(["match_id"])
    return ms.join(F.broadcast(star["dim_seasons"].select("season_id", "season_name")),
                   "season_id", "left").select("match_id", "season_name")


def _with_player_names(df: DataFrame, star: Star) -> DataFrame:
    return df.join(star["dim_players"], "player_id", "left")


def _scorers(goals: DataFrame, star: Star, n: int) -> DataFrame:
    """H2 on goals: count per (player, team), keep the top-n players by
    their total, show every team row of those players."""
    fine = goals.groupBy("player_id", "team_name").agg(F.count(F.lit(1)).alias("goals"))
    fine = _with_player_names(fine, star)
    top = top_members(fine, ["player_id", "player_name"], "goals", n,
                      tie_cols=["player_name", "player_id"])
    return top.select("player_name", "team_name", "goals")


# K1
def top_scorers(star: Star, season: str, competition: str, n: int = 10) -> DataFrame:
    return _scorers(events_in(star, season, competition, "goal"), star, n)


# K2
def league_table(star: Star, season: str, competition: str) -> DataFrame:
    st = (star["fct_standings"].filter(F.col("competition_name") == competition)
          .join(season_ids(star, season), "season_id", "left_semi"))
    return st.groupBy("team_name").agg(F.min("position").alias("position"),
                                       F.sum("points").alias("points"))


# K3
def team_results(star: Star, season: str, competition: str, team: str) -> DataFrame:
    m = matches_in(star, season).filter(
        (F.col("competition_name") == competition) & (F.col("match_status") == "Completed")
        & ((F.col("home_team_name") == team) | (F.col("away_team_name") == team)))
    return m.select("match_date", "home_team_name", "away_team_name", "home_score",
                    "away_score").orderBy(F.desc("match_date"))


# K4
def most_goals(star: Star, season: str, n: int = 1) -> DataFrame:
    st = star["fct_standings"].join(season_ids(star, season), "season_id", "left_semi")
    t = st.groupBy("team_name").agg(F.sum("goals_for").alias("goals_for"))
    return top_rows(t, [F.desc("goals_for"), F.asc("team_name")], n)


# K5
def team_record(star: Star, team: str, season: str) -> DataFrame:
    st = (star["fct_standings"].filter(F.col("team_name") == team)
          .join(season_ids(star, season), "season_id", "left_semi"))
    return st.select("competition_name", "played", "won", "drawn", "lost")


# K6 / F6
SUBTYPES = {"goal": ["FG", "PC", "PS"], "card": ["Green", "Yellow", "Red"]}


def goal_split(star: Star, seasons=None, competitions=None) -> DataFrame:
    g = events_in(star, seasons, competitions, "goal")
    return g.groupBy("event_subtype").agg(F.count(F.lit(1)).alias("goals"))


def split_counts(events: DataFrame, by: list[str], event_type: str = "goal") -> DataFrame:
    """one count column per subtype (fixed list, so the pivot needs no
    extra pass to discover values)."""
    vals = SUBTYPES[event_type]
    p = events.groupBy(*by).pivot("event_subtype", vals).agg(F.count(F.lit(1)))
    return p.select(*by, *[F.coalesce(F.col(v), F.lit(0)).cast("bigint").alias(v.lower())
                          for v in vals])


# K7
def best_goal_difference(star: Star, group_like: str = "%Mens%", n: int = 1) -> DataFrame:
    st = star["fct_standings"].filter(F.col("competition_group").like(group_like))
    st = st.select("team_name", "competition_name", "season_id", "phase_id", "goal_difference")
    return top_rows(st, [F.desc("goal_difference"), F.asc("team_name"), F.asc("competition_name"),
                         F.asc_nulls_first("season_id"), F.asc_nulls_first("phase_id")], n)


# K8
def home_away_counts(star: Star) -> DataFrame:
    tm = star["fct_team_matches"]
    team = F.when(F.col("is_home"), F.col("home_team_name")).otherwise(F.col("away_team_name"))
    return tm.groupBy(team.alias("team_name"), "is_home").agg(F.count(F.lit(1)).alias("matches"))


# K9
def upcoming(star: Star, competition: str) -> DataFrame:
    m = star["fct_matches"].filter((F.col("match_status") == "Upcoming")
                                   & (F.col("competition_name") == competition))
    return m.select("match_id", "match_date", "match_time", "home_team_name",
                    "away_team_name", "venue").orderBy("match_date")


# K10
def movement(star: Star) -> DataFrame:
    """Position against the previous season in the same competition: an
    equi-join on (team, competition, season_id - 1), so no window has to
    hold a whole team history in one task."""
    st = star["fct_standings"].select("team_name", "competition_name", "season_id", "position")
    prev = st.select(F.col("team_name").alias("_t"), F.col("competition_name").alias("_c"),
                     (F.col("season_id") + 1).alias("_s"), F.col("position").alias("prev_position"))
    j = st.join(prev, (st.team_name == prev._t) & (st.competition_name == prev._c)
                & (st.season_id == prev._s), "left")
    return j.select("team_name", "competition_name", "season_id", "position", "prev_position",
                    (F.col("prev_position") - F.col("position")).alias("places_gained"))


# K11
def card_count(star: Star, colour: str, season: str) -> DataFrame:
    c = events_in(star, season, None, "card").filter(F.col("event_subtype") == colour)
    return c.agg(F.count(F.lit(1)).alias("cards"))


# K12
def highest_scoring(star: Star, n: int = 5) -> DataFrame:
    m = star["fct_matches"].filter(F.col("home_score").isNotNull() & F.col("away_score").isNotNull())
    m = m.select("match_id", "match_date", "home_team_name", "away_team_name", "home_score",
                 "away_score", total_goals().alias("total_goals"))
    return top_rows(m, [F.desc("total_goals"), F.asc("match_date"), F.asc("match_id"),
                        F.desc("home_score")], n)


# K13
def division_results(star: Star, competition: str) -> DataFrame:
    m = star["fct_matches"].filter((F.col("competition_name") == competition)
                                   & (F.col("match_status") == "Completed"))
    return m.select("match_id", "match_date", "home_team_name", "away_team_name",
                    "home_score", "away_score")


def season_column(season: str) -> str:
    return "goals_" + season.replace("-", "_")


# K14
def scorer_consistency(star: Star, seasons: list[str], competitions=None) -> DataFrame:
    """Goals per player per season side by side; a season without goals is
    NULL (blank). The season list is fixed, so the pivot skips the
    value-discovery job."""
    # one inner join both restricts to the seasons and names the season
    g = events_in(star, None, competitions, "goal")
    g = g.join(match_seasons(star, seasons), "match_id", "inner")
    per = g.groupBy("player_id", "season_name").agg(F.count(F.lit(1)).alias("goals"))
    wide = per.groupBy("player_id").pivot("season_name", list(seasons)).agg(F.first("goals"))
    wide = _with_player_names(wide, star)
    return wide.select("player_name", *[F.col(f"`{s}`").alias(season_column(s)) for s in seasons])


# K15
def scorer_profile(star: Star, competitions, season: str) -> DataFrame:
    g = events_in(star, season, competitions, "goal")
    p = split_counts(g, ["player_id", "team_name"], "goal")
    p = _with_player_names(p, star)
    goals = F.col("fg") + F.col("pc") + F.col("ps")
    return p.select("player_name", "team_name", "fg", "pc", "ps", goals.alias("goals"),
                    F.round(share("pc", goals), 4).alias("pc_share"))


# K16
def goal_share(star: Star, season: str) -> DataFrame:
    g = events_in(star, season, None, "goal")
    per = g.groupBy("player_id", "team_name", "competition_name").agg(F.count(F.lit(1)).alias("goals"))
    team = per.groupBy("team_name", "competition_name").agg(F.sum("goals").alias("team_goals"))
    st = (star["fct_standings"].join(season_ids(star, season), "season_id", "left_semi")
          .select("team_name", "competition_name", "position"))
    j = (per.join(team, ["team_name", "competition_name"], "left")
         .join(st, ["team_name", "competition_name"], "left"))
    j = _with_player_names(j, star)
    return j.select("player_name", "team_name", "competition_name", "goals", "team_goals",
                    F.round(share("goals", "team_goals"), 4).alias("goal_share"), "position")


# K17
def tier_shortlist(star: Star, gender: str, tiers, season: str, n: int = 10) -> DataFrame:
    """Scorers of the competitions that the catalogue places in ``tiers``."""
    held = competitions_of(star, gender, tiers, season)
    g = events_in(star, season, None, "goal")
    g = g.join(held, (g.competition_name == held.held_name) & g.competition_group.eqNullSafe(held.held_group), "left_semi")
    return _scorers(g, star, n)


# K18
def team_journey(star: Star, team: str) -> DataFrame:
    tm = star["fct_team_matches"]
    me = F.when(F.col("is_home"), F.col("home_team_name")).otherwise(F.col("away_team_name"))
    opp = F.when(F.col("is_home"), F.col("away_team_name")).otherwise(F.col("home_team_name"))
    gf = F.when(F.col("is_home"), F.col("home_score")).otherwise(F.col("away_score"))
    ga = F.when(F.col("is_home"), F.col("away_score")).otherwise(F.col("home_score"))
    t = tm.filter(me == team).select("match_id", "match_date", "competition_name", "is_home",
                                     opp.alias("opponent"), gf.alias("goals_for"),
                                     ga.alias("goals_against"))
    res = (F.when(F.col("goals_for") > F.col("goals_against"), F.lit("W"))
           .when(F.col("goals_for") == F.col("goals_against"), F.lit("D"))
           .when(F.col("goals_for") < F.col("goals_against"), F.lit("L")))
    return t.withColumn("result", res)


def capped_matches(star, n: int) -> DataFrame:
    """H3: the latest matches, at most ``n`` rows."""
    m = star["fct_matches"].select("match_id", "match_date", "home_team_name", "away_team_name")
    return cap_rows(m, n, [F.desc("match_date"), F.col("match_id")])
