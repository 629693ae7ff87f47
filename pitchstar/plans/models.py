"""The star schema: 3 staging, 2 intermediate, 4 dimension and 4 fact
models (D1-D13), each a function from DataFrames to a lazy DataFrame.

``Star`` wires them together and memoises each model so a model used by
several others is planned once. Nothing runs until an action, except the
dimension numbering, which writes a checkpoint (see operators.numbering), and
the dimensions themselves, which are stored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import packed, surrogate_key, unpacked
from ..functions.text import date_of, match_status
from ..operators.lookup import lookup_fk, lookup_roles
from ..operators.numbering import number_rows
from ..sources.raw import stored

# --------------------------------------------------------------- staging


def stg_standings(raw: DataFrame) -> DataFrame:
    """Casts plus a hashed key over the natural key."""
    return raw.select(
        surrogate_key("season", "phase", "competition_group", "competition", "team").alias("standing_id"),
        *[F.col(c).cast("string").alias(c) for c in
          ("season", "phase", "competition_group", "competition", "team")],
        *[F.col(c).cast("bigint").alias(c) for c in
          ("position", "played", "won", "drawn", "lost", "goals_for",
           "goals_against", "goal_difference", "points")],
        F.col("standings_url"),
        F.col("scraped_at").cast("timestamp_ntz").alias("scraped_at"),
    )


def stg_matches(raw: DataFrame) -> DataFrame:
    """D2."""
    return raw.select(
        surrogate_key("season", "competition", "match_date", "home_team", "away_team").alias("match_id"),
        *[F.col(c).cast("string").alias(c) for c in
          ("season", "phase", "competition_group", "competition", "home_team",
           "away_team", "venue")],
        F.col("match_date").cast("date").alias("match_date"),
        F.col("match_time").cast("string").alias("match_time"),
        F.col("home_score").cast("bigint").alias("home_score"),
        F.col("away_score").cast("bigint").alias("away_score"),
        F.col("match_url"),
        F.col("scraped_at").cast("timestamp_ntz").alias("scraped_at"),
    )


def stg_match_events(raw: DataFrame) -> DataFrame:
    """D3: keeps logos and the match URL."""
    return raw.select(
        surrogate_key("match_url", "event_type", "team", "player_name", "minute").alias("event_id"),
        *[F.col(c).cast("string").alias(c) for c in
          ("season", "event_type", "event_subtype", "team", "player_name",
           "home_team", "away_team")],
        F.col("minute").cast("bigint").alias("minute"),
        F.col("home_logo"), F.col("away_logo"), F.col("match_url"),
        F.col("match_date").cast("date").alias("match_date"),
        F.col("scraped_at").cast("timestamp_ntz").alias("scraped_at"),
    )

# ----------------------------------------------------------- intermediate


INT_MATCH_COLS = ["match_id", "season", "phase", "competition_group", "competition",
                  "home_team", "away_team", "venue", "match_date", "match_time",
                  "home_score", "away_score", "match_url", "scraped_at"]


def int_matches(stg_m: DataFrame) -> DataFrame:
    """Adds match_status, judged against the collection date."""
    return stg_m.select(*INT_MATCH_COLS, match_status().alias("match_status"))


_TEAM_CTX = ["match_id", "season", "phase", "competition_group", "competition",
             "match_date", "match_time", "venue", "match_url", "scraped_at", "match_status"]


def _perspectives(df: DataFrame, ctx: list[str], carry: list[str] = ()) -> DataFrame:
    """Two rows per match (home view, away view) from a single scan: explode
    a two-element array instead of scanning twice for a UNION ALL."""
    views = F.array(
        F.struct(F.col("home_team").alias("team"), F.col("away_team").alias("opponent"),
                 F.lit(True).alias("is_home"), F.lit("Home").alias("home_away")),
        F.struct(F.col("away_team").alias("team"), F.col("home_team").alias("opponent"),
                 F.lit(False).alias("is_home"), F.lit("Away").alias("home_away")),
    )
    return (df.select(*ctx, *carry, F.explode(views).alias("_v"))
            .select(*ctx, *carry, "_v.team", "_v.opponent", "_v.is_home", "_v.home_away"))


def int_team_matches(int_m: DataFrame) -> DataFrame:
    """Home and away perspective of every match, keyed by (match, team)."""
    tm = _perspectives(int_m, _TEAM_CTX)
    return tm.select(surrogate_key("match_id", "team").alias("team_match_id"), *tm.columns)

# ------------------------------------------------------------- dimensions


def _members(df: DataFrame, col: str, alias: str) -> DataFrame:
    """non-NULL distinct values (partial + final hash aggregate)."""
    return df.select(F.col(col).alias(alias)).filter(F.col(alias).isNotNull()).distinct()


def dim_seasons(stg_s: DataFrame, stg_m: DataFrame) -> DataFrame:
    """Seasons named by standings, dated by matches, numbered by name."""
    seasons = number_rows(_members(stg_s, "season", "season_name"), ["season_name"], "season_id")
    dates = stg_m.groupBy("season").agg(F.min("match_date").alias("start_date"),
                                         F.max("match_date").alias("end_date"))
    # one row per season on both sides: bounded by the season count
    j = seasons.join(F.broadcast(dates), seasons.season_name == dates.season, "left")
    return j.select("season_name", "start_date", "end_date", "season_id")


def dim_phases(stg_s: DataFrame) -> DataFrame:
    """Phase 1 -> 1, Phase 2 -> 2, anything else 99; numbered by (order, name)."""
    p = _members(stg_s, "phase", "phase_name")
    p = p.withColumn("phase_order", F.when(F.col("phase_name") == "Phase 1", F.lit(1))
                     .when(F.col("phase_name") == "Phase 2", F.lit(2)).otherwise(F.lit(99)))
    return number_rows(p, ["phase_order", "phase_name"], "phase_id") \
        .select("phase_name", "phase_order", "phase_id")


def dim_teams(stg_s: DataFrame) -> DataFrame:
    """Teams named in standings (TBC placeholders are not among them)."""
    return number_rows(_members(stg_s, "team", "team_name"), ["team_name"], "team_id") \
        .select("team_name", "team_id")


def dim_players(stg_e: DataFrame) -> DataFrame:
    """Every non-NULL player name in events; same name = same player."""
    return number_rows(_members(stg_e, "player_name", "player_name"), ["player_name"], "player_id") \
        .select("player_name", "player_id")

# ------------------------------------------------------------------ facts


def fct_matches(int_m: DataFrame, seasons: DataFrame, phases: DataFrame,
                teams: DataFrame) -> DataFrame:
    """Natural keys -> dimension ids; team dim used twice (roles)."""
    # one row per season / per phase: bounded by construction
    f = lookup_fk(int_m, seasons, "season", "season_name", "season_id", small=True)
    f = lookup_fk(f, phases, "phase", "phase_name", "phase_id", small=True)
    f = lookup_roles(f, teams, "team_name", "team_id",
                     {"home_team": "home_team_id", "away_team": "away_team_id"})
    return f.select(
        "match_id", "season_id", "phase_id", "home_team_id", "away_team_id",
        F.col("home_team").alias("home_team_name"), F.col("away_team").alias("away_team_name"),
        "match_date", "match_time", "home_score", "away_score", "competition_group",
        F.col("competition").alias("competition_name"), "venue", "match_status")


def repeated_ids(int_m: DataFrame) -> DataFrame:
    """Ids that several matches share, with their number of matches, written out:
    the planner then knows how many they are."""
    ids = int_m.groupBy(packed("match_id").alias("_id")).agg(F.count(F.lit(1)).alias("_times")).filter("_times > 1")
    return stored({"repeated": ids.select(unpacked("_id").alias("_rid"), "_times")})["repeated"]


def counted_team_matches(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of fct_team_matches before ids fan out, with ``_n``, how often the model
    holds each; the scores, in which only the copies differ, are left out."""
    j = rows.drop("home_score", "away_score").join(ids, rows.match_id == ids["_rid"], "left")
    return j.withColumn("_n", F.coalesce("_times", F.lit(1).cast("bigint"))).drop("_rid", "_times")


def _with_scores(rows: DataFrame, int_m: DataFrame) -> DataFrame:
    """Rows of matches, which carry their own scores, left-joined to the scores by
    match_id (see D11)."""
    ids = repeated_ids(int_m)
    if ids.isEmpty():
        return _null_scores(rows)
    once, more = (rows.join(ids, rows.match_id == ids["_rid"], how) for how in ("left_anti", "left_semi"))
    scores = repeated_scores(int_m, ids).withColumnRenamed("match_id", "_sid")
    bare = more.drop("home_score", "away_score")
    again = bare.join(scores, bare.match_id == scores._sid, "left").drop("_sid")
    return _null_scores(once.unionByName(again.select(*once.columns)))


def repeated_scores(int_m: DataFrame, ids: DataFrame) -> DataFrame:
    return int_m.join(ids, int_m.match_id == ids["_rid"], "left_semi").select("match_id", "home_score", "away_score")


def _null_scores(ws: DataFrame) -> DataFrame:
    """A row without an id meets no scores in the join of D11."""
    for c in ("home_score", "away_score"):
        ws = ws.withColumn(c, F.when(F.col("match_id").isNotNull(), F.col(c)))
    return ws


def fct_team_matches(int_m: DataFrame, seasons: DataFrame, phases: DataFrame,
                     teams: DataFrame, fan_out: bool = True) -> DataFrame:
    """Team perspective with scores and five keys.

    The model joins scores on match_id, so an id that occurs k times fans out
    (k rows -> k*k per side). Ids are counted first, on the key column alone, and
    those that repeat are written out: a row whose id is unique carries its own
    scores through the explode, and only rows of repeated ids are joined, after
    keys and ids are looked up, once for each row that the join repeats. Clean
    data has none (the unique test on match_id blocks publication), so no row
    meets an exchange for its scores. ``fan_out=False`` takes every id as unique.
    """
    tm = _perspectives(int_m, _TEAM_CTX, carry=["home_score", "away_score"])
    tm = tm.withColumn("team_match_id", surrogate_key("match_id", "team"))
    f = lookup_fk(tm, seasons, "season", "season_name", "season_id", small=True)
    f = lookup_fk(f, phases, "phase", "phase_name", "phase_id", small=True)
    f = lookup_roles(f, teams, "team_name", "team_id",
                     {"team": "team_id", "opponent": "opponent_id"})
    home = F.when(F.col("is_home"), F.col("team")).otherwise(F.col("opponent"))
    away = F.when(F.col("is_home"), F.col("opponent")).otherwise(F.col("team"))
    f = f.select(
        "team_match_id", "match_id", "season_id", "phase_id", "team_id", "opponent_id",
        "competition_group", F.col("competition").alias("competition_name"),
        "is_home", "match_date", "venue", "home_score", "away_score",
        home.alias("home_team_name"), away.alias("away_team_name"))
    return (_with_scores(f, int_m) if fan_out else _null_scores(f)).select(*f.columns)


def fct_match_events(stg_e: DataFrame, stg_m: DataFrame, players: DataFrame,
                     teams: DataFrame) -> DataFrame:
    """Events -> match (by URL), player and team ids.

    The match side grows with the data, so that join is a shuffle join on the
    URL (AQE may still broadcast it when the measured side is small, and splits
    the events of a hot or empty URL); ids are looked up before it and keys cross
    it as bytes. Events without a URL have no match: each
    gets a key of its own that no match has, so they spread over all tasks
    instead of meeting in one under the null key.
    """
    m = stg_m.select(F.col("match_url").alias("_url"), packed("match_id").alias("_match"), "competition_group",
                     F.col("competition").alias("competition_name"))
    e = stg_e.withColumn("_key", F.coalesce("match_url", F.concat(F.lit("\u0000"), "event_id")))
    e = lookup_fk(e, players, "player_name", "player_name", "player_id")
    e = lookup_fk(e, teams, "team", "team_name", "team_id")
    e = e.withColumn("event_id", packed("event_id"))
    e = e.join(m, e["_key"] == m["_url"], "left").drop("_key")
    return e.select(unpacked("event_id").alias("event_id"), unpacked("_match").alias("match_id"), "player_id", "team_id",
                    F.col("team").alias("team_name"), "competition_group",
                    "competition_name", "event_type", "event_subtype", "minute")


def fct_standings(stg_s: DataFrame, seasons: DataFrame, phases: DataFrame,
                  teams: DataFrame) -> DataFrame:
    """Standings with season, phase and team ids plus snapshot date."""
    f = lookup_fk(stg_s, seasons, "season", "season_name", "season_id", small=True)
    f = lookup_fk(f, phases, "phase", "phase_name", "phase_id", small=True)
    f = lookup_fk(f, teams, "team", "team_name", "team_id")
    return f.select(
        F.col("standing_id").alias("standings_id"), "season_id", "phase_id", "team_id",
        F.col("team").alias("team_name"), "competition_group",
        F.col("competition").alias("competition_name"), "position", "played", "won",
        "drawn", "lost", "goals_for", "goals_against", "goal_difference", "points",
        date_of("scraped_at").alias("snapshot_date"))

# ------------------------------------------------------------------- star


MODEL_NAMES = ["stg_standings", "stg_matches", "stg_match_events", "int_matches",
               "int_team_matches", "dim_seasons", "dim_phases", "dim_teams",
               "dim_players", "fct_matches", "fct_team_matches", "fct_match_events",
               "fct_standings"]


class Star:
    """Lazy, memoised access to every model built from three raw tables.

    ``star["fct_matches"]`` plans the model (and what it depends on) once.
    Dimensions are numbered through a checkpoint, so reading one triggers a
    small job; facts stay lazy until an action.
    """

    def __init__(self, raw: dict[str, DataFrame]):
        self.raw = raw
        self._m: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._m:
            df = getattr(self, "_" + name)()
            # the planner knows the size of a stored dimension, so facts are not shuffled to look up a small one
            self._m[name] = stored({name: df})[name] if name.startswith("dim_") else df
        return self._m[name]

    def counted(self, name: str) -> DataFrame:
        """A model's rows with ``_n``, how often it holds each, for reports that
        count them; ids that fan out are counted without making their pairs."""
        if name != "fct_team_matches":
            return self[name].withColumn("_n", F.lit(1).cast("bigint"))
        if "_counted" not in self._m:
            rows = fct_team_matches(self["int_matches"], self["dim_seasons"], self["dim_phases"], self["dim_teams"], fan_out=False)
            self._m["_counted"] = counted_team_matches(rows, repeated_ids(self["int_matches"]))
        return self._m["_counted"]

    def __iter__(self):
        return iter(MODEL_NAMES)

    def _stg_standings(self): return stg_standings(self.raw["standings"])
    def _stg_matches(self): return stg_matches(self.raw["matches"])
    def _stg_match_events(self): return stg_match_events(self.raw["match_events"])
    def _int_matches(self): return int_matches(self["stg_matches"])
    def _int_team_matches(self): return int_team_matches(self["int_matches"])
    def _dim_seasons(self): return dim_seasons(self["stg_standings"], self["stg_matches"])
    def _dim_phases(self): return dim_phases(self["stg_standings"])
    def _dim_teams(self): return dim_teams(self["stg_standings"])
    def _dim_players(self): return dim_players(self["stg_match_events"])

    def _fct_matches(self):
        return fct_matches(self["int_matches"], self["dim_seasons"], self["dim_phases"],
                           self["dim_teams"])

    def _fct_team_matches(self):
        return fct_team_matches(self["int_matches"], self["dim_seasons"], self["dim_phases"],
                                self["dim_teams"])

    def _fct_match_events(self):
        return fct_match_events(self["stg_match_events"], self["stg_matches"],
                                self["dim_players"], self["dim_teams"])

    def _fct_standings(self):
        return fct_standings(self["stg_standings"], self["dim_seasons"], self["dim_phases"],
                             self["dim_teams"])


class CheckedStar(Star):
    """A Star for reports that read each model several times: events, which join
    the two large tables, are made once and stored."""

    def _fct_match_events(self): return stored({"fct_match_events": super()._fct_match_events()})["fct_match_events"]


def build_star(raw: dict[str, DataFrame]) -> Star:
    return Star(raw)
