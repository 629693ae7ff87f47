"""Data-quality checks as Spark jobs (Q1-Q7).

Each check returns a DataFrame of failing rows (or a per-column failure
count); ``run_checks`` unions every check of the model tests into one
summary frame (check, model, column, severity, failures). Not-null checks of a
table share a single scan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import packed
from ..session import release
from .lookup import orphans

# The model tests, in the order they are declared.
# (model, column, test, argument, severity)
MODEL_TESTS = [
    ("stg_standings", "standing_id", "unique", None, "error"),
    ("stg_standings", "standing_id", "not_null", None, "error"),
    ("stg_standings", "season", "not_null", None, "error"),
    ("stg_standings", "team", "not_null", None, "error"),
    ("stg_matches", "match_id", "unique", None, "error"),
    ("stg_matches", "match_id", "not_null", None, "error"),
    ("stg_matches", "season", "not_null", None, "error"),
    ("stg_matches", "match_date", "not_null", None, "error"),
    ("stg_matches", "home_team", "not_null", None, "error"),
    ("stg_matches", "away_team", "not_null", None, "error"),
    ("stg_matches", "venue", "not_null", None, "warn"),
    ("stg_match_events", "event_id", "unique", None, "error"),
    ("stg_match_events", "event_id", "not_null", None, "error"),
    ("stg_match_events", "event_type", "not_null", None, "error"),
    ("stg_match_events", "match_url", "not_null", None, "error"),
    ("stg_match_events", "match_url", "relationships", ("stg_matches", "match_url"), "error"),
    ("int_matches", "match_status", "not_null", None, "error"),
    ("int_matches", "match_status", "accepted_values", ("Completed", "Upcoming", "Missing result"), "error"),
    ("int_team_matches", "team_match_id", "unique", None, "error"),
    ("int_team_matches", "team_match_id", "not_null", None, "error"),
    ("int_team_matches", "team", "not_null", None, "error"),
    ("int_team_matches", "opponent", "not_null", None, "error"),
    ("int_team_matches", "is_home", "not_null", None, "error"),
    ("int_team_matches", "home_away", "not_null", None, "error"),
    ("int_team_matches", "home_away", "accepted_values", ("Home", "Away"), "error"),
    ("dim_seasons", "season_id", "unique", None, "error"),
    ("dim_seasons", "season_id", "not_null", None, "error"),
    ("dim_seasons", "season_name", "unique", None, "error"),
    ("dim_seasons", "season_name", "not_null", None, "error"),
    ("dim_seasons", "start_date", "not_null", None, "error"),
    ("dim_seasons", "end_date", "not_null", None, "error"),
    ("dim_phases", "phase_id", "unique", None, "error"),
    ("dim_phases", "phase_id", "not_null", None, "error"),
    ("dim_phases", "phase_name", "unique", None, "error"),
    ("dim_phases", "phase_name", "not_null", None, "error"),
    ("dim_phases", "phase_order", "not_null", None, "error"),
    ("dim_teams", "team_id", "unique", None, "error"),
    ("dim_teams", "team_id", "not_null", None, "error"),
    ("dim_teams", "team_name", "unique", None, "error"),
    ("dim_teams", "team_name", "not_null", None, "error"),
    ("dim_players", "player_id", "unique", None, "error"),
    ("dim_players", "player_id", "not_null", None, "error"),
    ("dim_players", "player_name", "unique", None, "error"),
    ("dim_players", "player_name", "not_null", None, "error"),
    ("fct_matches", "match_id", "unique", None, "error"),
    ("fct_matches", "match_id", "not_null", None, "error"),
    ("fct_matches", "season_id", "not_null", None, "error"),
    ("fct_matches", "season_id", "relationships", ("dim_seasons", "season_id"), "error"),
    ("fct_matches", "phase_id", "not_null", None, "warn"),
    ("fct_matches", "phase_id", "relationships", ("dim_phases", "phase_id"), "error"),
    ("fct_matches", "home_team_id", "relationships", ("dim_teams", "team_id"), "error"),
    ("fct_matches", "away_team_id", "relationships", ("dim_teams", "team_id"), "error"),
    ("fct_matches", "home_team_name", "not_null", None, "error"),
    ("fct_matches", "away_team_name", "not_null", None, "error"),
    ("fct_matches", "competition_group", "not_null", None, "error"),
    ("fct_matches", "competition_name", "not_null", None, "error"),
    ("fct_matches", "match_date", "not_null", None, "error"),
    ("fct_matches", "match_status", "not_null", None, "error"),
    ("fct_team_matches", "team_match_id", "unique", None, "error"),
    ("fct_team_matches", "team_match_id", "not_null", None, "error"),
    ("fct_team_matches", "match_id", "not_null", None, "error"),
    ("fct_team_matches", "match_id", "relationships", ("fct_matches", "match_id"), "error"),
    ("fct_team_matches", "season_id", "not_null", None, "error"),
    ("fct_team_matches", "season_id", "relationships", ("dim_seasons", "season_id"), "error"),
    ("fct_team_matches", "phase_id", "not_null", None, "warn"),
    ("fct_team_matches", "phase_id", "relationships", ("dim_phases", "phase_id"), "error"),
    ("fct_team_matches", "team_id", "relationships", ("dim_teams", "team_id"), "error"),
    ("fct_team_matches", "opponent_id", "relationships", ("dim_teams", "team_id"), "error"),
    ("fct_team_matches", "home_team_name", "not_null", None, "error"),
    ("fct_team_matches", "away_team_name", "not_null", None, "error"),
    ("fct_team_matches", "competition_group", "not_null", None, "error"),
    ("fct_team_matches", "competition_name", "not_null", None, "error"),
    ("fct_team_matches", "is_home", "not_null", None, "error"),
    ("fct_team_matches", "match_date", "not_null", None, "error"),
    ("fct_match_events", "event_id", "unique", None, "error"),
    ("fct_match_events", "event_id", "not_null", None, "error"),
    ("fct_match_events", "match_id", "not_null", None, "error"),
    ("fct_match_events", "match_id", "relationships", ("fct_matches", "match_id"), "error"),
    ("fct_match_events", "player_id", "not_null", None, "error"),
    ("fct_match_events", "player_id", "relationships", ("dim_players", "player_id"), "error"),
    ("fct_match_events", "team_id", "not_null", None, "error"),
    ("fct_match_events", "team_id", "relationships", ("dim_teams", "team_id"), "error"),
    ("fct_match_events", "team_name", "not_null", None, "error"),
    ("fct_match_events", "competition_group", "not_null", None, "error"),
    ("fct_match_events", "competition_name", "not_null", None, "error"),
    ("fct_match_events", "event_type", "not_null", None, "error"),
    ("fct_standings", "standings_id", "unique", None, "error"),
    ("fct_standings", "standings_id", "not_null", None, "error"),
    ("fct_standings", "season_id", "not_null", None, "error"),
    ("fct_standings", "season_id", "relationships", ("dim_seasons", "season_id"), "error"),
    ("fct_standings", "phase_id", "not_null", None, "warn"),
    ("fct_standings", "phase_id", "relationships", ("dim_phases", "phase_id"), "error"),
    ("fct_standings", "team_id", "not_null", None, "error"),
    ("fct_standings", "team_id", "relationships", ("dim_teams", "team_id"), "error"),
    ("fct_standings", "team_name", "not_null", None, "error"),
    ("fct_standings", "competition_group", "not_null", None, "error"),
    ("fct_standings", "competition_name", "not_null", None, "error"),
    ("fct_standings", "position", "not_null", None, "error"),
    ("fct_standings", "played", "not_null", None, "error"),
    ("fct_standings", "won", "not_null", None, "error"),
    ("fct_standings", "drawn", "not_null", None, "error"),
    ("fct_standings", "lost", "not_null", None, "error"),
    ("fct_standings", "goals_for", "not_null", None, "error"),
    ("fct_standings", "goals_against", "not_null", None, "error"),
    ("fct_standings", "goal_difference", "not_null", None, "error"),
    ("fct_standings", "points", "not_null", None, "error"),
    ("fct_standings", "snapshot_date", "not_null", None, "error"),
]
# Custom tests: (name, severity)
CUSTOM_TESTS = [("assert_no_future_results", "error"), ("warn_tbc_teams_missing_ids", "warn")]
TBC_REASON = "Placeholder opponent: no such team in the dimension yet"

SUMMARY_COLS = ["check_name", "model", "column_name", "severity", "failures"]


# Q1
def not_null(df: DataFrame, cols: list[str], times: str | None = None) -> DataFrame:
    """Per column, the number of NULL rows; all columns in one scan. ``times``: a
    column that tells how many rows each row stands for."""
    n = F.lit(1) if times is None else F.col(times)
    agg = df.agg(*[F.coalesce(F.sum(F.when(F.col(c).isNull(), n)), F.lit(0)).cast("bigint").alias(c) for c in cols])
    pairs = ", ".join(f"'{c}', `{c}`" for c in cols)
    return agg.selectExpr(f"stack({len(cols)}, {pairs}) AS (column_name, failures)")


# Q2
def unique(df: DataFrame, col: str) -> DataFrame:
    """Non-NULL values seen more than once, with their count."""
    return (df.filter(F.col(col).isNotNull()).groupBy(col)
            .agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1))


# Q3
def relationships(df: DataFrame, col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Rows whose non-NULL key has no parent row."""
    return orphans(df.select(col), parent, [col], [parent_col])


# Q4
def accepted_values(df: DataFrame, col: str, values) -> DataFrame:
    """Values outside the list, with their count (NULL is not judged)."""
    return (df.filter(F.col(col).isNotNull() & ~F.col(col).isin(list(values)))
            .groupBy(col).agg(F.count(F.lit(1)).alias("n_records")))


# Q5
def no_future_results(fct_m: DataFrame, as_of=None) -> DataFrame:
    """Matches dated after ``as_of`` (default: today) that carry a score."""
    day = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    return fct_m.filter((F.col("match_date") > day)
                        & (F.col("home_score").isNotNull() | F.col("away_score").isNotNull())) \
        .select("match_id", "match_date", "home_score", "away_score", "match_status")


# Q6
def tbc_without_ids(fct_m: DataFrame, stg_m: DataFrame) -> DataFrame:
    """Warning rows: a TBC placeholder team whose id is NULL. Inner join on
    match_id, as the test does (repeated ids fan out there too)."""
    s = stg_m.select(F.col("match_id").alias("_mid"), "home_team", "away_team")
    j = fct_m.join(s, fct_m.match_id == s._mid, "inner")
    cond = ((F.col("home_team_id").isNull() & F.col("home_team").like("TBC%"))
            | (F.col("away_team_id").isNull() & F.col("away_team").like("TBC%")))
    return j.filter(cond).select("match_id", "home_team", "away_team", "match_date",
                                 F.lit(TBC_REASON).alias("warning_reason"))


def tbc_failures(fct_m: DataFrame, stg_m: DataFrame) -> DataFrame:
    """Number of rows of ``tbc_without_ids``: both sides are counted for each id and
    the counts multiplied, so an id that repeats k times does not make k * k rows."""
    yes = lambda c: F.coalesce(c, F.lit(False))
    f = fct_m.groupBy("match_id", F.col("home_team_id").isNull().alias("fh"), F.col("away_team_id").isNull().alias("fa")).agg(F.count(F.lit(1)).alias("fn"))
    s = stg_m.groupBy(F.col("match_id").alias("_mid"), yes(F.col("home_team").like("TBC%")).alias("sh"), yes(F.col("away_team").like("TBC%")).alias("sa")) \
        .agg(F.count(F.lit(1)).alias("sn"))
    hit = (F.col("fh") & F.col("sh")) | (F.col("fa") & F.col("sa"))
    found = f.where("fh or fa").join(s.where("sh or sa"), F.col("match_id") == F.col("_mid")).where(hit)
    return found.agg(F.coalesce(F.sum(F.col("fn") * F.col("sn")), F.lit(0)).cast("bigint").alias("failures"))


def _count_row(df: DataFrame, check: str, model: str, col: str, severity: str) -> DataFrame:
    return _summary_row(df.agg(F.count(F.lit(1)).alias("failures")), check, model, col, severity)


def _summary_row(failures: DataFrame, check: str, model: str, col: str, severity: str) -> DataFrame:
    return failures.select(
        F.lit(check).alias("check_name"), F.lit(model).alias("model"),
        F.lit(col).alias("column_name"), F.lit(severity).alias("severity"), "failures")


#: Tables of a row for each season, phase, team, player or table line: their keys
#: are counted in one job.
SMALL = {"dim_seasons", "dim_phases", "dim_teams", "dim_players", "stg_standings", "fct_standings"}


def _counted(star, model: str) -> DataFrame:
    counted = getattr(star, "counted", None)
    return counted(model) if counted else star[model].withColumn("_n", F.lit(1).cast("bigint"))


def key_groups() -> dict[tuple, list[tuple]]:
    """Unique and relationships tests by the key column they are about: the column
    itself, then the columns that refer to it."""
    groups: dict[tuple, list[tuple]] = {}
    for model, col, test, arg, _ in MODEL_TESTS:
        if test == "unique":
            groups.setdefault((model, col), [(model, col)])
        elif test == "relationships":
            groups.setdefault(arg, [arg]).append((model, col))
    return groups


def group_counts(star, groups: list[list[tuple]]) -> DataFrame:
    """For each group (``g``, its place in the list) and each of its columns by
    place: ``dup`` values seen more than once, and ``lone`` rows whose value the
    first column lacks. One pass over each model and one aggregation, of values as
    bytes; a hot value is one row for each task before the shuffle."""
    reads: dict[str, list[tuple]] = {}
    for g, members in enumerate(groups):
        for at, (model, col) in enumerate(members):
            reads.setdefault(model, []).append((g, at, col))
    parts = []
    for model, cols in reads.items():
        value = lambda g, at, c: F.struct(F.lit(g).alias("g"), F.lit(at).alias("at"), packed(F.col(c).cast("string")).alias("v"))
        rows = _counted(star, model)
        rows = rows.select(value(*cols[0]).alias("x"), "_n") if len(cols) == 1 else rows.select(F.explode(F.array(*[value(*x) for x in cols])).alias("x"), "_n")
        parts.append(rows.select("x.*", "_n"))
    places = range(max(map(len, groups)))
    seen = reduce(DataFrame.unionByName, parts).groupBy("g", "v").agg(
        *[F.sum(F.when(F.col("at") == i, F.col("_n"))).alias(f"n{i}") for i in places])
    some = F.col("v").isNotNull()   # a null value is not judged
    return seen.groupBy("g").agg(*[F.count_if(some & (F.col(f"n{i}") > 1)).alias(f"dup{i}") for i in places],
                                 *[F.coalesce(F.sum(F.when(some & F.col("n0").isNull(), F.col(f"n{i}"))), F.lit(0)).alias(f"lone{i}") for i in places])


def key_failures(star) -> dict[tuple, int]:
    """Failures of every unique and relationships test, by (test, model, column,
    argument). Keys of small tables are counted in one job and the keys of each
    large one in another, one after the other, so that no more than one of these
    shuffles is on disk."""
    groups = key_groups()
    small = [k for k in groups if k[0] in SMALL]
    out: dict[tuple, int] = {}
    for keys in [small] + [[k] for k in groups if k not in small]:
        for r in group_counts(star, [groups[k] for k in keys]).collect():   # a row for each group
            key = keys[r["g"]]
            out[("unique", *key, None)] = r["dup0"]
            for at, (model, col) in enumerate(groups[key][1:], 1):
                out[("relationships", model, col, key)] = r[f"lone{at}"]
        release(star["dim_seasons"].sparkSession)
    return out


def relationship_counts(star, tests) -> DataFrame:
    """All relationships tests in one join on (parent, parent column, value).
    Child rows are counted per distinct non-NULL value first, so only values
    and counts are shuffled, however often a value occurs; an outer join with
    a marker keeps Catalyst from pushing one join into every branch."""
    child = reduce(DataFrame.unionByName, [
        star[m].select(F.lit(m).alias("model"), F.lit(c).alias("column_name"),
                       F.lit(f"{a[0]}.{a[1]}").alias("_parent"), F.col(c).cast("string").alias("value"))
        .filter(F.col("value").isNotNull())
        for m, c, a in tests])
    child = child.groupBy("model", "column_name", "_parent", "value").agg(F.count(F.lit(1)).alias("_n"))
    parents = reduce(DataFrame.unionByName, [
        star[p].select(F.lit(f"{p}.{k}").alias("_parent"), F.col(k).cast("string").alias("value"))
        for p, k in sorted({(a[0], a[1]) for _, _, a in tests})]).distinct()
    seen = parents.withColumn("_found", F.lit(True))
    orphan = child.join(seen, ["_parent", "value"], "left").filter(F.col("_found").isNull())
    return orphan.groupBy("model", "column_name").agg(F.sum("_n").alias("failures"), F.min("value").alias("sample_value"))


# Q7
def run_checks(star, as_of=None) -> DataFrame:
    """Every model test plus the two custom tests as one summary frame.

    ``star`` maps a model name to a DataFrame (a ``Star`` or stored tables).
    not_null tests share one scan per table; unique and relationships tests are
    counted at once, a key at a time (see ``key_failures``).
    """
    parts: list[DataFrame] = []
    nn: dict[str, list[tuple[str, str]]] = {}
    for model, col, test, arg, sev in MODEL_TESTS:
        if test == "not_null":
            nn.setdefault(model, []).append((col, sev))
    for model, cols in nn.items():
        counts = not_null(_counted(star, model), [c for c, _ in cols], "_n")
        sev = F.create_map(*[x for c, s in cols for x in (F.lit(c), F.lit(s))])
        parts.append(counts.select(
            F.lit("not_null").alias("check_name"), F.lit(model).alias("model"), "column_name",
            sev[F.col("column_name")].alias("severity"), F.col("failures").cast("bigint")))
    found = key_failures(star)
    # one row per declared test; tests without failures count 0
    parts.append(star["dim_seasons"].sparkSession.createDataFrame(
        [(t, m, c, s, found.get((t, m, c, a), 0)) for m, c, t, a, s in MODEL_TESTS if t in ("unique", "relationships")],
        "check_name string, model string, column_name string, severity string, failures bigint"))
    for model, col, test, arg, sev in MODEL_TESTS:
        if test == "accepted_values":
            # failures = number of distinct unexpected values, like the test's row count
            parts.append(_count_row(accepted_values(star[model], col, arg), test, model, col, sev))
    parts.append(_count_row(no_future_results(star["fct_matches"], as_of),
                            CUSTOM_TESTS[0][0], "fct_matches", "", CUSTOM_TESTS[0][1]))
    parts.append(_summary_row(tbc_failures(star["fct_matches"], star["stg_matches"]),
                            CUSTOM_TESTS[1][0], "fct_matches", "", CUSTOM_TESTS[1][1]))
    return reduce(DataFrame.unionByName, parts)


# Q8
def gate(summary: DataFrame) -> DataFrame:
    """One row: failing error checks, failing warn checks, and whether the
    build may be published (no failing error check)."""
    failing = F.col("failures") > 0
    return summary.agg(
        F.count_if(failing & (F.col("severity") == "error")).alias("error_checks_failed"),
        F.count_if(failing & (F.col("severity") == "warn")).alias("warn_checks_failed"),
    ).withColumn("publish", F.col("error_checks_failed") == 0)


def passed(summary: DataFrame) -> bool:
    return bool(gate(summary).first()["publish"])
