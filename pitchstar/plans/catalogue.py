"""Competitions by name, with level, gender and the season they hold in,
and which seasons the data holds at all.

The catalogue is one row for each (season, group, competition) that the facts
name. Its level comes from a table of level words, each with the seasons it is
valid in, joined on the words of the name; a name with several levels has the
highest. Names without a level, and names that contradict their group, are
reported and not guessed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import gender_of

# Word of a competition's name, tier, first and last season (None: open).
LEVELS = [
    ("Premier", 1, None, None),
    ("Division", 2, None, None),
    ("Conference", 3, None, None),
]
NO_LEVEL = "no level of this season in the name"
OTHER_GENDER = "the name and its group differ in gender"


def competition_names(star) -> DataFrame:
    """(season_id, group, competition) of matches and tables, with what they hold."""
    key = ["season_id", "competition_group", "competition_name"]
    matches = star["fct_matches"].groupBy(*key).agg(
        F.min("match_date").alias("first_match"), F.max("match_date").alias("last_match"), F.count(F.lit(1)).alias("n_matches"))
    tables = star["fct_standings"].groupBy(*key).agg(F.count(F.lit(1)).alias("n_standings"))
    none = F.lit(None).cast("date")
    both = matches.withColumn("n_standings", F.lit(0)).unionByName(tables.select(
        *key, none.alias("first_match"), none.alias("last_match"), F.lit(0).alias("n_matches"), "n_standings"))
    return both.groupBy(*key).agg(F.min("first_match").alias("first_match"), F.max("last_match").alias("last_match"),
                                  F.sum("n_matches").alias("n_matches"), F.sum("n_standings").alias("n_standings"))


def catalogue(star, levels=LEVELS) -> DataFrame:
    """One row for each competition of a season; ``tier`` is NULL where no level is known."""
    spark = star["dim_seasons"].sparkSession
    table = spark.createDataFrame(levels, "level string, tier int, since string, until string")
    names = competition_names(star).join(star["dim_seasons"].select("season_id", "season_name"), "season_id", "left")
    key = ["season_name", "competition_group", "competition_name"]
    words = names.select(*key, F.explode(F.split("competition_name", r"\s+")).alias("level"))
    valid = ((F.col("since").isNull() | (F.col("season_name") >= F.col("since")))
             & (F.col("until").isNull() | (F.col("season_name") <= F.col("until"))))
    tiers = (words.join(table, "level").filter(valid).groupBy(*key)
             .agg(F.min(F.struct("tier", "level")).alias("best")))
    a, b = names.alias("a"), tiers.alias("b")
    on = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in key]
    return a.join(b, on, "left").select(
        *[F.col(f"a.{c}") for c in key],
        F.regexp_replace("a.competition_name", r"\s+Phase 2.*$", "").alias("division"),
        gender_of(F.col("a.competition_group")).alias("gender"),
        F.col("best.tier").alias("tier"), F.col("best.level").alias("level"),
        "first_match", "last_match", "n_matches", "n_standings")


def unknown_competitions(star, levels=LEVELS) -> DataFrame:
    """Catalogue rows that no tier question can use, and why."""
    said = F.regexp_extract("competition_name", r"\b(Men|Women)'?s\b", 1)
    reason = (F.when(F.col("tier").isNull(), F.lit(NO_LEVEL))
              .when((said != "") & (F.concat(said, F.lit("s")) != F.col("gender")), F.lit(OTHER_GENDER)))
    return (catalogue(star, levels).withColumn("reason", reason).filter("reason IS NOT NULL")
            .select("season_name", "competition_group", "competition_name", "n_matches", "reason"))


def competitions_of(star, gender: str, tiers, season: str, levels=LEVELS) -> DataFrame:
    """(group, competition) of a season's tiers, for a semi-join with a fact."""
    return catalogue(star, levels).filter(
        (F.col("season_name") == season) & (F.col("gender") == gender) & F.col("tier").isin(list(tiers))).select(
        F.col("competition_group").alias("held_group"), F.col("competition_name").alias("held_name"))


def season_coverage(star, seasons: list[str]) -> DataFrame:
    """For each season asked for, whether it is held, and the reason where nothing
    can be told about it."""
    held = star["dim_seasons"].select("season_id", "season_name")
    counts = star["fct_matches"].groupBy("season_id").agg(
        F.count(F.lit(1)).alias("n_matches"), F.count_if(F.col("match_status") == "Completed").alias("n_completed"))
    span = held.agg(F.min("season_name").alias("lo"), F.max("season_name").alias("hi"))  # one row
    asked = span.select("lo", "hi", F.explode(F.array(*[F.lit(s) for s in seasons])).alias("season_name"))
    out = asked.join(held, "season_name", "left").join(counts, "season_id", "left")
    n = F.coalesce("n_matches", F.lit(0))
    reason = (F.when(F.col("lo").isNull(), F.lit("no season is held"))
              .when(F.col("season_id").isNull(), F.concat(F.lit("only seasons "), "lo", F.lit(" to "), "hi", F.lit(" are held")))
              .when(n == 0, F.lit("the season holds tables and no matches")))
    return out.select("season_name", F.col("season_id").isNotNull().alias("held"), n.alias("n_matches"),
                      F.coalesce("n_completed", F.lit(0)).alias("n_completed"), reason.alias("reason"))


def refuse_seasons(star, wanted) -> None:
    """Raise ValueError if none of the seasons asked for is held."""
    wanted = [wanted] if isinstance(wanted, str) else list(wanted)
    name = F.col("season_name")
    lo, hi, some = star["dim_seasons"].agg(F.min(name), F.max(name), F.count_if(name.isin(wanted))).first()
    if not some:
        raise ValueError(f"season_name: only seasons {lo} to {hi} are held" if lo else "season_name: no season is held")
