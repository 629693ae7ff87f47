"""Driver tables -> the three raw league tables.

The driver ships TPC-H-like tables, not league data, so every registered
query starts from this deterministic mapping (documented in FIXTURES.md):
orders become matches, lineitems of finished orders become goal and card
events, and the scored matches roll up into standings. Each output has the
exact raw schema of ``pitchstar.schemas``.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import collected_at
from ..schemas import MATCH_EVENTS, MATCHES, STANDINGS
from .raw import stored
from .tables import read_table

# Fixed values of the mapping.
COLLECTED_AT = "1999-01-01 20:55:51"
GROUP_EVEN = "League Womens"
GROUP_ODD = "League Mens"
TBC_TEAM = "TBC 1"
GOAL_SUBTYPES = ["FG", "PC", "PS"]
CARD_SUBTYPES = ["Green", "Yellow", "Red"]


def _season(d):
    y = F.when(F.month(d) >= 9, F.year(d)).otherwise(F.year(d) - 1)
    return F.concat_ws("-", y.cast("string"), (y + 1).cast("string"))


def _matches_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches plus the hidden columns (order key) the events need."""
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey",
                   "o_orderstatus", "o_orderdate", "o_orderpriority")
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_name",
                   "c_nationkey", "c_mktsegment")
    # nation is the fixed 25-row TPC-H dimension: broadcasting it is bounded.
    n = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    h = F.broadcast(n.select(F.col("n_nationkey").alias("h_key"), F.col("n_name").alias("h_name")))
    a = F.broadcast(n.select(F.col("n_nationkey").alias("a_key"), F.col("n_name").alias("a_name")))

    j = (o.join(c, o.o_custkey == c.c_custkey)
         .join(h, F.col("c_nationkey") == F.col("h_key"))
         .join(a, ((F.col("c_nationkey") + 1 + F.col("o_orderkey") % 24) % 25) == F.col("a_key")))

    k = F.col("o_orderkey")
    scored = F.col("o_orderstatus") == "F"
    phase = (F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("Phase 1"))
             .when(F.col("o_orderpriority") == "2-HIGH", F.lit("Phase 2")))
    group = F.when(F.col("c_custkey") % 2 == 0, F.lit(GROUP_EVEN)).otherwise(F.lit(GROUP_ODD))
    competition = F.concat(
        group,
        F.when(phase.isNotNull(), F.lit(" Premier ")).otherwise(F.lit(" Division ")),
        F.col("c_mktsegment"),
        F.when(phase == "Phase 2", F.lit(" Phase 2")).otherwise(F.lit("")))
    return j.select(
        _season(F.col("o_orderdate")).alias("season"),
        phase.alias("phase"),
        group.alias("competition_group"),
        competition.alias("competition"),
        F.to_date("o_orderdate").alias("match_date"),
        F.when(F.col("o_orderstatus") == "O", F.lit("12:00")).alias("match_time"),
        F.col("h_name").alias("home_team"),
        F.when(k % 97 == 0, F.lit(TBC_TEAM)).otherwise(F.col("a_name")).alias("away_team"),
        F.when(scored, k % 6).cast("bigint").alias("home_score"),
        F.when(scored, k % 5).cast("bigint").alias("away_score"),
        F.when(k % 15 != 0, F.col("c_name")).alias("venue"),
        F.concat(F.lit("/fixtures/"), k.cast("string")).alias("match_url"),
        collected_at(COLLECTED_AT).alias("scraped_at"),
        k.alias("_orderkey"), F.col("h_key").alias("_home_key"), F.col("a_key").alias("_away_key"),
    )


def raw_matches(spark: SparkSession, sf_dir: str, keyed: DataFrame | None = None) -> DataFrame:
    keyed = keyed if keyed is not None else _matches_keyed(spark, sf_dir)
    return keyed.select(*MATCHES.fieldNames())


def raw_match_events(spark: SparkSession, sf_dir: str, keyed: DataFrame | None = None) -> DataFrame:
    """Distinct event rows: one per lineitem of a scored match (the raw
    table holds each event once, like the upserted CSV)."""
    keyed = keyed if keyed is not None else _matches_keyed(spark, sf_dir)
    m = keyed.filter(F.col("home_score").isNotNull())
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_suppkey",
                    "l_linenumber", "l_quantity", "l_returnflag")
    # supplier grows with scale; no hint -> Spark/AQE pick by measured size. It is joined
    # first: rows then lie by order, as the match join deals them, when they are made
    # distinct, which moves none of them (the order key tells no more than the URL).
    s = read_table(spark, sf_dir, "supplier", "s_suppkey", "s_name")
    card = F.col("l_returnflag") == "R"
    r = F.col("l_linenumber") % 3

    def pick(names):
        return F.when(r == 0, F.lit(names[0])).when(r == 1, F.lit(names[1])).otherwise(F.lit(names[2]))

    named = li.join(s, F.col("l_suppkey") == F.col("s_suppkey")).drop("s_suppkey")
    ev = (m.join(named, m._orderkey == named.l_orderkey)
          .select(
              "_orderkey",
              "season", "match_url", "match_date", "home_team", "away_team",
              F.concat(F.lit("/logos/"), F.col("_home_key").cast("string"), F.lit(".png")).alias("home_logo"),
              F.concat(F.lit("/logos/"), F.col("_away_key").cast("string"), F.lit(".png")).alias("away_logo"),
              F.when(card, F.lit("card")).otherwise(F.lit("goal")).alias("event_type"),
              F.when(card, pick(CARD_SUBTYPES)).otherwise(pick(GOAL_SUBTYPES)).alias("event_subtype"),
              F.when(F.col("l_suppkey") % 2 == 0, F.col("home_team")).otherwise(F.col("away_team")).alias("team"),
              F.col("s_name").alias("player_name"),
              F.col("l_quantity").cast("bigint").alias("minute"),
              "scraped_at"))
    return ev.distinct().select(*MATCH_EVENTS.fieldNames())


def raw_standings(spark: SparkSession, sf_dir: str, keyed: DataFrame | None = None) -> DataFrame:
    """League table per (season, phase, group, competition, team) from both
    sides of every scored match; TBC placeholders get no row."""
    m = raw_matches(spark, sf_dir, keyed).filter(F.col("home_score").isNotNull())
    ctx = ["season", "phase", "competition_group", "competition"]
    # Both perspectives from one scan: explode a two-element array.
    sides = m.select(*ctx, F.explode(F.array(
        F.struct(F.col("home_team").alias("team"), F.col("home_score").alias("gf"), F.col("away_score").alias("ga")),
        F.struct(F.col("away_team").alias("team"), F.col("away_score").alias("gf"), F.col("home_score").alias("ga")),
    )).alias("s")).select(*ctx, "s.*").filter(~F.col("team").startswith("TBC"))
    t = sides.groupBy(*ctx, "team").agg(
        F.count(F.lit(1)).alias("played"),
        F.sum((F.col("gf") > F.col("ga")).cast("bigint")).alias("won"),
        F.sum((F.col("gf") == F.col("ga")).cast("bigint")).alias("drawn"),
        F.sum((F.col("gf") < F.col("ga")).cast("bigint")).alias("lost"),
        F.sum("gf").alias("goals_for"),
        F.sum("ga").alias("goals_against"),
    )
    t = (t.withColumn("goal_difference", F.col("goals_for") - F.col("goals_against"))
         .withColumn("points", 3 * F.col("won") + F.col("drawn")))
    # A competition table has one row per team, so this window's groups are
    # bounded by league size, not by data volume.
    w = Window.partitionBy("season", "phase", "competition").orderBy(
        F.desc("points"), F.desc("goal_difference"), F.desc("goals_for"), F.asc("team"))
    return t.select(
        *ctx, F.row_number().over(w).cast("bigint").alias("position"), "team",
        "played", "won", "drawn", "lost", "goals_for", "goals_against",
        "goal_difference", "points",
        F.concat(F.lit("/standings/"), F.col("season")).alias("standings_url"),
        collected_at(COLLECTED_AT).alias("scraped_at"),
    ).select(*STANDINGS.fieldNames())


def stored_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The three raw tables written once, for jobs that read them many times; the
    join of orders and customers is computed once for all three."""
    keyed = stored({"matches": _matches_keyed(spark, sf_dir)})["matches"]
    rest = stored({"standings": raw_standings(spark, sf_dir, keyed), "match_events": raw_match_events(spark, sf_dir, keyed)})
    return {"standings": rest["standings"], "matches": raw_matches(spark, sf_dir, keyed), "match_events": rest["match_events"]}


def raw_tables(spark: SparkSession, sf_dir: str, share: bool = False) -> dict[str, DataFrame]:
    """The three raw tables. ``share=True`` persists the keyed matches once
    (memory and disk; lost blocks are recomputed from lineage) so writing
    all three tables does not repeat the orders/customer join."""
    keyed = _matches_keyed(spark, sf_dir)
    if share:
        keyed = keyed.persist(StorageLevel.MEMORY_AND_DISK)
    return {"standings": raw_standings(spark, sf_dir, keyed),
            "matches": raw_matches(spark, sf_dir, keyed),
            "match_events": raw_match_events(spark, sf_dir, keyed)}
