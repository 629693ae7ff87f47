"""Scalar expressions (C1-C14) run over text composed from driver columns,
so every branch of each rule is hit by real rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import keys as KY
from ..functions import text as T
from ..sources.fixtures import raw_matches
from ..sources.tables import read_table


def names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Padded names with curly apostrophes and blanks -> clean names."""
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_name")
    raw = (F.when(F.col("c_custkey") % 50 == 0, F.lit("   "))
           .when(F.col("c_custkey") % 7 == 0, F.lit(None))
           .otherwise(F.concat(F.lit("  "), F.regexp_replace("c_name", "#", "’  "), F.lit("\n "))))
    return c.select("c_custkey", raw.alias("raw_name")).select(
        "c_custkey", "raw_name", T.clean_name("raw_name").alias("clean_name"))


def phase_gender(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C2, C3 and the tier rule over every (group, competition) in matches."""
    m = raw_matches(spark, sf_dir).select("competition_group", "competition").distinct()
    return m.select("competition_group", "competition",
                    T.phase_of("competition").alias("phase"),
                    T.gender_of("competition_group").alias("gender"),
                    T.tier_of("competition").alias("tier"))


def _li(spark, sf_dir):
    return read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_quantity",
                      "l_returnflag", "l_suppkey")


def ints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C4, C5 over good and bad numeric text."""
    q = F.col("l_quantity").cast("bigint").cast("string")
    txt = (F.when(F.col("l_linenumber") % 4 == 0, F.concat(F.lit(" "), q, F.lit(" ")))
           .when(F.col("l_linenumber") % 4 == 1, F.col("l_quantity").cast("string"))
           .when(F.col("l_linenumber") % 4 == 2, F.col("l_returnflag"))
           .otherwise(F.concat(F.lit("-"), q)))
    return _li(spark, sf_dir).select("l_orderkey", "l_linenumber", txt.alias("text")).select(
        "l_orderkey", "l_linenumber", "text", T.int_or_null("text").alias("int_or_null"),
        T.int_or_zero("text").alias("int_or_zero"))


def minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minute text like 15', 15′ or HT -> leading digits or 0."""
    q = F.col("l_quantity").cast("bigint").cast("string")
    txt = (F.when(F.col("l_linenumber") % 3 == 0, F.concat(q, F.lit("'")))
           .when(F.col("l_linenumber") % 3 == 1, F.concat(F.lit(" "), q, F.lit("′ ")))
           .otherwise(F.lit("HT")))
    return _li(spark, sf_dir).select("l_orderkey", "l_linenumber", txt.alias("text")).select(
        "l_orderkey", "l_linenumber", "text", T.minute_of("text").alias("minute"))


ICON_NAMES = ["field-goal", "penalty-corner", "penalty-stroke", "green-card", "yellow-card",
              "red-card", "corner-kick"]


def icons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Icon references with and without the details suffix, unknown
    icons and references without '#'."""
    name = F.element_at(F.array(*[F.lit(n) for n in ICON_NAMES]),
                        (F.col("l_suppkey") % len(ICON_NAMES) + 1).cast("int"))
    ref = (F.when(F.col("l_linenumber") % 3 == 0, F.concat(F.lit("/assets/icons.svg#"), name))
           .when(F.col("l_linenumber") % 3 == 1,
                 F.concat(F.lit("/assets/icons.svg#"), name, F.lit("-match-details")))
           .otherwise(name))
    return _li(spark, sf_dir).select("l_orderkey", "l_linenumber", ref.alias("icon")).select(
        "l_orderkey", "l_linenumber", "icon", T.event_type_of("icon").alias("event_type"),
        T.event_subtype_of("icon").alias("event_subtype"))


def players(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Board text with the minute before or after the name."""
    li = _li(spark, sf_dir)
    s = read_table(spark, sf_dir, "supplier", "s_suppkey", "s_name")
    q = F.col("l_quantity").cast("bigint").cast("string")
    txt = (F.when(F.col("l_linenumber") % 2 == 0, F.concat("s_name", F.lit("  "), q, F.lit("’")))
           .otherwise(F.concat(q, F.lit("′ \n"), F.col("s_name"))))
    j = li.join(s, li.l_suppkey == s.s_suppkey)
    return j.select("l_orderkey", "l_linenumber", txt.alias("text")).select(
        "l_orderkey", "l_linenumber", "text", T.player_name("text").alias("player_name"))


def dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C9, C10, C11, C14 over order dates rendered as page text."""
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_orderdate", "o_orderstatus")
    d = F.col("o_orderdate")
    month = F.date_format(d, "MMMM")
    line = (F.when(F.col("o_orderkey") % 10 == 0, F.lit("Date to be confirmed"))
            .when(F.col("o_orderkey") % 10 == 1,
                  F.concat(F.dayofmonth(d).cast("string"), F.lit(" Sept "), F.year(d).cast("string")))
            .otherwise(F.concat(F.dayofmonth(d).cast("string"), F.lit(" "), month, F.lit(" "),
                                F.year(d).cast("string"), F.lit(" | 14:00"))))
    iso = F.concat(F.to_date(d).cast("string"), F.lit("T00:00:00"))
    return o.select(
        "o_orderkey", line.alias("date_line"), T.page_date(line).alias("page_date"),
        T.date_part(iso).alias("date_part"), T.prefix(d, 10).alias("prefix10"),
        T.date_of(d).alias("date_of"),
        KY.text_key(F.col("o_orderstatus"), T.date_of(d), F.col("o_orderkey")).alias("text_key"))
