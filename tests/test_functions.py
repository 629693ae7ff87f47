import hashlib

from pyspark.sql import functions as F

from pitchstar.functions import keys as K
from pitchstar.functions import text as T


def one(spark, col, value, dtype="string"):
    df = spark.createDataFrame([(value,)], f"x {dtype}")
    return df.select(col(F.col("x")).alias("y")).first()["y"]


def test_surrogate_key_matches_md5_of_joined_text(spark):
    df = spark.createDataFrame([("a", None, 3)], "a string, b string, c bigint")
    got = df.select(K.surrogate_key("a", "b", "c").alias("k")).first()["k"]
    want = hashlib.md5("a-_dbt_utils_surrogate_key_null_-3".encode()).hexdigest()
    assert got == want


def test_clean_name(spark):
    assert one(spark, T.clean_name, "  Men’s \n  Premier   Division ") == "Men's Premier Division"
    assert one(spark, T.clean_name, "Womenʼs") == "Women's"
    assert one(spark, T.clean_name, "   ") == "Unknown"
    assert one(spark, T.clean_name, None) == "Unknown"
    # Unicode spaces collapse too, as Python's str.split() does
    assert one(spark, T.clean_name, "\u00a0Division\u2003 1\u3000North ") == "Division 1 North"
    # exactly Python's str.isspace() set collapses, nothing else
    ws = "".join(c for c in map(chr, range(0x10000)) if c.isspace())
    assert one(spark, T.clean_name, "a" + ws + "b") == "a b"
    non_ws = "\u200b\u00ad\ufeff"
    assert one(spark, T.clean_name, "a" + non_ws + "b") == "a" + non_ws + "b"


def test_phase_of_order_matters(spark):
    assert one(spark, T.phase_of, "Premier Division Phase 2 Top 6") == "Phase 2"
    assert one(spark, T.phase_of, "Womens Premier Division") == "Phase 1"
    assert one(spark, T.phase_of, "Division 1 North") == ""


def test_gender_is_case_sensitive(spark):
    # 'Womens' contains 'mens' but not 'Mens'
    assert one(spark, T.gender_of, "Adult Womens") == "Womens"
    assert one(spark, T.gender_of, "Adult Open/Mens") == "Mens"
    assert one(spark, T.gender_of, "Open - Men's Premier") == "Mens"


def test_two_integer_parsers(spark):
    assert one(spark, T.int_or_zero, " 12 ") == 12
    assert one(spark, T.int_or_zero, "") == 0
    assert one(spark, T.int_or_zero, "x") == 0
    assert one(spark, T.int_or_null, "") is None
    assert one(spark, T.int_or_null, "17.0") is None
    assert one(spark, T.int_or_null, "-3") == -3


def test_unicode_digits_like_python(spark):
    # Python's \d and int() accept decimal digits of any script
    assert one(spark, T.minute_of, "١٥'") == int("١٥")
    assert one(spark, T.int_or_null, " ４２ ") == int(" ４２ ")
    assert one(spark, T.int_or_zero, "\U0001D7DA") == int("\U0001D7DA")
    assert one(spark, T.player_name, "Ana Silva ٢٠’") == "Ana Silva"


def test_minute(spark):
    assert one(spark, T.minute_of, "15'") == 15
    assert one(spark, T.minute_of, " 7′ ") == 7
    assert one(spark, T.minute_of, "HT") == 0


def test_icons(spark):
    assert one(spark, T.event_type_of, "/a/icons.svg#field-goal") == "goal"
    assert one(spark, T.event_subtype_of, "/a/icons.svg#yellow-card-match-details") == "Yellow"
    assert one(spark, T.event_subtype_of, "penalty-stroke") == "PS"
    assert one(spark, T.event_type_of, "/a/icons.svg#corner") is None


def test_player_name(spark):
    assert one(spark, T.player_name, "Jane Smith 20'") == "Jane Smith"
    assert one(spark, T.player_name, "35’  \n A. N. Other") == "A. N. Other"


def test_page_date(spark):
    assert one(spark, T.page_date, "22 November 2025 | 14:00") == "2025-11-22"
    assert one(spark, T.page_date, "3 Sept 2025") == "2025-01-03"   # unknown month -> January
    assert one(spark, T.page_date, "TBC") == ""
    assert one(spark, T.page_date, "5\u00a0March\u20032026 | 14:00") == "2026-03-05"


def test_match_status(spark):
    rows = [(1, "2025-01-10", "2025-01-01 10:00:00"), (None, "2025-01-10", "2025-01-01 10:00:00"),
            (None, "2024-12-01", "2025-01-01 10:00:00"), (None, None, "2025-01-01 10:00:00")]
    df = spark.createDataFrame(rows, "home_score bigint, d string, t string").select(
        "home_score", F.to_date("d").alias("match_date"),
        F.col("t").cast("timestamp_ntz").alias("scraped_at"))
    got = [r[0] for r in df.select(T.match_status()).collect()]
    assert got == ["Completed", "Upcoming", "Missing result", "Missing result"]


def test_typed_and_project(spark):
    from pyspark.sql.types import LongType, StringType, StructField, StructType

    from pitchstar.functions.casts import project, typed
    df = spark.createDataFrame([("7", "x"), ("bad", "y")], "a string, b string")
    schema = StructType([StructField("a", LongType()), StructField("b", StringType())])
    got = [tuple(r) for r in typed(df, schema).collect()]
    assert got == [(7, "x"), (None, "y")]
    p = project(df, {"b2": "b", "a_len": F.length("a")}).collect()
    assert [tuple(r) for r in p] == [("x", 1), ("y", 3)]
