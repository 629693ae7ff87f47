"""Competitions by level and season, and seasons the data does not hold."""

import datetime as dt

import pytest

from pitchstar.plans import catalogue as C
from pitchstar.plans.ask import ask


@pytest.fixture(scope="module")
def small(spark):
    day = dt.date(2023, 10, 1)
    matches = [("m1", 1, "Top Womens", "Womens Premier Division", day, "Completed"),
               ("m2", 1, "Top Womens", "Womens Premier Division", dt.date(2023, 11, 1), "Upcoming"),
               ("m3", 1, "Top Womens", "Womens Premier Division Phase 2 Lower 6", day, "Completed"),
               ("m4", 2, "Top Open/Mens", "Open - Men's Division 1 North", day, "Completed"),
               ("m5", 2, "Top Open/Mens", "Women's Conference East", day, "Completed"),
               ("m6", 2, "Top Open/Mens", "Champions Cup", day, "Completed"),
               ("m7", None, None, None, day, "Completed")]
    return {
        "dim_seasons": spark.createDataFrame([(1, "2023-2024"), (2, "2024-2025"), (3, "2025-2026")], "season_id long, season_name string"),
        "fct_matches": spark.createDataFrame(matches, "match_id string, season_id long, competition_group string, competition_name string, match_date date, match_status string"),
        "fct_standings": spark.createDataFrame([(1, "Top Womens", "Womens Premier Division"), (3, "Top Womens", "Premiership")],
                                               "season_id long, competition_group string, competition_name string"),
    }


def test_levels_are_whole_words_and_the_highest_counts(small):
    got = {(r.season_name, r.competition_name): r for r in C.catalogue(small).collect()}
    assert len(got) == 7
    first = got["2023-2024", "Womens Premier Division"]
    assert (first.tier, first.level, first.gender, first.n_matches, first.n_standings, first.last_match) == (1, "Premier", "Womens", 2, 1, dt.date(2023, 11, 1))
    assert got["2023-2024", "Womens Premier Division Phase 2 Lower 6"].division == "Womens Premier Division"
    assert got["2024-2025", "Open - Men's Division 1 North"].tier == 2
    assert got["2025-2026", "Premiership"].tier is None and got[None, None].tier is None


def test_unknown_names_are_told(small):
    got = {(r.competition_name, r.reason) for r in C.unknown_competitions(small).collect()}
    assert got == {("Champions Cup", C.NO_LEVEL), ("Premiership", C.NO_LEVEL), (None, C.NO_LEVEL), ("Women's Conference East", C.OTHER_GENDER)}
    levels = [("Premier", 1, None, None), ("Division", 2, "2025-2026", None), ("Conference", 3, None, "2023-2024")]
    later = {r.competition_name for r in C.unknown_competitions(small, levels).collect()}
    assert {"Open - Men's Division 1 North", "Women's Conference East"} <= later and "Womens Premier Division" not in later


def test_a_season_that_is_not_held_has_a_reason(small):
    got = {r.season_name: r for r in C.season_coverage(small, ["2020-2021", "2023-2024", "2025-2026"]).collect()}
    assert (got["2020-2021"].held, got["2020-2021"].reason) == (False, "only seasons 2023-2024 to 2025-2026 are held")
    assert (got["2023-2024"].n_matches, got["2023-2024"].n_completed, got["2023-2024"].reason) == (3, 2, None)
    assert got["2025-2026"].held and got["2025-2026"].reason == "the season holds tables and no matches"
    none = {**small, "dim_seasons": small["dim_seasons"].limit(0)}
    assert C.season_coverage(none, ["2020-2021"]).first().reason == "no season is held"


def test_a_question_about_it_is_refused(star):
    n, held = {"n": ("count", "match_id")}, star["dim_seasons"].orderBy("season_name").first().season_name
    with pytest.raises(ValueError, match=f"only seasons {held} to"):
        ask(star, "fct_matches", n, [], {"season_name": "1900-1901"})
    one, both = (ask(star, "fct_matches", n, [], {"season_name": s}).first().n for s in (held, ["1900-1901", held]))
    assert one == both > 0
