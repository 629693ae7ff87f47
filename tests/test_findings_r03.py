"""F6 of round 3: raw tables are computed once and repeated ids cost no more than
the rows they make."""

from pyspark.sql import functions as F

from pitchstar.operators import checks as C
from pitchstar.plans import incremental as P
from pitchstar.plans import loading as LD
from pitchstar.plans import models as M


def test_tbc_failures_are_counted_without_pairs(spark):
    fct = spark.createDataFrame([("x", None, 1), ("x", None, 1), ("x", 2, None), ("y", None, None), ("z", 1, 1), (None, None, None)],
                                "match_id string, home_team_id int, away_team_id int") \
        .withColumn("match_date", F.lit(None).cast("date"))
    stg = spark.createDataFrame([("x", "TBC 1", "A"), ("x", "A", "TBC 1"), ("x", "TBC 2", "TBC 1"), ("y", None, "TBC 1"), ("y", "A", "B"),
                                 ("z", "TBC 1", "TBC 1"), (None, "TBC 1", "TBC 1")], "match_id string, home_team string, away_team string")
    got = C.tbc_failures(fct, stg)
    assert got.first()[0] == C.tbc_without_ids(fct, stg).count() == 7
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.rindex("Aggregate") and plan.count("Aggregate") == 3
    assert C.tbc_failures(fct.limit(0), stg).first()[0] == 0


def test_keys_are_made_before_repeated_ids_fan_out(spark):
    cols = ("match_id string, season string, phase string, competition_group string, competition string, home_team string, away_team string, "
            "venue string, match_date string, match_time string, home_score long, away_score long, match_url string, scraped_at string, match_status string")
    row = lambda i, h, a: (i, "s", None, "g", "c", "A", "B", "v", "d", "t", h, a, f"u{h}", "n", "Completed")
    int_m = spark.createDataFrame([row("m", 1, 0), row("m", 2, 1), row("m", None, None), row("n", 5, 4), row(None, 7, 7)], cols)
    seasons = spark.createDataFrame([("s", 1)], "season_name string, season_id int")
    phases = spark.createDataFrame([("Phase 1", 1)], "phase_name string, phase_id int")
    teams = spark.createDataFrame([("A", 1), ("B", 2)], "team_name string, team_id int")
    out = M.fct_team_matches(int_m, seasons, phases, teams)
    got = sorted(str((r.match_id, r.team_id, r.opponent_id, r.home_score)) for r in out.collect())
    want = [(i, a, b, s) for a, b in ((1, 2), (2, 1)) for i, scores in (("m", [1, 2, None] * 3), ("n", [5]), (None, [None])) for s in scores]
    assert got == sorted(map(str, want))
    # the join that fans out stands above the explode, and so above keys and lookups
    lines = out._jdf.queryExecution().optimizedPlan().toString().split("\n")
    at = next(i for i, x in enumerate(lines) if "Join" in x and "_sid" in x)
    assert any("Generate" in x for x in lines[at:]) and not any("Generate" in x and len(x) - len(x.lstrip(" :+-")) < len(lines[at]) - len(lines[at].lstrip(" :+-")) for x in lines[:at])


def test_promote_computes_raw_tables_once(spark, monkeypatch):
    m = spark.createDataFrame([("1997-09-01", "a"), ("1999-01-01", "b"), ("2000-02-01", "c")], "d string, match_url string") \
        .select(F.col("d").cast("date").alias("match_date"), F.lit("1996-1997").alias("season"), "match_url")

    def never(*_):
        raise AssertionError("the raw table is computed anew")

    for name in ("raw_matches", "raw_match_events"):
        monkeypatch.setattr(P, name, never)
    base = LD._base_tables(spark, "nowhere", {"standings": m, "matches": m, "match_events": m})
    assert [base[t].count() for t in ("standings", "matches", "match_events")] == [3, 1, 1]
    assert P.batch_matches(spark, "nowhere", m).count() == 4
