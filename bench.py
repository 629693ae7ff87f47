"""Benchmark: the weekly refresh workload at one scale factor.

Stages (each timed): load the raw tables, build all 13 models as stored
tables, run every data check in one action, answer the analytic
questions, run the page-extraction round trips, and the incremental
upsert. Prints one JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8)
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pitchstar.session import get_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    work = tempfile.mkdtemp(prefix="pitchstar-bench-")
    spark = get_session(f"local[{cpus}]", app="pitchstar-bench", shuffle_partitions=cpus * 2,
                        extra={"spark.driver.memory": "16g",
                               "spark.sql.warehouse.dir": f"{work}/warehouse",
                               "spark.checkpoint.dir": f"{work}/checkpoints"})
    from pitchstar.operators import checks as C
    from pitchstar.plans import extraction as X
    from pitchstar.plans import incremental as A
    from pitchstar.plans import questions as K
    from pitchstar.plans.publish import build_star_tables
    from pitchstar.registry import PARAMS as P
    from pitchstar.sources.fixtures import raw_tables
    from pyspark.sql import functions as F

    from pitchstar.operators.upsert import upsert
    from pitchstar.schemas import UPSERT_KEYS
    from pitchstar.sources.raw import create_database, load_raw, materialize, write_rows

    times: dict[str, float] = {}

    def timed(name, fn):
        t = time.time()
        out = fn()
        times[name] = round(time.time() - t, 3)
        return out

    spark.read.parquet(f"{sf_dir}/nation.parquet").count()  # JVM warm-up, not timed
    db = create_database(spark, "bench_star", f"{work}/bench_star.db")

    # setup (not timed): the collector's output, one header CSV per raw table
    csv = {}
    for t, df in raw_tables(spark, sf_dir, share=True).items():
        csv[t] = f"{work}/collected/{t}"
        write_rows(df, csv[t], table=t)

    def load():
        for t, p in csv.items():
            load_raw(spark, p, db, t)
        return {t: spark.table(f"{db}.{t}") for t in csv}

    raw = timed("load_raw", load)
    star = timed("build_star", lambda: build_star_tables(raw, db))
    timed("checks", lambda: C.run_checks(star, P["as_of"]).collect())
    questions = {
        "top_scorers": lambda: K.top_scorers(star, P["season"], P["competition"], P["top_n"]),
        "league_table": lambda: K.league_table(star, P["season"], P["competition"]),
        "goal_split": lambda: K.goal_split(star),
        "home_away_counts": lambda: K.home_away_counts(star),
        "movement": lambda: K.movement(star),
        "highest_scoring": lambda: K.highest_scoring(star, 5),
        "scorer_consistency": lambda: K.scorer_consistency(star, P["seasons"]),
        "scorer_profile": lambda: K.scorer_profile(star, P["profile_competitions"], P["season"]),
        "goal_share": lambda: K.goal_share(star, P["season"]),
        "tier_shortlist": lambda: K.tier_shortlist(star, P["gender"], P["tiers"], P["season"], P["top_n"]),
        "team_journey": lambda: K.team_journey(star, P["team"]),
    }
    for name, q in questions.items():
        timed(name, lambda q=q: q().collect())
    # league pages rendered from the stored raw rows (test input, not timed)
    from pitchstar.sources.league_pages import event_pages, listing_pages, standings_pages
    lp = materialize(listing_pages(raw["matches"]), db, "pages_listing")
    sp = materialize(standings_pages(raw["standings"]), db, "pages_standings")
    ep = materialize(event_pages(raw["match_events"]), db, "pages_match")
    timed("extract_matches", lambda: X.parse_listing(lp).count())
    timed("extract_standings", lambda: X.parse_standings_pages(sp).count())
    timed("extract_events", lambda: X.parse_match_pages(ep).count())
    timed("extract_articles", lambda: X.article_sections(spark, sf_dir).count())
    def weekly_upsert():
        m = raw["matches"]
        base = m.filter(F.col("match_date") < F.lit(A.BASE_BEFORE).cast("date"))
        batch = m.filter(F.col("match_date") >= F.lit(A.BATCH_FROM).cast("date")) \
            .withColumn("scraped_at", F.lit(A.BATCH_AT).cast("timestamp_ntz"))
        merged = upsert(base, batch, UPSERT_KEYS["matches"], ["scraped_at"])
        merged.write.mode("overwrite").parquet(f"{work}/matches_v2")

    timed("upsert_matches", weekly_upsert)

    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "weekly_refresh_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
