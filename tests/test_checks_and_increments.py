import datetime as dt

from pyspark.sql import functions as F

from pitchstar.operators import checks as C
from pitchstar.operators import increments as I
from pitchstar.sources import raw as R


def test_basic_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "b"), (None, "zz")], "id bigint, s string")
    nn = {r.column_name: r.failures for r in C.not_null(df, ["id", "s"]).collect()}
    assert nn == {"id": 1, "s": 1}
    assert [(r.id, r.n_records) for r in C.unique(df, "id").collect()] == [(1, 2)]
    parent = spark.createDataFrame([(2,)], "id bigint")
    assert sorted(r.id for r in C.relationships(df, "id", parent, "id").collect()) == [1, 1]
    av = C.accepted_values(df, "s", ["a", "b"]).collect()
    assert [(r.s, r.n_records) for r in av] == [("zz", 1)]


def test_gate_blocks_on_error_only(spark):
    rows = [("unique", "m", "c", "error", 0), ("not_null", "m", "c", "warn", 3)]
    s = spark.createDataFrame(rows, ", ".join(f"{c} {t}" for c, t in zip(
        C.SUMMARY_COLS, ["string", "string", "string", "string", "bigint"])))
    assert C.passed(s)
    s2 = s.union(spark.createDataFrame([("unique", "m", "c", "error", 1)], s.schema))
    assert not C.passed(s2)


def _matches(spark, rows):
    return spark.createDataFrame(
        rows, "season string, match_url string, match_date date, home_score bigint, away_score bigint")


def test_event_work_selection_counters(spark):
    d = dt.date
    m = _matches(spark, [
        ("2025-2026", "/f/1", d(2025, 9, 1), 1, 0),     # before since, has events -> skip
        ("2025-2026", "/f/2", d(2025, 9, 2), 2, 2),     # before since, current season, none -> forced
        ("2024-2025", "/f/3", d(2025, 1, 1), 1, 1),     # before since, past season -> skip
        ("2025-2026", "", d(2025, 9, 3), 1, 1),         # forced, but no URL -> counted, not fetched
        ("2025-2026", "/f/5", d(2025, 12, 1), 3, 1),    # after since -> selected
        ("2025-2026", "/f/6", d(2025, 12, 1), None, 1),  # no result -> not considered
    ])
    ev = spark.createDataFrame([("/f/1",)], "match_url string")
    dec = I.select_event_work(m, ev, "2025-10-01", "2025-2026")
    work = sorted(r.match_url for r in I.event_work(dec).collect())
    assert work == ["/f/2", "/f/5"]
    c = I.event_work_counters(dec).first()
    assert (c.to_fetch, c.skipped_before_since, c.forced_retry) == (2, 2, 2)


def test_high_water_mark_and_full_refresh(spark):
    m = spark.createDataFrame([(dt.datetime(2026, 1, 31, 20, 55, 51),), (dt.datetime(2026, 2, 7, 8, 0, 0),)],
                              "scraped_at timestamp_ntz")
    assert I.last_collected_date(m).first()[0] == "2026-02-07"
    assert I.last_collected_date(m, full_refresh=True).first()[0] is None
    assert I.last_collected_date(m.limit(0)).first()[0] is None


def test_csv_empty_is_null_and_quotes(spark, tmp_path):
    p = tmp_path / "m.csv"
    p.write_bytes(("season,phase,competition_group,competition,match_date,match_time,home_team,away_team,"
                   "home_score,away_score,venue,match_url,scraped_at\r\n"
                   '2025-2026,,"G ""x""",C,2025-09-20,,A,B,,,"",/f/1,2026-01-31T20:55:51\r\n').encode())
    r = R.read_raw(spark, str(p), "matches").first()
    assert r.phase is None and r.match_time is None and r.venue is None and r.home_score is None
    assert r.competition_group == 'G "x"'
    assert r.scraped_at == dt.datetime(2026, 1, 31, 20, 55, 51)


def test_run_summary_truncates_notes(spark):
    res = spark.createDataFrame(
        [("matches", "2025-2026", "Womens Premier Division", "failed", 5, "e" * 300, None),
         ("match_events", None, None, "complete", 10, None, 4)],
        "data_type string, season string, competition string, status string, row_count bigint, "
        "error string, matches_scraped bigint")
    out = {r.data_type: r for r in I.run_summary(res, None, "2026-02-02T08:00:00").collect()}
    m = out["matches"]
    assert (m.gender, m.phase, m.row_count, len(m.notes)) == ("Womens", "Phase 1", 0, 100)
    e = out["match_events"]
    assert (e.season, e.competition, e.notes) == ("All", "All", "Scraped 4 matches")


def test_event_work_limit(spark):
    d = dt.date
    m = _matches(spark, [("2025-2026", f"/f/{i}", d(2025, 12, i), 1, 1) for i in range(1, 6)])
    ev = spark.createDataFrame([], "match_url string")
    dec = I.select_event_work(m, ev, None, "2025-2026")
    assert [r.match_url for r in I.event_work(dec, limit=2).collect()] == ["/f/1", "/f/2"]
    assert I.event_work(dec).count() == 5


def test_read_raw_tolerates_bad_numbers(spark, tmp_path):
    p = tmp_path / "s.csv"
    p.write_text("season,phase,competition_group,competition,position,team,played,won,drawn,lost,"
                 "goals_for,goals_against,goal_difference,points,standings_url,scraped_at\n"
                 "2025-2026,,G,C,1st,T,10,x,,1,5,3,2,9,/u,2026-01-31T20:55:51\n")
    r = R.read_raw(spark, str(p), "standings").first()
    assert (r.position, r.won, r.drawn, r.points) == (None, None, None, 9)


def test_upsert_collapses_repeated_stored_keys(spark):
    from pitchstar.operators.upsert import upsert
    base = spark.createDataFrame([("a", "v1", 1), ("a", "v2", 2), ("b", "v1", 1)], "k string, v string, t int")
    new = spark.createDataFrame([("c", "v1", 3)], "k string, v string, t int")
    plain = sorted((r.k, r.v) for r in upsert(base, new, ["k"], ["t"]).collect())
    assert plain == [("a", "v1"), ("a", "v2"), ("b", "v1"), ("c", "v1")]
    col = sorted((r.k, r.v) for r in upsert(base, new, ["k"], ["t"], collapse_base=True).collect())
    assert col == [("a", "v2"), ("b", "v1"), ("c", "v1")]


def test_prune_days_with_retry(spark):
    d = dt.date
    days = spark.createDataFrame([(d(2025, 9, 1),), (d(2025, 9, 8),), (d(2025, 10, 6),)], "match_day date")
    retry = spark.createDataFrame([(d(2025, 9, 8),)], "match_day date")
    assert sorted(r.match_day for r in I.prune_days(days, "2025-10-01").collect()) == [d(2025, 10, 6)]
    got = sorted(r.match_day for r in I.prune_days(days, "2025-10-01", retry_days=retry).collect())
    assert got == [d(2025, 9, 8), d(2025, 10, 6)]


def test_read_raw_maps_columns_by_header_name(spark, tmp_path):
    p = tmp_path / "e.csv"
    p.write_text("match_url,season,minute,player_name,event_type,extra\n"
                 "/f/1,2025-2026,12,A B,goal,zzz\n")
    r = R.read_raw(spark, str(p), "match_events").first()
    assert (r.match_url, r.season, r.minute, r.player_name, r.event_type) == ("/f/1", "2025-2026", 12, "A B", "goal")
    assert r.team is None and r.match_date is None
    assert R.read_raw(spark, str(p), "match_events").columns == R.RAW["match_events"].fieldNames()
