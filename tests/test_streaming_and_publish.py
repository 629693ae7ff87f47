import datetime as dt

import pytest

from pitchstar.operators import checks as C
from pitchstar.plans import publish as PB
from pitchstar.schemas import RAW
from pitchstar.sources import raw as R
from pitchstar.sources.versions import Versions
from pitchstar.streaming.refresh import ingest, versions

MCOLS = ("season string, phase string, competition_group string, competition string, match_date date, "
         "match_time string, home_team string, away_team string, home_score bigint, away_score bigint, "
         "venue string, match_url string, scraped_at timestamp_ntz")


def _m(spark, url, score, at):
    return spark.createDataFrame([("2025-2026", None, "G", "C", dt.date(2025, 9, 20), None, "A", "B",
                                   score, 0, None, url, at)], MCOLS)


def test_stream_ingest_newest_wins_and_replay_safe(spark, tmp_path):
    drops = str(tmp_path / "drops")
    state = str(tmp_path / "state")
    t1, t2 = dt.datetime(2026, 1, 1, 8), dt.datetime(2026, 1, 8, 8)
    R.write_rows(_m(spark, "/f/1", 1, t1).unionByName(_m(spark, "/f/2", 1, t1)), drops)
    first = {r.match_url: r.home_score for r in ingest(spark, drops, state, "matches").collect()}
    assert first == {"/f/1": 1, "/f/2": 1}
    # a later drop updates /f/1; an older copy of /f/2 must not win
    R.write_rows(_m(spark, "/f/1", 5, t2).unionByName(_m(spark, "/f/2", 9, dt.datetime(2025, 1, 1))),
                 drops, overwrite=False)
    second = {r.match_url: r.home_score for r in ingest(spark, drops, state, "matches").collect()}
    assert second == {"/f/1": 5, "/f/2": 1}
    n = len(versions(spark, f"{state}/matches"))
    assert 1 <= n <= 3
    # nothing new: the stream does nothing and the table stays
    again = {r.match_url: r.home_score for r in ingest(spark, drops, state, "matches").collect()}
    assert again == second and len(versions(spark, f"{state}/matches")) == n


def _summary(spark, failures):
    cols = ", ".join(f"{c} {t}" for c, t in zip(C.SUMMARY_COLS, ["string"] * 4 + ["bigint"]))
    return spark.createDataFrame([("unique", "m", "c", "error", failures)], cols)


def _urls(df):
    return sorted((r.match_url, r.home_score) for r in df.collect())


def test_prepare_and_promote_respect_gate(spark, tmp_path):
    store = Versions(spark, str(tmp_path / "store"))
    day = dt.datetime(2026, 1, 1)
    draft = PB.prepare(store, "s0")
    assert store.current() is None and draft.table("matches").count() == 0
    draft.merge("matches", _m(spark, "/f/1", 1, day), ["match_url"], ["scraped_at"], by="season")
    ok, diff = PB.promote(store, draft, _summary(spark, 1))
    assert not ok and store.current() is None
    ok, diff = PB.promote(store, draft, _summary(spark, 0))
    first = store.current()
    d = {r.table_name: (r.before_rows, r.after_rows, r.change_text) for r in diff.collect()}
    assert ok and d["matches"] == (0, 1, "+1") and d["standings"] == (0, 0, "+0")
    # a later run: the draft names the folders it starts from
    draft = PB.prepare(store, "s1")
    assert draft.unchanged("matches")
    draft.merge("matches", _m(spark, "/f/2", 2, day), ["match_url"], ["scraped_at"], by="season")
    assert _urls(store.table("matches")) == [("/f/1", 1)]          # readers see nothing of it
    ok, _ = PB.promote(store, draft, _summary(spark, 0))
    assert ok and _urls(store.table("matches")) == [("/f/1", 1), ("/f/2", 2)]
    # the backup is the old pointer
    assert store.history()[1] == first and _urls(store.table("matches", first)) == [("/f/1", 1)]
    store.rollback(first)
    assert _urls(store.table("matches")) == [("/f/1", 1)]
    # a draft whose base was published over is refused
    a, b = store.begin("a"), store.begin("b")
    store.publish(a)
    with pytest.raises(RuntimeError):
        store.publish(b)


def test_a_run_that_dies_leaves_the_old_version_whole(spark, tmp_path, monkeypatch):
    store = Versions(spark, str(tmp_path / "store"))
    day = dt.datetime(2026, 1, 1)
    draft = store.begin("s0")
    for t in ("matches", "others"):
        draft.write(t, _m(spark, "/f/1", 1, day))
    store.publish(draft)
    # killed between two tables
    draft = store.begin("s1")
    draft.write("matches", _m(spark, "/f/9", 9, day))
    assert {n: _urls(df) for n, df in store.tables().items()} == {"matches": [("/f/1", 1)], "others": [("/f/1", 1)]}
    # killed between the pointer's file and the rename
    old = store.current()
    monkeypatch.setattr(store.files, "replace", lambda *a: (_ for _ in ()).throw(OSError("killed")))
    with pytest.raises(OSError):
        store.publish(draft)
    assert Versions(spark, store.root).current() == old and _urls(store.table("matches")) == [("/f/1", 1)]
    monkeypatch.undo()
    # what no version names can be cleared, and only that
    assert store.expire(5) == [draft.version] and _urls(store.table("matches")) == [("/f/1", 1)]


def test_merge_rewrites_only_parts_it_touches(spark, tmp_path):
    from pyspark.sql import functions as F

    from pitchstar.operators.upsert import upsert
    store = Versions(spark, str(tmp_path / "store"))
    day = dt.datetime(2026, 1, 1)
    row = _m(spark, "/f/0", 0, day).first().asDict()
    schema = _m(spark, "/f/0", 0, day).schema
    rows = lambda *keys: spark.createDataFrame([{**row, "match_url": u, "season": s, "home_score": n} for u, s, n in keys], schema)
    seasons = ["a", "b", "c", "d", None, ""]
    base = rows(*[(f"/f/{k}", seasons[k % 6], k) for k in range(600)], (None, "a", 7))
    draft = store.begin("s0")
    draft.merge("matches", base, ["match_url"], ["scraped_at"], by="season")
    store.publish(draft)
    parts = lambda e: {p: x["path"] for p, x in e["parts"].items()}
    before = parts(draft.entries["matches"])
    # a new key for b, a key of a that moves to c, the null key
    batch = rows(("/f/new", "b", 1), ("/f/6", "c", 2), (None, "e", 3))
    draft = store.begin("s1")
    touched = draft.merge("matches", batch, ["match_url"], ["scraped_at"], by="season")
    after = parts(draft.entries["matches"])
    want = upsert(base, batch, ["match_url"], ["scraped_at"])
    same = lambda df: sorted(map(str, df.select("match_url", "season", "home_score").collect()))
    assert same(draft.table("matches")) == same(want)
    assert sum(after.get(p) == q for p, q in before.items()) == 2 and len(after) == 6 and len(touched) == 4
    assert sum(x["rows"] for x in draft.entries["matches"]["parts"].values()) == want.count()
    # keys not stored touch no part but the one they arrive in; an empty batch touches none
    draft = store.begin("s2")
    assert len(draft.merge("matches", rows(*[(f"/g/{k}", "d", 0) for k in range(500)]), ["match_url"], ["scraped_at"], by="season")) == 1
    draft = store.begin("s3")
    assert draft.merge("matches", base.limit(0), ["match_url"], ["scraped_at"], by="season") == [] and draft.unchanged("matches")
    # a part that loses all its rows is gone
    draft = store.begin("s4")
    draft.merge("matches", base.filter("season = 'd'").withColumn("season", F.lit("a")), ["match_url"], ["scraped_at"], by="season")
    assert len(draft.entries["matches"]["parts"]) == len(before) - 1 and draft.table("matches").filter("season = 'd'").count() == 0


def test_last_in_the_input_wins_a_tie(spark, tmp_path):
    from pitchstar.operators.upsert import upsert
    day = dt.datetime(2026, 1, 1)
    head = ",".join(RAW["matches"].fieldNames())
    line = lambda url, venue: f"s,,g,c,2026-01-01,,h,a,1,2,{venue},{url},2026-01-01T00:00:00"
    folder = tmp_path / "batch"
    folder.mkdir()
    (folder / "part-1.csv").write_text("\n".join([head, line("/f/1", "zzz first"), line("/f/2", "kept"), line("/f/1", "aaa last")]))
    (folder / "part-2.csv").write_text("\n".join([head, line("/f/2", "a later file"), line("/f/3", "mmm"), line("/f/3", "ccc")]))
    batch = R.read_raw(spark, str(folder), "matches", sequence=True).repartition(7)
    merged = upsert(_m(spark, "/f/1", 1, day), batch, ["match_url"])
    assert {r.match_url: r.venue for r in merged.collect()} == {"/f/1": "aaa last", "/f/2": "a later file", "/f/3": "ccc"}
    assert merged.columns == RAW["matches"].fieldNames()


def test_rejected_values_are_told(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    head = ",".join(RAW["matches"].fieldNames())
    (folder / "a.csv").write_text("\n".join([head, "s,,g,c,2026-01-01,,h,a,1,2,v,/f/1,2026-01-01T00:00:00",
                                             "s,,g,c,2026-13-01,,h,a,three, ,v,/f/2,", "s,,g,c,,,h,a,,4.5,v,/f/3,soon"]))
    got = sorted((r.pos, r.column_name, r.text) for r in R.rejects(spark, str(folder), "matches").collect())
    assert [x[1:] for x in got] == [("away_score", " "), ("home_score", "three"), ("match_date", "2026-13-01"), ("away_score", "4.5"), ("scraped_at", "soon")]
    assert R.read_raw(spark, str(folder), "matches").count() == 3
    (tmp_path / "none").mkdir()
    assert R.rejects(spark, str(tmp_path / "none"), "matches").count() == 0
    counts = {r.column_name: (r.n_rejected, r.n_files) for r in R.reject_counts(R.rejects(spark, str(folder), "matches")).collect()}
    assert counts["away_score"] == (2, 1)


def test_refresh_flow_publishes_clean_data_and_blocks_bad(spark, tmp_path):
    from pitchstar.plans.loading import clean_tables
    from pitchstar.sources.fixtures import raw_tables
    store = Versions(spark, str(tmp_path / "rf"))
    raw = raw_tables(spark, "/root/testdata/sf0.001")
    # the raw fixture has events of TBC teams (no team id): the run must be blocked
    ok, summary, diff = PB.refresh(store, raw, "s1", as_of="2100-01-01")
    assert not ok and store.current() is None
    failing = {(r.model, r.column_name) for r in summary.filter("failures > 0 AND severity = 'error'").collect()}
    assert ("fct_match_events", "team_id") in failing
    clean = clean_tables(spark, "/root/testdata/sf0.001")
    ok2, summary2, diff2 = PB.refresh(store, clean, "s2", as_of="2100-01-01")
    bad = [(r.model, r.column_name, r.failures) for r in summary2.filter("failures > 0 AND severity = 'error'").collect()]
    assert ok2, bad
    assert store.table("fct_matches").count() == clean["matches"].count()
    # only events again: models of the other tables keep their folders
    first = store.pointer(store.current())["tables"]
    ok3, _, diff3 = PB.refresh(store, {"match_events": clean["match_events"].limit(5)}, "s3", as_of="2100-01-01")
    second = store.pointer(store.current())["tables"]
    assert ok3 and {r.change_text for r in diff3.collect()} == {"+0"}
    assert {n for n in first if first[n] != second[n]} == {"match_events", "stg_match_events", "dim_players", "fct_match_events", "check_summary"}


def test_databases_reattach_tables_of_earlier_runs(spark, tmp_path):
    dbs = PB.ensure_databases(spark, str(tmp_path), "ra")
    R.materialize(_m(spark, "/f/1", 1, dt.datetime(2026, 1, 1)), dbs["pre"], "matches")
    # a session whose catalog forgot the table (as a new process would)
    spark.sql(f"DROP TABLE {dbs['pre']}.matches")          # external: files stay
    assert not spark.catalog.tableExists(f"{dbs['pre']}.matches")
    dbs2 = PB.ensure_databases(spark, str(tmp_path), "ra")
    assert spark.table(f"{dbs2['pre']}.matches").count() == 1
    # overwriting an attached table works, and dropping a working table removes its data
    R.materialize(_m(spark, "/f/2", 1, dt.datetime(2026, 1, 1)), dbs2["pre"], "matches")
    assert [r.match_url for r in spark.table(f"{dbs2['pre']}.matches").collect()] == ["/f/2"]
    R.drop_table(spark, dbs2["pre"], "matches")
    PB.ensure_databases(spark, str(tmp_path), "ra")
    assert not spark.catalog.tableExists(f"{dbs2['pre']}.matches")


def test_command_line_refresh_and_ask(spark, tmp_path, capsys):
    from pyspark.sql import functions as F

    from pitchstar.__main__ import main
    from pitchstar.operators.pages import dedupe_first
    from pitchstar.sources.fixtures import raw_tables
    raw = raw_tables(spark, "/root/testdata/sf0.001")
    s = raw["standings"].filter(F.col("phase").isNotNull())
    m = dedupe_first(raw["matches"], ["season", "competition", "match_date", "home_team", "away_team"],
                     ["match_url"]).filter(~F.col("away_team").startswith("TBC") & F.col("phase").isNotNull()) \
        .join(s.select("season").distinct(), "season", "left_semi")
    e = dedupe_first(raw["match_events"].join(m.select("match_url"), "match_url", "left_semi"),
                     ["match_url", "event_type", "team", "player_name", "minute"], ["event_subtype"])
    for t, df in {"standings": s, "matches": m, "match_events": e}.items():
        R.write_rows(df, f"{tmp_path}/collected/{t}", table=t)
    args = ["refresh", "--collected", f"{tmp_path}/collected", "--root", f"{tmp_path}/wh", "--name", "cli",
            "--as-of", "2100-01-01"]
    assert main(args) == 0
    assert main(args) == 0          # second run: production carried over, +0 rows
    out = capsys.readouterr().out
    assert out.count("published") == 2 and "+0" in out
    assert main(["ask", "--root", f"{tmp_path}/wh", "--name", "cli", "league_table", "1997-1998",
                 "League Mens Premier BUILDING"]) == 0
