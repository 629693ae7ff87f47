"""Findings of round 4: checks, drafts and merges over large tables write and move
less, and count repeated ids without making their pairs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pitchstar.functions.keys import packed, unpacked
from pitchstar.operators import checks as C
from pitchstar.plans import models as M
from pitchstar.schemas import RAW
from pitchstar.sources.raw import stored

AT = dt.datetime(2026, 1, 1)


def _raw(spark):
    """Matches whose ids occur once, twice and four times, a TBC team, unknown
    phases and teams, events without a match, a player or a team."""
    day = dt.date(2025, 9, 1)
    match = lambda url, home, away, phase, h, a, season="s1": (season, phase, "g", "c", day, None, home, away, h, a, None if h == 9 else "v", url, AT)
    matches = [match("/1", "A", "B", "Phase 1", 1, 0), match("/2", "A", "B", "Phase 1", 2, 0), match("/3", "A", "TBC 1", None, None, None),
               match("/4", "A", "TBC 1", None, 3, 3), match("/5", "A", "TBC 1", "Phase 9", 9, 9), match("/6", "A", "TBC 1", None, 1, 1),
               match("/7", "B", "C", "Phase 2", 0, 0, "s2"), match(None, None, "C", "Phase 2", 0, 0, None), match("/7", "C", "B", "Phase 2", 0, 5, "s2")]
    event = lambda url, team, player, minute, kind="goal": ("s1", url, day, "A", "B", "l", "l", kind, "FG", team, player, minute, AT)
    events = [event("/1", "A", "P1", 1), event("/1", "A", "P1", 1), event("/7", "B", "P2", 2), event("/nowhere", "A", "P2", 3), event(None, "X", None, 4, None), event("/3", None, "P1", None)]
    line = lambda team, phase, place, season="s1": (season, phase, "g", "c", place, team, 1, 1, 0, 0, 1, 0, 1, 3, "u", AT)
    standings = [line("A", "Phase 1", 1), line("B", "Phase 1", 2), line("B", "Phase 1", 2), line("C", "Phase 2", None, "s2"), line("A", None, 1)]
    rows = {"standings": standings, "matches": matches, "match_events": events}
    return {t: spark.createDataFrame(r, RAW[t]) for t, r in rows.items()}


def _plain(star, as_of):
    """The summary as its tests say, a test at a time, over all rows of each model."""
    star, out = {m: df.persist() for m, df in stored({m: star[m] for m in star}).items()}, {}
    for m, c, t, a, s in C.MODEL_TESTS:
        df = star[m]
        found = {"not_null": lambda: df.filter(F.col(c).isNull()), "unique": lambda: C.unique(df, c), "accepted_values": lambda: C.accepted_values(df, c, a),
                 "relationships": lambda: C.relationships(df, c, star[a[0]].alias("p"), a[1])}[t]()
        out[(t, m, c, s)] = found.count()
    (future, se), (tbc, st) = C.CUSTOM_TESTS
    out[(future, "fct_matches", "", se)] = C.no_future_results(star["fct_matches"], as_of).count()
    out[(tbc, "fct_matches", "", st)] = C.tbc_without_ids(star["fct_matches"], star["stg_matches"]).count()
    return out


def _told(summary):
    rows = summary.collect()
    got = {(r.check_name, r.model, r.column_name, r.severity): r.failures for r in rows}
    assert len(got) == len(rows)
    return got


def test_packed_text_is_told_apart_and_comes_back(spark):
    digest = "00112233445566778899aabbccddeeff"
    texts = [digest, digest.upper(), digest[:31] + "g", "", "a" * 15, "a" * 16, "a" * 14, "a" * 15 + "\x00", "a" * 15 + "\x00\x00", "ä" * 8, "ä" * 16, "/fixtures/1", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", packed("t").alias("v")).withColumn("back", unpacked("v")).collect()
    assert [r.back for r in rows] == texts and len({r.v and bytes(r.v) for r in rows}) == len(texts)
    assert len(rows[0].v) == 16


def test_summary_equals_each_test_and_makes_no_pairs(spark, monkeypatch):
    star = M.CheckedStar(_raw(spark))
    want = _plain(star, "2025-01-01")
    assert star["fct_team_matches"].count() == 2 * (2 * 2 + 4 * 4 + 3) and want[("not_null", "fct_team_matches", "phase_id", "warn")] > 16

    def never(*_):
        raise AssertionError("pairs of repeated ids are made")

    monkeypatch.setattr(M, "_with_scores", never)
    assert _told(C.run_checks(M.CheckedStar(_raw(spark)), "2025-01-01")) == want
    assert _told(C.run_checks({m: star[m] for m in star}, "2025-01-01")) == want   # any mapping


def test_keys_of_a_large_table_are_counted_alone(spark):
    groups = C.key_groups()
    assert groups[("fct_matches", "match_id")] == [("fct_matches", "match_id"), ("fct_team_matches", "match_id"), ("fct_match_events", "match_id")]
    tested = [(m, c) for m, c, t, _, _ in C.MODEL_TESTS if t in ("unique", "relationships")]
    assert all(any(x in g for g in groups.values()) for x in tested)


def test_dimensions_are_stored_so_that_facts_need_no_shuffle(spark):
    star = M.build_star(_raw(spark))
    assert star["dim_teams"].inputFiles() and star["dim_players"].inputFiles()
    plan = star["fct_matches"]._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan
    events = M.CheckedStar(_raw(spark))["fct_match_events"]
    assert events.inputFiles() and "Join" not in events._jdf.queryExecution().optimizedPlan().toString()


def test_draft_keeps_repeated_ids_without_their_pairs(spark, tmp_path, monkeypatch):
    from pitchstar.plans import publish as PB
    from pitchstar.sources.versions import Versions
    raw = _raw(spark)
    store = Versions(spark, str(tmp_path / "store"))
    draft = PB.prepare(store, "s")
    for t, df in raw.items():
        draft.write(t, df)
    monkeypatch.setattr(M, "_with_scores", lambda *_: pytest.fail("pairs of repeated ids are made"))
    star = PB.DraftStar(draft)
    PB.build_models(star)
    got = _told(C.run_checks(star, "2025-01-01"))
    monkeypatch.undo()
    plain = M.build_star(raw)
    same = lambda df, cols: sorted(map(str, df.select(*cols).collect()))
    for name in star:
        assert same(star[name], plain[name].columns) == same(plain[name], plain[name].columns), name
        assert draft.rows()[name] == plain[name].count(), name
    assert got == _plain(plain, "2025-01-01")
    assert spark.read.parquet(f"{draft.root}/fct_team_matches").count() == 18   # two for each match
    store.publish(draft)   # a version read anew, and a run that inherits the table
    assert store.table("fct_team_matches").count() == plain["fct_team_matches"].count()
    assert _told(C.run_checks(PB.DraftStar(store.begin("t")), "2025-01-01")) == got


def test_merge_writes_the_batch_once_and_probes_other_parts_only(spark, tmp_path, monkeypatch):
    from pitchstar.operators.upsert import upsert
    from pitchstar.sources.versions import Draft, Versions
    m = _raw(spark)["matches"].limit(1).drop("season", "match_url", "home_score")
    rows = lambda keys: m.crossJoin(spark.createDataFrame(keys, "season string, match_url string, home_score long")).select(*RAW["matches"].fieldNames())
    store = Versions(spark, str(tmp_path / "a folder"))
    base = rows([(f"s{k % 4}", f"/{k}", k) for k in range(400)])
    draft = store.begin("one")
    draft.merge("matches", base, ["match_url"], ["scraped_at"], by="season")
    assert not store.files.exists(f"{draft.root}/_batch")
    store.publish(draft)
    asked = []
    real = Draft._parts_with
    monkeypatch.setattr(Draft, "_parts_with", lambda self, entry, batch, keys, arriving: asked.append((set(arriving), real(self, entry, batch, keys, arriving))) or asked[-1][1])
    small = rows([("s0", "/1", -1), ("s0", "/4", -4), ("s0", "/new", 0), ("s0", None, 1)])     # /1 moves from s1
    large = rows([(f"s{k % 2}", f"/{k}", -k) for k in range(0, 400)])                            # all of s2 and s3 move
    for batch, others in ((small, 1), (large, 2)):
        draft = store.begin("two")
        draft.merge("matches", batch, ["match_url"], ["scraped_at"], by="season")
        want = upsert(base, batch, ["match_url"], ["scraped_at"])
        same = lambda df: sorted(map(str, df.select("match_url", "season", "home_score").collect()))
        assert same(draft.table("matches")) == same(want) and draft.rows()["matches"] == want.count()
        arriving, found = asked[-1]
        assert len(found) == others and not arriving & set(found)
