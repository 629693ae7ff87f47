"""Oracle SQL for the analytic questions, parameterised like the Spark side."""

from .models import with_models


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _in(vals) -> str:
    return ", ".join(q(v) for v in vals)


def season_matches(seasons) -> str:
    return (f"SELECT m.match_id FROM fct_matches m JOIN dim_seasons s ON m.season_id = s.season_id "
            f"WHERE s.season_name IN ({_in(seasons)})")


def events_where(seasons=None, comps=None, etype=None) -> str:
    w = ["TRUE"]
    if etype:
        w.append(f"e.event_type = {q(etype)}")
    if comps is not None:
        w.append(f"e.competition_name IN ({_in(comps)})")
    if seasons is not None:
        w.append(f"e.match_id IN ({season_matches(seasons)})")
    return " AND ".join(w)


def _wm(body: str) -> str:
    """Models prefix + extra CTEs: body starts with ', name AS (...)'."""
    base = with_models("")
    return base.rstrip() + "\n" + body


def top_scorers(season, comp, n=10):
    return _wm(_scorers_body(events_where([season], [comp], "goal"), n))


def _scorers_body(where: str, n: int) -> str:
    return f""", g AS (SELECT e.* FROM fct_match_events e WHERE {where}),
fine AS (SELECT player_id, team_name, count(*) AS goals FROM g GROUP BY player_id, team_name),
named AS (SELECT f.player_id, f.team_name, f.goals, p.player_name
          FROM fine f LEFT JOIN dim_players p ON f.player_id = p.player_id),
tot AS (SELECT player_id, player_name, sum(goals) AS t FROM named GROUP BY player_id, player_name),
win AS (SELECT player_id, player_name FROM tot
        ORDER BY t DESC, player_name ASC NULLS FIRST, player_id ASC NULLS FIRST LIMIT {n})
SELECT n.player_name, n.team_name, n.goals FROM named n
WHERE EXISTS (SELECT 1 FROM win w WHERE w.player_id IS NOT DISTINCT FROM n.player_id
              AND w.player_name IS NOT DISTINCT FROM n.player_name)
"""


def league_table(season, comp):
    return with_models(f"""
SELECT team_name, min("position") AS "position", CAST(sum(points) AS BIGINT) AS points
FROM fct_standings st JOIN dim_seasons s ON st.season_id = s.season_id
WHERE s.season_name = {q(season)} AND st.competition_name = {q(comp)}
GROUP BY team_name""")


def team_results(season, comp, team):
    return with_models(f"""
SELECT match_date, home_team_name, away_team_name, home_score, away_score
FROM fct_matches m WHERE m.match_id IN ({season_matches([season])})
  AND competition_name = {q(comp)} AND match_status = 'Completed'
  AND (home_team_name = {q(team)} OR away_team_name = {q(team)})""")


def most_goals(season, n=1):
    return with_models(f"""
SELECT team_name, CAST(sum(goals_for) AS BIGINT) AS goals_for
FROM fct_standings st JOIN dim_seasons s ON st.season_id = s.season_id
WHERE s.season_name = {q(season)}
GROUP BY team_name ORDER BY goals_for DESC, team_name ASC LIMIT {n}""")


def team_record(team, season):
    return with_models(f"""
SELECT competition_name, played, won, drawn, lost
FROM fct_standings st JOIN dim_seasons s ON st.season_id = s.season_id
WHERE s.season_name = {q(season)} AND st.team_name = {q(team)}""")


def goal_split():
    return with_models("""
SELECT event_subtype, count(*) AS goals FROM fct_match_events
WHERE event_type = 'goal' GROUP BY event_subtype""")


def best_goal_difference(like="%Mens%", n=1):
    return with_models(f"""
SELECT team_name, competition_name, season_id, phase_id, goal_difference
FROM fct_standings WHERE competition_group LIKE {q(like)}
ORDER BY goal_difference DESC, team_name ASC, competition_name ASC,
  season_id ASC NULLS FIRST, phase_id ASC NULLS FIRST LIMIT {n}""")


def home_away_counts():
    return with_models("""
SELECT CASE WHEN is_home THEN home_team_name ELSE away_team_name END AS team_name, is_home,
  count(*) AS matches
FROM fct_team_matches GROUP BY 1, 2""")


def upcoming(comp):
    return with_models(f"""
SELECT match_id, match_date, match_time, home_team_name, away_team_name, venue
FROM fct_matches WHERE match_status = 'Upcoming' AND competition_name = {q(comp)}""")


def movement():
    return with_models("""
SELECT a.team_name, a.competition_name, a.season_id, a."position" AS "position",
  b."position" AS prev_position, b."position" - a."position" AS places_gained
FROM fct_standings a LEFT JOIN fct_standings b
  ON a.team_name = b.team_name AND a.competition_name = b.competition_name
 AND a.season_id = b.season_id + 1""")


def card_count(colour, season):
    return with_models(f"""
SELECT count(*) AS cards FROM fct_match_events e
WHERE {events_where([season], None, 'card')} AND e.event_subtype = {q(colour)}""")


def highest_scoring(n=5):
    return with_models(f"""
SELECT match_id, match_date, home_team_name, away_team_name, home_score, away_score,
  home_score + away_score AS total_goals
FROM fct_matches WHERE home_score IS NOT NULL AND away_score IS NOT NULL
ORDER BY total_goals DESC, match_date ASC, match_id ASC, home_score DESC LIMIT {n}""")


def division_results(comp):
    return with_models(f"""
SELECT match_id, match_date, home_team_name, away_team_name, home_score, away_score
FROM fct_matches WHERE competition_name = {q(comp)} AND match_status = 'Completed'""")


def scorer_consistency(seasons, comps=None):
    cols = ",\n  ".join(
        f"CAST(sum(CASE WHEN season_name = {q(s)} THEN goals END) AS BIGINT) AS goals_{s.replace('-', '_')}"
        for s in seasons)
    return _wm(f""", g AS (SELECT e.* FROM fct_match_events e WHERE {events_where(seasons, comps, 'goal')}),
ms AS (SELECT DISTINCT m.match_id, s.season_name FROM fct_matches m
       LEFT JOIN dim_seasons s ON m.season_id = s.season_id),
per AS (SELECT g.player_id, ms.season_name, count(*) AS goals FROM g JOIN ms ON g.match_id = ms.match_id
        GROUP BY g.player_id, ms.season_name)
SELECT p.player_name, {cols}
FROM per LEFT JOIN dim_players p ON per.player_id = p.player_id
GROUP BY per.player_id, p.player_name
""")


def scorer_profile(comps, season):
    return _wm(f""", g AS (SELECT e.* FROM fct_match_events e WHERE {events_where([season], comps, 'goal')}),
c AS (SELECT player_id, team_name,
        CAST(count(*) FILTER (WHERE event_subtype = 'FG') AS BIGINT) AS fg,
        CAST(count(*) FILTER (WHERE event_subtype = 'PC') AS BIGINT) AS pc,
        CAST(count(*) FILTER (WHERE event_subtype = 'PS') AS BIGINT) AS ps
      FROM g GROUP BY player_id, team_name)
SELECT p.player_name, c.team_name, fg, pc, ps, fg + pc + ps AS goals,
  round(CAST(pc AS DOUBLE) / nullif(CAST(fg + pc + ps AS DOUBLE), 0), 4) AS pc_share
FROM c LEFT JOIN dim_players p ON c.player_id = p.player_id
""")


def goal_share(season):
    return _wm(f""", g AS (SELECT e.* FROM fct_match_events e WHERE {events_where([season], None, 'goal')}),
per AS (SELECT player_id, team_name, competition_name, count(*) AS goals FROM g
        GROUP BY player_id, team_name, competition_name),
team AS (SELECT team_name, competition_name, CAST(sum(goals) AS BIGINT) AS team_goals FROM per
         GROUP BY team_name, competition_name),
st AS (SELECT st.team_name, st.competition_name, st."position" FROM fct_standings st
       JOIN dim_seasons s ON st.season_id = s.season_id WHERE s.season_name = {q(season)})
SELECT p.player_name, per.team_name, per.competition_name, per.goals, team.team_goals,
  round(CAST(per.goals AS DOUBLE) / nullif(CAST(team.team_goals AS DOUBLE), 0), 4) AS goal_share,
  st."position" AS "position"
FROM per
LEFT JOIN team ON per.team_name IS NOT DISTINCT FROM team.team_name
  AND per.competition_name IS NOT DISTINCT FROM team.competition_name
LEFT JOIN st ON per.team_name = st.team_name AND per.competition_name = st.competition_name
LEFT JOIN dim_players p ON per.player_id = p.player_id
""")


def tier_case(name: str, season: str, levels) -> str:
    """Tier by the first level word of a name that is valid in the season."""
    def valid(since, until):
        return "".join([f" AND {season} >= {q(since)}" if since else "", f" AND {season} <= {q(until)}" if until else ""])
    return "CASE " + " ".join(
        f"WHEN list_contains(regexp_split_to_array({name}, '\\s+'), {q(w)}){valid(since, until)} THEN {t}"
        for w, t, since, until in sorted(levels, key=lambda x: x[1])) + " END"


LEVELS = [("Premier", 1, None, None), ("Division", 2, None, None), ("Conference", 3, None, None)]
GENDER = "CASE WHEN {0} LIKE '%Mens%' OR {0} LIKE '%Open%' THEN 'Mens' ELSE 'Womens' END"


def tier_shortlist(gender, tiers, season, n=10):
    where = (events_where([season], None, "goal")
             + f" AND {GENDER.format('e.competition_group')} = {q(gender)}"
             + f" AND {tier_case('e.competition_name', q(season), LEVELS)} IN ({', '.join(str(t) for t in tiers)})")
    return _wm(_scorers_body(where, n))


def competitions(levels) -> str:
    return f"""SELECT s.season_name, competition_group, competition_name, {GENDER.format('competition_group')} AS gender,
  CAST({tier_case('competition_name', 's.season_name', levels)} AS INTEGER) AS tier,
  min(d) AS first_match, max(d) AS last_match, CAST(sum(m) AS BIGINT) AS n_matches, CAST(sum(t) AS BIGINT) AS n_standings
FROM (SELECT season_id, competition_group, competition_name, match_date AS d, 1 AS m, 0 AS t FROM fct_matches
      UNION ALL SELECT season_id, competition_group, competition_name, NULL, 0, 1 FROM fct_standings) x
LEFT JOIN dim_seasons s USING (season_id) GROUP BY 1, 2, 3"""


def competition_catalogue():
    return with_models(f"""
SELECT *, CASE tier WHEN 1 THEN 'Premier' WHEN 2 THEN 'Division' WHEN 3 THEN 'Conference' END AS level,
  CASE WHEN strpos(competition_name, ' Phase 2') > 0 THEN left(competition_name, strpos(competition_name, ' Phase 2') - 1)
       ELSE competition_name END AS division
FROM ({competitions(LEVELS)}) c""")


def unknown_competitions(levels):
    return with_models(f"""
SELECT season_name, competition_group, competition_name, n_matches,
  CASE WHEN tier IS NULL THEN 'no level of this season in the name' ELSE 'the name and its group differ in gender' END AS reason
FROM ({competitions(levels)}) c
WHERE tier IS NULL OR (competition_name LIKE '%Womens%' AND gender = 'Mens') OR (competition_name LIKE '%Mens%' AND gender = 'Womens')""")


def season_coverage(seasons):
    asked = ", ".join(f"({q(s)})" for s in seasons)
    return with_models(f"""
SELECT a.season_name, s.season_id IS NOT NULL AS held, count(m.match_id) AS n_matches,
  count(m.match_id) FILTER (m.match_status = 'Completed') AS n_completed,
  CASE WHEN s.season_id IS NULL THEN 'only seasons ' || (SELECT min(season_name) FROM dim_seasons) || ' to '
            || (SELECT max(season_name) FROM dim_seasons) || ' are held'
       WHEN count(m.match_id) = 0 THEN 'the season holds tables and no matches' END AS reason
FROM (VALUES {asked}) a(season_name) LEFT JOIN dim_seasons s USING (season_name)
LEFT JOIN fct_matches m ON m.season_id = s.season_id GROUP BY a.season_name, s.season_id""")


def team_journey(team):
    return with_models(f"""
SELECT match_id, match_date, competition_name, is_home,
  CASE WHEN is_home THEN away_team_name ELSE home_team_name END AS opponent,
  CASE WHEN is_home THEN home_score ELSE away_score END AS goals_for,
  CASE WHEN is_home THEN away_score ELSE home_score END AS goals_against,
  CASE WHEN (CASE WHEN is_home THEN home_score ELSE away_score END) >
            (CASE WHEN is_home THEN away_score ELSE home_score END) THEN 'W'
       WHEN (CASE WHEN is_home THEN home_score ELSE away_score END) =
            (CASE WHEN is_home THEN away_score ELSE home_score END) THEN 'D'
       WHEN (CASE WHEN is_home THEN home_score ELSE away_score END) <
            (CASE WHEN is_home THEN away_score ELSE home_score END) THEN 'L' END AS result
FROM fct_team_matches
WHERE (CASE WHEN is_home THEN home_team_name ELSE away_team_name END) = {q(team)}""")


def ask_goals_by_team():
    return with_models("""
SELECT s.season_name, e.team_name, count(e.event_id) AS goals
FROM fct_match_events e
LEFT JOIN (SELECT DISTINCT match_id, season_id FROM fct_matches) m ON e.match_id = m.match_id
LEFT JOIN dim_seasons s ON m.season_id = s.season_id
WHERE e.event_type = 'goal'
GROUP BY s.season_name, e.team_name""")


def ask_home_team():
    return with_models("""
SELECT s.season_name, t.team_name AS home_team_team_name, CAST(sum(m.home_score) AS BIGINT) AS scored, count(m.match_id) AS matches
FROM fct_matches m
LEFT JOIN dim_seasons s ON m.season_id = s.season_id
LEFT JOIN dim_teams t ON m.home_team_id = t.team_id
WHERE m.competition_name LIKE '%Premier%'
GROUP BY ALL""")


def ask_opponent():
    return with_models("""
SELECT t.team_name, o.team_name AS opponent_team_name, count(*) AS matches
FROM fct_team_matches m
JOIN dim_seasons s ON m.season_id = s.season_id AND s.season_name BETWEEN '1996-1997' AND '1998-1999'
JOIN dim_teams o ON m.opponent_id = o.team_id AND o.team_name LIKE '%_1%'
LEFT JOIN dim_teams t ON m.team_id = t.team_id
GROUP BY ALL""")


def ask_top_members():
    return with_models("""
, g AS (
  SELECT p.player_name, s.season_name, count(*) AS goals
  FROM fct_match_events e
  LEFT JOIN dim_players p ON e.player_id = p.player_id
  LEFT JOIN (SELECT DISTINCT match_id, season_id FROM fct_matches) m ON e.match_id = m.match_id
  LEFT JOIN dim_seasons s ON m.season_id = s.season_id
  WHERE e.event_type = 'goal' AND e."minute" >= 10
  GROUP BY ALL
), best AS (
  SELECT player_name FROM g GROUP BY 1 ORDER BY sum(goals) DESC, player_name NULLS FIRST LIMIT 5
)
SELECT * FROM g WHERE player_name IN (SELECT player_name FROM best)""")


def capped_matches(n: int) -> str:
    return with_models(f"""SELECT match_id, match_date, home_team_name, away_team_name FROM fct_matches
ORDER BY match_date DESC, match_id LIMIT {n}""")
