"""Oracle SQL for the extraction jobs. The article jobs re-split the driver
pages with DuckDB's own regex functions; the league-page jobs compute what
the parsers must give back straight from the fixture rows."""

import html.entities

from pitchstar.plans import extraction as X

from .models import with_models

START = X.ARTICLE_START

# whitespace as Python's str.split() sees it (rule, not a list)
WS = "[" + "".join(c for c in map(chr, range(0x110000)) if c.isspace()) + "]"


def _q(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


# the named references of HTML 4 (the standard library's copy) and &apos;
_NAMES = {**{n: chr(c) for n, c in html.entities.name2codepoint.items()}, "apos": "'"}
NAMES = "MAP([" + ", ".join(map(_q, _NAMES)) + "], [" + ", ".join(map(_q, _NAMES.values())) + "])"


def decoded(x: str) -> str:
    """Character references as a browser shows them, each decoded once."""
    ref = "regexp_extract(p, '^(#?[0-9A-Za-z]{1,31});', 1)"
    code = (f"CASE WHEN regexp_full_match({ref}, '#[0-9]{{1,7}}') THEN TRY_CAST(substr({ref}, 2) AS INTEGER) "
            f"WHEN regexp_full_match({ref}, '#[xX][0-9A-Fa-f]{{1,6}}') THEN TRY_CAST('0x' || substr({ref}, 3) AS INTEGER) END")
    shown = f"CASE WHEN {ref} LIKE '#%' THEN chr({code}) ELSE {NAMES}[{ref}] END"
    return (f"array_to_string(list_transform(string_split({x}, '&'), lambda p, i: CASE WHEN i = 1 THEN p "
            f"ELSE coalesce({shown} || regexp_replace(p, '^[^;]*;', ''), '&' || p) END), '')")


def strip(x: str) -> str:
    bare = f"regexp_replace({x}, '<[^>]*>', ' ', 'g')"
    return f"trim(regexp_replace({decoded(bare)}, '{WS}+', ' ', 'g'))"


def clean(x: str) -> str:
    t = f"trim(regexp_replace(translate({x}, '’‘ʼ', ''''''''''), '{WS}+', ' ', 'g'))"
    return f"coalesce(nullif({t}, ''), 'Unknown')"


ELEMENTS = f"""
d AS (SELECT page_id, regexp_extract_all(html, '{START}') AS delims,
             regexp_split_to_array(html, '{START}') AS pieces FROM pages),
di AS (SELECT page_id, delims, pieces, unnest(generate_series(1, len(delims))) AS i FROM d),
e0 AS (SELECT page_id, i - 1 AS pos, delims[i] || pieces[i + 1] AS chunk FROM di),
e1 AS (SELECT page_id, pos, regexp_extract(chunk, '^<([a-z0-9]+)', 1) AS kind, chunk FROM e0),
elements AS (SELECT page_id, pos, kind,
   {strip("CASE WHEN kind = 'p' THEN split_part(chunk, '</p>', 1) ELSE split_part(chunk, '</h1>', 1) END")} AS text
   FROM e1)
"""


def page_elements() -> str:
    return "WITH " + ELEMENTS + "SELECT page_id, pos, kind, text FROM elements"


def page_sections() -> str:
    hdr = f"CASE WHEN kind = 'h1' AND coalesce(text, '') <> '' THEN {clean('text')} END"
    return "WITH " + ELEMENTS + f""",
s AS (SELECT page_id, pos, kind, text, coalesce(last_value({hdr} IGNORE NULLS) OVER (
        PARTITION BY page_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 'Unknown') AS section
      FROM elements)
SELECT page_id, pos, section, text FROM s WHERE kind <> 'h1'"""


PHASE = ("CASE WHEN competition LIKE '%Phase 2%' THEN 'Phase 2' "
         "WHEN competition LIKE '%Premier%' THEN 'Phase 1' ELSE '' END")

ROWS = f"""
SELECT season, {PHASE} AS phase, competition_group, competition, match_date,
  coalesce(match_time, '') AS match_time, home_team, away_team, home_score, away_score,
  coalesce(venue, '') AS venue, match_url
FROM raw_matches"""


def page_rows() -> str:
    return with_models(ROWS)


# a match's page comes where its number does
PAGE_SEQ = "CAST(split_part(match_url, '/', 3) AS BIGINT)"


def _rows_cte(body: str) -> str:
    return with_models("").rstrip() + f"\n, parsed AS ({ROWS})\n" + body


def page_dedupe() -> str:
    return _rows_cte(f"""SELECT * FROM parsed QUALIFY row_number() OVER (
  PARTITION BY season, match_date, home_team, away_team ORDER BY {PAGE_SEQ}) = 1""")


def page_cap() -> str:
    return _rows_cte(f""", dedup AS (SELECT * FROM parsed QUALIFY row_number() OVER (
  PARTITION BY season, match_date, home_team, away_team ORDER BY {PAGE_SEQ}) = 1)
SELECT * FROM dedup QUALIFY row_number() OVER (
  PARTITION BY competition ORDER BY match_date, {PAGE_SEQ}) <= {X.CAP_PER_COMPETITION}""")


def page_total_cap() -> str:
    return _rows_cte(f""", per_day AS (SELECT match_date, count(*) AS n FROM parsed GROUP BY match_date),
days AS (SELECT match_date FROM (SELECT match_date, coalesce(sum(n) OVER (ORDER BY match_date
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM per_day) x
         WHERE before < {X.TOTAL_CAP})
SELECT * FROM parsed WHERE match_date IN (SELECT match_date FROM days)""")


def page_standings() -> str:
    return with_models(f"""
SELECT season, {PHASE} AS phase, competition_group, trim(competition) AS competition, "position",
  team, played, won, drawn, lost, goals_for, goals_against, goal_difference, points
FROM raw_standings""")


PID = ("concat_ws('|', coalesce(match_url, ''), coalesce(event_type, ''), coalesce(event_subtype, ''), "
       "coalesce(team, ''), coalesce(player_name, ''), coalesce(CAST(\"minute\" AS VARCHAR), ''))")


def page_header() -> str:
    return with_models(f"""
SELECT {PID} AS page_id, home_team, away_team, home_logo, away_logo,
  CAST(match_date AS VARCHAR) AS match_date
FROM raw_match_events""")


def page_events() -> str:
    return with_models(f"""
SELECT match_url, team, event_type, event_subtype,
  trim(regexp_replace(player_name, '{WS}+', ' ', 'g')) AS player_name, "minute" AS "minute"
FROM raw_match_events""")


def page_first_match() -> str:
    ends = f"'^{WS}+|{WS}+$'"
    texts = [decoded(f"regexp_extract(html, '{p}', 1)") for p in X.HEADING_PATTERNS]
    parts = ", ".join(f"nullif(regexp_replace({t}, {ends}, '', 'g'), '')" for t in texts)
    return f"SELECT page_id, coalesce({parts}) AS heading FROM pages"


def page_missing() -> str:
    return "WITH " + ELEMENTS + """SELECT page_id, (contains(html, 'Page Not Found') OR contains(html, '404'))
  AND page_id NOT IN (SELECT page_id FROM elements WHERE pos >= 2) AS not_found FROM pages"""


def page_days() -> str:
    return with_models(f"""
SELECT match_url AS page_id, CAST(match_date AS VARCHAR) AS match_day FROM raw_matches
UNION ALL
SELECT CAST(page_id AS VARCHAR), '{X.DEFAULT_DAY}' FROM pages""")
