"""Oracle SQL for the scalar-expression queries."""

from pitchstar.plans.expressions import ICON_NAMES

from .models import with_models

# whitespace as Python's str.split() sees it (rule, not a list)
WS = "[" + "".join(c for c in map(chr, range(0x110000)) if c.isspace()) + "]"


def squash(x: str) -> str:
    return f"trim(regexp_replace({x}, '{WS}+', ' ', 'g'))"


def names() -> str:
    raw = ("CASE WHEN c_custkey % 50 = 0 THEN '   ' WHEN c_custkey % 7 = 0 THEN NULL "
           "ELSE '  ' || replace(c_name, '#', '’  ') || chr(10) || ' ' END")
    return f"""SELECT c_custkey, raw_name,
  coalesce(nullif({squash("translate(raw_name, '’‘ʼ', '''''''''')")}, ''), 'Unknown') AS clean_name
FROM (SELECT c_custkey, {raw} AS raw_name FROM customer) x"""


def phase_gender() -> str:
    return with_models("""
SELECT competition_group, competition,
  CASE WHEN competition LIKE '%Phase 2%' THEN 'Phase 2' WHEN competition LIKE '%Premier%' THEN 'Phase 1' ELSE '' END AS phase,
  CASE WHEN competition_group LIKE '%Mens%' OR competition_group LIKE '%Open%' THEN 'Mens' ELSE 'Womens' END AS gender,
  CASE WHEN competition LIKE '%Premier%' THEN 1 WHEN competition LIKE '%Division%' THEN 2
       WHEN competition LIKE '%Conference%' THEN 3 END AS tier
FROM (SELECT DISTINCT competition_group, competition FROM raw_matches) d""")


Q = "CAST(CAST(l_quantity AS BIGINT) AS VARCHAR)"


def _int(x: str) -> str:
    return f"TRY_CAST(regexp_extract({x}, '^\\s*([+-]?\\d+)\\s*$', 1) AS BIGINT)"


def ints() -> str:
    txt = (f"CASE l_linenumber % 4 WHEN 0 THEN ' ' || {Q} || ' ' WHEN 1 THEN CAST(l_quantity AS VARCHAR) "
           f"WHEN 2 THEN l_returnflag ELSE '-' || {Q} END")
    return f"""SELECT l_orderkey, l_linenumber, text, {_int('text')} AS int_or_null,
  coalesce({_int('text')}, 0) AS int_or_zero
FROM (SELECT l_orderkey, l_linenumber, {txt} AS text FROM lineitem) x"""


def minutes() -> str:
    txt = (f"CASE l_linenumber % 3 WHEN 0 THEN {Q} || '''' WHEN 1 THEN ' ' || {Q} || '′ ' ELSE 'HT' END")
    return f"""SELECT l_orderkey, l_linenumber, text,
  coalesce(TRY_CAST(regexp_extract(trim(text), '^(\\d+)', 1) AS BIGINT), 0) AS "minute"
FROM (SELECT l_orderkey, l_linenumber, {txt} AS text FROM lineitem) x"""


def icons() -> str:
    arr = "[" + ", ".join(f"'{n}'" for n in ICON_NAMES) + "]"
    name = f"{arr}[CAST(l_suppkey % {len(ICON_NAMES)} + 1 AS INTEGER)]"
    ref = (f"CASE l_linenumber % 3 WHEN 0 THEN '/assets/icons.svg#' || {name} "
           f"WHEN 1 THEN '/assets/icons.svg#' || {name} || '-match-details' ELSE {name} END")
    nm = "regexp_replace(CASE WHEN contains(icon, '#') THEN split_part(icon, '#', -1) ELSE icon END, '-match-details$', '')"
    return f"""SELECT l_orderkey, l_linenumber, icon,
  CASE WHEN n IN ('field-goal', 'penalty-corner', 'penalty-stroke') THEN 'goal'
       WHEN n IN ('green-card', 'yellow-card', 'red-card') THEN 'card' END AS event_type,
  CASE n WHEN 'field-goal' THEN 'FG' WHEN 'penalty-corner' THEN 'PC' WHEN 'penalty-stroke' THEN 'PS'
         WHEN 'green-card' THEN 'Green' WHEN 'yellow-card' THEN 'Yellow' WHEN 'red-card' THEN 'Red' END AS event_subtype
FROM (SELECT *, {nm} AS n FROM (SELECT l_orderkey, l_linenumber, {ref} AS icon FROM lineitem) a) b"""


def players() -> str:
    txt = (f"CASE WHEN l_linenumber % 2 = 0 THEN s_name || '  ' || {Q} || '’' "
           f"ELSE {Q} || '′ ' || chr(10) || s_name END")
    return f"""SELECT l_orderkey, l_linenumber, text,
  {squash("regexp_replace(text, '\\d+[''′’]', '', 'g')")} AS player_name
FROM (SELECT l_orderkey, l_linenumber, {txt} AS text FROM lineitem JOIN supplier ON l_suppkey = s_suppkey) x"""


def dates() -> str:
    line = ("CASE WHEN o_orderkey % 10 = 0 THEN 'Date to be confirmed' "
            "WHEN o_orderkey % 10 = 1 THEN CAST(day(o_orderdate) AS VARCHAR) || ' Sept ' || CAST(year(o_orderdate) AS VARCHAR) "
            "ELSE CAST(day(o_orderdate) AS VARCHAR) || ' ' || strftime(o_orderdate, '%B') || ' ' "
            "|| CAST(year(o_orderdate) AS VARCHAR) || ' | 14:00' END")
    pat = "'^(\\d{1,2})\\s+(\\w+)\\s+(\\d{4})'"
    months = ["January", "February", "March", "April", "May", "June", "July", "August",
              "September", "October", "November", "December"]
    mm = "CASE regexp_extract(trim(date_line), " + pat + ", 2) " + " ".join(
        f"WHEN '{m}' THEN '{i:02d}'" for i, m in enumerate(months, 1)) + " ELSE '01' END"
    pd = (f"CASE WHEN regexp_matches(trim(date_line), {pat}) THEN regexp_extract(trim(date_line), {pat}, 3) || '-' || "
          f"{mm} || '-' || lpad(regexp_extract(trim(date_line), {pat}, 1), 2, '0') ELSE '' END")
    return f"""SELECT o_orderkey, date_line, {pd} AS page_date,
  CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date_part,
  substr(CAST(o_orderdate AS VARCHAR), 1, 10) AS prefix10,
  CAST(o_orderdate AS DATE) AS date_of,
  concat_ws('_', o_orderstatus, CAST(CAST(o_orderdate AS DATE) AS VARCHAR), CAST(o_orderkey AS VARCHAR)) AS text_key
FROM (SELECT o_orderkey, o_orderdate, o_orderstatus, {line} AS date_line FROM orders) x"""
