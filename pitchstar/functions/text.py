"""Scalar column expressions (C1-C15, C21). All are built-in Spark
functions, so they stay inside whole-stage codegen."""

from __future__ import annotations

import unicodedata
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

# Apostrophe variants mapped to a plain quote, the minute marks
# that follow a minute number, and the icon names of event types.
APOSTROPHES = "’‘ʼ"
MINUTE_MARKS = "'′’"
ICON_EVENTS = [
    ("field-goal", "goal", "FG"),
    ("penalty-corner", "goal", "PC"),
    ("penalty-stroke", "goal", "PS"),
    ("green-card", "card", "Green"),
    ("yellow-card", "card", "Yellow"),
    ("red-card", "card", "Red"),
]
ICON_SUFFIX = "-match-details"
# Whitespace as Python's str.split() sees it (the collector collapses names
# with split/join): Unicode White_Space (Java's \s under the (?U) flag,
# a fast property test) plus U+001C-U+001F, i.e. exactly str.isspace().
WHITESPACE_CLASS = r"(?U)[\s\x{1c}-\x{1f}]"

# Decimal digits of every script (Unicode category Nd), as Python's \d and
# int() accept them, with their ASCII equivalents; built from the rule.
_ND = [c for c in map(chr, range(0x110000)) if unicodedata.category(c) == "Nd"]
UNICODE_DIGITS = "".join(_ND)
ASCII_DIGITS = "".join(str(unicodedata.decimal(c)) for c in _ND)

MONTHS = ["January", "February", "March", "April", "May", "June", "July",
          "August", "September", "October", "November", "December"]


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def squash_spaces(c) -> Column:
    """Collapse runs of whitespace (Unicode spaces included) to one space
    and trim."""
    return F.trim(F.regexp_replace(_col(c), WHITESPACE_CLASS + "+", " "))


def strip_spaces(c) -> Column:
    """Drop white space of any kind at both ends, as Python's strip does."""
    return F.regexp_replace(_col(c), f"^{WHITESPACE_CLASS}+|{WHITESPACE_CLASS}+$", "")


def bind(c, f) -> Column:
    """``f`` of a value that is computed once, however often ``f`` names it."""
    return F.element_at(F.transform(F.array(_col(c)), f), 1)


# The standard table of named character references, from Python's own copy;
# ``apos`` came to it later.
ENTITIES = {**{n: chr(c) for n, c in name2codepoint.items()}, "apos": "'"}


def _reference(ref: Column) -> Column:
    """What a reference (between & and ;) stands for, or NULL."""
    code = (F.when(ref.rlike("^#[xX][0-9A-Fa-f]{1,6}$"), F.conv(F.substring(ref, 3, 6), 16, 10))
            .when(ref.rlike("^#[0-9]{1,7}$"), F.substring(ref, 2, 7))).try_cast("bigint")
    named = F.map_from_arrays(F.array(*[F.lit(n) for n in ENTITIES]), F.array(*[F.lit(c) for c in ENTITIES.values()]))
    valid = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    number = F.when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
    return F.when(ref.startswith("#"), number).otherwise(F.try_element_at(named, ref))


def unescape(c) -> Column:
    """Text as a browser shows it: character references decoded, once, by
    number or by name; what is no reference stays. Text without an ampersand,
    nearly all of it, is not looked at."""
    def piece(p: Column) -> Column:
        return bind(_reference(F.regexp_extract(p, "^(#?[0-9A-Za-z]{1,31});", 1)),
                    lambda r: F.when(r.isNull(), F.concat(F.lit("&"), p)).otherwise(F.concat(r, F.regexp_replace(p, "^[^;]*;", ""))))

    def decoded(x: Column) -> Column:
        parts = F.split(x, "&")
        rest = F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), piece)
        return F.concat(F.element_at(parts, 1), F.array_join(rest, ""))

    return bind(c, lambda x: F.when(F.instr(x, "&") > 0, decoded(x)).otherwise(x))


def unify_name(c) -> Column:
    """Apostrophe variants -> plain quote, whitespace collapsed and trimmed;
    empty text stays empty."""
    return squash_spaces(F.translate(_col(c), APOSTROPHES, "'" * len(APOSTROPHES)))


def clean_name(c) -> Column:
    """Unify apostrophes, collapse whitespace, empty or NULL -> 'Unknown'."""
    x = squash_spaces(F.translate(_col(c), APOSTROPHES, "'" * len(APOSTROPHES)))
    return F.coalesce(F.nullif(x, F.lit("")), F.lit("Unknown"))


def phase_of(c) -> Column:
    """C2: 'Phase 2' wins over 'Premier' (-> 'Phase 1'); otherwise empty."""
    x = _col(c)
    return (F.when(x.contains("Phase 2"), F.lit("Phase 2"))
            .when(x.contains("Premier"), F.lit("Phase 1"))
            .otherwise(F.lit("")))


def gender_of(c) -> Column:
    """Case-sensitive; 'Womens' does not contain 'Mens'."""
    x = _col(c)
    return F.when(x.contains("Mens") | x.contains("Open"), F.lit("Mens")).otherwise(F.lit("Womens"))


def tier_of(c) -> Column:
    """League tier from a competition name: Premier 1, Division 2, Conference 3."""
    x = _col(c)
    return (F.when(x.contains("Premier"), F.lit(1))
            .when(x.contains("Division"), F.lit(2))
            .when(x.contains("Conference"), F.lit(3)))


def int_or_null(c) -> Column:
    """Text -> bigint, bad or empty -> NULL (never raises under ANSI).
    Accepts an optionally signed run of digits with surrounding whitespace,
    like Python's int(); '17.0' or '3rd' are bad."""
    digits = F.regexp_extract(_col(c).cast("string"), r"(?U)^\s*([+-]?\d+)\s*$", 1)
    return ascii_digits(digits).try_cast("bigint")


def ascii_digits(c) -> Column:
    """Map decimal digits of any script to 0-9 (no-op on ASCII text)."""
    return F.translate(_col(c), UNICODE_DIGITS, ASCII_DIGITS)


def int_or_zero(c) -> Column:
    """C4: text -> bigint, bad or empty -> 0."""
    return F.coalesce(int_or_null(c), F.lit(0).cast("bigint"))


def minute_of(c) -> Column:
    """Leading digits of the trimmed text ("15'" -> 15), default 0."""
    digits = F.regexp_extract(strip_spaces(c), r"(?U)^(\d+)", 1)
    return F.coalesce(ascii_digits(digits).try_cast("bigint"), F.lit(0).cast("bigint"))


def icon_name(c) -> Column:
    """Text after the last '#', with the '-match-details' suffix removed."""
    tail = F.substring_index(_col(c), "#", -1)
    return F.regexp_replace(tail, ICON_SUFFIX + "$", "")


def event_type_of(icon) -> Column:
    """Icon reference -> event type ('goal'/'card'), unknown -> NULL."""
    return _by_icon(icon, {n: t for n, t, _ in ICON_EVENTS})


def _by_icon(icon, meaning: dict[str, str]) -> Column:
    """Value of an icon's name, which is taken from the reference once."""
    table = F.create_map(*[F.lit(x) for pair in meaning.items() for x in pair])
    return F.try_element_at(table, icon_name(icon))


def event_subtype_of(icon) -> Column:
    """Icon reference -> subtype (FG/PC/PS/Green/Yellow/Red), unknown -> NULL."""
    return _by_icon(icon, {n: s for n, _, s in ICON_EVENTS})


def player_name(c) -> Column:
    """Drop minute marks like 20' / 20′ / 20’ and collapse whitespace."""
    x = F.regexp_replace(_col(c), r"(?U)\d+[" + MINUTE_MARKS + "]", "")
    return squash_spaces(x)


def page_date(c) -> Column:
    """C9: '22 November 2025 | 14:00' -> '2025-11-22'; no match -> '';
    an unknown month name falls back to January."""
    pat = r"(?U)^(\d{1,2})\s+(\w+)\s+(\d{4})"     # Unicode classes, like Python's re
    months = F.array(*[F.lit(m) for m in MONTHS])

    def iso(x: Column) -> Column:
        day, month, year = (F.regexp_extract(x, pat, i) for i in (1, 2, 3))
        mm = F.lpad(F.greatest(F.array_position(months, month), F.lit(1)).cast("string"), 2, "0")
        return F.when(F.regexp_like(x, F.lit(pat)), F.concat_ws("-", year, mm, F.lpad(day, 2, "0"))).otherwise(F.lit(""))

    return bind(strip_spaces(c), iso)


def date_part(c) -> Column:
    """Date part of an ISO datetime text ('2026-01-25T00:00:00')."""
    return F.substring_index(_col(c), "T", 1)


def prefix(c, n: int) -> Column:
    """First n characters."""
    return F.substring(_col(c).cast("string"), 1, n)


def collected_at(ts: str) -> Column:
    """Run-level collection time, seconds precision, as timestamp_ntz."""
    return F.lit(ts).cast("timestamp_ntz")


def date_of(c) -> Column:
    """C14: DATE(timestamp)."""
    return F.to_date(_col(c))


def match_status(home_score="home_score", match_date="match_date",
                 scraped_at="scraped_at") -> Column:
    """Completed if the home score is known; Upcoming if the match is
    after the collection date; else Missing result (also for NULL dates)."""
    return (F.when(_col(home_score).isNotNull(), F.lit("Completed"))
            .when(_col(match_date) > date_of(scraped_at), F.lit("Upcoming"))
            .otherwise(F.lit("Missing result")))


def total_goals(h="home_score", a="away_score") -> Column:
    """Home + away (NULL if either is NULL)."""
    return _col(h) + _col(a)


def share(x, y) -> Column:
    """X / y as double, NULL on a zero denominator."""
    return F.try_divide(_col(x).cast("double"), _col(y).cast("double"))
