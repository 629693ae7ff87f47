"""League web pages rendered from the fixture rows, for the extraction jobs.

The driver's ``pages`` table has no league markup, so the extraction jobs
are also run over pages that Spark renders from the fixture tables (one
page per match, per standings row, per event): parsing them must give back
the rows they were made from. Rendering adds the noise the parsers must
undo: padded, doubled whitespace in names and curly apostrophes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import pages as P


def _s(c) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit("")) if isinstance(c, str) else c


def noisy(c) -> Column:
    """Pad with newlines and double every space."""
    return F.concat(F.lit("\n   "), F.regexp_replace(_s(c), " ", "  "), F.lit(" \n"))


def _tag(tag: str, cls: str, body: Column, extra: str = "") -> Column:
    return F.concat(F.lit(f'<{tag} class="{cls}"{extra}>'), body, F.lit(f"</{tag}>"))


def listing_pages(matches: DataFrame) -> DataFrame:
    """One fixtures page per match: date picker, competition ribbon, card."""
    picker = F.concat(F.lit('<ul class="c-date-picker-timeline"><li class="c-date-picker-timeline__item">'
                            '<time datetime="'), _s("match_date"), F.lit('T00:00:00">'),
                      _s("match_date"), F.lit("</time></li></ul>"))
    ribbon = _tag("div", P.RIBBON, _tag("h3", P.RIBBON_TITLE, F.concat(
        F.lit('<a href="/competitions">'), noisy("competition"), F.lit("</a>"))))
    label = lambda c: _tag("span", P.TEAM_LABEL, _s(c))
    score = F.when(F.col("home_score").isNotNull(), _tag("div", P.SCORE_BOARD, F.concat(
        _tag("span", P.SCORE_ITEM, _s("home_score")), _tag("span", P.SCORE_ITEM, _s("away_score")))))
    time = F.when(F.col("match_time").isNotNull(), _tag("div", P.MATCH_TIME, _s("match_time")))
    venue = F.when(F.col("venue").isNotNull(), _tag("div", P.VENUE, F.concat(
        F.lit("<span>"), _s("venue"), F.lit("</span>"))))
    card = _tag("div", P.MATCH_CARD, _tag("div", "c-fixture", F.concat(
        _tag("div", P.HOME_BADGE, label("home_team")),
        F.coalesce(score, F.lit("")), F.coalesce(time, F.lit("")),
        _tag("div", P.AWAY_BADGE, label("away_team")),
        F.coalesce(venue, F.lit("")),
        F.concat(F.lit('<a class="c-fixture__link" href="'), _s("match_url"), F.lit('">Details</a>')))))
    # what a parser must not take: a card beside the list, a comment that looks
    # like one, a link and a time in the footer
    beside = F.lit(f'<aside><div class="{P.MATCH_CARD}"><div class="{P.HOME_BADGE}"><b class="{P.TEAM_LABEL}">Advert A</b></div>'
                   f'<div class="{P.AWAY_BADGE}"><b class="{P.TEAM_LABEL}">Advert B</b></div><a href="/fixtures/advert">Go</a></div></aside>')
    footer = F.lit('<footer><a href="/fixtures/all">All fixtures</a><time datetime="1970-01-01T00:00:00">Built</time></footer>')
    html = F.concat(F.lit(f"<html><body><!-- <div class='{P.FIXTURES_LIST}'> -->"), picker, F.lit(f"<div id=l class = '{P.FIXTURES_LIST}'><div>"),
                    ribbon, card, F.lit("</div></div>"), beside, footer, F.lit("</body></html>"))
    # pages are collected in the order of their match's number
    seq = F.substring_index("match_url", "/", -1).cast("bigint")
    return matches.select(F.col("match_url").alias("page_id"), "season", "competition_group",
                          F.col("match_date").alias("match_day"), html.alias("html"), seq.alias("page_seq"))


def standings_pages(standings: DataFrame) -> DataFrame:
    """One competition-table page per standings row."""
    cells = ["position", "team", "played", "won", "drawn", "lost", "goals_for", "goals_against",
             "goal_difference", "points"]
    row = F.concat(F.lit("<tr>"), *[F.concat(F.lit("<td>"), _s(c), F.lit("</td>")) for c in cells],
                   F.lit("</tr>"))
    head = F.lit("<thead><tr>" + "".join(f"<th>{c}</th>" for c in cells) + "</tr></thead>")
    ribbon = _tag("div", P.RIBBON, _tag("h3", P.RIBBON_TITLE, F.concat(F.lit(" "), _s("competition"), F.lit(" "))))
    table = _tag("div", P.TABLE_CONTAINER, F.concat(F.lit('<table class="c-table--standings">'), head,
                                                    F.lit("<tbody>"), row, F.lit("</tbody></table>")))
    beside = F.lit(f'<aside><div class="{P.TABLE_CONTAINER}"><table><tbody><tr><td>1</td><td>Advert</td></tr></tbody></table></div></aside>')
    html = F.concat(F.lit(f"<html><body><div class={P.TABLE_LIST}>"), ribbon, table,
                    F.lit("</div>"), beside, F.lit("</body></html>"))
    pid = F.concat_ws("|", _s("season"), _s("competition"), _s("team"))
    return standings.select(pid.alias("page_id"), "season", "competition_group", html.alias("html"))


ICONS = {("goal", "FG"): "field-goal", ("goal", "PC"): "penalty-corner",
         ("goal", "PS"): "penalty-stroke", ("card", "Green"): "green-card",
         ("card", "Yellow"): "yellow-card-match-details", ("card", "Red"): "red-card"}
MONTH_NAMES = ["January", "February", "March", "April", "May", "June", "July", "August",
               "September", "October", "November", "December"]


def _icon(t, s) -> Column:
    out = None
    for (et, st), name in ICONS.items():
        cond = (F.col(t) == et) & (F.col(s) == st)
        out = F.when(cond, F.lit(name)) if out is None else out.when(cond, F.lit(name))
    return out.otherwise(F.lit("unknown-icon"))


def event_pages(events: DataFrame) -> DataFrame:
    """One match page per event: header (teams, logos, date line) and the
    event on the board of the side it belongs to."""
    month = F.element_at(F.array(*[F.lit(m) for m in MONTH_NAMES]), F.month("match_date"))
    date_line = F.concat(F.dayofmonth("match_date").cast("string"), F.lit(" "), month, F.lit(" "),
                         F.year("match_date").cast("string"), F.lit(" | 14:00"))
    header = F.concat(
        _tag("span", P.HEADER_TEAM, _s("home_team")),
        F.concat(F.lit(f'<img class="{P.HEADER_LOGO}" src="'), _s("home_logo"), F.lit('">')),
        _tag("span", P.HEADER_TEAM, _s("away_team")),
        F.concat(F.lit(f'<img class="{P.HEADER_LOGO}" src="'), _s("away_logo"), F.lit('">')),
        _tag("div", P.MATCH_DATE, date_line))
    home_side = F.col("team") == F.col("home_team")
    mark = F.when(F.col("minute") % 2 == 0, F.lit("'")).otherwise(F.lit("′"))
    item = _tag("div", P.BOARD_ITEM, F.concat(
        F.lit('<svg><use xlink:href="/assets/icons.svg#'), _icon("event_type", "event_subtype"),
        F.lit('"></use></svg>'),
        F.when(home_side, F.concat(_s("player_name"), F.lit(" "),
                                   _tag("span", P.EVENT_TIME, F.concat(_s("minute"), mark))))
        .otherwise(F.concat(_tag("span", P.EVENT_TIME, F.concat(_s("minute"), mark)), F.lit(" "),
                            _s("player_name")))))
    empty = F.lit("")
    home_board = _tag("div", P.BOARD_HOME, F.when(home_side, item).otherwise(empty))
    away_board = _tag("div", P.BOARD_AWAY, F.when(home_side, empty).otherwise(item))
    # an item after both boards belongs to nobody; boards come in either order
    after = F.lit(f'<section><div class="{P.BOARD_ITEM}"><svg><use href="/assets/icons.svg#field-goal"></use></svg>Advert</div></section>')
    boards = F.when(F.col("minute") % 3 == 0, F.concat(away_board, home_board)).otherwise(F.concat(home_board, away_board))
    html = F.concat(F.lit("<html><body>"), header, boards, after, F.lit("</body></html>"))
    pid = F.concat_ws("|", _s("match_url"), _s("event_type"), _s("event_subtype"), _s("team"),
                      _s("player_name"), _s("minute"))
    return events.select(pid.alias("page_id"), "season", "match_url", html.alias("html"))
