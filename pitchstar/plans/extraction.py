"""Extraction jobs wired to data: the driver's ``pages`` table and the
league pages rendered from the fixture (see sources.league_pages)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import pages as P
from ..sources.fixtures import raw_match_events, raw_matches, raw_standings
from ..sources.league_pages import event_pages, listing_pages, standings_pages
from ..sources.raw import scratch_root
from ..sources.tables import read_table

# Fixed values of the registered runs.
ARTICLE_START = "<(?:h1|p)[ >]"
KIND_RE = "^<([a-z0-9]+)"
CAP_PER_COMPETITION = 25
TOTAL_CAP = 2000
DEFAULT_DAY = "1999-01-01"
HEADING_PATTERNS = ["<h2[^>]*>([^<]*)<", "<h1[^>]*>([^<]*)<", "<title>([^<]*)<"]


def spread(rows: DataFrame) -> DataFrame:
    """Rows dealt evenly over all tasks before pages are rendered and parsed from
    them: a small table sits in one file split or a few, while a page costs far
    more than its row."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _pages(spark, sf_dir) -> DataFrame:
    return read_table(spark, sf_dir, "pages", "page_id", "html")


def article_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1 on the driver pages: headings and paragraphs in document order."""
    el = P.page_elements(_pages(spark, sf_dir), ARTICLE_START, KIND_RE, keep=["page_id"])
    body = (F.when(F.col("kind") == "p", F.substring_index("chunk", "</p>", 1))
            .otherwise(F.substring_index("chunk", "</h1>", 1)))
    return el.select("page_id", "pos", "kind", P.strip_tags(body).alias("text"))


def _article_text(chunk, kind):
    body = (F.when(kind == "p", F.substring_index(chunk, "</p>", 1))
            .otherwise(F.substring_index(chunk, "</h1>", 1)))
    return P.strip_tags(body)


def article_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B2: every paragraph with the (normalised) heading before it."""
    el = P.page_sections(_pages(spark, sf_dir), ARTICLE_START, KIND_RE, "h1",
                         lambda x: _article_text(x, F.regexp_extract(x, KIND_RE, 1)), keep=["page_id"])
    return el.select("page_id", "pos", "section", _article_text(F.col("chunk"), F.col("kind")).alias("text"))


def parsed_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1 + B2 + B3 (+ B11, C1, C2, C5) over the rendered fixtures pages."""
    return parse_listing(listing_pages(spread(raw_matches(spark, sf_dir))))


def ribbon_title(x):
    """Ribbon text: the title link, else the title itself."""
    def text(title):
        link = P.strip_tags(P.element_of(F.regexp_extract(title, "(?s)(<a[\\s>].*)", 1)))
        return F.coalesce(F.nullif(link, F.lit("")), F.nullif(P.strip_tags(title), F.lit("")))

    return P.bind(P.first_element(P.element_of(x), P.RIBBON_TITLE), text)


def listing_scope(pages: DataFrame, cls: str) -> DataFrame:
    """Pages cut down to the list that holds their ribbons and cards."""
    rest = [c for c in pages.columns if c != "html"]
    return P.once(pages.select(*rest, F.col("html").alias("_page")), "html", P.scope("_page", cls)).drop("_page")


#: Place of a row in the collection (G2): its page's, then its card's.
PLACE = ["page_seq", "pos"]


def parse_listing(pages: DataFrame, place: bool = False) -> DataFrame:
    """Fixtures pages (page_id, season, competition_group, match_day, html)
    -> raw match fields. ``place`` keeps ``page_seq``, the page's place in the
    collection, and ``pos``, the card's place on the page."""
    cards = P.page_sections(listing_scope(pages, P.FIXTURES_LIST), P.class_start(P.RIBBON, P.MATCH_CARD), P.class_kind(P.RIBBON, P.MATCH_CARD), P.RIBBON,
                            ribbon_title, keep=["page_id", "season", "competition_group", "match_day"] + ["page_seq"] * place)
    rows = P.parse_match_cards(cards)
    return rows.select("season", "phase", "competition_group", "competition",
                       F.col("match_day").alias("match_date"), "match_time", "home_team",
                       "away_team", "home_score", "away_score", "venue", "match_url", *(PLACE if place else []))


def parsed_standings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1 + B2 + B4 over the rendered standings pages (titles are only
    trimmed, as the standings collector does)."""
    return parse_standings_pages(standings_pages(spread(raw_standings(spark, sf_dir))))


def parse_standings_pages(pages: DataFrame) -> DataFrame:
    tables = P.page_sections(
        listing_scope(pages, P.TABLE_LIST), P.class_start(P.RIBBON, P.TABLE_CONTAINER), P.class_kind(P.RIBBON, P.TABLE_CONTAINER), P.RIBBON,
        lambda x: P.inner_text(P.element_of(x), P.RIBBON_TITLE),
        normalise=False, keep_empty=True, keep=["page_id", "season", "competition_group"])
    rows = P.parse_standings_rows(tables)
    return rows.select("season", "phase", "competition_group", "competition", "position", "team",
                       "played", "won", "drawn", "lost", "goals_for", "goals_against",
                       "goal_difference", "points")


def parsed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B6 (+ C9) over the rendered match pages."""
    h = P.parse_header(event_pages(spread(raw_match_events(spark, sf_dir))))
    return h.select("page_id", "home_team", "away_team", "home_logo", "away_logo", "match_date")


def parsed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B5 (+ C6, C7, C8) over the rendered match pages."""
    return parse_match_pages(event_pages(spread(raw_match_events(spark, sf_dir))))


def parse_match_pages(pages: DataFrame) -> DataFrame:
    """Match pages (page_id, match_url, html) -> event rows."""
    ev = P.parse_events(P.parse_header(pages))
    return ev.select("match_url", "team", "event_type", "event_subtype", "player_name", "minute")


def dedupe_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First card per (season, date, home, away) in the order of the
    collection."""
    return _deduped(spark, sf_dir).drop(*PLACE)


def _deduped(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = parse_listing(listing_pages(spread(raw_matches(spark, sf_dir))), place=True)
    return P.dedupe_first(rows, ["season", "match_date", "home_team", "away_team"], PLACE)


def capped_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At most CAP_PER_COMPETITION matches per competition, counting
    only cards kept by the in-run dedupe (B8), in processing order."""
    return P.limit_per_group(_deduped(spark, sf_dir), "competition", CAP_PER_COMPETITION,
                             ["match_date", *PLACE]).drop(*PLACE)


def total_capped_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole match days until TOTAL_CAP rows are stored. Every page is
    parsed once: the rows are written, then counted and chosen by day."""
    rows, path = parsed_matches(spark, sf_dir), f"{scratch_root(spark)}/parsed"
    rows.write.parquet(path)
    return P.limit_total(spark.read.schema(rows.schema).parquet(path), TOTAL_CAP, "match_date")


def page_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B11 on the driver pages: first non-empty of h2, h1, title."""
    return _pages(spark, sf_dir).select("page_id", P.first_match("html", HEADING_PATTERNS).alias("heading"))


def missing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B12 on the driver pages; a page with two or more sections gave rows, so it
    exists whatever its source says."""
    pages = _pages(spark, sf_dir)
    rows = P.page_elements(pages, ARTICLE_START, KIND_RE, keep=["page_id"]).filter("pos >= 2")
    return P.flag_missing(pages, rows).select("page_id", "not_found")


def match_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B7 over rendered fixtures pages and the driver pages (which have no
    date picker, so they get the default day)."""
    listing = listing_pages(spread(raw_matches(spark, sf_dir))).select("page_id", "html")
    driver = _pages(spark, sf_dir).select(F.col("page_id").cast("string").alias("page_id"), "html")
    return P.page_days(listing.unionByName(driver), DEFAULT_DAY)
