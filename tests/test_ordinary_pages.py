"""Pages as sites write them: attributes in any order, several classes, padding,
character references, boards in either order; CSV fields with line breaks;
partitioned tables attached again with their types."""

from pyspark.sql import functions as F

from pitchstar.operators import pages as P
from pitchstar.plans.extraction import parse_listing
from pitchstar.sources.raw import attach_table, create_database, read_raw, save_table, table_path, write_rows

CARD = """<div {attrs}><div class="x c-fixture__badge-before"><span class="c-badge__label">
   Bath &amp; Wells  1
</span></div><div class='c-fixture__badge-after'><span id="l" class="c-badge__label">O&#39;Hara 2</span></div>
<a href="/fixtures/{n}">go</a></div>"""


def test_cards_with_ordinary_attributes(spark):
    html = ('<div id="r" class="big c-ribbon"><h3 class="c-ribbon__title"> Mens &amp; Open </h3></div>'
            + CARD.format(attrs='id="m1" class="c-match-detail-card__container"', n=1)
            + CARD.format(attrs='\nclass="js-card c-match-detail-card__container wide"', n=2))
    df = spark.createDataFrame([("p", "2025-2026", "G", "2025-11-22", html)], "page_id string, season string, competition_group string, match_day string, html string")
    rows = parse_listing(df).orderBy("match_url").collect()
    assert [r.match_url for r in rows] == ["/fixtures/1", "/fixtures/2"]
    assert {r.competition for r in rows} == {"Mens & Open"}
    assert {(r.home_team, r.away_team) for r in rows} == {("Bath & Wells 1", "O'Hara 2")}


def test_boards_in_either_order(spark):
    item = '<div class="c-info-board-item__text"><svg><use href="#field-goal"></use></svg><span class="u-font-bold">\n 20&#39;</span> {p}</div>'
    home = '<div class="c-match-header__info-board-home">' + item.format(p="Ann") + "</div>"
    away = '<div class="c-match-header__info-board-away">' + item.format(p="Bob") + "</div>"
    teams = '<span class="c-match-header__results-team-name">H</span><span class="c-match-header__results-team-name">A</span>'
    logo = '<img src="/l.png" class="c-match-header__results-team-logo">'
    df = spark.createDataFrame([("hb", teams + logo + home + away), ("ab", teams + logo + away + home)], "page_id string, html string")
    rows = P.parse_events(P.parse_header(df)).select("page_id", "team", "player_name", "minute", "home_logo").collect()
    assert sorted(map(tuple, rows)) == [(p, t, n, 20, "/l.png") for p in ("ab", "hb") for t, n in (("A", "Bob"), ("H", "Ann"))]


def test_a_page_with_rows_is_not_missing(spark):
    df = spark.createDataFrame([("a", "room 404"), ("b", "404")], "page_id string, html string")
    got = P.flag_missing(df, df.where("page_id = 'a'")).collect()
    assert {r.page_id: r.not_found for r in got} == {"a": False, "b": True}


def test_csv_keeps_line_breaks_and_padding(spark, tmp_path):
    rows = spark.range(1).select(*[F.lit(v).alias(k) for k, v in {"season": "s", "match_url": "/u", "venue": " pad \nsecond, line\\", "home_team": 'a "q" b'}.items()])
    write_rows(rows, str(tmp_path / "m"))
    got = read_raw(spark, str(tmp_path / "m"), "matches").select("venue", "home_team", "match_url").collect()
    assert [tuple(r) for r in got] == [(" pad \nsecond, line\\", 'a "q" b', "/u")]


def test_partitioned_table_is_attached_whole(spark):
    db = create_database(spark, "attach_again")
    save_table(spark.range(20).select("id", (F.col("id") % 3).alias("season_id")), db, "f", ["season_id"])
    before, path = spark.table(f"{db}.f").dtypes, table_path(spark, db, "f")
    spark.sql(f"DROP TABLE {db}.f")
    attach_table(spark, db, "f", path)
    assert spark.table(f"{db}.f").count() == 20 and spark.table(f"{db}.f").dtypes == before


def _listing(spark, html):
    df = spark.createDataFrame([("p", "2025-2026", "G", "2025-11-22", html)], "page_id string, season string, competition_group string, match_day string, html string")
    return parse_listing(df).orderBy("home_team")


BADGES = ('<div class="c-fixture__badge-before"><span class="c-badge__label">{h}</span></div>'
          '<div class="c-fixture__badge-after"><span class="c-badge__label">{a}</span></div>')


def test_a_card_ends_where_it_ends(spark):
    card = '<div class="c-match-detail-card__container">' + BADGES + "{more}</div>"
    html = ('<aside>' + card.format(h="Advert", a="Other", more="") + '</aside><ul class="js-fixtures-list x"><li><div>'
            '<div class=c-ribbon><h3 class = "c-ribbon__title"><a href="/c">Premier <b>East</b></a></h3></div><h3 class="c-ribbon__title">Not in it</h3>'
            + card.format(h="<b>Bold</b> 1", a="Caf&eacute; &#x41;&#49; &amp;lt;", more="<a href='/fixtures/1?a=1&amp;b=2'>x</a>")
            + card.format(h="No", a="Link", more="<div><div></div></div>") + "</div></li></ul>"
            '<a href="/fixtures/all">all</a><div class="c-fixture__location">Elsewhere</div>' + card.format(h="After", a="All", more=""))
    rows = [(r.competition, r.home_team, r.away_team, r.match_url, r.venue) for r in _listing(spark, html).collect()]
    assert rows == [("Premier East", "Bold 1", "Café A1 &lt;", "/fixtures/1?a=1&b=2", ""), ("Premier East", "No", "Link", "", "")]


def test_elements_in_comments_and_scripts_do_not_count(spark):
    card = '<div class="c-match-detail-card__container">' + BADGES + "</div>"
    html = ("<!-- <div class='js-fixtures-list'> --><script>var x = '</div><div class=\"js-fixtures-list\">';</script>"
            '<div class="js-fixtures-list"><!-- </div> --><style>a > b {}</style>' + card.format(h="A", a="B") + "</div>" + card.format(h="C", a="D"))
    assert [(r.home_team, r.away_team) for r in _listing(spark, html).collect()] == [("A", "B")]


def test_element_ends(spark):
    cases = {"<div a><div>x</div></div>tail": "<div a><div>x</div></div>", "<b>x</b> y": "<b>x</b>", "<div><divider></divider>x</div >y": "<div><divider></divider>x</div >",
             "<DIV><div></DIV></div>z": "<DIV><div></DIV></div>", "<li>never closed <b>x</b>": "<li>never closed <b>x</b>", "": "", "<p>a<p>b</p>": "<p>a<p>b</p>"}
    df = spark.createDataFrame(list(cases.items()), "html string, want string").select("html", "want", P.element_of("html").alias("got"))
    assert [(r.html, r.got) for r in df.collect() if r.got != r.want] == []
    deep = "<div>" * 3000 + "x" + "</div>" * 3000
    assert spark.createDataFrame([(deep + "<i>",)], "html string").select(P.element_of("html")).first()[0] == deep


def test_items_after_the_boards_belong_to_nobody(spark):
    item = '<div class="c-info-board-item__text"><svg><use href=\'#field-goal\'></use></svg><b class="u-font-bold">20\'</b> {p}</div>'
    teams = '<span class="c-match-header__results-team-name"><b>H</b></span><span class="c-match-header__results-team-name">A</span>'
    html = (teams + '<div class="c-match-header__info-board-home"><div>' + item.format(p="Ann") + '</div></div><div>' + item.format(p="Nobody") + "</div>"
            '<div class="c-match-header__info-board-away">' + item.format(p="Bob") + "</div>" + item.format(p="Nobody"))
    df = spark.createDataFrame([(1, html)], "page_id int, html string")
    assert sorted((r.team, r.player_name, r.minute) for r in P.parse_events(P.parse_header(df)).collect()) == [("A", "Bob", 20), ("H", "Ann", 20)]


def test_days_come_from_the_date_picker(spark):
    item = '<li class="c-date-picker-timeline__item">{t}</li>'
    html = {"a": item.format(t="<time class=x datetime='2025-01-02T00:00:00'>2</time><time datetime=\"2025-01-03\">3</time>") + item.format(t="none") + '<time datetime="2000-01-01">built</time>',
            "b": '<time datetime="2000-01-01">built</time>', "c": item.format(t="no time")}
    df = spark.createDataFrame(list(html.items()), "page_id string, html string")
    assert sorted(tuple(r) for r in P.page_days(df, "2025-10-01").collect()) == [("a", "2025-01-02"), ("b", "2025-10-01")]


def test_first_card_in_collection_order_stays(spark):
    from pitchstar.plans.extraction import PLACE
    card = '<div class="c-match-detail-card__container">' + BADGES + '<div class="c-fixture__location">{v}</div><a href="/fixtures/{n}">x</a></div>'
    page = lambda *cards: "<div class='js-fixtures-list'>" + "".join(card.format(h="H", a="A", v=v, n=n) for v, n in cards) + "</div>"
    df = spark.createDataFrame([("z", "s", "G", "2025-01-01", page(("first", 9), ("second", 1)), 1), ("a", "s", "G", "2025-01-01", page(("third", 0)), 2)],
                               "page_id string, season string, competition_group string, match_day string, html string, page_seq long")
    rows = P.dedupe_first(parse_listing(df, place=True).repartition(5), ["season", "match_date", "home_team", "away_team"], PLACE).collect()
    assert [(r.venue, r.match_url) for r in rows] == [("first", "/fixtures/9")]
