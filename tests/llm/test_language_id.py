"""Language identification: defined cases that a whole table must keep."""

from pitchstar.llm import language_id as L

PAGES = "page_id long, url string, html string"
EN, FR = "the house and the garden of the old king", "la maison et le jardin du vieux roi"


def test_a_declared_language_is_found_wherever_it_stands(spark):
    late = "<!-- " + "> " * 40 + "-->\n" + "<meta a>" * 20 + "<html class=x lang='en-GB'><p>" + EN
    rows = [(1, "http://a.b.uk/x", late), (2, None, "<html><p lang=fr>" + FR), (3, "http://c.fr", None)]
    got = {r.key: r.declared for r in L.pages_evidence(spark.createDataFrame(rows, PAGES)).collect()}
    assert got == {1: "en", 2: "", 3: ""}


def test_without_anything_to_fit_all_is_und(spark):
    rows = [(1, "http://a.uk", "<p>" + EN), (2, "http://b.fr", "<p>" + FR), (3, None, None), (4, "http://b.fr", "<p>" + FR)]
    got = L.identify(L.pages_evidence(spark.createDataFrame(rows, PAGES))).collect()
    assert len(got) == 4 and {(r.language, r.text_language) for r in got} == {("und", "und")}


def test_rows_keep_columns_of_any_name(spark):
    schema = "doc_id long, text string, lang string, source string, key string, row string, language int, lid_key string, lid_own string, `a.b` int"
    rows = [(i, t, lang, "s", f"k{i}", "r", i, "x", "y", None) for i, (t, lang) in enumerate([(EN, "en"), (FR, "fr"), (EN + " and more", "en"), (None, "en"), (" 12 ", None), (FR, None)])]
    rows += [rows[0]]
    got = L.keep_identified(spark.createDataFrame(rows, schema))
    assert got.columns == [c.split()[0].strip("`") for c in schema.split(", ")]
    kept = sorted(map(tuple, got.collect()), key=lambda r: r[0])
    assert [r[0] for r in kept] == [0, 0, 1, 2, 5]
    assert all(r[4:] == (f"k{r[0]}", "r", r[0], "x", "y", None) for r in kept)
    assert [r[2] for r in kept] == ["en", "en", "fr", "en", "fr"]
    assert L.keep_identified(spark.createDataFrame([], schema)).count() == 0
