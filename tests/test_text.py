"""Hand-worked values for the scalar functions."""

import pytest
from pyspark.sql import functions as F

from gripelode.functions import gates, keys, text


def values(spark, inputs, *columns):
    """Rows of the given expressions over a column ``c`` of inputs, in input order."""
    df = spark.createDataFrame([(i, c) for i, c in enumerate(inputs)], "i int, c string")
    rows = df.select("i", *[col.alias(f"v{k}") for k, col in enumerate(columns)]).orderBy("i").collect()
    return [tuple(r)[1:] if len(columns) > 1 else r[1] for r in rows]


@pytest.fixture(autouse=True)
def column(spark):
    """``C`` is the input column; columns need a running session."""
    global C
    C = F.col("c")


def test_clean_and_normalize_cover_unicode_blanks(spark):
    inputs = [None, " A\u00a0\u2003 b\x1c\x0b\x85c\0 ", "\u3000"]
    assert values(spark, inputs, text.clean(C), text.normalize(C)) == [("", ""), ("A b c", "a b c\0"), ("", "")]


def test_strip_html_decodes_once_and_falls_back_for_rare_entities(spark):
    got = values(spark, ["<p>a &amp;lt; b</p>", "&eacute;t&eacute;&nbsp;x &notanentity; &amp", "plain", None, "a<br>b&#8364;"], text.strip_html(C))
    assert got == ["a &lt; b", "été x ¬anentity; &", "plain", "", "a b€"]


def test_title_case_after_every_non_letter(spark):
    assert values(spark, ["3d don't e-mail", "été ß", ""], text.title_case(C)) == ["3D Don'T E-Mail", "Été Ss", ""]


def test_locations(spark):
    cases = {
        "r/india": True, "India Sales": True, "new york": True, "Springfield City": True, "us": True, "in": True, "go": False, "": False,
        "one two three india": False, "crm": False, "r/": False,
    }
    assert values(spark, list(cases), text.looks_like_location(C)) == list(cases.values())


def test_clean_tag(spark):
    cases = {"/_project_management ;": "Project Management", "N/A": None, "HubSpot": "HubSpot", "general": None, "london": None, "x" * 50: "X" + "x" * 39, " , ": None}
    # "N/A" becomes "N A", which is no generic word.
    cases["N/A"] = "N A"
    assert values(spark, list(cases), text.clean_tag(C)) == list(cases.values())


def test_slug_terms_and_sentiment(spark):
    assert values(spark, ["  Hé, World!! ", "", "a" * 130], text.slug(C)) == ["h-world", "idea", "a" * 120]
    assert values(spark, ["The app is BROKEN, broken 3d x2"], text.content_terms(C)) == [["broken", "broken"]]
    assert values(spark, ["whatever badge", "Love hateful"], text.sentiment(F.lower(C))) == [-1 - 1, 0]


def test_category_tags_keep_first_spelling(spark):
    df = spark.createDataFrame([("Sales ops", ["sales OPS", "india", "A/b"], ["crm_x", "crm x", "data", "zz"])], "d string, m array<string>, t array<string>")
    assert df.select(text.category_tags(F.col("d"), F.col("m"), F.col("t"))).first()[0] == ["Sales ops", "A b", "Crm X", "Data"]
    empty = df.select(text.category_tags(F.lit("india"), F.array().cast("array<string>"), F.array().cast("array<string>"))).first()[0]
    assert empty == ["Pain Intelligence"]


def test_lenient_json(spark):
    cases = ['{"k": 1}', 'so: {"k": 2} ok', "[1]", "", None, "{bad", '"text"', '[{"k": 3}]']
    assert values(spark, cases, F.try_variant_get(text.lenient_json(C), "$.k", "int")) == [1, 2, None, None, None, None, None, 3]


def test_bounded_and_level(spark):
    got = values(spark, ["2", "0.1", "0.5", "bad", None], text.bounded(C, F.lit(0.7), 0.2, 0.98), text.level(C, F.lit("medium")))
    assert [g[0] for g in got] == [0.98, 0.2, 0.5, 0.7, 0.7]
    assert values(spark, ["Very HIGH", "lowest", "?"], text.level(C, F.lit("medium"))) == ["high", "low", "medium"]


def test_times(spark):
    cases = {
        "2024-01-02T03:04:05Z": "2024-01-02T03:04:05+00:00", "2024-01-02T03:04:05.25+05:30": "2024-01-01T21:34:05.250000+00:00",
        "2024-01-02 03:04:05": "2024-01-02T03:04:05+00:00", "2024-01-02": "2024-01-02T00:00:00+00:00",
        "Tue, 02 Jan 2024 03:04:05 -0700": "2024-01-02T10:04:05+00:00", "2024": None, "2024-13-01": None, "soon": None, "": None,
    }
    assert values(spark, list(cases), keys.iso_utc(keys.parse_time(C))) == list(cases.values())
    assert values(spark, ["1704164645.5"], keys.iso_utc(keys.from_epoch(C.cast("double")))) == ["2024-01-02T03:04:05.500000+00:00"]


def test_pages(spark):
    html = '<html>\n<TITLE a="b"> T &x </TITLE><meta content="D  d" name="description">"ratingValue": "3.5"'
    plain = "\n Title: Head line\nURL Source: u\nfirst body line\nsecond"
    got = values(spark, [html, plain, "Rating: 4.5.1", "short"], text.page_title(C), text.page_description(C), text.page_rating(C))
    assert got == [("T &x", "D d", 3.5), ("Head line", "first body line second", None), ("Rating: 4.5.1", "Rating: 4.5.1", None), ("", "short", None)]


def test_budget_and_chunks(spark):
    assert values(spark, ["Budget: $1,500.", "hourly range - 10 -  $20 x", "no"], text.budget(C)) == ["1,500.", "10 - $20", None]
    assert values(spark, ["a\n\n b \n\n\n", "One. Two! three", "<html>x. y"], text.chunks(C)) == [["a", "b"], ["One.", "Two!", "three"], ["x.", "y"]]


def test_query_encoding(spark):
    assert values(spark, ["a b*~/é"], text.query_encode(C)) == ["a+b%2A~%2F%C3%A9"]
    assert values(spark, ["https://x/s?a=1&query=b+c%20d", "https://x/"], text.query_param(C, "query")) == ["b c d", ""]


def test_gates_match_substrings(spark):
    assert values(spark, ["I WISH", "fine", None], gates.pain(C)) == [True, False, False]
    assert values(spark, ["$5 manual", "payload", "need"], gates.job(C)) == [True, False, False]
    assert values(spark, ["403 Forbidden", "captcha"], gates.blocked(C), gates.blocked(C, launch_page=True)) == [(False, True), (True, True)]


def test_truthy(spark):
    assert values(spark, [" ON ", "0", None], text.truthy(C), text.truthy(C, default=True)) == [(True, True), (False, False), (False, True)]
