"""Costly steps are taken once a row, and only where a text needs them; the results are those of the plain forms."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from gripelode.functions import keys, text
from gripelode.operators import ingest
from gripelode.sources import landing, payloads, union

NAMES = ["source", "source_item_id", "entity_id", "entity_name", "category", "reviewer_name", "comment_text", "posted_at", "url", "country", "language"]
ODD = ["", "plain words", " lead", "trail ", "two  blanks", "tab\there", "a\0b", "a b", "a|b", "a |b", "été", " ", "x\x1cy", "İ Σ", None]


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def plain_clean(c):
    return F.trim(F.regexp_replace(F.translate(F.coalesce(c, F.lit("")), "\0", " "), text.WS + "+", " "))


def test_texts_with_nothing_to_clean_are_only_looked_at(spark):
    df = spark.createDataFrame([(t,) for t in ODD], "c string")
    cleaned = df.select("c", text.clean(F.col("c")).alias("v"), plain_clean(F.col("c")).alias("plain"))
    assert [r for r in cleaned.collect() if r["v"] != r["plain"]] == []
    assert "translate(" not in plan(df.select(text.clean(F.col("c"))))


def test_canonical_looks_at_all_texts_of_a_row_once(spark):
    # Each odd text stands once in each column, beside texts that are clean.
    rows = [tuple(odd if i == k else f"v{k}" for k in range(len(NAMES))) + (1.0, "{}") for odd in ODD for i in range(len(NAMES))]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in NAMES) + ", rating double, raw_json string")
    got = ingest.canonical(df, F.lit("2024-03-01").cast("timestamp_ntz"))
    want = df.select(*[plain_clean(F.col(c)).alias(c) for c in NAMES]).replace({"": "Unknown"}, subset="category").replace({"": "en"}, subset="language")
    want = want.withColumn("fingerprint", keys.fingerprint(*[F.col(c) for c in ("source", "source_item_id", "entity_id", "reviewer_name", "comment_text", "posted_at")]))
    assert sorted(map(tuple, got.select(*NAMES, "fingerprint").collect())) == sorted(map(tuple, want.collect()))
    assert plan(got).count(text.COLLAPSED) == 1


@pytest.mark.parametrize("given, time", [
    ("2024-02-29T23:59:59.5Z", datetime(2024, 2, 29, 23, 59, 59, 500000)), ("2024-01-02 03:04:05.000001+00:00", datetime(2024, 1, 2, 3, 4, 5, 1)),
    ("Thu, 29 Feb 2024 01:02:03 +0000", datetime(2024, 2, 29, 1, 2, 3)), ("Sun, 31 Dec 2023 23:00:00 +0000", datetime(2023, 12, 31, 23)),
    ("Mon, 01 May 2023 00:00:00 +0000", datetime(2023, 5, 1)), ("2024-01-02T03:04:05+05:30", datetime(2024, 1, 1, 21, 34, 5)),
    ("2023-02-29T00:00:00Z", None), ("0000-01-01T00:00:00Z", None), ("2024-01-01T24:00:00Z", None), ("Mon, 00 May 2023 00:00:00 +0000", None),
    ("Mon, 30 Feb 2023 00:00:00 +0000", None), ("Mon, 01 Jan 0000 00:00:00 +0000", None),
])
def test_usual_times_are_read_as_they_stand(spark, given, time):
    df = spark.createDataFrame([(given,)], "c string")
    assert df.select(keys.parse_time(F.col("c"))).first()[0] == time
    assert "0000" in keys._USUAL_ISO and "0000" in keys._USUAL_MAIL


def test_the_spellings_of_a_job_are_read_in_one_walk(spark):
    bodies = ['{"id": null, "uid": 7, "headline": "t", "summary": "<b>s</b>", "amount": 5, "currencyCode": "USD", "publishedOn": 1704067200000}', '{"id": "", "x": 1}', '{"zz": "t"}']
    objects = spark.createDataFrame([("q", i, 0, b) for i, b in enumerate(bodies)], "query string, pos int, depth int, object string")
    nodes = payloads.job_nodes(objects)
    assert [tuple(r) for r in nodes.select("pos", "title", "description", "guid", "pubDate").collect()] == [(0, "t", "s", "7", "2024-01-01T00:00:00+00:00")]
    assert plan(nodes).count("variant_get(") == 1


def test_a_missing_link_of_a_job_stays_missing_in_its_id(spark):
    items = spark.createDataFrame([("q", "c", "I wish", "x", None, " ", "", "rss"), ("q", "c", "I wish", "x", "", None, None, "rss")], "query string, category string, title string, description string, link string, guid string, pubDate string, provider string")
    ids = {r["source_item_id"] for r in payloads.job_reviews(items).collect()}
    want = spark.range(1).select(F.sha1(F.lit("q|I wish")), F.sha1(F.lit("q|I wish|"))).first()
    assert ids == set(want)


def test_attributes_of_landed_payloads_come_back(spark):
    frame = spark.createDataFrame([("a", None, "c", "us", "[]"), (None, "n", "", "de", None)], "play_id string, app_name string, category string, country string, body string")
    back = union.of_shape(union.landed({"play": frame}), "play")
    assert back.columns == frame.columns and sorted(map(str, back.collect())) == sorted(map(str, frame.collect()))


def test_a_time_is_parsed_once_for_all_pieces_of_its_text(spark):
    frame = spark.createDataFrame([("a", "n", "c", "us", '[{"reviewId": "r", "content": "I hate it", "score": 1, "at": "2024-01-02T03:04:05.5Z"}]')], "play_id string, app_name string, category string, country string, body string")
    rows = payloads.play_reviews(frame)
    assert rows.first()["posted_at"] == "2024-01-02T03:04:05.500000+00:00"
    once = plan(frame.select(keys.parse_time(F.col("body")).alias("t"))).count("jan|feb|mar")
    assert plan(rows).count("jan|feb|mar") == once


def test_pages_are_grouped_by_their_number_first(spark):
    revs = spark.createDataFrame([(33, "b", "x"), (1, "b", "y"), (0, "b", "z"), (2, None, "w"), (None, "b", "v")], "event_id long, category string, item string")
    pages = landing.paged(revs, ["category"], F.col("item"))
    assert sorted(map(str, (tuple(r) for r in pages.select("category", "page", "items").collect()))) == sorted(map(str, [("b", 0, ["z", "y"]), ("b", 1, ["x"]), (None, 0, ["w"]), ("b", None, ["v"])]))
    assert pages.columns == ["page", "category", "items"] and "lambda" not in plan(pages)
