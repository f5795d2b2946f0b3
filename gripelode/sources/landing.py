"""Landed payload shapes derived from the given tables: JSON, XML, HTML and text bodies.

A payload body holds the rows of one small page of event ids, so no body grows with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gripelode.functions import keys
from gripelode.sources.tables import pick, table

PAGE = 32


def budget_texts(revs: DataFrame) -> DataFrame:
    e = F.col("event_id")
    body = (
        F.when(e % 4 == 0, F.col("comment_text"))
        .when(e % 4 == 1, F.concat(F.lit("Hourly Range: $"), e % 90, F.lit(".50 - $"), e % 90 + 10))
        .when(e % 4 == 2, F.concat(F.lit("BUDGET - $ 1,"), F.lpad((e % 1000).cast("string"), 3, "0"), F.lit(" "), "comment_text"))
        .otherwise(F.concat(F.lit("no sum: "), "comment_text"))
    )
    return revs.select("event_id", body.alias("body"))


def market_pages(pages: DataFrame) -> DataFrame:
    """Product pages: the given html plus description and rating markup in several spellings."""
    p, html = F.col("page_id"), F.col("html")
    named = F.concat(
        F.lit('<meta name="description" content="I hate\n this vendor '), p, F.lit('"><script>{"ratingValue": "'), p % 5,
        F.lit('.5"}</script></head>'),
    )
    content_first = F.concat(
        F.lit("<meta content='Best pricing "), p, F.lit("' name='description'></head><i data-rating=\""), p % 5, F.lit('"></i>')
    )
    broken = F.concat(F.lit("<body>Rating: 1.2."), p, F.lit(" "))
    marked = (
        F.when(p % 4 == 0, F.replace(html, F.lit("</head>"), named))
        .when(p % 4 == 1, F.replace(html, F.lit("</head>"), content_first))
        .when(p % 4 == 2, F.replace(html, F.lit("<body>"), broken))
        .otherwise(html)
    )
    source = F.when(p % 5 == 4, "g2").when(p % 5 == 3, "capterra").otherwise("other")
    return pages.select("page_id", "url", source.alias("source"), marked.alias("html"))


def page_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = market_pages(table(spark, sf_dir, "pages")).select(F.lit("page").alias("kind"), F.col("page_id").alias("id"), F.col("html").alias("body"))
    head = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("\nTitle:  About "), "doc_id", F.lit("\nURL Source: x\n"))).otherwise("")
    docs = table(spark, sf_dir, "documents").select(F.lit("document").alias("kind"), F.col("doc_id").alias("id"), F.concat(head, "text").alias("body"))
    return pages.unionByName(docs)


def challenge_pages(pages: DataFrame) -> DataFrame:
    p = F.col("page_id")
    head = (
        F.when(p % 6 == 0, "<h1>Just a Moment</h1>").when(p % 6 == 1, "CloudFlare check").when(p % 6 == 2, "solve the CAPTCHA")
        .when(p % 6 == 3, "403 Forbidden").when(p % 6 == 4, "forbidden").otherwise("")
    )
    # Digits of the given html are masked so that 403 only occurs where it was put.
    return pages.select("page_id", F.concat(head, F.regexp_replace("html", "403", "xxx")).alias("html"))


def tag_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, p = F.col("c_custkey"), F.col("p_partkey")
    place = F.lower("n_name")
    customers = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("c_nationkey")).select(
        F.lit("customer").alias("kind"), c.alias("id"),
        F.when(c % 4 == 0, F.col("n_name")).when(c % 4 == 1, F.concat(F.lit("r/"), place))
        .when(c % 4 == 2, F.concat(F.lit("/_"), place, F.lit(" sales_ops ;"))).otherwise(F.concat("c_mktsegment", F.lit(" city"))).alias("value"),
    )
    parts = table(spark, sf_dir, "part").select(
        F.lit("part").alias("kind"), p.alias("id"),
        F.when(p % 5 == 0, "n/a").when(p % 5 == 1, F.concat("p_name", F.lit("/3d e-mail")))
        .when(p % 5 == 2, F.concat(F.lower("p_type"), F.lit(" don't  work in the us"))).otherwise(F.col("p_brand")).alias("value"),
    )
    return customers.unionByName(parts)


def json_texts(events: DataFrame) -> DataFrame:
    """Model-like answers: clean, fenced, array, garbage, and prose around an object."""
    e, props = F.col("event_id"), F.col("props")
    answer = (
        F.when(e % 5 == 0, props).when(e % 5 == 1, F.concat(F.lit("```json\n"), props, F.lit("\n```")))
        .when(e % 5 == 2, F.concat(F.lit("[1, 2, "), e, F.lit("]"))).when(e % 5 == 3, F.concat(F.lit("{not json "), e, F.lit("}")))
        .otherwise(F.concat(F.lit("Sure, here it is: "), props, F.lit(" - done")))
    )
    return events.select("event_id", answer.alias("response"))


def time_texts(events: DataFrame) -> DataFrame:
    e, ts = F.col("event_id"), F.col("ts")
    second = F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
    value = (
        F.when(e % 7 == 0, keys.iso_utc(ts)).when(e % 7 == 1, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
        .when(e % 7 == 2, F.concat(second, F.lit("+05:30"))).when(e % 7 == 3, F.date_format(ts, "yyyy-MM-dd"))
        .when(e % 7 == 4, F.date_format(ts, "EEE, dd MMM yyyy HH:mm:ss' -0700'")).when(e % 7 == 5, F.concat(F.lit(" "), second))
        .otherwise(F.concat(F.lit("about "), second))
    )
    return events.select("event_id", value.alias("value"))


# --- payload pages: each body holds the reviews of one page of event ids ----------------------


def paged(revs: DataFrame, keys_: list[str], item: Column) -> DataFrame:
    """One row per key and page with its ``items`` in event order (at most PAGE of them)."""
    page = F.floor(F.col("event_id") / PAGE).alias("page")
    listed = F.sort_array(F.collect_list(F.struct(F.col("event_id"), item.alias("item"))))
    # The page comes first: a number tells most groups apart without a look at the texts.
    return revs.groupBy(page, *keys_).agg(listed["item"].alias("items"))


def _e(n: int, hit: int = 0) -> Column:
    return F.col("event_id") % n == hit


def _label(c: Column, name: str = "label") -> Column:
    return F.struct(c.alias(name))


def play_payloads(revs: DataFrame) -> DataFrame:
    item = F.struct(
        F.when(~_e(29), F.col("source_item_id")).alias("reviewId"), F.col("reviewer_name").alias("userName"),
        F.concat(F.lit(" "), F.replace("comment_text", F.lit(" "), F.lit("  "))).alias("content"), F.col("rating").alias("score"),
        F.col("posted_at").alias("at"),
    )
    revs = revs.withColumn("play_id", F.concat(F.lit("app."), "entity_id")).withColumn("country", F.lower("country"))
    pages = paged(revs, ["play_id", "entity_name", "category", "country"], item)
    return pages.select("play_id", F.col("entity_name").alias("app_name"), "category", "country", F.to_json("items").alias("body"))


def appstore_payloads(revs: DataFrame) -> DataFrame:
    rating = F.when(_e(31), "five").otherwise(F.col("rating").cast("string"))
    item = F.struct(
        F.when(F.col("rating").isNotNull(), _label(rating)).alias("im:rating"), _label(F.col("comment_text")).alias("content"),
        _label(F.col("posted_at")).alias("updated"), _label(F.col("source_item_id")).alias("id"),
        F.struct(_label(F.col("reviewer_name")).alias("name")).alias("author"),
    )
    pages = paged(revs.withColumn("country", F.lower("country")), ["entity_id", "entity_name", "category", "country"], item)
    many = F.to_json(F.struct(F.struct(F.col("items").alias("entry")).alias("feed")))
    one = F.to_json(F.struct(F.struct(F.get("items", F.lit(0)).alias("entry")).alias("feed")))
    body = F.when(F.size("items") == 1, one).otherwise(many)
    return pages.select(F.col("entity_id").alias("apple_id"), F.col("entity_name").alias("app_name"), "category", "country", body.alias("body"))


def community_payloads(revs: DataFrame) -> DataFrame:
    post = F.struct(
        F.col("event_id").cast("string").alias("id"), F.when(_e(29), "").otherwise(F.col("source_item_id")).alias("name"),
        F.col("comment_text").alias("title"), F.when(_e(2), "Details\n\n follow").otherwise("").alias("selftext"),
        F.col("reviewer_name").alias("author"), F.concat(F.lit("/r/x/"), F.col("event_id").cast("string")).alias("permalink"),
        (keys.epoch_micros(F.col("posted_ts")) / 1e6).alias("created_utc"),
    )
    pages = paged(revs, ["entity_name"], _label(post, "data"))
    listing = F.struct(F.struct(F.col("items").alias("children")).alias("data"))
    return pages.select(F.lower("entity_name").alias("community"), F.to_json(listing).alias("body"))


def _result_text() -> Column:
    link = F.when(_e(4), F.concat(F.lit(" https://news.ycombinator.com/item?id="), F.col("event_id"))).otherwise("")
    return F.concat("comment_text", link)


def forum_payloads(revs: DataFrame) -> DataFrame:
    pages = paged(revs, ["category"], F.concat(_result_text(), F.lit("\n")))
    query = F.concat("category", F.lit(" team export"))
    return pages.select(query.alias("query"), "category", "page", F.concat(F.lit(" \n\n"), F.array_join("items", "\n\n \n\n")).alias("body"))


def launch_payloads(revs: DataFrame) -> DataFrame:
    """Every third page is HTML, every fifth a challenge page."""
    pages = paged(revs, ["category"], F.col("comment_text"))
    html = F.concat(F.lit("<HTML><body><p>"), F.array_join("items", "!</p><p>"), F.lit("</p></body></html>"))
    body = F.when(F.col("page") % 3 == 1, html).otherwise(F.array_join("items", "\n\n\n"))
    guarded = F.when(F.col("page") % 5 == 0, F.concat(F.lit("Captcha\n\n"), body)).otherwise(body)
    return pages.select(F.lit("ticket & export").alias("query"), "category", "page", guarded.alias("body"))


def _xml(name: str, value: Column) -> Column:
    escaped = F.replace(F.replace(value, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    return F.concat(F.lit(f"<{name}>"), escaped, F.lit(f"</{name}>"))


def atom_payloads(revs: DataFrame) -> DataFrame:
    """Entries with summary or content, some without id, some without title and summary."""
    markup = F.concat(F.lit("<p>"), "comment_text", F.lit(" &amp; more</p>"))
    body = F.when(_e(7), "").otherwise(F.concat(_xml("title", F.concat(F.lit("Launch "), F.col("event_id"))), F.when(_e(2), _xml("summary", markup)).otherwise(_xml("content", markup))))
    entry = F.concat(
        F.lit("<entry>"), body, F.when(_e(29), "").otherwise(_xml("id", F.concat(F.lit("tag:"), "source_item_id"))), _xml("updated", F.col("posted_at")),
        F.lit('<link rel="alternate" href="'), "url", F.lit('"/><link rel="edit" href="https://no.example/"/></entry>'),
    )
    pages = paged(revs, ["category"], entry)
    feed = F.concat(F.lit('<?xml version="1.0" encoding="UTF-8"?><feed xmlns="http://www.w3.org/2005/Atom"><title>t</title>'), F.array_join("items", "\n"), F.lit("</feed>"))
    return pages.select(F.lit("export launch").alias("query"), "category", feed.alias("body"))


def rss_payloads(revs: DataFrame) -> DataFrame:
    item = F.concat(
        F.lit("<item>"), _xml("title", F.concat(F.lit("Job "), F.col("event_id"))), _xml("description", F.concat(F.lit("<b>"), "comment_text", F.lit("</b>"))),
        _xml("link", F.col("url")), F.when(_e(29), "").otherwise(_xml("guid", F.col("source_item_id"))),
        _xml("pubDate", F.date_format("posted_ts", "EEE, dd MMM yyyy HH:mm:ss' +0000'")), F.lit("</item>"),
    )
    pages = paged(revs, ["category"], item)
    feed = F.concat(F.lit('<rss version="2.0"><channel><title>t</title>'), F.array_join("items", ""), F.lit("</channel></rss>"))
    return pages.select(F.col("category").alias("query"), "category", feed.alias("body"))


def dataset_payloads(revs: DataFrame) -> DataFrame:
    """Lists on even pages, ``items`` objects on odd ones; spellings alternate."""
    item = F.struct(
        F.concat(F.lit(" Job  "), F.col("event_id")).alias("title"), F.concat(F.lit("<i>"), "comment_text", F.lit("</i>")).alias("description"),
        F.when(_e(2), F.col("url")).alias("url"), F.when(_e(2, 1), F.col("url")).alias("link"),
        F.when(_e(3), F.col("source_item_id")).otherwise("").alias("id"), F.when(~_e(29), F.col("source_item_id")).alias("jobId"),
        F.when(_e(2), F.col("posted_at")).alias("publishedAt"), F.when(_e(2, 1), F.col("posted_at")).alias("createdAt"),
    )
    pages = paged(revs, ["category"], item)
    body = F.when(F.col("page") % 2 == 0, F.to_json("items")).otherwise(F.to_json(F.struct("items")))
    return pages.select(F.col("category").alias("query"), "category", "page", body.alias("body"))


def job_node_payloads(revs: DataFrame) -> DataFrame:
    """Nested edge lists with alternating spellings, epoch seconds, epoch millis and ISO dates."""
    seconds = F.floor(keys.epoch_micros(F.col("posted_ts")) / 1_000_000)
    node = F.struct(
        F.when(_e(2), F.concat(F.lit("Job "), F.col("event_id"))).alias("title"), F.when(_e(2, 1), F.concat(F.lit("Job "), F.col("event_id"))).alias("jobTitle"),
        F.when(_e(3), F.concat(F.lit("<p>"), "comment_text", F.lit("</p>"))).alias("description"), F.when(_e(3, 1), F.col("comment_text")).alias("snippet"),
        F.when(_e(4), "15").alias("hourlyBudgetMin"), F.when(_e(5), 200).alias("amount"), F.when(_e(5), "USD").alias("currencyCode"),
        F.col("url").alias("canonicalUrl"), F.when(~_e(29), F.col("source_item_id")).alias("jobId"),
        F.when(_e(3), seconds).when(_e(3, 1), seconds * 1000).alias("publishedOn"), F.when(_e(3, 2), F.col("posted_at")).alias("createdAt"),
        F.struct(F.col("country").alias("code")).alias("client"),
    )
    pages = paged(revs, ["category"], F.struct(node.alias("node")))
    data = F.struct(F.struct(F.struct(F.col("items").alias("edges"), F.lit(1).alias("total")).alias("search")).alias("data"))
    return pages.select(F.concat_ws("-", "category", "page").alias("payload_id"), F.col("category").alias("query"), "category", F.to_json(data).alias("body"))


def forum_listings(revs: DataFrame) -> DataFrame:
    """Forum HTML: story rows, comments and new-comment rows of one page."""
    e = F.col("event_id")
    link = F.when(_e(3), F.concat(F.lit("item?id="), e)).otherwise(F.col("url"))
    story = F.concat(
        F.lit("<tr class='athing submission' id='"), e, F.lit("'>\n<td><span class=\"titleline\"> <a rel=\"n\" href=\""), link, F.lit("\">"),
        F.when(_e(11), "").otherwise(F.col("comment_text")), F.lit(" <i>&amp;</i></a></span></td></tr>"),
    )
    comment = F.concat(F.lit("<span dir='x' class=\"commtext c00\">"), F.when(_e(7), " <p> ").otherwise(F.col("comment_text")), F.lit("</span>"))
    fresh = F.concat(
        F.lit("<tr class='athing' data='1' id='"), e, F.lit("'><td><span x='1' class=\"onstory\">on: <a x='1' href=\""),
        F.when(_e(2), F.concat(F.lit("/item?id="), e)).otherwise(F.col("url")), F.lit("\">Story <b>"), e,
        F.lit("</b></a></span><div x='1' class=\"comment\"> <div x='1' class=\"commtext c00\">"), F.when(_e(7), "").otherwise(F.col("comment_text")), F.lit("</div></div></td></tr>"),
    )
    pages = paged(revs, ["category"], F.struct(story.alias("story"), comment.alias("comment"), fresh.alias("fresh")))
    return pages.select(
        F.concat_ws("-", "category", "page").alias("listing_id"),
        *[F.concat(F.lit("<table>"), F.array_join(F.col(f"items.{k}"), "\n"), F.lit("</table>")).alias(k) for k in ("story", "comment", "fresh")],
    )


def job_search_pages(revs: DataFrame) -> DataFrame:
    pages = paged(revs, ["category"], F.concat("comment_text", F.lit(" fixed-price, needs a long description. "), F.col("event_id")))
    body = F.concat(F.when(F.col("page") % 5 == 4, "Just a moment\n\n").otherwise(""), F.array_join("items", "\n\n"))
    return pages.select(F.concat_ws("-", "category", "page").alias("query"), "category", "page", body.alias("body"))
