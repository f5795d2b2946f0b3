"""Payload normalisers over payloads landed from all reviews, and page and forum extractors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gripelode import lexicon as lx
from gripelode.operators import ingest
from gripelode.operators import seeds as seed_ops
from gripelode.plans import sql as S
from gripelode.plans.registry import CHECKS, cte, query
from gripelode.session import stage
from gripelode.sources import landing, payloads, union
from gripelode.sources.tables import reviews, table

SHOWN = ["source", "source_item_id", "entity_id", "entity_name", "category", "reviewer_name", "rating", "comment_text", "posted_at", "url", "country", "language"]


def shown(df: DataFrame) -> DataFrame:
    return df.select(*SHOWN)


def _review_sql(where: str, frm: str = "x_reviews", **cols: str) -> str:
    base = {"reviewer_name": "reviewer_name", "rating": "CAST(NULL AS DOUBLE)", "country": "''", "language": "'en'", "posted_at": "''", "category": "category"}
    return "SELECT " + ", ".join(f"{v} AS {k}" for k, v in {**base, **cols}.items()) + f" FROM {frm} WHERE {where}"


@query("norm_play", _review_sql(
    S.mobile("comment_text"), source="'play_store'", entity_id="'app.' || entity_id", entity_name="entity_name", rating="rating", comment_text="comment_text",
    source_item_id="CASE WHEN event_id % 29 = 0 THEN md5('app.' || entity_id || '-' || reviewer_name || '-' || posted_at) ELSE source_item_id END",
    posted_at="posted_at", url="'https://play.google.com/store/apps/details?id=app.' || entity_id", country="country"))
def norm_play(spark, sf):
    return shown(payloads.play_reviews(landing.play_payloads(reviews(spark, sf))))


@query("norm_appstore", _review_sql(
    f"event_id % 31 <> 0 AND {S.mobile('comment_text')}", source="'app_store'", entity_id="entity_id", entity_name="entity_name", rating="rating",
    comment_text="comment_text", source_item_id="source_item_id", posted_at="posted_at", url="source_item_id", country="country"))
def norm_appstore(spark, sf):
    return shown(payloads.appstore_reviews(landing.appstore_payloads(reviews(spark, sf))))


cte("x_posts", "SELECT * REPLACE (comment_text || CASE WHEN event_id % 2 = 0 THEN ' Details follow' ELSE '' END AS comment_text) FROM x_reviews")


@query("norm_reddit", _review_sql(
    S.community("comment_text"), frm="x_posts", source="'reddit'", entity_id="lower(entity_name)", entity_name="lower(entity_name)", category="'reddit'", comment_text="comment_text",
    source_item_id="CASE WHEN event_id % 29 = 0 THEN 't3_' || event_id ELSE source_item_id END", posted_at="posted_at", url="'https://reddit.com/r/x/' || event_id"))
def norm_reddit(spark, sf):
    return shown(payloads.community_posts(landing.community_payloads(reviews(spark, sf))))


def _q(text: str) -> str:
    return f"replace(url_encode({text}), '%20', '+')"


cte("x_results", f"""
  SELECT category, category || ' team export' AS query, event_id, row_number() OVER (PARTITION BY category, event_id // {landing.PAGE} ORDER BY event_id) - 1 AS pos,
    comment_text || CASE WHEN event_id % 4 = 0 THEN ' https://news.ycombinator.com/item?id=' || event_id ELSE '' END AS chunk FROM x_reviews""")


@query("norm_forum_chunks", _review_sql(
    S.forum("chunk", "query"), frm="x_results", source="'hacker_news'", entity_id="query", entity_name="'Hacker News - ' || query", reviewer_name="''", comment_text="left(chunk, 2500)",
    source_item_id="sha1('hn:' || query || ':' || pos || ':' || left(chunk, 220))",
    url=f"CASE WHEN event_id % 4 = 0 THEN 'https://news.ycombinator.com/item?id=' || event_id ELSE 'https://hn.algolia.com/?q=' || {_q('query')} || '&type=comment&sort=byDate' END"))
def norm_forum_chunks(spark, sf):
    return shown(payloads.forum_chunks(landing.forum_payloads(reviews(spark, sf))))


cte("x_launch_pages", f"""
  SELECT category, event_id // {landing.PAGE} AS page, list(comment_text ORDER BY event_id) AS items FROM x_reviews GROUP BY 1, 2""")
cte("x_launch_chunks", rf"""
  SELECT category, 'ticket & export' AS query, generate_subscripts(parts, 1) - 1 AS pos, unnest(parts) AS chunk FROM (
    SELECT category, CASE WHEN page % 3 = 1 THEN string_split(regexp_replace(array_to_string(items, '! ') , '([.!?])\s+', '\1' || chr(30), 'g'), chr(30)) ELSE
      CASE WHEN len(items) > 1 THEN items ELSE string_split(regexp_replace(items[1], '([.!?])\s+', '\1' || chr(30), 'g'), chr(30)) END END AS parts
    FROM x_launch_pages WHERE page % 5 <> 0)""")


@query("norm_launch_chunks", _review_sql(
    S.launch("chunk", "query"), frm="x_launch_chunks", source="'product_hunt'", entity_id="query", entity_name="'Product Hunt - ' || query", reviewer_name="''", comment_text="left(chunk, 2500)",
    source_item_id="sha1('producthunt-html:' || query || ':' || pos || ':' || left(chunk, 220))", url=f"'https://www.producthunt.com/search/posts?q=' || {_q('query')}"))
def norm_launch_chunks(spark, sf):
    return shown(payloads.launch_chunks(landing.launch_payloads(reviews(spark, sf))))


cte("x_entries", """
  SELECT *, 'export launch' AS query, 'Launch ' || event_id || '. ' || comment_text || ' & more' AS content FROM x_reviews WHERE event_id % 7 <> 0""")


@query("norm_atom", _review_sql(
    S.launch("content", "query"), frm="x_entries", source="'product_hunt'", entity_id="query", entity_name="'Product Hunt - ' || query", reviewer_name="''", comment_text="left(content, 2500)",
    source_item_id="CASE WHEN event_id % 29 = 0 THEN sha1('producthunt-feed:' || query || ':' || url || ':Launch ' || event_id) ELSE 'tag:' || source_item_id END",
    posted_at="posted_at", url="url"))
def norm_atom(spark, sf):
    return shown(payloads.atom_reviews(landing.atom_payloads(reviews(spark, sf))))


_SECOND = "date_trunc('second', posted_ts)"


@query("norm_rss", f"""
SELECT category AS query, 'Job ' || event_id AS title, comment_text AS description, url AS link, CASE WHEN event_id % 29 = 0 THEN '' ELSE source_item_id END AS guid,
  strftime(posted_ts, '%a, %d %b %Y %H:%M:%S +0000') AS "pubDate" FROM x_reviews""")
def norm_rss(spark, sf):
    items = payloads.rss_items(landing.rss_payloads(reviews(spark, sf)))
    return items.select("query", "title", "description", "link", "guid", "pubDate")


@query("norm_dataset_json", """
SELECT category AS query, 'Job ' || event_id AS title, comment_text AS description, url AS link,
  CASE WHEN event_id % 29 = 0 AND event_id % 3 <> 0 THEN '' ELSE source_item_id END AS guid, posted_at AS "pubDate" FROM x_reviews""")
def norm_dataset_json(spark, sf):
    items = payloads.dataset_items(landing.dataset_payloads(reviews(spark, sf)))
    return items.select("query", "title", "description", "link", "guid", "pubDate")


# Visiting order: root, data, search, then the edges from the last to the first.
cte("x_nodes", f"""
  SELECT *, 4 + 3 * (row_number() OVER (PARTITION BY category, event_id // {landing.PAGE} ORDER BY event_id DESC) - 1) AS pos,
    category || '-' || (event_id // {landing.PAGE}) AS payload_id FROM x_reviews""")
cte("x_job_items", f"""
  SELECT payload_id, pos, category AS query, category, 'Job ' || event_id AS title, url AS link,
    CASE WHEN event_id % 3 IN (0, 1) THEN comment_text ELSE array_to_string(list_filter([
      CASE WHEN event_id % 4 = 0 THEN 'Hourly: 15-?' END, CASE WHEN event_id % 5 = 0 THEN 'Budget: 200 USD' END], lambda b: b IS NOT NULL), ' ') END AS description,
    CASE WHEN event_id % 29 = 0 THEN sha1(category || '|Job ' || event_id || '|' || url || '|' || pos) ELSE source_item_id END AS guid,
    CASE WHEN event_id % 3 IN (0, 1) THEN {S.iso(_SECOND)} ELSE posted_at END AS "pubDate"
  FROM x_nodes""")


@query("json_walk_objects", """
SELECT payload_id, depth, count(*) AS objects FROM (
  SELECT payload_id, unnest([4, 5, 6]) AS depth FROM x_nodes UNION ALL
  SELECT payload_id, unnest([0, 1, 2]) FROM (SELECT DISTINCT payload_id FROM x_nodes)) GROUP BY 1, 2""")
def json_walk_objects(spark, sf):
    objects = payloads.json_objects(landing.job_node_payloads(reviews(spark, sf)))
    return objects.groupBy("payload_id", "depth").agg(F.count("*").alias("objects"))


_NODE_ID = "CASE WHEN event_id % 29 <> 0 THEN source_item_id END"


@query("json_walk_order", f"""
SELECT payload_id, pos, 5 AS depth, {_NODE_ID} AS job_id, url, NULL AS code, NULL AS total FROM x_nodes
UNION ALL SELECT payload_id, pos - 1, 4, NULL, NULL, NULL, NULL FROM x_nodes
UNION ALL SELECT payload_id, pos + 1, 6, NULL, NULL, country, NULL FROM x_nodes
UNION ALL SELECT payload_id, unnest([0, 1, 2]), unnest([0, 1, 2]), NULL, NULL, NULL, unnest([NULL, NULL, '1']) FROM (SELECT DISTINCT payload_id FROM x_nodes)""")
def json_walk_order(spark, sf):
    """Every object at its place in the walk, told apart by what only its own level holds."""
    objects = payloads.json_objects(landing.job_node_payloads(reviews(spark, sf)))
    # All of an object's names are read in one go.
    held = F.json_tuple("object", "jobId", "canonicalUrl", "code", "total").alias("job_id", "url", "code", "total")
    return objects.select("payload_id", F.col("pos").cast("long").alias("pos"), "depth", held)


@query("norm_job_nodes", "SELECT payload_id, query, title, description, link, guid, \"pubDate\" FROM x_job_items")
def norm_job_nodes(spark, sf):
    items = payloads.job_nodes(payloads.json_objects(landing.job_node_payloads(reviews(spark, sf))))
    return items.select("payload_id", "query", "title", "description", "link", "guid", "pubDate")


@query("job_items_dedupe", """
SELECT payload_id, item_rank, title, guid FROM (
  SELECT *, row_number() OVER (PARTITION BY payload_id ORDER BY pos) AS item_rank FROM (
    SELECT *, row_number() OVER (PARTITION BY payload_id, guid ORDER BY pos) AS seen FROM x_job_items) WHERE seen = 1) WHERE item_rank <= 5""")
def job_items_dedupe(spark, sf):
    items = payloads.job_nodes(payloads.json_objects(landing.job_node_payloads(reviews(spark, sf))))
    first = payloads.first_items(items, ["payload_id"], [F.col("pos").asc()], 5)
    return first.select("payload_id", F.col("item_rank").cast("long").alias("item_rank"), "title", "guid")


cte("x_rss_text", "SELECT *, 'Job ' || event_id || '. ' || comment_text AS content FROM x_reviews")


@query("norm_jobs", _review_sql(
    S.job("content"), frm="x_rss_text", source="'upwork'", entity_id="category", entity_name="'Upwork - ' || category", reviewer_name="'client'", comment_text="content",
    source_item_id="CASE WHEN event_id % 29 = 0 THEN sha1(category || '|Job ' || event_id || '|' || url) ELSE source_item_id END", posted_at=S.iso(_SECOND), url="url"))
def norm_jobs(spark, sf):
    return shown(payloads.job_reviews(payloads.rss_items(landing.rss_payloads(reviews(spark, sf)))))


cte("x_snippets", f"""
  SELECT p.page_id, p.url, p.source, r.rating, t.title || '. ' || d.description AS snippet FROM x_market_pages p
  JOIN x_page_ratings r USING (page_id) JOIN x_page_titles t ON t.kind = 'page' AND t.id = page_id JOIN x_page_descs d ON d.kind = 'page' AND d.id = page_id""")


@query("norm_market_pages", _review_sql(
    S.market("snippet", "source"), frm="x_snippets", source="source", entity_id="url", entity_name="'Page ' || page_id", category="'Unknown'", reviewer_name="''", rating="rating",
    comment_text=S.clean("snippet"), source_item_id="sha1(source || ':' || url)", url="url"))
def norm_market_pages(spark, sf):
    pages = landing.market_pages(table(spark, sf, "pages")).withColumn("product_name", F.concat(F.lit("Page "), "page_id")).withColumn("category", F.lit(None).cast("string"))
    return shown(payloads.market_reviews(pages))


cte("x_market_seeds", """
  SELECT CASE WHEN s_suppkey % 2 = 0 THEN 'g2' ELSE 'capterra' END AS source, CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE s_name END AS product_name,
    CASE WHEN s_suppkey % 4 = 0 THEN '' ELSE 'Sales' END AS category, s_acctbal > 0 AS enabled, s_suppkey,
    'https://market.example/search?query=' || replace(url_encode(CASE WHEN s_suppkey % 6 = 0 THEN '' ELSE s_name || ' a+b' END), '%20', '+') AS url
  FROM supplier""")


@query("signal_rows", _review_sql(
    "enabled AND (source, url) NOT IN (SELECT source, url FROM x_market_seeds WHERE s_suppkey % 5 = 0)", frm="x_market_seeds", source="source", source_item_id="sha1(source || ':' || url)", entity_id="url", entity_name="product_name", reviewer_name="''",
    comment_text="""upper(source) || ' marketplace demand signal: buyers are researching ' || CASE WHEN product_name <> '' THEN product_name
      WHEN s_suppkey % 6 = 0 THEN 'software buyers' ELSE 'Supplier#' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0') || ' a b' END || ' in ' || CASE WHEN category = '' THEN 'Unknown' ELSE category END ||
      '. Search and review discovery pages indicate active comparison intent around pricing, alternatives, feature gaps, and fit for business workflows. Capture reason: HTTP 503.'""", url="url")
    + """ UNION ALL SELECT '' AS reviewer_name, NULL, '', 'en', '', 'Parts', 'upwork', 'upwork-query-signal:' || regexp_replace(p_name, ' ', '-') || '-' || p_partkey, p_name || ' ' || p_partkey, 'Upwork - ' || p_name || ' ' || p_partkey,
      'Upwork demand signal: ' || p_name || ' ' || p_partkey || '. Upwork demand signal query: ' || p_name || ' ' || p_partkey || '. This query indicates ongoing buyer intent around Parts workflows and manual-process pain that teams want to automate.',
      'https://www.upwork.com/ab/feed/jobs/rss?q=' || replace(p_name, ' ', '+') || '+' || p_partkey FROM part""".replace("SELECT '' AS reviewer_name, NULL, '', 'en', '', 'Parts'", "SELECT 'client' AS reviewer_name, NULL, '', 'en', '', 'Parts'"))
def signal_rows(spark, sf):
    seeds = seed_ops.market_seeds(table(spark, sf, "supplier"))
    landed = seeds.where(F.col("s_suppkey") % 5 == 0).select("source", "url")
    signals = payloads.market_signals(seeds, landed, "HTTP 503")
    queries = table(spark, sf, "part").select(F.concat_ws(" ", "p_name", "p_partkey").alias("query"), F.lit("Parts").alias("category"))
    return shown(signals.unionByName(payloads.job_reviews(payloads.job_query_signals(queries))))


@query("job_chunks", f"""
SELECT query, item_rank, sha1('upwork-jina:' || query || ':' || pos || ':' || left(chunk, 220)) AS guid, left(chunk, 2000) AS description,
  'https://www.upwork.com/nx/search/jobs/?q=' || {_q('query')} || '&sort=recency' AS link FROM (
  SELECT *, row_number() OVER (PARTITION BY query ORDER BY pos) AS item_rank FROM (
    SELECT category || '-' || (event_id // {landing.PAGE}) AS query, event_id // {landing.PAGE} AS page, comment_text || ' fixed-price, needs a long description. ' || event_id AS chunk,
      row_number() OVER (PARTITION BY category, event_id // {landing.PAGE} ORDER BY event_id) - 1 AS pos FROM x_reviews)
  WHERE page % 5 <> 4 AND length(chunk) >= 120 AND {S.job('chunk')}) WHERE item_rank <= 3""")
def job_chunks(spark, sf):
    found = payloads.job_page_chunks(landing.job_search_pages(reviews(spark, sf)), 3)
    return found.select("query", F.col("item_rank").cast("long").alias("item_rank"), "guid", "description", "link")


@query("extract_stories", f"""
SELECT category || '-' || (event_id // {landing.PAGE}) AS listing_id, CAST(event_id AS VARCHAR) AS id, trim(CASE WHEN event_id % 11 = 0 THEN '' ELSE comment_text END || ' &') AS title,
  CASE WHEN event_id % 3 = 0 THEN 'https://news.ycombinator.com/item?id=' || event_id ELSE url END AS link, 'https://news.ycombinator.com/item?id=' || event_id AS item_url FROM x_reviews""")
def extract_stories(spark, sf):
    pages = landing.forum_listings(reviews(spark, sf)).select("listing_id", F.col("story").alias("html"))
    return payloads.forum_stories(pages, "listing_id").select("listing_id", "id", "title", "link", "item_url")


@query("extract_comments", f"SELECT category || '-' || (event_id // {landing.PAGE}) AS listing_id, comment_text FROM x_reviews WHERE event_id % 7 <> 0")
def extract_comments(spark, sf):
    pages = landing.forum_listings(reviews(spark, sf)).select("listing_id", F.col("comment").alias("html"))
    return payloads.forum_comments(pages, "listing_id").select("listing_id", "comment_text")


@query("extract_newcomments", f"""
SELECT category || '-' || (event_id // {landing.PAGE}) AS listing_id, CAST(event_id AS VARCHAR) AS comment_id,
  CASE WHEN event_id % 2 = 0 THEN 'https://news.ycombinator.com/item?id=' || event_id ELSE url END AS story_link, 'Story ' || event_id AS story_title, comment_text
FROM x_reviews WHERE event_id % 7 <> 0""")
def extract_newcomments(spark, sf):
    pages = landing.forum_listings(reviews(spark, sf)).select("listing_id", F.col("fresh").alias("html"))
    return payloads.forum_new_comments(pages, "listing_id").select("listing_id", "comment_id", "story_link", "story_title", "comment_text")


def all_sources(spark, sf) -> DataFrame:
    """Every normaliser's rows as one frame, each source reading its own reviews."""
    revs = reviews(spark, sf)
    of = {label: revs.where(F.col("source") == label) for label in lx.SOURCE_LABELS}
    parts = [
        payloads.play_reviews(landing.play_payloads(of["play_store"])), payloads.appstore_reviews(landing.appstore_payloads(of["app_store"])),
        payloads.community_posts(landing.community_payloads(of["reddit"])), payloads.forum_chunks(landing.forum_payloads(of["hacker_news"])),
        payloads.atom_reviews(landing.atom_payloads(of["product_hunt"])), payloads.job_reviews(payloads.rss_items(landing.rss_payloads(of["upwork"]))),
        payloads.market_reviews(landing.market_pages(table(spark, sf, "pages")).withColumn("product_name", F.col("url")).withColumn("category", F.lit("Unknown"))),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query("reviews_union", f"""
SELECT source, count(*) AS n FROM (
  SELECT source FROM x_reviews WHERE source = 'play_store' AND {S.mobile('comment_text')}
  UNION ALL SELECT source FROM x_reviews WHERE source = 'app_store' AND event_id % 31 <> 0 AND {S.mobile('comment_text')}
  UNION ALL SELECT source FROM x_posts WHERE source = 'reddit' AND {S.community('comment_text')}
  UNION ALL SELECT 'hacker_news' FROM x_results JOIN x_reviews USING (event_id) WHERE source = 'hacker_news' AND {S.forum('chunk', 'query')}
  UNION ALL SELECT source FROM x_entries WHERE source = 'product_hunt' AND {S.launch('content', 'query')}
  UNION ALL SELECT source FROM x_rss_text WHERE source = 'upwork' AND {S.job('content')}
  UNION ALL SELECT source FROM x_snippets WHERE {S.market('snippet', 'source')}) GROUP BY 1""")
def reviews_union(spark, sf):
    return ingest.canonical(all_sources(spark, sf), F.lit("2024-03-01 00:00:00").cast("timestamp_ntz")).groupBy("source").agg(F.count("*").alias("n"))


def landed_payloads(spark, sf) -> DataFrame:
    """Every review landed in every shape, and the given pages as product pages."""
    revs = stage(reviews(spark, sf), "reviews")
    return union.landed({
        "play": landing.play_payloads(revs), "appstore": landing.appstore_payloads(revs), "community": landing.community_payloads(revs), "forum": landing.forum_payloads(revs),
        "launch": landing.launch_payloads(revs), "atom": landing.atom_payloads(revs), "rss": landing.rss_payloads(revs), "dataset": landing.dataset_payloads(revs),
        "job_nodes": landing.job_node_payloads(revs), "job_page": landing.job_search_pages(revs),
        "market": landing.market_pages(table(spark, sf, "pages")).withColumns({"product_name": F.concat(F.lit("Page "), "page_id"), "category": F.lit(None).cast("string"), "body": F.col("html")}),
    })


def _jobs_sql(frm: str, guid: str = "guid", posted: str = '"pubDate"', category: str = "category") -> str:
    return _review_sql(S.job("title || '. ' || description"), frm=frm, source="'upwork'", entity_id="query", entity_name="'Upwork - ' || query", reviewer_name="'client'",
                       comment_text="title || '. ' || description", source_item_id=guid, posted_at=posted, url="link", category=category)


cte("x_dataset_items", CHECKS["norm_dataset_json"].replace("SELECT category AS query", "SELECT category, category AS query"))
cte("x_first_nodes", "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY payload_id, guid ORDER BY pos) AS seen FROM x_job_items) WHERE seen = 1")
cte("x_page_items", f"""
  SELECT query, 'Upwork market signal: ' || query AS title, left(chunk, 2000) AS description, sha1('upwork-jina:' || query || ':' || pos || ':' || left(chunk, 220)) AS guid,
    'https://www.upwork.com/nx/search/jobs/?q=' || {_q('query')} || '&sort=recency' AS link FROM (
    SELECT category || '-' || (event_id // {landing.PAGE}) AS query, event_id // {landing.PAGE} AS page, comment_text || ' fixed-price, needs a long description. ' || event_id AS chunk,
      row_number() OVER (PARTITION BY category, event_id // {landing.PAGE} ORDER BY event_id) - 1 AS pos FROM x_reviews)
  WHERE page % 5 <> 4 AND length(chunk) >= 120 AND {S.job('chunk')}""")
_ALL = [CHECKS[n] for n in ("norm_play", "norm_appstore", "norm_reddit", "norm_forum_chunks", "norm_launch_chunks", "norm_atom", "norm_jobs", "norm_market_pages", "signal_rows")]
_ALL += [_jobs_sql("x_dataset_items", "CASE WHEN guid = '' THEN sha1(query || '|' || title || '|' || link) ELSE guid END"), _jobs_sql("x_first_nodes"), _jobs_sql("x_page_items", posted="''", category="'Operations'")]
cte("x_all_rows", " UNION ALL BY NAME ".join(f"SELECT * FROM ({sql})" for sql in _ALL))
_FP = S.fp("source", "source_item_id", "entity_id", "reviewer_name", "comment_text", "posted_at")


@query("reviews_union_all", f"""
SELECT source, source_item_id, entity_id, entity_name, category, reviewer_name, rating, posted_at, url, country, language, comment_text, {_FP} AS fingerprint
FROM (SELECT * REPLACE ({S.clean('comment_text')} AS comment_text, coalesce(nullif(trim(category), ''), 'Unknown') AS category) FROM x_all_rows)""")
def reviews_union_all(spark, sf):
    """Canonical rows of all twelve shapes from one landed table, and of demand signals."""
    queries = table(spark, sf, "part").select(F.concat_ws(" ", "p_name", "p_partkey").alias("query"), F.lit("Parts").alias("category"))
    seeds = seed_ops.market_seeds(table(spark, sf, "supplier"))
    there = seeds.where(F.col("s_suppkey") % 5 == 0).select("source", "url")
    signals = payloads.market_signals(seeds, there, "HTTP 503").unionByName(payloads.job_reviews(payloads.job_query_signals(queries)))
    rows = ingest.canonical(union.normalised(landed_payloads(spark, sf), signals), F.lit("2024-03-01 00:00:00").cast("timestamp_ntz"))
    return rows.select(*SHOWN, "fingerprint")
