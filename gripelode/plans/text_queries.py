"""Scalar functions over the whole given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from gripelode import lexicon as lx
from gripelode.functions import gates, keys, text
from gripelode.plans import sql as S
from gripelode.plans.registry import cte, query
from gripelode.sources import landing
from gripelode.sources.tables import pick, reviews, table


@query("fn_clean", f"SELECT doc_id, {S.clean('text')} AS cleaned FROM documents")
def fn_clean(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.clean(F.col("text")).alias("cleaned"))


@query("fn_strip_html", f"SELECT page_id, {S.strip_html('html')} AS body FROM pages")
def fn_strip_html(spark, sf):
    return table(spark, sf, "pages").select("page_id", text.strip_html(F.col("html")).alias("body"))


@query("fn_normalize", f"SELECT conv_id, turn, {S.norm('text')} AS body FROM conversations")
def fn_normalize(spark, sf):
    return table(spark, sf, "conversations").select("conv_id", "turn", text.normalize(F.col("text")).alias("body"))


@query("fn_tokens", f"""
SELECT doc_id, {S.big('len(t)')} AS n_tokens, array_to_string(t, ' ') AS tokens
FROM (SELECT doc_id, {S.tokens('text')} AS t FROM documents)""")
def fn_tokens(spark, sf):
    docs = table(spark, sf, "documents").withColumn("t", text.tokens(F.col("text")))
    return docs.select("doc_id", F.size("t").cast("long").alias("n_tokens"), F.array_join("t", " ").alias("tokens"))


@query("fn_content_terms", f"SELECT conv_id, turn, array_to_string({S.terms('text')}, ' ') AS terms FROM conversations")
def fn_content_terms(spark, sf):
    terms = text.content_terms(F.col("text"))
    return table(spark, sf, "conversations").select("conv_id", "turn", F.array_join(terms, " ").alias("terms"))


@query("fn_slug", """
SELECT doc_id, coalesce(nullif(left(trim(regexp_replace(lower(text), '[^a-z0-9]+', '-', 'g'), '-'), 120), ''), 'idea') AS slug FROM documents""")
def fn_slug(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.slug(F.col("text")).alias("slug"))


@query("fn_query_match", f"SELECT event_id, {S.big(S.match('comment_text', 'query'))} AS score FROM (SELECT *, source || ' export widget, team!' AS query FROM x_reviews)")
def fn_query_match(spark, sf):
    query_text = F.concat("source", F.lit(" export widget, team!"))
    return reviews(spark, sf).select("event_id", text.query_match(F.col("comment_text"), query_text).cast("long").alias("score"))


@query("fn_sentiment", f"""
SELECT 'review' AS kind, event_id AS id, {S.big(S.sentiment('lower(comment_text)'))} AS score FROM x_reviews
UNION ALL SELECT 'document', doc_id, {S.big(S.sentiment('lower(text)'))} FROM documents""")
def fn_sentiment(spark, sf):
    score = text.sentiment(F.lower("body")).cast("long").alias("score")
    revs = reviews(spark, sf).select(F.lit("review").alias("kind"), F.col("event_id").alias("id"), F.col("comment_text").alias("body"))
    docs = table(spark, sf, "documents").select(F.lit("document").alias("kind"), F.col("doc_id").alias("id"), F.col("text").alias("body"))
    return revs.unionByName(docs).select("kind", "id", score)


cte("x_budget_texts", """
  SELECT event_id, CASE event_id % 4 WHEN 0 THEN comment_text WHEN 1 THEN 'Hourly Range: $' || (event_id % 90) || '.50 - $' || (event_id % 90 + 10)
         WHEN 2 THEN 'BUDGET - $ 1,' || lpad(CAST(event_id % 1000 AS VARCHAR), 3, '0') || ' ' || comment_text ELSE 'no sum: ' || comment_text END AS body
  FROM x_reviews""")


@query("fn_budget", r"""
SELECT event_id, CASE WHEN lower(body) LIKE '%budget: $50%' THEN '50'
  WHEN body LIKE 'BUDGET%' THEN regexp_extract(body, '1,[0-9]{3}') WHEN body LIKE 'Hourly%' THEN substring(body, 16) END AS budget
FROM (SELECT event_id, CASE WHEN body LIKE 'BUDGET%' THEN left(body, 16) ELSE body END AS body FROM x_budget_texts)""")
def fn_budget(spark, sf):
    return landing.budget_texts(reviews(spark, sf)).select("event_id", text.budget(F.col("body")).alias("budget"))


@query("fn_chunks", rf"""
SELECT doc_id, pos - 1 AS pos, chunk FROM (
  SELECT doc_id, generate_subscripts(parts, 1) AS pos, unnest(parts) AS chunk FROM (
    SELECT doc_id, CASE WHEN len(b) > 1 THEN b ELSE
      list_filter(list_transform(string_split(regexp_replace(text, '([.!?]){S.WS}+', '\1' || chr(30), 'g'), chr(30)), lambda c: {S.clean('c')}), lambda c: c <> '') END AS parts
    FROM (SELECT doc_id, text, list_filter(list_transform(regexp_split_to_array(text, '\n{{2,}}'), lambda c: {S.clean('c')}), lambda c: c <> '') AS b FROM documents)))""")
def fn_chunks(spark, sf):
    parts = text.chunks(F.col("text"))
    return table(spark, sf, "documents").select("doc_id", F.posexplode(parts).alias("pos", "chunk")).withColumn("pos", F.col("pos").cast("long"))


cte("x_market_pages", """
  SELECT page_id, url, CASE page_id % 5 WHEN 4 THEN 'g2' WHEN 3 THEN 'capterra' ELSE 'other' END AS source,
    CASE page_id % 4
      WHEN 0 THEN replace(html, '</head>', '<meta name="description" content="I hate
 this vendor ' || page_id || '"><script>{"ratingValue": "' || (page_id % 5) || '.5"}</script></head>')
      WHEN 1 THEN replace(html, '</head>', '<meta content=''Best pricing ' || page_id || ''' name=''description''></head><i data-rating="' || (page_id % 5) || '"></i>')
      WHEN 2 THEN replace(html, '<body>', '<body>Rating: 1.2.' || page_id || ' ') ELSE html END AS html
  FROM pages""")
cte("x_page_ratings", """
  SELECT page_id, CASE page_id % 4 WHEN 0 THEN (page_id % 5) + 0.5e0 WHEN 1 THEN CAST(page_id % 5 AS DOUBLE) END AS rating FROM pages""")


@query("fn_page_rating", "SELECT page_id, rating FROM x_page_ratings")
def fn_page_rating(spark, sf):
    return landing.market_pages(table(spark, sf, "pages")).select("page_id", text.page_rating(F.col("html")).alias("rating"))


_LINES = rf"list_filter(list_transform(regexp_split_to_array(body, '\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{{85}}\x{{2028}}\x{{2029}}]'), lambda c: {S.clean('c')}), lambda c: c <> '')"
cte("x_bodies", """
  SELECT 'page' AS kind, page_id AS id, html AS body FROM x_market_pages
  UNION ALL SELECT 'document', doc_id, CASE WHEN doc_id % 3 = 0 THEN chr(10) || 'Title:  About ' || doc_id || chr(10) || 'URL Source: x' || chr(10) ELSE '' END || text FROM documents""")
cte("x_lined", rf"""
  SELECT kind, id, body, {_LINES} AS lines, regexp_extract(body, '(?is)<title[^>]*>(.*?)</title>', 1) AS title_text, regexp_matches(body, '(?is)<title[^>]*>.*?</title>') AS titled,
    list_filter({_LINES}, lambda l: NOT regexp_matches(lower(l), '^(title|url source|warning|markdown content):'))[:5] AS body_lines
  FROM x_bodies""")
cte("x_page_titles", f"""
  SELECT kind, id, CASE WHEN titled THEN {S.clean('title_text')} ELSE coalesce((
    SELECT CASE WHEN lower(l) LIKE 'title:%' THEN trim(substring(l, 7)) ELSE left(l, 180) END
    FROM (SELECT list_filter(lines, lambda c: lower(c) LIKE 'title:%' OR length(c) > 8)[1] AS l)), '') END AS title FROM x_lined""")
cte("x_page_descs", r"""
  SELECT kind, id, CASE WHEN kind = 'page' AND id % 4 = 0 THEN 'I hate this vendor ' || id WHEN kind = 'page' AND id % 4 = 1 THEN 'Best pricing ' || id
    ELSE left(array_to_string(body_lines, ' '), 1000) END AS description FROM x_lined""")


@query("fn_page_title", "SELECT * FROM x_page_titles")
def fn_page_title(spark, sf):
    return landing.page_bodies(spark, sf).select("kind", "id", text.page_title(F.col("body")).alias("title"))


@query("fn_page_desc", "SELECT * FROM x_page_descs")
def fn_page_desc(spark, sf):
    return landing.page_bodies(spark, sf).select("kind", "id", text.page_description(F.col("body")).alias("description"))


@query("fn_query_url", """
SELECT conv_id, turn, 'https://search.example/?q=' || replace(url_encode(text), '%20', '+') AS url FROM conversations""")
def fn_query_url(spark, sf):
    url = F.concat(F.lit("https://search.example/?q="), text.query_encode(F.col("text")))
    return table(spark, sf, "conversations").select("conv_id", "turn", url.alias("url"))


cte("x_tag_values", """
  SELECT 'customer' AS kind, c_custkey AS id, CASE c_custkey % 4 WHEN 0 THEN n_name WHEN 1 THEN 'r/' || lower(n_name) WHEN 2 THEN '/_' || lower(n_name) || ' sales_ops ;' ELSE c_mktsegment || ' city' END AS value
  FROM customer JOIN nation ON n_nationkey = c_nationkey
  UNION ALL SELECT 'part', p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'n/a' WHEN 1 THEN p_name || '/3d e-mail' WHEN 2 THEN lower(p_type) || ' don''t  work in the us' ELSE p_brand END FROM part""")


@query("fn_clean_tag", f"SELECT kind, id, {S.tag('value')} AS tag FROM x_tag_values")
def fn_clean_tag(spark, sf):
    return landing.tag_values(spark, sf).select("kind", "id", F.coalesce(text.clean_tag(F.col("value")), F.lit("")).alias("tag"))


@query("location_flag", f"SELECT kind, id, {S.location('value')} AS is_location FROM x_tag_values")
def location_flag(spark, sf):
    return landing.tag_values(spark, sf).select("kind", "id", text.looks_like_location(F.col("value")).alias("is_location"))


@query("fn_lenient_json", """
SELECT event_id, CASE WHEN event_id % 5 <> 2 AND event_id % 5 <> 3 THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k FROM events""")
def fn_lenient_json(spark, sf):
    payload = text.lenient_json(F.col("response"))
    return landing.json_texts(table(spark, sf, "events")).select("event_id", F.try_variant_get(payload, "$.k", "long").alias("k"))


@query("fn_genre", "SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 THEN 'Unknown' ELSE p_type END AS genre FROM part")
def fn_genre(spark, sf):
    raw = F.when(F.col("p_partkey") % 14 == 0, " \t").when(F.col("p_partkey") % 7 != 0, F.concat(F.lit("\n"), "p_type", F.lit(" ")))
    return table(spark, sf, "part").select("p_partkey", text.genre(raw).alias("genre"))


@query("fn_title", f"SELECT conv_id, turn, {S.title('text')} AS titled FROM conversations")
def fn_title(spark, sf):
    return table(spark, sf, "conversations").select("conv_id", "turn", text.title_case(F.col("text")).alias("titled"))


@query("fn_fingerprint", "SELECT event_id, fingerprint FROM x_reviews")
def fn_fingerprint(spark, sf):
    return reviews(spark, sf).select("event_id", "fingerprint")


@query("fn_ids", """
SELECT event_id, sha1(source || ':' || url)[:16] AS cluster_id, sha1(source || comment_text || 'batch-1')[:24] AS candidate_id,
  md5(entity_id || '-' || reviewer_name || '-' || posted_at) AS fallback_id FROM x_reviews""")
def fn_ids(spark, sf):
    return reviews(spark, sf).select(
        "event_id", keys.sha1_id(16, F.col("source"), F.lit(":"), F.col("url")).alias("cluster_id"),
        keys.sha1_id(24, F.col("source"), F.col("comment_text"), F.lit("batch-1")).alias("candidate_id"),
        F.md5(F.concat_ws("-", "entity_id", "reviewer_name", "posted_at")).alias("fallback_id"),
    )


@query("fn_parse_ts", f"""
SELECT event_id, {S.iso('''(CASE event_id % 7 WHEN 0 THEN ts WHEN 1 THEN ts WHEN 2 THEN date_trunc('second', ts) - INTERVAL 330 MINUTE WHEN 3 THEN date_trunc('day', ts)
  WHEN 4 THEN date_trunc('second', ts) + INTERVAL 7 HOUR WHEN 5 THEN date_trunc('second', ts) END)''')} AS posted_at FROM events""")
def fn_parse_ts(spark, sf):
    return landing.time_texts(table(spark, sf, "events")).select("event_id", keys.iso_utc(keys.parse_time(F.col("value"))).alias("posted_at"))


@query("fn_iso", f"SELECT event_id, {S.iso('ts')} AS a, {S.iso(chr(39).join(['date_trunc(', 'second', ', ts)']))} AS b FROM events")
def fn_iso(spark, sf):
    return table(spark, sf, "events").select("event_id", keys.iso_utc(F.col("ts")).alias("a"), keys.iso_utc(F.date_trunc("second", "ts").cast("timestamp_ntz")).alias("b"))


FLAG_TEXTS = ["1", "TRUE", " Yes ", "y", "On", "0", "no", "", "truely"]


@query("fn_bool", f"SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 9 THEN true ELSE o_orderkey % 10 < 5 END AS flag FROM orders")
def fn_bool(spark, sf):
    raw = F.when(F.col("o_orderkey") % 10 < 9, pick(FLAG_TEXTS, F.col("o_orderkey") % 10))
    return table(spark, sf, "orders").select("o_orderkey", text.truthy(raw, default=True).alias("flag"))


# --- gates ---------------------------------------------------------------------------------

GATE_COLUMNS = ["event_id", "source", "fingerprint"]


def _gate(name: str, condition_sql: str, condition) -> None:
    @query(name, f"SELECT event_id, source, fingerprint FROM (SELECT *, split_part(category, ' ', 1) || ' team widget' AS query FROM x_reviews) WHERE {condition_sql}")
    def run(spark, sf):
        return reviews(spark, sf).withColumn("query", F.concat(F.split_part("category", F.lit(" "), F.lit(1)), F.lit(" team widget"))).where(condition()).select(*GATE_COLUMNS)


_gate("gate_pain", S.pain("comment_text"), lambda: gates.pain(F.col("comment_text")))
_gate("gate_mobile", S.mobile("comment_text"), lambda: gates.mobile(F.col("rating"), F.col("comment_text")))
_gate("gate_reddit", S.community("comment_text"), lambda: gates.community(F.col("comment_text")))
_gate("gate_meta", f"coalesce(rating <= 2, false) OR {S.pain('comment_text')}", lambda: gates.market_strict(F.col("rating"), F.col("comment_text")))
_gate("gate_market", S.market("comment_text", "source"), lambda: gates.market(F.col("rating"), F.col("comment_text"), F.col("source")))
_gate("gate_jobs", S.job("comment_text"), lambda: gates.job(F.col("comment_text")))
_gate("gate_forum", S.forum("comment_text", "query"), lambda: gates.forum(F.col("comment_text"), F.col("query")))
_gate("gate_launch", S.launch("comment_text", "query"), lambda: gates.launch(F.col("comment_text"), F.col("query")))


@query("filter_blocked", """
SELECT page_id, page_id % 6 NOT IN (0, 1, 2) AS open_page, page_id % 6 NOT IN (0, 1, 2, 3) AS open_launch_page FROM pages""")
def filter_blocked(spark, sf):
    body = F.col("html")
    return landing.challenge_pages(table(spark, sf, "pages")).select(
        "page_id", (~gates.blocked(body)).alias("open_page"), (~gates.blocked(body, launch_page=True)).alias("open_launch_page")
    )
