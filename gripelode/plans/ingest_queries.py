"""Ingest, duplicate removal, cursors and batch selection over all landed reviews."""

from __future__ import annotations

from pyspark.sql import functions as F

from gripelode.config import DEFAULT
from gripelode.functions import keys
from gripelode.operators import ingest
from gripelode.plans.registry import cte, query
from gripelode.plans import sql as S
from gripelode.sources import operations as ops
from gripelode.sources.tables import landed_copies, reviews

STAMP = "2024-01-20 00:00:00"


def stamp():
    return F.lit(STAMP).cast("timestamp_ntz")


def _time(c: str):
    return keys.iso_utc(F.col(c)).alias(c)


@query("ingest_new_reviews", f"""
SELECT fingerprint, ingest_seq, {S.iso('scraped_at')} AS scraped_at, comment_text FROM x_copies WHERE enriched_at IS NULL AND copy = 1""")
def ingest_new_reviews(spark, sf):
    """Copies land while the reviews enriched so far are already stored."""
    revs = reviews(spark, sf)
    stored = revs.where(F.col("enriched_at").isNotNull())
    new = ingest.insert_if_new(landed_copies(revs), stored, ["scraped_at", "ingest_seq"])
    return new.select("fingerprint", "ingest_seq", _time("scraped_at"), "comment_text")


@query("dedupe_latest", f"""
SELECT fingerprint, source, rating, comment_text, ingest_seq, {S.iso('scraped_at')} AS scraped_at FROM (
  SELECT *, row_number() OVER (PARTITION BY fingerprint ORDER BY scraped_at DESC NULLS LAST, ingest_seq DESC) AS rn FROM x_copies) WHERE rn = 1""")
def dedupe_latest(spark, sf):
    kept = ingest.newest_per_fingerprint(landed_copies(reviews(spark, sf)))
    return kept.select("fingerprint", "source", "rating", "comment_text", "ingest_seq", _time("scraped_at"))


@query("duplicate_report", """
SELECT CAST(sum(n) AS BIGINT) AS total_before, count(*) AS total_after, CAST(sum(n) - count(*) AS BIGINT) AS purged, max(n) AS most_copies
FROM (SELECT count(*) AS n FROM x_copies GROUP BY fingerprint)""")
def duplicate_report(spark, sf):
    return ingest.duplicate_report(landed_copies(reviews(spark, sf)))


cte("x_cursors", f"""
  SELECT 'play:' || entity_id || ':' || lower(country) AS cursor_key, since, {S.iso('since')} AS cursor_value FROM (
    SELECT DISTINCT entity_id, country, TIMESTAMP '2024-01-12 00:00:00' + to_days(CAST(CAST(entity_id AS BIGINT) % 10 AS INTEGER)) AS since
    FROM x_reviews WHERE CAST(entity_id AS BIGINT) % 4 <> 0)""")


@query("cursor_filter", """
SELECT fingerprint, posted_at FROM x_reviews LEFT JOIN x_cursors ON cursor_key = 'play:' || entity_id || ':' || lower(country)
WHERE since IS NULL OR posted_ts > since""")
def cursor_filter(spark, sf):
    revs = reviews(spark, sf)
    key = F.concat(F.lit("play:"), "entity_id", F.lit(":"), F.lower("country"))
    return ingest.cursor_filter(revs, ops.cursors(revs), key).select("fingerprint", "posted_at")


cte("x_advance", f"""
  SELECT 'play:' || entity_id || ':' || CASE WHEN grouping(country) = 1 THEN 'max' ELSE lower(country) END AS cursor_key, max(posted_ts) AS newest, {S.iso('max(posted_ts)')} AS cursor_value
  FROM x_reviews GROUP BY GROUPING SETS ((entity_id, country), (entity_id))""")


@query("cursor_advance", "SELECT cursor_key, cursor_value FROM x_advance")
def cursor_advance(spark, sf):
    return ingest.cursor_advance(reviews(spark, sf), "play", "entity_id", "country")


@query("cursor_upsert", f"""
SELECT cursor_key, CASE WHEN since IS NULL OR newest > since THEN n.cursor_value ELSE c.cursor_value END AS cursor_value,
  CASE WHEN since IS NULL OR newest > since THEN {S.iso(f"TIMESTAMP '{STAMP}'")} ELSE {S.iso('since')} END AS updated_at
FROM x_cursors c FULL JOIN x_advance n USING (cursor_key)""")
def cursor_upsert(spark, sf):
    revs = reviews(spark, sf)
    merged = ingest.cursor_upsert(ops.cursors(revs), ingest.cursor_advance(revs, "play", "entity_id", "country"), stamp())
    return merged.select("cursor_key", "cursor_value", _time("updated_at"))


@query("pending_reviews", "SELECT fingerprint, source FROM x_reviews WHERE enriched_at IS NULL AND trim(comment_text) <> ''")
def pending_reviews(spark, sf):
    return ingest.pending(reviews(spark, sf)).select("fingerprint", "source")


_COOLED = f"enriched_at <= TIMESTAMP '{STAMP}' - INTERVAL 24 HOUR AND trim(comment_text) <> ''"


@query("reprocess_pool", f"SELECT fingerprint, {S.iso('enriched_at')} AS enriched_at FROM x_reviews WHERE {_COOLED}")
def reprocess_pool(spark, sf):
    return ingest.reprocessable(reviews(spark, sf), stamp(), DEFAULT.cooldown_hours).select("fingerprint", _time("enriched_at"))


cte("x_again", f"SELECT fingerprint, enriched_at FROM x_reviews WHERE {_COOLED} ORDER BY enriched_at, scraped_at DESC, fingerprint LIMIT {DEFAULT.batch_size}")


@query("reprocess_topk", f"SELECT fingerprint, {S.iso('enriched_at')} AS enriched_at FROM x_again")
def reprocess_topk(spark, sf):
    return ingest.reprocess_top(reviews(spark, sf), stamp(), DEFAULT.cooldown_hours, DEFAULT.batch_size).select("fingerprint", _time("enriched_at"))


@query("enrich_batch", """
SELECT fingerprint, false AS reprocess FROM x_reviews WHERE enriched_at IS NULL AND trim(comment_text) <> ''
UNION ALL SELECT fingerprint, true FROM x_again""")
def enrich_batch(spark, sf):
    return ingest.enrich_batch(reviews(spark, sf), stamp(), DEFAULT.cooldown_hours, DEFAULT.batch_size).select("fingerprint", "reprocess")


@query("mark_enriched", f"SELECT fingerprint, {S.iso(f'coalesce(enriched_at, TIMESTAMP {S.q(STAMP)})')} AS enriched_at FROM x_reviews")
def mark_enriched(spark, sf):
    revs = reviews(spark, sf)
    return ingest.mark_enriched(revs, ingest.pending(revs), stamp()).select("fingerprint", _time("enriched_at"))


@query("cap_per_seed", """
SELECT source, entity_id, seed_rank, fingerprint FROM (
  SELECT *, row_number() OVER (PARTITION BY source, entity_id ORDER BY posted_ts DESC, fingerprint) AS seed_rank FROM x_reviews) WHERE seed_rank <= 5""")
def cap_per_seed(spark, sf):
    capped = ingest.cap_per_seed(reviews(spark, sf), ["source", "entity_id"], [F.col("posted_ts").desc(), F.col("fingerprint")], 5)
    return capped.select("source", "entity_id", F.col("seed_rank").cast("long").alias("seed_rank"), "fingerprint")
