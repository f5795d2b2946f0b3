"""Streams over the given events, worked off to the end and read back as tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gripelode import schema
from gripelode.functions import keys
from gripelode.plans import sql as S
from gripelode.plans.registry import query
from gripelode.session import shared_dir
from gripelode.sources import operations as ops
from gripelode.sources.tables import landed_copies, reviews, reviews_of, table
from gripelode.stores import Store
from gripelode.streaming import jobs


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.read_landed(spark, sf, table(spark, sf, "events").schema, "events.parquet")


def _reviews(spark: SparkSession, sf: str) -> DataFrame:
    return reviews_of(_events(spark, sf), table(spark, sf, "part"))


def _paths(spark: SparkSession, name: str) -> tuple[str, str]:
    base = f"{shared_dir(spark)}/gripelode/{uuid.uuid4().hex}/{name}"
    return f"{base}/table", f"{base}/checkpoint"


@query("stream_ingest", "SELECT fingerprint, ingest_seq, comment_text FROM x_copies WHERE copy = 1")
def stream_ingest(spark, sf):
    path, checkpoint = _paths(spark, "stream_ingest")
    stream = landed_copies(_reviews(spark, sf))
    stored = Store(spark, path, "fingerprint string, ingest_seq long, comment_text string", ["fingerprint"])
    jobs.ingest_stream(stream, stored, checkpoint, ["scraped_at", "ingest_seq"])
    return stored.read()


@query("stream_dedupe", "SELECT DISTINCT fingerprint, source FROM x_copies")
def stream_dedupe(spark, sf):
    path, checkpoint = _paths(spark, "stream_dedupe")
    stream = jobs.dedupe_stream(landed_copies(_reviews(spark, sf)), "posted_ts").select("fingerprint", "source")
    jobs.run(stream, checkpoint, lambda batch, batch_id: jobs.write_batch(batch, path, batch_id))
    return jobs.read_batches(spark, path, stream.schema).select("fingerprint", "source")


@query("stream_cursor", """
SELECT fingerprint, posted_at FROM x_reviews LEFT JOIN x_cursors ON cursor_key = 'play:' || entity_id || ':' || lower(country) WHERE since IS NULL OR posted_ts > since""")
def stream_cursor(spark, sf):
    path, checkpoint = _paths(spark, "stream_cursor")
    stream = _reviews(spark, sf)
    key = F.concat(F.lit("play:"), "entity_id", F.lit(":"), F.lower("country"))
    cursors = Store(spark, f"{path}-cursors", schema.SOURCE_CURSORS, ["cursor_key"], filtered=False)
    cursors.upsert(ops.cursors(reviews(spark, sf)))
    jobs.cursor_stream(stream, cursors, key, path, checkpoint)
    return jobs.read_batches(spark, path, stream.schema).select("fingerprint", "posted_at")


@query("stream_cursors", f"SELECT 'play:' || entity_id AS cursor_key, {S.iso('max(posted_ts)')} AS newest FROM x_reviews GROUP BY 1")
def stream_cursors(spark, sf):
    path, checkpoint = _paths(spark, "stream_cursors")
    stream = jobs.newest_per_key(_reviews(spark, sf), F.concat(F.lit("play:"), "entity_id"), "posted_ts")
    jobs.update_stream(stream, path, checkpoint)
    return jobs.latest_updates(spark, path, stream.schema, ["cursor_key"]).select("cursor_key", keys.iso_utc(F.col("newest")).alias("newest"))


@query("stream_rate", f"""
SELECT event_type, {S.iso('window_start')} AS window_start, count(*) AS events
FROM (SELECT event_type, date_trunc('second', ts) - to_seconds(CAST(k AS INTEGER)) AS window_start FROM events, (SELECT unnest(range(60)) AS k)) GROUP BY event_type, window_start""")
def stream_rate(spark, sf):
    path, checkpoint = _paths(spark, "stream_rate")
    stream = jobs.panes(_events(spark, sf), "event_type", "ts")
    jobs.update_stream(stream, path, checkpoint)
    rows = jobs.sliding_counts(jobs.latest_updates(spark, path, stream.schema, ["event_type", "second"]), "event_type")
    return rows.withColumn("window_start", keys.iso_utc(F.col("window_start")))


@query("stream_daily", "SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1")
def stream_daily(spark, sf):
    path, checkpoint = _paths(spark, "stream_daily")
    stream = jobs.daily_counts_stream(_events(spark, sf), "ts")
    jobs.update_stream(stream, path, checkpoint)
    return jobs.latest_updates(spark, path, stream.schema, ["day"])
