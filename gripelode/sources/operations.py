"""Operational tables (seeds, progress, runs, cursors, ledger, logs) derived from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gripelode.functions import keys
from gripelode.operators import seeds
from gripelode.sources.tables import pick, reviews, table

SEED_TYPES = ["apps", "reddit", "hackernews", "producthunt", "g2", "capterra", "upwork"]
ERRORS = ["HTTP 403", "captcha page", "App not found (404)", "timeout", "Cloudflare", "feed not reachable", "", "package missing"]


def app_rows(spark: SparkSession, sf: str) -> DataFrame:
    p = F.col("p_partkey")
    return table(spark, sf, "part").select(
        p.alias("pos"), F.concat("p_name", F.lit(" "), p % 50).alias("app_name"), F.when(p % 3 == 0, "").otherwise(F.concat(F.lit("app."), p)).alias("play_id"),
        F.when(p % 4 == 0, (p + 100000).cast("string")).otherwise("").alias("apple_id"), F.when(p % 7 == 0, " ").otherwise(F.col("p_type")).alias("category"),
        pick(["1", "0", "Yes"], p % 3).alias("enabled"),
    )


def community_rows(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col("c_custkey")
    return table(spark, sf, "customer").select(
        c.alias("pos"), F.concat(F.when(c % 2 == 0, "/r/").otherwise("R/"), "c_mktsegment", F.lit("_"), c, F.lit("/")).alias("subreddit"),
        F.when(c % 3 != 0, pick(["1", "0"], c % 2)).alias("enabled"), F.when(c % 5 == 0, "hate|wish").alias("keywords"),
    )


def query_rows(spark: SparkSession, sf: str) -> DataFrame:
    p = F.col("p_partkey")
    return table(spark, sf, "part").select(
        p.alias("pos"), F.when(p % 9 == 0, " ").otherwise(F.concat("p_name", F.lit("  "), F.lower("p_brand"))).alias("query"),
        F.when(p % 4 != 0, pick(["on", "0"], p % 2)).alias("enabled"), F.when(p % 5 == 0, "").otherwise(F.col("p_type")).alias("category"),
    )


def all_seeds(spark: SparkSession, sf: str) -> DataFrame:
    queries = query_rows(spark, sf)
    market = seeds.market_seeds(table(spark, sf, "supplier")).withColumn("enabled", F.col("enabled").cast("string"))
    return seeds.union_all([
        seeds.app_seeds(app_rows(spark, sf)), seeds.community_seeds(community_rows(spark, sf)), seeds.marketplace_seeds(market),
        *[seeds.query_seeds(queries, t) for t in ("hackernews", "producthunt", "upwork")],
    ])


def progress(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col("c_custkey")
    at = F.timestamp_add("MINUTE", c % 1000, F.lit("1997-01-01 00:00:00").cast("timestamp_ntz"))
    return table(spark, sf, "customer").select(
        pick(SEED_TYPES, c % 7).alias("seed_type"), F.concat(F.lit("k"), c).alias("seed_key"), (F.col("c_acctbal") > 0).alias("enabled"),
        pick(["done", "error", "running", "pending", "error"], c % 5).alias("status"), F.when(c % 6 != 0, c % 100).alias("total_seen"),
        (c % 10).alias("total_inserted"), F.when(c % 5 != 3, at).alias("last_run_at"), F.when(c % 5 != 0, pick(ERRORS, c % 8)).alias("last_error"),
        (c % 4 == 0).alias("exhausted"), at.alias("updated_at"),
    )


def runs(spark: SparkSession, sf: str) -> DataFrame:
    o = F.col("o_orderkey")
    return table(spark, sf, "orders").select(
        pick(SEED_TYPES, F.col("o_custkey") % 7).alias("seed_type"), F.concat(F.lit("k"), "o_custkey").alias("seed_key"), F.col("o_orderdate").alias("run_at"),
        o.alias("run_seq"), F.when(F.col("o_orderstatus") == "F", "done").when(F.col("o_orderstatus") == "O", "error").otherwise("running").alias("status"),
        F.floor(F.col("o_totalprice") / 1000).alias("seen"), (o % 4).alias("inserted"), pick(ERRORS, o % 8).alias("error"), F.col("o_orderpriority").startswith("1").alias("exhausted"),
    )


def cursors(revs: DataFrame) -> DataFrame:
    """Half-month old cursors for three quarters of the entities."""
    e = F.col("entity_id").cast("long")
    at = F.timestamp_add("DAY", e % 10, F.lit("2024-01-12 00:00:00").cast("timestamp_ntz"))
    known = revs.select("entity_id", "country").distinct().where(e % 4 != 0)
    return known.select(
        F.concat(F.lit("play:"), "entity_id", F.lit(":"), F.lower("country")).alias("cursor_key"), keys.iso_utc(at).alias("cursor_value"), at.alias("updated_at")
    )


def ledger(spark: SparkSession, sf: str) -> DataFrame:
    cents = F.sum(F.round(F.col("o_totalprice") * 100).cast("long"))
    return table(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("ledger_date")).agg((cents / 100).alias("total_inr"))


def run_log(spark: SparkSession, sf: str) -> DataFrame:
    """One run per hour of events."""
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("run_at")
    hourly = table(spark, sf, "events").groupBy(hour).agg(
        F.count("*").alias("seen"), F.count_if(F.col("event_type") == "purchase").alias("inserted"), F.count_if(F.col("event_type") == "error").alias("errors")
    )
    return hourly.select(
        "run_at", F.when(F.hour("run_at") < 6, "fast_backfill").otherwise("incremental").alias("mode"),
        F.to_json(F.struct("seen", "inserted", "errors")).alias("stats_json"), F.col("seen").alias("total_records"),
    )


def cycle_results(revs: DataFrame) -> DataFrame:
    """Result of one scrape task per source and entity."""
    counted = revs.groupBy("source", "entity_id").agg(F.count("*").alias("seen"), F.count_if(F.col("copy") == 1).alias("inserted"))
    return counted.withColumn("errors", F.when(F.col("entity_id").cast("long") % 7 == 0, 1).otherwise(0).cast("long"))


def search_results(spark: SparkSession, sf: str) -> DataFrame:
    """Three store search results for every app name."""
    p, name = F.col("p_partkey"), F.concat_ws(" ", "p_name", "p_partkey")
    found = F.array(
        F.concat(F.lit("other "), p), F.when(p % 3 == 0, F.concat(F.upper(name), F.lit(" pro"))).otherwise(F.concat(F.lit("another "), p)),
        F.when(p % 3 == 1, F.concat(F.lit("my "), F.col("p_name"))).when(p % 3 == 2, F.col("p_name")).otherwise(name),
    )
    return table(spark, sf, "part").select(name.alias("query_name"), F.posexplode(found).alias("pos", "track_name"), p.alias("p")).select(
        "query_name", "pos", "track_name", F.concat_ws("-", F.col("p"), F.col("pos")).alias("track_id")
    )


__all__ = ["all_seeds", "app_rows", "community_rows", "cursors", "cycle_results", "ledger", "progress", "query_rows", "reviews", "run_log", "runs", "search_results"]
