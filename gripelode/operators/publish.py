"""Evidence links, publish cards, exports and the public snapshot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gripelode.config import DEFAULT
from gripelode.functions import text
from gripelode.operators.candidates import evidence_payload, source_metadata
from gripelode.operators.cluster import top_rows

LINK_KEY = ["candidate_id", "review_fingerprint"]
MAX_BROADCAST_IDS = 100_000


def upsert(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Old rows without a new version, plus the new rows."""
    return old.join(new.select(*key), key, "left_anti").unionByName(new)


def evidence_links(records: DataFrame, linked_at: Column, limit: int = DEFAULT.max_links) -> DataFrame:
    s = F.col("s")
    rows = records.select("candidate_id", F.posexplode(F.slice("support", 1, limit)).alias("pos", "s"))
    linked = rows.where(text.strip(text.text_of(s["fingerprint"])) != "")
    copied = [text.text_of(s[c]).alias(c) for c in ("source", "source_item_id", "entity_id", "entity_name", "category", "reviewer_name", "posted_at", "url")]
    return linked.select(
        "candidate_id", s["fingerprint"].alias("review_fingerprint"), *copied, F.substring(s["comment_text"], 1, 1200).alias("quote_text"),
        F.lit(1.0).alias("match_score"), F.lit("direct_cluster").alias("link_method"), F.lit(False).alias("is_backfill"),
        linked_at.alias("linked_at"), (F.col("pos") + 1).alias("support_rank"),
    )


def add_links(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Links that exist stay untouched; only new (candidate, review) pairs are added."""
    return existing.unionByName(new.join(existing.select(*LINK_KEY), LINK_KEY, "left_anti"))


def publish_cards(records: DataFrame) -> DataFrame:
    return records.select(
        "candidate_id", "name", "description", "categories", "difficulty", "pain_point", "reasoning",
        F.to_json(evidence_payload(F.col("support"))).alias("supporting_evidence"),
        F.to_json(source_metadata(F.col("support"), F.col("inferred_location"))).alias("source_metadata"), "source", "source_date",
        "impact_label", "frequency_label", F.col("boosted_opportunity_score").alias("opportunity_score"), "suggested_solution",
        "pricing_hint", "confidence_score", "generated_at", "batch_id",
    )


def newest_links(links: DataFrame, limit: int, min_links: int) -> DataFrame:
    """Newest ``limit`` links per candidate, for candidates with at least ``min_links``."""
    order = [F.col("linked_at").desc(), F.col("support_rank").desc(), F.col("review_fingerprint").asc()]
    top = top_rows(links, ["candidate_id"], order, limit, "link_rank")
    enough = top.groupBy("candidate_id").agg(F.count("*").alias("_n")).where(F.col("_n") >= min_links).select("candidate_id")
    return top.join(enough, "candidate_id", "left_semi")


def newest_candidates(candidates: DataFrame, limit: int | None = None) -> DataFrame:
    live = candidates.where(F.coalesce("quality_status", F.lit("accepted")) == "accepted")
    return live if limit is None else live.orderBy(F.col("generated_at").desc(), "candidate_id").limit(limit)


def rebuild_cards(candidates: DataFrame, links: DataFrame, as_of: Column, limit: int | None = None, max_links: int = 8, min_links: int = DEFAULT.min_supporting) -> DataFrame:
    """Coarse cards from stored candidates and links, for all candidates or the newest ``limit``."""
    chosen = newest_candidates(candidates, limit)
    ids = chosen.select("candidate_id")
    # Links are pruned before they are ranked; few ids are broadcast, others shuffled.
    relevant = links.join(F.broadcast(ids) if limit is not None and limit <= MAX_BROADCAST_IDS else ids, "candidate_id", "left_semi")
    e = F.struct(
        "link_rank", "source", text.text_of(F.col("url")).alias("url"), text.text_of(F.col("reviewer_name")).alias("author"),
        text.text_of(F.col("posted_at")).alias("posted_at"), F.substring("quote_text", 1, 700).alias("quote"), F.coalesce("match_score", F.lit(0.0)).alias("match_score"),
    )
    listed = newest_links(relevant, max_links, min_links).groupBy("candidate_id").agg(F.array_sort(F.collect_list(e)).alias("evidence"))
    first = F.get("evidence", F.lit(0))
    supporting = F.transform("evidence", lambda x: F.struct(x["quote"], x["source"], x["url"], x["author"], x["posted_at"], x["match_score"]))
    meta = F.transform("evidence", lambda x: F.struct(x["source"], x["url"], x["author"], x["posted_at"]))
    blank = F.lit("")
    texts = {c: F.coalesce(F.col(c), blank) for c in ("reasoning", "suggested_solution", "pain_point")}
    shown = F.coalesce(*[F.nullif(texts[c], blank) for c in ("reasoning", "suggested_solution", "pain_point")], blank)
    return chosen.join(listed, "candidate_id").select(
        "candidate_id",
        F.substring(F.concat(text.strip(F.substring_index(texts["pain_point"], " users ", 1)), F.lit(" Opportunity")), 1, 90).alias("name"),
        F.substring(shown, 1, 360).alias("description"),
        F.substring(F.concat_ws(", ", F.nullif(first["source"], blank), F.lit("Pain Intelligence")), 1, 120).alias("categories"),
        F.lit("Medium").alias("difficulty"), "pain_point", texts["reasoning"].alias("reasoning"), F.to_json(supporting).alias("supporting_evidence"),
        F.to_json(meta).alias("source_metadata"), first["source"].alias("source"), F.substring(first["posted_at"], 1, 10).alias("source_date"),
        *[F.lower(F.coalesce(F.col(c), F.lit("medium"))).alias(c) for c in ("impact_label", "frequency_label")],
        F.coalesce("boosted_opportunity_score", F.lit(0.0)).alias("opportunity_score"), texts["suggested_solution"].alias("suggested_solution"),
        F.coalesce("pricing_hint", blank).alias("pricing_hint"), F.coalesce("confidence_score", F.lit(0.0)).alias("confidence_score"),
        as_of.alias("generated_at"), F.coalesce("batch_id", blank).alias("batch_id"),
    )


def clean_cards(cards: DataFrame, min_links: int = DEFAULT.min_supporting) -> DataFrame:
    """Cards whose evidence JSON is an array of at least ``min_links`` items."""
    return cards.where(text.json_items(F.col("supporting_evidence")) >= min_links)


# --- exports ---------------------------------------------------------------------------------


def _day(column: str) -> Column:
    return F.to_date(column)


def best_export_day(candidates: DataFrame, preferred: list[str]) -> DataFrame:
    """The preferred day with the most candidates; the earlier preference wins ties."""
    days = candidates.sparkSession.createDataFrame(list(enumerate(preferred)), "preference int, day string").withColumn("day", F.to_date("day"))
    counts = candidates.where(_day("generated_at").isin([F.to_date(F.lit(d)) for d in preferred])).groupBy(_day("generated_at").alias("day")).agg(F.count("*").alias("n"))
    joined = days.join(counts, "day", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return joined.orderBy(F.col("n").desc(), "preference").limit(1).select("day", "n")


def export_ideas(candidates: DataFrame, day: Column) -> DataFrame:
    return candidates.where(_day("generated_at") == day)


def export_clusters(candidates: DataFrame, day: Column) -> DataFrame:
    return export_ideas(candidates, day).orderBy(F.coalesce("boosted_opportunity_score", F.lit(0.0)).desc(), "candidate_id")


def export_page_seed(candidates: DataFrame, day: Column) -> DataFrame:
    return export_ideas(candidates, day).where(F.col("quality_status") == "accepted").select(
        "candidate_id", text.slug(F.col("pain_point")).alias("slug"), F.col("pain_point").alias("title"),
        F.col("boosted_opportunity_score").alias("score"), "pricing_hint", F.col("suggested_solution").alias("solution"),
    )


def export_cards(cards: DataFrame, day: Column) -> DataFrame:
    return cards.where(_day("generated_at") == day).orderBy(F.col("opportunity_score").desc(), F.col("confidence_score").desc(), "candidate_id")


def write_exports(candidates: DataFrame, cards: DataFrame, day: str, path: str) -> None:
    """The four JSON exports of one day under ``path``/<name>/export_date=<day>."""
    d = F.to_date(F.lit(day))
    frames = {
        "ideas": export_ideas(candidates, d), "opportunity_clusters": export_clusters(candidates, d),
        "page_seed": export_page_seed(candidates, d), "publish_cards": export_cards(cards, d),
    }
    for name, frame in frames.items():
        frame.write.mode("overwrite").json(f"{path}/{name}/export_date={day}")


def write_snapshot(tables: dict[str, DataFrame], path: str, version: str) -> None:
    """Write all tables of a version, then name it live: readers never see a half-written one."""
    for name, df in tables.items():
        df.write.mode("errorifexists").parquet(f"{path}/versions/{version}/{name}")
    spark = next(iter(tables.values())).sparkSession
    row = spark.createDataFrame([(version,)], "version string").withColumn("published_at", F.current_timestamp())
    row.write.mode("append").json(f"{path}/manifest")


def read_snapshot(spark: SparkSession, path: str, name: str) -> DataFrame:
    manifest = spark.read.schema("version string, published_at timestamp").json(f"{path}/manifest")
    live = manifest.agg(F.max_by("version", "published_at")).first()[0]
    return spark.read.parquet(f"{path}/versions/{live}/{name}")


def snapshot_summary(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count and distinct candidates of every snapshot table."""
    parts = [df.agg(F.lit(name).alias("table_name"), F.count("*").alias("rows"), F.countDistinct("candidate_id").alias("candidates")) for name, df in tables.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
