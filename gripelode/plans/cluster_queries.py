"""Clustering, scoring and candidate queries over all reviews."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gripelode.config import DEFAULT, STRICT, Config
from gripelode.functions import text
from gripelode.operators import candidates as cand
from gripelode.operators import cluster
from gripelode.plans import sql as S
from gripelode.plans.registry import query
from gripelode.session import stage
from gripelode.sources.tables import reviews

BATCH = "batch-1"


def as_of():
    return F.lit("2024-03-01 00:00:00").cast("timestamp_ntz")


def clustered(spark: SparkSession, sf: str) -> DataFrame:
    return cluster.merge_small_clusters(cluster.key_reviews(reviews(spark, sf)), DEFAULT.min_cluster_size)


def described(spark: SparkSession, sf: str, cfg: Config = DEFAULT) -> DataFrame:
    return cand.describe_clusters(clustered(spark, sf), cfg)


def records(spark: SparkSession, sf: str, cfg: Config = DEFAULT, generated_at=None) -> DataFrame:
    return cand.build_records(described(spark, sf, cfg), cfg, BATCH, as_of() if generated_at is None else generated_at)


@query("clusterable_reviews", "SELECT fingerprint, array_to_string(terms, ' ') AS terms FROM x_keyed")
def clusterable_reviews(spark, sf):
    return cluster.clusterable(cluster.key_reviews(reviews(spark, sf))).select("fingerprint", F.array_join("terms", " ").alias("terms"))


@query("cluster_keys", "SELECT fingerprint, raw_key FROM x_keyed")
def cluster_keys(spark, sf):
    return cluster.clusterable(cluster.key_reviews(reviews(spark, sf))).select("fingerprint", "raw_key")


@query("cluster_counts", "SELECT raw_key, n FROM x_counts")
def cluster_counts(spark, sf):
    return cluster.cluster_counts(cluster.clusterable(cluster.key_reviews(reviews(spark, sf))))


@query("merged_clusters", "SELECT cluster_key, count(*) AS n, count(DISTINCT raw_key) AS raw_keys FROM x_clustered GROUP BY 1")
def merged_clusters(spark, sf):
    counts = stage(cluster.cluster_counts(cluster.key_reviews(reviews(spark, sf))), "cluster_counts")
    mapping = cluster.merge_map(counts, DEFAULT.min_cluster_size)
    kept = mapping.where(F.col("cluster_key").isNotNull())
    return kept.groupBy("cluster_key").agg(F.sum("n").alias("n"), F.count("*").alias("raw_keys"))


@query("clustered_reviews", "SELECT fingerprint, cluster_key FROM x_clustered")
def clustered_reviews(spark, sf):
    return clustered(spark, sf).select("fingerprint", "cluster_key")


@query("cluster_sources", "SELECT cluster_key, array_to_string(sources, ',') AS sources, source_count FROM x_stats")
def cluster_sources(spark, sf):
    totals = cluster.cluster_totals(clustered(spark, sf))
    return totals.select("cluster_key", F.array_join("sources", ",").alias("sources"), F.col("source_count").cast("long").alias("source_count"))


@query("cluster_rating", "SELECT cluster_key, avg_rating FROM x_stats")
def cluster_rating(spark, sf):
    return cluster.cluster_totals(clustered(spark, sf)).select("cluster_key", "avg_rating")


@query("cluster_cues", "SELECT cluster_key, n, cue_hits FROM x_stats")
def cluster_cues(spark, sf):
    return cluster.cluster_totals(clustered(spark, sf)).select("cluster_key", "n", "cue_hits")


@query("cluster_top_terms", "SELECT cluster_key, rank, term, hits FROM x_top_terms")
def cluster_top_terms(spark, sf):
    return cluster.top_terms(clustered(spark, sf)).withColumn("rank", F.col("rank").cast("long"))


@query("cluster_domain", "SELECT cluster_key, domain FROM x_domains")
def cluster_domain(spark, sf):
    return cluster.cluster_domain(clustered(spark, sf))


@query("support_score", "SELECT fingerprint, support_score FROM x_scored_rows")
def support_score(spark, sf):
    return clustered(spark, sf).select("fingerprint", cluster.support_score(F.col("comment_text"), F.col("rating")).alias("support_score"))


@query("support_rows", "SELECT cluster_key, support_rank, fingerprint, source_item_id, support_score, is_repeat FROM x_support")
def support_rows(spark, sf):
    rows = cluster.support_rows(clustered(spark, sf), DEFAULT.support_pool)
    return rows.select("cluster_key", F.col("support_rank").cast("long").alias("support_rank"), "fingerprint", "source_item_id", "support_score", "is_repeat")


@query("cluster_scores", """
SELECT cluster_key, willingness_signal, round(will, 2) AS willingness_score, round(base, 2) AS raw_opportunity_score,
  round(boosted, 2) AS boosted_opportunity_score, round(conf, 2) AS confidence_score, difficulty FROM x_described""")
def cluster_scores(spark, sf):
    done = cand.finish_scores(cand.score_clusters(cluster.cluster_totals(clustered(spark, sf))))
    return done.select("cluster_key", "willingness_signal", "willingness_score", "raw_opportunity_score", "boosted_opportunity_score", "confidence_score", "difficulty")


@query("cluster_labels", "SELECT cluster_key, impact_label, frequency_label, pricing_hint FROM x_described")
def cluster_labels(spark, sf):
    return cand.score_clusters(cluster.cluster_totals(clustered(spark, sf))).select("cluster_key", "impact_label", "frequency_label", "pricing_hint")


@query("quality_gate", """
SELECT cluster_key, CASE WHEN n < 2 THEN 'insufficient_evidence' WHEN source_count < 3 AND n < 6 THEN 'insufficient_sources'
  WHEN conf < 0.70e0 THEN 'low_confidence' ELSE 'accepted' END AS quality_reason FROM x_labeled""")
def quality_gate(spark, sf):
    done = cand.finish_scores(cand.score_clusters(cluster.cluster_totals(clustered(spark, sf))), STRICT)
    return done.select("cluster_key", "quality_reason")


@query("cluster_narratives", "SELECT cluster_id, pain_point, reasoning, suggested_solution, name, description FROM x_records")
def cluster_narratives(spark, sf):
    told = cand.product_texts(cand.narratives(described(spark, sf)))
    return told.select("cluster_id", "pain_point", "reasoning", "suggested_solution", "name", "description")


@query("fn_category_tags", "SELECT cluster_id, categories FROM x_records")
def fn_category_tags(spark, sf):
    return records(spark, sf).select("cluster_id", "categories")


@query("primary_source", """
SELECT cluster_id, s.source, left(s.posted_at, 10) AS source_date FROM x_described d JOIN x_support s USING (cluster_key) WHERE s.support_rank = 1""")
def primary_source(spark, sf):
    return cand.primary_source(described(spark, sf)).select("cluster_id", "source", "source_date")


def _json_pairs(*pairs: str) -> str:
    it = iter(pairs)
    return " || ',' || ".join(f"'\"{k}\":' || to_json({v})" for k, v in zip(it, it))


@query("evidence_payload", """
SELECT d.cluster_id, s.support_rank - 1 AS pos, left(s.comment_text, 700) AS quote, s.source, s.url, s.reviewer_name AS author, s.posted_at, 1e0 AS match_score
FROM x_described d JOIN x_support s USING (cluster_key) WHERE s.support_rank <= 6""")
def evidence_payload(spark, sf):
    """The stored JSON read back, one row per quote."""
    payload = F.to_json(cand.evidence_payload(F.col("support")))
    schema = "array<struct<quote:string,source:string,url:string,author:string,posted_at:string,match_score:double>>"
    rows = described(spark, sf).select("cluster_id", F.posexplode(F.from_json(payload, schema)).alias("pos", "e"))
    return rows.select("cluster_id", F.col("pos").cast("long").alias("pos"), "e.*")


@query("source_metadata", """
SELECT d.cluster_id, s.support_rank - 1 AS pos, s.source, s.entity_name, s.category AS seed_category, '' AS inferred_location, s.country, s.language, s.url
FROM x_described d JOIN x_support s USING (cluster_key) WHERE s.support_rank <= 6""")
def source_metadata(spark, sf):
    meta = cand.source_metadata(F.col("support"), F.col("inferred_location"))
    rows = described(spark, sf).select("cluster_id", F.posexplode(meta).alias("pos", "e"))
    return rows.select("cluster_id", F.col("pos").cast("long").alias("pos"), "e.*")


RECORD = """candidate_id, cluster_id, n AS evidence_count, array_to_string(sources, ',') AS sources, willingness_signal, round(will, 2) AS willingness_score,
  round(base, 2) AS raw_opportunity_score, round(boosted, 2) AS boosted_opportunity_score, impact_label, frequency_label, pricing_hint,
  round(conf, 2) AS confidence_score, round(conf * 100, 2) AS quality_score, difficulty"""


def slim_record(df: DataFrame) -> DataFrame:
    return df.select(
        "candidate_id", "cluster_id", F.col("n").alias("evidence_count"), F.array_join("sources", ",").alias("sources"), "willingness_signal",
        "willingness_score", "raw_opportunity_score", "boosted_opportunity_score", "impact_label", "frequency_label", "pricing_hint",
        "confidence_score", "quality_score", "difficulty",
    )


@query("accepted_candidates", f"SELECT {RECORD} FROM x_records")
def accepted_candidates(spark, sf):
    return slim_record(cand.accepted(records(spark, sf)))


@query("accepted_strict", f"SELECT {RECORD} FROM x_records WHERE NOT (source_count < 3 AND n < 6) AND conf >= 0.70e0")
def accepted_strict(spark, sf):
    return slim_record(cand.accepted(records(spark, sf, STRICT)))


@query("rejects", """
SELECT 'batch-1' AS batch_id, cluster_id, pain_point, CASE WHEN source_count < 3 AND n < 6 THEN 'insufficient_sources' ELSE 'low_confidence' END AS reason,
  round(conf * 100, 2) AS quality_score, least(n, 6) AS quotes FROM x_records WHERE (source_count < 3 AND n < 6) OR conf < 0.70e0""")
def rejects(spark, sf):
    rows = cand.reject_rows(records(spark, sf, STRICT))
    return rows.select("batch_id", "cluster_id", "pain_point", "reason", "quality_score", text.json_items(F.col("payload")).cast("long").alias("quotes"))


_VARIANT_TERM = "top_terms[least(v + 1, len(top_terms))]"


@query("candidate_variants", f"""
SELECT cluster_id, v AS variant, pain_point, reasoning, suggested_solution, name, description,
  CASE WHEN v = 0 THEN candidate_id ELSE sha1(cluster_id || pain_point || 'batch-1' || v)[:24] END AS candidate_id
FROM (SELECT cluster_id, v, candidate_id,
    CASE WHEN v = 0 THEN pain_point ELSE rtrim(pain_point, '.') || ' A recurring sub-problem is ' || {_VARIANT_TERM} || '.' END AS pain_point,
    CASE WHEN v = 0 THEN reasoning ELSE rtrim(reasoning, '.') || ' Additional evidence points to ' || {_VARIANT_TERM} || ' as a high-friction step.' END AS reasoning,
    CASE WHEN v = 0 THEN suggested_solution ELSE rtrim(suggested_solution, '.') || ' Include an explicit workflow for ' || {_VARIANT_TERM} || '.' END AS suggested_solution,
    CASE WHEN v = 0 THEN name ELSE trim(left(name || ' ' || {S.title(_VARIANT_TERM)}, 90)) END AS name,
    CASE WHEN v = 0 THEN description ELSE left(rtrim(description, '.') || ' This variant prioritizes improvements around ' || {_VARIANT_TERM} || '.', 360) END AS description
  FROM x_records, (SELECT unnest(range(3)) AS v) WHERE v = 0 OR n >= 4)""")
def candidate_variants(spark, sf):
    out = cand.expand_variants(cand.accepted(records(spark, sf)), 3)
    return out.select("cluster_id", F.col("variant").cast("long").alias("variant"), "pain_point", "reasoning", "suggested_solution", "name", "description", "candidate_id")


@query("batch_quality", """
SELECT 'batch-1' AS batch_id, CASE WHEN reason = 'accepted' THEN 'accepted' ELSE 'rejected' END AS quality_status, reason AS quality_reason, count(*) AS clusters
FROM (SELECT CASE WHEN source_count < 3 AND n < 6 THEN 'insufficient_sources' WHEN conf < 0.70e0 THEN 'low_confidence' ELSE 'accepted' END AS reason FROM x_labeled)
GROUP BY 3""")
def batch_quality(spark, sf):
    done = cand.finish_scores(cand.score_clusters(cluster.cluster_totals(clustered(spark, sf))), STRICT)
    return done.groupBy(F.lit(BATCH).alias("batch_id"), "quality_status", "quality_reason").agg(F.count("*").alias("clusters"))


@query("flagship", f"""
SELECT r.candidate_id, r.cluster_id, r.n AS evidence_count, round(r.boosted, 2) AS boosted_opportunity_score, s.support_rank, s.fingerprint, s.source
FROM (SELECT x_support.*, cluster_key AS ck FROM x_support) s JOIN x_records r ON r.cluster_key = s.ck WHERE s.support_rank <= 3""")
def flagship(spark, sf):
    """Accepted candidates with their three best pieces of evidence, best candidates first."""
    ranked = cand.accepted(records(spark, sf)).select(
        "candidate_id", "cluster_id", F.col("n").alias("evidence_count"), "boosted_opportunity_score", F.explode(F.slice("support", 1, 3)).alias("s")
    )
    return ranked.select(
        "candidate_id", "cluster_id", "evidence_count", "boosted_opportunity_score", F.col("s.rank").cast("long").alias("support_rank"), "s.fingerprint", "s.source"
    ).orderBy(F.col("boosted_opportunity_score").desc(), "candidate_id", "support_rank")
