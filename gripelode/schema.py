"""Table schemas as DDL. Times are UTC ``timestamp_ntz``; nested values stay nested until a sink."""

from __future__ import annotations

REVIEWS = (
    "source string, source_item_id string, entity_id string, entity_name string, category string, "
    "reviewer_name string, rating double, comment_text string, posted_at string, url string, country string, "
    "language string, fingerprint string, scraped_at timestamp_ntz, raw_json string, enriched_at timestamp_ntz"
)
SEED_PROGRESS = (
    "seed_type string, seed_key string, enabled boolean, status string, total_seen bigint, total_inserted bigint, "
    "last_run_at timestamp_ntz, last_error string, exhausted boolean, updated_at timestamp_ntz"
)
RUN_LOG = ("run_at timestamp_ntz, mode string, stats_json string, total_records bigint")
SOURCE_CURSORS = ("cursor_key string, cursor_value string, updated_at timestamp_ntz")
CANDIDATES = (
    "candidate_id string, cluster_id string, pain_point string, reasoning string, evidence_count bigint, "
    "sources_present string, willingness_signal string, willingness_score double, raw_opportunity_score double, "
    "boosted_opportunity_score double, impact_label string, frequency_label string, suggested_solution string, "
    "pricing_hint string, confidence_score double, quality_score double, quality_status string, "
    "quality_reason string, evidence_quotes string, generated_at timestamp_ntz, batch_id string"
)
EVIDENCE_MAP = (
    "candidate_id string, review_fingerprint string, source string, source_item_id string, entity_id string, "
    "entity_name string, category string, reviewer_name string, posted_at string, url string, quote_text string, "
    "match_score double, link_method string, is_backfill boolean, linked_at timestamp_ntz, support_rank int"
)
PUBLISH_CARDS = (
    "candidate_id string, name string, description string, categories string, difficulty string, "
    "pain_point string, reasoning string, supporting_evidence string, source_metadata string, source string, "
    "source_date string, impact_label string, frequency_label string, opportunity_score double, "
    "suggested_solution string, pricing_hint string, confidence_score double, generated_at timestamp_ntz, "
    "batch_id string"
)
REJECTS = (
    "created_at timestamp_ntz, batch_id string, cluster_id string, pain_point string, reason string, "
    "quality_score double, payload string"
)
COST_LEDGER = ("ledger_date date, total_inr double, updated_at timestamp_ntz")
