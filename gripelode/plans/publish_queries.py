"""Publishing, exports, model hand-off and observation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from gripelode.config import DEFAULT
from gripelode.functions import keys, text
from gripelode.operators import candidates as cand
from gripelode.operators import observe, publish
from gripelode.plans import sql as S
from gripelode.plans.cluster_queries import as_of, described, records
from gripelode.plans.registry import cte, query
from gripelode.session import stage
from gripelode.sources import operations as ops
from gripelode.sources.tables import landed_copies, reviews, table

DAYS = ["2024-01-29", "2024-01-30"]


def dated_records(spark, sf):
    """Records generated when their newest review was scraped, so that they spread over days."""
    return records(spark, sf, generated_at=F.col("last_scraped_at"))


LINK = ["candidate_id", "review_fingerprint", "source", "source_item_id", "entity_id", "entity_name", "category", "reviewer_name", "posted_at", "url", "quote_text", "link_method"]
cte("x_links", """
  SELECT r.candidate_id, s.fingerprint AS review_fingerprint, s.source, s.source_item_id, s.entity_id, s.entity_name, s.category, s.reviewer_name, s.posted_at, s.url,
    left(s.comment_text, 1200) AS quote_text, s.support_rank, left(s.comment_text, 700) AS quote
  FROM x_records r JOIN x_support s USING (cluster_key) WHERE s.support_rank <= 6""")


@query("evidence_links", f"SELECT {', '.join(LINK[:-1])}, CASE WHEN support_rank <= 2 THEN 'earlier' ELSE 'direct_cluster' END AS link_method FROM x_links")
def evidence_links(spark, sf):
    """Links of this run added to a table that already holds the first two of every candidate."""
    links = stage(publish.evidence_links(cand.accepted(records(spark, sf)), as_of()), "links")
    stored = links.where(F.col("support_rank") <= 2).withColumn("link_method", F.lit("earlier"))
    return publish.add_links(stored, links).select(*LINK)


@query("evidence_topn", "SELECT candidate_id, link_rank, review_fingerprint FROM (SELECT *, row_number() OVER (PARTITION BY candidate_id ORDER BY support_rank DESC) AS link_rank, count(*) OVER (PARTITION BY candidate_id) AS n FROM x_links) WHERE least(n, 4) >= 4 AND link_rank <= 4")
def evidence_topn(spark, sf):
    links = publish.evidence_links(cand.accepted(records(spark, sf)), as_of())
    top = publish.newest_links(links, 4, 4)
    return top.select("candidate_id", F.col("link_rank").cast("long").alias("link_rank"), "review_fingerprint")


@query("candidate_upsert", "SELECT candidate_id, evidence_count, CASE WHEN impact_label = 'high' THEN 'batch-1' ELSE 'batch-0' END AS batch_id FROM (SELECT *, n AS evidence_count FROM x_records)")
def candidate_upsert(spark, sf):
    rows = stage(cand.candidate_rows(cand.accepted(records(spark, sf))), "candidates")
    old, new = rows.withColumn("batch_id", F.lit("batch-0")), rows.where(F.col("impact_label") == "high")
    return publish.upsert(old, new, ["candidate_id"]).select("candidate_id", "evidence_count", "batch_id")


@query("card_upsert", "SELECT candidate_id, CASE WHEN difficulty = 'Hard' THEN 'batch-1' ELSE 'batch-0' END AS batch_id, round(boosted, 2) AS opportunity_score FROM x_records")
def card_upsert(spark, sf):
    cards = stage(publish.publish_cards(cand.accepted(records(spark, sf))), "cards")
    old, new = cards.withColumn("batch_id", F.lit("batch-0")), cards.where(F.col("difficulty") == "Hard")
    return publish.upsert(old, new, ["candidate_id"]).select("candidate_id", "batch_id", "opportunity_score")


@query("publish_cards", """
SELECT r.candidate_id, name, description, categories, difficulty, pain_point, s.source, left(s.posted_at, 10) AS source_date, impact_label, frequency_label,
  round(boosted, 2) AS opportunity_score, pricing_hint, round(conf, 2) AS confidence_score, least(n, 6) AS quotes
FROM x_records r JOIN x_support s USING (cluster_key) WHERE s.support_rank = 1""")
def publish_cards(spark, sf):
    cards = publish.publish_cards(cand.accepted(records(spark, sf)))
    return cards.select(
        "candidate_id", "name", "description", "categories", "difficulty", "pain_point", "source", "source_date", "impact_label", "frequency_label",
        "opportunity_score", "pricing_hint", "confidence_score", text.json_items(F.col("supporting_evidence")).cast("long").alias("quotes"),
    )


cte("x_rebuilt", """
  SELECT c.candidate_id, left(split_part(pain_point, ' users ', 1) || ' Opportunity', 90) AS name, left(reasoning, 360) AS description, l.source || ', Pain Intelligence' AS categories,
    'Medium' AS difficulty, l.source, left(l.posted_at, 10) AS source_date, impact_label, round(boosted, 2) AS opportunity_score, least(n, 6) AS quotes
  FROM (SELECT * FROM x_records ORDER BY last_scraped_at DESC, candidate_id LIMIT 500) c
  JOIN (SELECT *, row_number() OVER (PARTITION BY candidate_id ORDER BY support_rank DESC) AS link_rank FROM x_links) l USING (candidate_id) WHERE link_rank = 1""")


@query("rebuild_cards", "SELECT * FROM x_rebuilt")
def rebuild_cards(spark, sf):
    recs = stage(cand.accepted(dated_records(spark, sf)), "records")
    cards = publish.rebuild_cards(cand.candidate_rows(recs), publish.evidence_links(recs, as_of()), as_of(), 500)
    return cards.select(
        "candidate_id", "name", "description", "categories", "difficulty", "source", "source_date", "impact_label", "opportunity_score",
        text.json_items(F.col("supporting_evidence")).cast("long").alias("quotes"),
    )


@query("cards_cleanup", "SELECT candidate_id, least(n, 6) AS quotes FROM x_records WHERE impact_label <> 'low' AND n >= 4")
def cards_cleanup(spark, sf):
    """Cards need four quotes here; low-impact cards carry broken JSON."""
    cards = publish.publish_cards(cand.accepted(records(spark, sf)))
    broken = cards.withColumn("supporting_evidence", F.when(F.col("impact_label") == "low", "{bad").otherwise(F.col("supporting_evidence")))
    kept = publish.clean_cards(broken, 4)
    return kept.select("candidate_id", text.json_items(F.col("supporting_evidence")).cast("long").alias("quotes"))


@query("best_export_day", f"""
SELECT day, n FROM (SELECT d.day, d.p, count(r.cluster_key) AS n FROM (SELECT unnest([DATE '{DAYS[0]}', DATE '{DAYS[1]}']) AS day, unnest([0, 1]) AS p) d
  LEFT JOIN x_records r ON CAST(r.last_scraped_at AS DATE) = d.day GROUP BY 1, 2) ORDER BY n DESC, p LIMIT 1""")
def best_export_day(spark, sf):
    return publish.best_export_day(cand.candidate_rows(cand.accepted(dated_records(spark, sf))), DAYS)


def _day():
    return F.to_date(F.lit(DAYS[1]))


_ON_DAY = f"CAST(last_scraped_at AS DATE) = DATE '{DAYS[1]}'"


@query("export_ideas", f"SELECT candidate_id, cluster_id, n AS evidence_count, round(boosted, 2) AS boosted_opportunity_score FROM x_records WHERE {_ON_DAY}")
def export_ideas(spark, sf):
    return publish.export_ideas(cand.candidate_rows(cand.accepted(dated_records(spark, sf))), _day()).select("candidate_id", "cluster_id", "evidence_count", "boosted_opportunity_score")


@query("export_clusters", f"SELECT candidate_id, round(boosted, 2) AS boosted_opportunity_score FROM x_records WHERE {_ON_DAY}")
def export_clusters(spark, sf):
    return publish.export_clusters(cand.candidate_rows(cand.accepted(dated_records(spark, sf))), _day()).select("candidate_id", "boosted_opportunity_score")


@query("export_page_seed", f"""
SELECT candidate_id, left(trim(regexp_replace(lower(pain_point), '[^a-z0-9]+', '-', 'g'), '-'), 120) AS slug, pain_point AS title, round(boosted, 2) AS score, pricing_hint, suggested_solution AS solution
FROM x_records WHERE {_ON_DAY}""")
def export_page_seed(spark, sf):
    return publish.export_page_seed(cand.candidate_rows(cand.accepted(dated_records(spark, sf))), _day())


@query("export_cards", f"SELECT candidate_id, name, round(boosted, 2) AS opportunity_score, round(conf, 2) AS confidence_score FROM x_records WHERE {_ON_DAY}")
def export_cards(spark, sf):
    return publish.export_cards(publish.publish_cards(cand.accepted(dated_records(spark, sf))), _day()).select("candidate_id", "name", "opportunity_score", "confidence_score")


@query("public_snapshot", """
SELECT 'idea_candidates' AS table_name, count(*) AS rows, count(DISTINCT candidate_id) AS candidates FROM x_records
UNION ALL SELECT 'idea_publish_cards', count(*), count(DISTINCT candidate_id) FROM x_records
UNION ALL SELECT 'idea_evidence_map', count(*), count(DISTINCT candidate_id) FROM x_links""")
def public_snapshot(spark, sf):
    recs = stage(cand.accepted(records(spark, sf)), "records")
    return publish.snapshot_summary({
        "idea_candidates": cand.candidate_rows(recs), "idea_publish_cards": publish.publish_cards(recs), "idea_evidence_map": publish.evidence_links(recs, as_of()),
    })


@query("daily_counts", "SELECT CAST(last_scraped_at AS DATE) AS day, count(*) AS n FROM x_records GROUP BY 1")
def daily_counts(spark, sf):
    return observe.daily_counts(cand.accepted(dated_records(spark, sf)))


# --- model hand-off ----------------------------------------------------------------------------


@query("enrichment_requests", """
SELECT cluster_id, least(n, 14) AS evidence_rows, n AS evidence_count, round(avg_rating, 3) AS avg_rating, array_to_string(top_terms, ',') AS top_terms, s.comment AS first_comment
FROM x_described JOIN (SELECT cluster_key, left(comment_text, 420) AS comment FROM x_support WHERE support_rank = 1) s USING (cluster_key)""")
def enrichment_requests(spark, sf):
    """The request JSON read back."""
    schema = "struct<evidence_count:bigint,avg_rating:double,top_terms:array<string>,evidence:array<struct<id:int,comment:string>>>"
    r = F.from_json("request", schema)
    return cand.enrichment_requests(described(spark, sf)).select(
        "cluster_id", F.col("evidence_rows").cast("long").alias("evidence_rows"), r["evidence_count"].alias("evidence_count"), r["avg_rating"].alias("avg_rating"),
        F.array_join(r["top_terms"], ",").alias("top_terms"), r["evidence"][0]["comment"].alias("first_comment"),
    )


def responses(desc):
    """A response per cluster, by its size: clean, fenced with a text tag list, array, garbage, or none."""
    n = F.col("n")
    clean = F.concat(F.lit('{"domain_category": "ops_desk", "impact_label": "Very HIGH", "frequency_label": "?", "willingness_signal": "low", "confidence_score": 2, '
                           '"pricing_hint": "", "pain_point": " Sync breaks ", "category_tags": ["Ops Desk", "india", "'), F.get("top_terms", F.lit(0)),
                     F.lit('"], "location_hint": " New   Delhi ", "supporting_comment_ids": ["1", 1, 99, -1, "x"], "name": "Sync  Doctor"}'))
    fenced = F.concat(F.lit('```json\n{"confidence_score": "bad", "category_tags": "alpha, beta ,,gamma", "supporting_comment_ids": [2, 0, 1], "willingness_signal": "high"}\n```'))
    answer = F.when(n % 5 == 0, clean).when(n % 5 == 1, fenced).when(n % 5 == 2, "[1, 2]").when(n % 5 == 3, "{oops")
    return desc.where(n % 5 < 4).select("cluster_id", answer.alias("response"))


cte("x_answered", """
  SELECT *, CASE WHEN n % 5 = 0 THEN 'Ops Desk' ELSE domain END AS dom2, CASE WHEN n % 5 = 0 THEN 'low' WHEN n % 5 = 1 THEN 'high' ELSE willingness_signal END AS will2,
    CASE WHEN n % 5 = 0 THEN least(0.98e0, greatest(0.35e0, conf * 0.6e0 + 0.98e0 * 0.4e0)) WHEN n % 5 = 1 THEN least(0.98e0, greatest(0.35e0, conf * 0.6e0 + conf * 0.4e0)) ELSE conf END AS conf2,
    CASE WHEN n % 5 = 0 THEN 'high' ELSE impact_label END AS impact2 FROM x_records""")
cte("x_answered_scores", """
  SELECT *, greatest(hw, CASE will2 WHEN 'low' THEN 30e0 WHEN 'medium' THEN 55e0 ELSE 78e0 END) AS w2 FROM x_answered""")


@query("apply_enrichment", """
SELECT cluster_id, dom2 AS domain, will2 AS willingness_signal, impact2 AS impact_label, frequency_label, pricing_hint, round(conf2, 2) AS confidence_score, round(w2, 2) AS willingness_score,
  round(least(100e0, 30e0 + least(45e0, n * 4e0) + least(18e0, source_count * 5.5e0) + w2 * 0.12e0 + conf2 * 12e0), 2) AS raw_opportunity_score,
  CASE WHEN n % 5 = 0 THEN 'Sync breaks' ELSE pain_point END AS pain_point, CASE WHEN n % 5 = 0 THEN 'Sync Doctor' ELSE name END AS name,
  CASE WHEN n % 5 = 0 THEN 'New Delhi' ELSE '' END AS inferred_location FROM x_answered_scores""")
def apply_enrichment(spark, sf):
    desc = stage(described(spark, sf), "described")
    out = cand.build_records(desc, DEFAULT, "batch-1", as_of(), responses(desc))
    return out.select(
        "cluster_id", "domain", "willingness_signal", "impact_label", "frequency_label", "pricing_hint", "confidence_score", "willingness_score", "raw_opportunity_score",
        "pain_point", "name", "inferred_location",
    )


@query("remap_support", """
SELECT d.cluster_id, pos, s.fingerprint FROM (
  SELECT cluster_key, cluster_id, unnest(ranks) AS rank, generate_subscripts(ranks, 1) AS pos FROM (
    SELECT cluster_key, cluster_id, list_filter(CASE WHEN n % 5 = 0 THEN [2, 1, 3, 4, 5, 6] WHEN n % 5 = 1 THEN [3, 1, 2] ELSE [1, 2, 3, 4, 5, 6] END, lambda r: r <= n) AS ranks FROM x_described)) d
JOIN x_support s ON s.cluster_key = d.cluster_key AND s.support_rank = d.rank""")
def remap_support(spark, sf):
    desc = stage(described(spark, sf), "described")
    out = cand.apply_responses(cand.narratives(desc), responses(desc))
    return out.select("cluster_id", F.posexplode("support").alias("p", "s")).select("cluster_id", (F.col("p") + 1).cast("long").alias("pos"), "s.fingerprint")


# --- observation -------------------------------------------------------------------------------


cte("x_tasks", """
  SELECT source, entity_id, count(*) AS seen, count(*) FILTER (copy = 1) AS inserted, CASE WHEN CAST(entity_id AS BIGINT) % 7 = 0 THEN 1 ELSE 0 END AS errors FROM x_copies GROUP BY 1, 2""")


@query("cycle_stats", """
SELECT source, grouping(source) AS is_total, CAST(sum(seen) AS BIGINT) AS seen, CAST(sum(inserted) AS BIGINT) AS inserted, CAST(sum(errors) AS BIGINT) AS errors
FROM x_tasks GROUP BY ROLLUP (source)""".replace("grouping(source)", "CAST(grouping(source) AS INTEGER)"))
def cycle_stats(spark, sf):
    return observe.cycle_stats(ops.cycle_results(landed_copies(reviews(spark, sf))))


@query("run_log_append", f"""
SELECT {S.iso("TIMESTAMP '2024-03-01 00:00:00'")} AS run_at, 'incremental' AS mode, CAST(sum(seen) AS BIGINT) AS seen, CAST(sum(inserted) AS BIGINT) AS inserted,
  CAST(sum(errors) AS BIGINT) AS errors, count(DISTINCT source) AS sources, (SELECT count(*) FROM x_reviews) AS total_records FROM x_tasks""")
def run_log_append(spark, sf):
    """The row that is appended, its JSON read back."""
    revs = reviews(spark, sf)
    stats = observe.cycle_stats(ops.cycle_results(landed_copies(revs)))
    row = observe.run_log_row(stats, as_of(), "incremental", revs.agg(F.count("*")).scalar())
    s = F.from_json("stats_json", "struct<seen:bigint,inserted:bigint,errors:bigint,sources:array<struct<source:string>>>")
    return row.select(keys.iso_utc(F.col("run_at")).alias("run_at"), "mode", s["seen"].alias("seen"), s["inserted"].alias("inserted"), s["errors"].alias("errors"),
                      F.size(s["sources"]).cast("long").alias("sources"), "total_records")


cte("x_run_log", """
  SELECT date_trunc('hour', ts) AS run_at, CASE WHEN hour(date_trunc('hour', ts)) < 6 THEN 'fast_backfill' ELSE 'incremental' END AS mode, count(*) AS seen,
    count(*) FILTER (event_type = 'purchase') AS inserted, count(*) FILTER (event_type = 'error') AS errors FROM events GROUP BY 1""")


@query("latest_cycle", f"""
SELECT mode AS latest_cycle_mode, seen AS latest_cycle_total_records, inserted AS latest_cycle_inserted, seen AS latest_cycle_seen, errors AS latest_cycle_errors, {S.iso('run_at')} AS latest_cycle_run_at
FROM x_run_log ORDER BY run_at DESC LIMIT 1""")
def latest_cycle(spark, sf):
    return observe.latest_cycle(ops.run_log(spark, sf))


@query("health_counts", """
SELECT (SELECT count(*) FROM x_reviews) AS reviews_count, (SELECT count(*) FROM x_records) AS ideas_count, (SELECT count(*) FROM x_run_log) AS run_log_count,
  (SELECT count(*) FROM x_progress WHERE status = 'running') AS seed_running_count, (SELECT count(*) FROM x_progress WHERE status = 'error') AS seed_error_count""")
def health_counts(spark, sf):
    return observe.health_counts(reviews(spark, sf), cand.accepted(records(spark, sf)), ops.run_log(spark, sf), ops.progress(spark, sf))


@query("health_latest", f"SELECT {S.iso('run_at')} AS taken_at, seen, errors FROM x_run_log ORDER BY run_at DESC LIMIT 1")
def health_latest(spark, sf):
    s = F.from_json("stats_json", observe.STATS)
    history = ops.run_log(spark, sf).select(keys.iso_utc(F.col("run_at")).alias("taken_at"), s["seen"].alias("seen"), s["errors"].alias("errors"))
    return observe.latest_snapshot(history)


BUDGET = 2_000_000.0


@query("budget_gate", f"""
SELECT d.day, coalesce(l.spent, 0) AS spent, coalesce(l.spent, 0) >= {BUDGET:.1f}e0 AS reached FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS day FROM lineitem) d
LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS day, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) / 100e0 AS spent FROM orders GROUP BY 1) l USING (day)""".replace(".0e0", "e0"))
def budget_gate(spark, sf):
    days = table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("day")).distinct()
    return observe.budget_flags(days, ops.ledger(spark, sf), BUDGET)


def _span(width: int) -> str:
    return f"CAST(sum(n) OVER (PARTITION BY event_type ORDER BY us RANGE BETWEEN {width * 1_000_000 - 1} PRECEDING AND CURRENT ROW) AS BIGINT)"


@query("rate_budget_report", f"""
SELECT event_type, {S.iso('ts')} AS ts, n AS events, last_second, last_minute, last_day, last_second > 8 AS over_last_second, last_minute > 240 AS over_last_minute, last_day > 60 AS over_last_day
FROM (SELECT *, {_span(1)} AS last_second, {_span(60)} AS last_minute, {_span(86400)} AS last_day FROM (SELECT event_type, ts, epoch_us(ts) AS us, count(*) AS n FROM events GROUP BY 1, 2))""")
def rate_budget_report(spark, sf):
    from dataclasses import replace

    report = observe.rate_budget_report(table(spark, sf, "events"), "event_type", "ts", replace(DEFAULT, rate_per_day=60))
    return report.withColumn("ts", keys.iso_utc(F.col("ts")))
