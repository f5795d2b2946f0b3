"""Candidate records from clusters: scores, texts, model responses, gate, variants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gripelode.config import DEFAULT, Config
from gripelode.functions import keys, scores, text
from gripelode.operators import cluster
from gripelode.session import stage

SUPPORT_FIELDS = [
    "fingerprint", "source", "source_item_id", "entity_id", "entity_name", "category", "reviewer_name", "rating",
    "comment_text", "posted_at", "url", "country", "language",
]


def score_clusters(totals: DataFrame) -> DataFrame:
    n, sc = F.col("n"), F.col("source_count")
    scored = totals.withColumns({
        "heuristic_willingness": scores.heuristic_willingness(n, sc, F.col("cue_hits")), "heuristic_confidence": scores.heuristic_confidence(n, sc),
        "impact_label": scores.impact(F.col("avg_rating"), n), "frequency_label": scores.frequency(n),
    })
    labeled = scored.withColumns({"willingness_signal": scores.willingness_label(F.col("heuristic_willingness")), "confidence": F.col("heuristic_confidence")})
    return labeled.withColumn("pricing_hint", scores.pricing_hint(F.col("willingness_signal")))


def finish_scores(df: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Final scores and gate from the (possibly model-adjusted) label and confidence."""
    sc, confidence = F.col("source_count"), F.col("confidence")
    judged = df.withColumns({
        "willingness": scores.willingness_score(F.col("heuristic_willingness"), F.col("willingness_signal")),
        "quality_reason": scores.quality_reason(F.col("n"), sc, confidence, cfg),
    })
    boosted = judged.withColumn("raw", scores.raw_score(F.col("n"), sc, F.col("willingness"), confidence)).withColumn(
        "boosted", scores.boosted_score(F.col("raw"), sc)
    )
    return boosted.withColumns({
        "difficulty": scores.difficulty(F.col("boosted")), "quality_status": scores.quality_status(F.col("quality_reason")),
        "willingness_score": F.round("willingness", 2), "raw_opportunity_score": F.round("raw", 2), "boosted_opportunity_score": F.round("boosted", 2),
        "confidence_score": F.round(confidence, 2), "quality_score": F.round(confidence * 100, 2),
    })


def narratives(df: DataFrame) -> DataFrame:
    """Template texts from domain, leading terms, size and sources."""
    domain = F.col("domain")

    def lead(k: int) -> Column:
        return F.array_join(F.slice("top_terms", 1, k), ", ")

    return (
        df.withColumn("pain_point", F.concat(
            domain, F.lit(" users repeatedly report issues around "), lead(3),
            F.lit(", causing delays, rework, and poor trust in existing tools."),
        ))
        .withColumn("reasoning", F.concat(
            F.lit("Based on "), F.col("n"), F.lit(" negative complaints across "), F.col("source_count"),
            F.lit(" source(s) ("), F.array_join("sources", ", "), F.lit("). Recurring signals center on: "), lead(5), F.lit("."),
        ))
        .withColumn("suggested_solution", F.concat(
            F.lit("Build a focused "), domain, F.lit(" operations assistant that detects and resolves "), lead(2),
            F.lit(" failures early, adds proactive alerts, and provides one-click remediation workflows."),
        ))
    )


def product_texts(df: DataFrame) -> DataFrame:
    titled = F.array_join(F.transform(F.slice("top_terms", 1, 2), text.title_case), " ")
    name = text.strip(F.concat_ws(" ", "domain", titled, F.lit("Optimizer")))
    description = F.concat(
        F.lit("A SaaS platform that helps "), F.lower("domain"), F.lit(" teams reduce issues related to "),
        F.array_join(F.slice("top_terms", 1, 3), ", "),
        F.lit(" by automating detection, prioritization, and guided resolution workflows."),
    )
    return df.withColumn("name", F.substring(F.regexp_replace(name, text.WS + "+", " "), 1, 90)).withColumn(
        "description", F.substring(description, 1, 360)
    )


def support_lists(support: DataFrame) -> DataFrame:
    """At most ``support_pool`` evidence structs per cluster, in rank order."""
    item = F.struct(F.col("support_rank").alias("rank"), *SUPPORT_FIELDS)
    return support.groupBy("cluster_key").agg(F.array_sort(F.collect_list(item)).alias("support_pool"))


def describe_clusters(clustered: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """One row per cluster: totals, labels, domain, top terms and support pool.

    The clustered rows feed four branches, so they are staged once; every branch aggregates by
    cluster key and the joins below line up on it.
    """
    rows = stage(clustered, "clustered")
    pool = cluster.support_rows(rows, max(cfg.max_quotes, cfg.support_pool))
    return (
        score_clusters(cluster.cluster_totals(rows))
        .join(cluster.top_term_lists(cluster.top_terms(rows)), "cluster_key", "left")
        .withColumn("top_terms", F.coalesce("top_terms", F.array(F.lit("workflow"), F.lit("reliability"))))
        .join(cluster.cluster_domain(rows), "cluster_key")
        .join(support_lists(pool), "cluster_key")
        .withColumn("cluster_id", keys.sha1_id(16, F.col("cluster_key")))
        .withColumn("support", F.slice("support_pool", 1, cfg.max_quotes))
        .withColumn("model_tags", F.array().cast("array<string>"))
        .withColumn("inferred_location", F.lit(""))
    )


def enrichment_requests(described: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """One JSON request per cluster for an offline model job."""
    evidence = F.transform(F.slice("support_pool", 1, cfg.support_pool), lambda s, i: F.struct(
        i.alias("id"), s["source"].alias("source"), s["entity_name"].alias("entity_name"),
        s["category"].alias("seed_category"), s["rating"].alias("rating"), s["country"].alias("country"),
        s["language"].alias("language"), F.substring(s["comment_text"], 1, 420).alias("comment"), s["url"].alias("url"),
    ))
    request = F.struct(
        F.col("cluster_key"), F.col("n").alias("evidence_count"), F.col("sources"),
        F.round("avg_rating", 3).alias("avg_rating"), F.slice("top_terms", 1, 6).alias("top_terms"), evidence.alias("evidence"),
    )
    return described.select(
        "cluster_id", "cluster_key", F.size(evidence).alias("evidence_rows"),
        F.to_json(request, {"ignoreNullFields": "false"}).alias("request"),
    )


def _field(payload: Column, name: str, kind: str = "string") -> Column:
    return F.try_variant_get(payload, f"$.{name}", kind)


def remap_support(pool: Column, ids: Column, cfg: Config = DEFAULT) -> Column:
    """Evidence picked by a response's ids; invalid and repeated ids are skipped, at least two rows kept.

    All arrays are bounded by the support pool, so this needs no join.
    """
    default = F.slice(pool, 1, cfg.max_quotes)
    valid = F.array_distinct(F.filter(ids, lambda i: (i >= 0) & (i < F.size(pool))))
    picked = F.slice(F.transform(valid, lambda i: F.get(pool, i)), 1, cfg.max_quotes)
    rest = F.filter(pool, lambda s, i: ~F.array_contains(valid, i))
    topped_up = F.slice(F.concat(picked, rest), 1, cfg.max_quotes)
    return (
        F.when(ids.isNull() | (F.size(picked) == 0), default)
        .when(F.size(picked) < F.least(F.lit(2), F.size(pool)), topped_up)
        .otherwise(picked)
    )


def apply_responses(described: DataFrame, responses: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Merge model responses (cluster_id, response) into described clusters that carry narratives.

    Clusters without a usable response keep their template values. Of several responses for one cluster the greatest
    text counts, which puts bare JSON before prose.
    """
    single = responses.groupBy("cluster_id").agg(F.max("response").alias("response"))
    parsed = single.withColumn("payload", text.lenient_json(F.col("response"))).select("cluster_id", "payload")
    joined = described.join(parsed, "cluster_id", "left")
    payload = F.col("payload")
    # An empty object counts as no response.
    answered = F.coalesce(F.to_json(payload) != "{}", F.lit(False))

    def taken(name: str, current: str, length: int) -> Column:
        given = F.nullif(_field(payload, name), F.lit(""))
        return F.when(answered, F.substring(text.strip(F.coalesce(given, F.col(current))), 1, length)).otherwise(F.col(current))

    def named(name: str, current: str, length: int) -> Column:
        given = F.nullif(text.strip(text.text_of(_field(payload, name))), F.lit(""))
        return F.coalesce(F.substring(F.regexp_replace(given, text.WS + "+", " "), 1, length), F.col(current))

    def leveled(name: str, current: str) -> Column:
        return F.when(answered, text.level(_field(payload, name), F.col(current))).otherwise(F.col(current))

    model_confidence = text.bounded(_field(payload, "confidence_score"), F.col("heuristic_confidence"), 0.2, 0.98)
    blended = F.least(F.lit(0.98), F.greatest(F.lit(0.35), F.col("heuristic_confidence") * 0.6 + model_confidence * 0.4))
    tag_list = _field(payload, "category_tags", "array<string>")
    tag_text = F.filter(
        F.transform(F.split(text.text_of(_field(payload, "category_tags")), ","), text.strip), lambda t: t != ""
    )
    ids = F.transform(
        _field(payload, "supporting_comment_ids", "array<string>"), lambda i: F.when(text.strip(i).rlike(r"^[+-]?\d+$"), text.strip(i).try_cast("int"))
    )
    model_domain = text.clean_tag(_field(payload, "domain_category"))
    location = F.substring(text.clean(_field(payload, "location_hint")), 1, 90)
    merged = joined.withColumns({
        "domain": F.coalesce(model_domain, F.col("domain")),
        "pain_point": taken("pain_point", "pain_point", 420),
        "reasoning": taken("reasoning", "reasoning", 420),
        "suggested_solution": taken("suggested_solution", "suggested_solution", 420),
        "pricing_hint": taken("pricing_hint", "pricing_hint", 80),
        "impact_label": leveled("impact_label", "impact_label"),
        "frequency_label": leveled("frequency_label", "frequency_label"),
        "willingness_signal": leveled("willingness_signal", "willingness_signal"),
        "confidence": F.when(answered, blended).otherwise(F.col("confidence")),
        "model_tags": F.when(answered, F.coalesce(tag_list, tag_text)).otherwise(F.col("model_tags")),
        "inferred_location": F.when(answered, location).otherwise(F.col("inferred_location")),
        "support": F.when(answered, remap_support(F.col("support_pool"), ids, cfg)).otherwise(F.col("support")),
    })
    return product_texts(merged).withColumns({
        "name": F.when(answered, named("name", "name", 90)).otherwise(F.col("name")),
        "description": F.when(answered, named("description", "description", 360)).otherwise(F.col("description")),
    }).drop("payload")


def primary_source(df: DataFrame) -> DataFrame:
    first = F.get("support", F.lit(0))
    return df.withColumn("source", F.coalesce(F.nullif(first["source"], F.lit("")), F.lit("unknown"))).withColumn(
        "source_date", F.substring(text.text_of(first["posted_at"]), 1, 10)
    )


def evidence_payload(support: Column) -> Column:
    """Quotes as stored on candidates and cards."""
    return F.transform(support, lambda s: F.struct(
        F.substring(s["comment_text"], 1, 700).alias("quote"), s["source"].alias("source"), s["url"].alias("url"),
        s["reviewer_name"].alias("author"), s["posted_at"].alias("posted_at"), F.lit(1.0).alias("match_score"),
    ))


def source_metadata(support: Column, location: Column, limit: int = 8) -> Column:
    return F.transform(F.slice(support, 1, limit), lambda s: F.struct(
        s["source"].alias("source"), s["entity_name"].alias("entity_name"), s["category"].alias("seed_category"),
        location.alias("inferred_location"), s["country"].alias("country"), s["language"].alias("language"), s["url"].alias("url"),
    ))


def build_records(
    described: DataFrame, cfg: Config, batch_id: str, generated_at: Column, responses: DataFrame | None = None
) -> DataFrame:
    """All cluster records, accepted and rejected, still carrying their nested support rows."""
    told = narratives(described)
    told = product_texts(told) if responses is None else apply_responses(told, responses, cfg)
    tags = text.category_tags(F.col("domain"), F.col("model_tags"), F.col("top_terms"))
    return (
        primary_source(finish_scores(told, cfg))
        .withColumn("categories", F.array_join(tags, ", "))
        .withColumn("batch_id", F.lit(batch_id))
        .withColumn("generated_at", generated_at)
        .withColumn("candidate_id", keys.sha1_id(24, F.col("cluster_id"), F.col("pain_point"), F.lit(batch_id)))
    )


def accepted(records: DataFrame) -> DataFrame:
    return records.where(F.col("quality_status") == "accepted")


def expand_variants(acc: DataFrame, variants: int, min_evidence: int = DEFAULT.variant_min_evidence) -> DataFrame:
    """Accepted records plus ``variants - 1`` rewordings of each record with enough evidence."""
    last = F.when((F.col("n") >= min_evidence) & (F.size("top_terms") > 0), F.lit(variants - 1)).otherwise(0)
    df = acc.withColumn("variant", F.explode(F.sequence(F.lit(0), last)))
    base = F.col("variant") == 0
    term = F.element_at("top_terms", F.least(F.col("variant") + 1, F.size("top_terms")))

    def undotted(c: str) -> Column:
        return F.rtrim(F.col(c), F.lit("."))

    df = df.withColumns({
        "pain_point": F.when(base, F.col("pain_point")).otherwise(F.concat(undotted("pain_point"), F.lit(" A recurring sub-problem is "), term, F.lit("."))),
        "reasoning": F.when(base, F.col("reasoning")).otherwise(F.concat(
            undotted("reasoning"), F.lit(" Additional evidence points to "), term, F.lit(" as a high-friction step."))),
        "suggested_solution": F.when(base, F.col("suggested_solution")).otherwise(F.concat(
            undotted("suggested_solution"), F.lit(" Include an explicit workflow for "), term, F.lit("."))),
        "name": F.when(base, F.col("name")).otherwise(text.strip(F.substring(F.concat(text.strip(F.col("name")), F.lit(" "), text.title_case(term)), 1, 90))),
        "description": F.when(base, F.col("description")).otherwise(F.substring(
            F.concat(undotted("description"), F.lit(" This variant prioritizes improvements around "), term, F.lit(".")), 1, 360)),
    })
    variant_id = keys.sha1_id(24, F.col("cluster_id"), F.col("pain_point"), F.col("batch_id"), F.col("variant").cast("string"))
    return df.withColumn("candidate_id", F.when(base, F.col("candidate_id")).otherwise(variant_id))


def candidate_rows(records: DataFrame) -> DataFrame:
    """The candidates table; nested values become JSON text here."""
    return records.select(
        "candidate_id", "cluster_id", "pain_point", "reasoning", F.col("n").alias("evidence_count"),
        F.to_json("sources").alias("sources_present"), "willingness_signal", "willingness_score", "raw_opportunity_score",
        "boosted_opportunity_score", "impact_label", "frequency_label", "suggested_solution", "pricing_hint",
        "confidence_score", "quality_score", "quality_status", "quality_reason",
        F.to_json(evidence_payload(F.col("support"))).alias("evidence_quotes"), "generated_at", "batch_id",
    )


def reject_rows(records: DataFrame) -> DataFrame:
    return records.where(F.col("quality_status") == "rejected").select(
        F.col("generated_at").alias("created_at"), "batch_id", "cluster_id", "pain_point",
        F.col("quality_reason").alias("reason"), "quality_score",
        F.to_json(evidence_payload(F.col("support"))).alias("payload"),
    )


def enrich(reviews: DataFrame, cfg: Config, batch_id: str, generated_at: Column, responses: DataFrame | None = None) -> DataFrame:
    """Reviews to cluster records; the whole frame is one batch."""
    clustered = cluster.merge_small_clusters(cluster.key_reviews(reviews), cfg.min_cluster_size)
    return build_records(describe_clusters(clustered, cfg), cfg, batch_id, generated_at, responses)
