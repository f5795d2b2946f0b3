"""Whole runs over stored tables: an ingest cycle, and an enrichment run with its publishing.

Every table is a ``Store``: a run reads the versions that are there when it begins each step and adds new ones, so a run
that dies can be started again, and one that finds nothing new writes no version of what stays the same.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gripelode import schema
from gripelode.config import DEFAULT, Config
from gripelode.functions import gates, keys
from gripelode.operators import candidates as cand
from gripelode.operators import ingest, observe, publish, seeds
from gripelode.session import drop, stage
from gripelode.stores import Store

#: Sources whose rows have a cursor; the others land again in every cycle and rest on the fingerprint alone.
CURSOR_SOURCES = ("play_store", "app_store", "reddit", "upwork")


@dataclass
class Tables:
    """All stored tables of one data set below a folder."""

    reviews: Store
    cursors: Store
    progress: Store
    run_log: Store
    candidates: Store
    links: Store
    cards: Store
    rejects: Store

    @classmethod
    def at(cls, spark: SparkSession, path: str, buckets: int = 8) -> "Tables":
        def store(name: str, ddl: str, *key: str) -> Store:
            return Store(spark, f"{path}/{name}", ddl, list(key), buckets, filtered=name in ("reviews", "idea_evidence_map"))

        return cls(
            reviews=store("reviews", schema.REVIEWS, "fingerprint"), cursors=store("source_cursors", schema.SOURCE_CURSORS, "cursor_key"),
            progress=store("seed_progress", schema.SEED_PROGRESS, "seed_type", "seed_key"), run_log=store("run_log", schema.RUN_LOG, "run_at", "mode"),
            candidates=store("idea_candidates", schema.CANDIDATES, "candidate_id"), links=store("idea_evidence_map", schema.EVIDENCE_MAP, *publish.LINK_KEY),
            cards=store("idea_publish_cards", schema.PUBLISH_CARDS, "candidate_id"), rejects=store("idea_rejects", schema.REJECTS, "batch_id", "cluster_id"),
        )

    def versions(self) -> dict[str, int]:
        return {name: table.version() for name, table in vars(self).items()}


# --- ingest ------------------------------------------------------------------------------------


def passes_gate(cfg: Config = DEFAULT) -> Column:
    """The gate of a row's source; ``query`` is the search that found a forum or launch row."""
    source, text, rating = F.col("source"), F.col("comment_text"), F.col("rating")
    by_source = (
        F.when(source.isin("play_store", "app_store"), gates.mobile(rating, text)).when(source == "reddit", gates.community(text))
        .when(source == "hacker_news", gates.forum(text, F.col("query"))).when(source == "product_hunt", gates.launch(text, F.col("query")))
        .when(source.isin("g2", "capterra"), gates.market(rating, text, source, cfg.relaxed_market)).when(source == "upwork", gates.job(text))
    )
    return F.coalesce(by_source, F.lit(False))


def cursor_key() -> Column:
    """source:entity:country for sources with cursors, else null."""
    return F.when(F.col("source").isin(*CURSOR_SOURCES), F.concat_ws(":", "source", "entity_id", F.lower("country")))


def ingest_cycle(tables: Tables, landed: DataFrame, seed_keys: DataFrame, run_at: Column, mode: str = "incremental", cfg: Config = DEFAULT) -> DataFrame:
    """One cycle over what has landed; returns its statistics per source and in total (``cycle_stats``).

    ``landed``: canonical rows with ``query``, ``seed_type``, ``seed_key``, ``ingest_seq``. ``seed_keys``: seed_type, seed_key,
    enabled. Rows that pass their source's gate and are newer than their cursor are added if their fingerprint is new; then
    cursors move to the newest added time, seeds get their counters and status, and the run is logged. The fast mode ignores
    cursors. Rows of seeds that are not enabled are not looked at.
    """
    enabled = seed_keys.where("enabled").select("seed_type", "seed_key")
    rows = stage(landed.join(enabled, ["seed_type", "seed_key"], "left_semi").withColumn("posted_ts", keys.parse_time(F.col("posted_at"))), "landed")
    passed = rows.where(passes_gate(cfg))
    if mode != "fast_backfill":
        passed = ingest.cursor_filter(passed, tables.cursors.read(), cursor_key())
    first = stage(ingest.first_per_fingerprint(passed, ["scraped_at", "ingest_seq"]), "first")
    known = tables.reviews.known(first)
    fresh = stage(first.join(known, "fingerprint", "left_anti"), "fresh")
    drop(first, known)
    tables.reviews.append(fresh)

    newest = fresh.withColumn("cursor_key", cursor_key()).where("cursor_key is not null and posted_ts is not null")
    newest = newest.groupBy("cursor_key").agg(F.max("posted_ts").alias("newest")).select("cursor_key", keys.iso_utc(F.col("newest")).alias("cursor_value"))
    asked = tables.cursors.read().join(newest.select("cursor_key"), "cursor_key", "left_semi")
    tables.cursors.upsert(ingest.cursor_upsert(asked, newest, run_at))

    per_seed = ["source", "seed_type", "seed_key"]
    seen, added = rows.groupBy(*per_seed).agg(F.count("*").alias("seen")), fresh.groupBy(*per_seed).agg(F.count("*").alias("inserted"))
    results = stage(seen.join(added, per_seed, "left").na.fill(0, ["inserted"]).withColumn("errors", F.lit(0).cast("long")), "results")
    runs = results.select(
        "seed_type", "seed_key", run_at.alias("run_at"), F.lit(0).cast("long").alias("run_seq"), "seen", "inserted",
        seeds.run_status(F.col("source"), F.col("inserted"), F.lit("")).alias("status"), F.lit("").alias("error"), F.lit(False).alias("exhausted"),
    )
    progress = seeds.update_progress(seeds.upsert_progress(tables.progress.read(), seed_keys, run_at), runs)
    tables.progress.upsert(progress)

    stats = stage(observe.cycle_stats(results), "stats")
    total = F.lit(sum(s.rows for s in tables.reviews.segments())).cast("long")
    tables.run_log.append(observe.run_log_row(stats, run_at, mode, total))
    drop(rows, fresh, results)
    return stats


# --- enrichment --------------------------------------------------------------------------------


@dataclass(frozen=True)
class Run:
    """What an enrichment run did."""

    batches: int
    budget_reached: bool = False


def rebuild_and_clean(tables: Tables, as_of: Column, limit: int | None, cfg: Config = DEFAULT) -> None:
    """Coarse cards of stored candidates (the newest ``limit``, or all), then cards with too little evidence go."""
    cards = publish.rebuild_cards(tables.candidates.read(), tables.links.read(), as_of, limit, cfg.max_links, cfg.min_supporting)
    cards = stage(publish.clean_cards(cards, cfg.min_supporting), "rebuilt")
    # A card that only its time would change stays as it is.
    stored = tables.cards.read().drop("generated_at")
    same = [F.col(f"n.{c}").eqNullSafe(F.col(f"o.{c}")) for c in stored.columns]
    on = same[0]
    for condition in same[1:]:
        on = on & condition
    tables.cards.upsert(cards.alias("n").join(stored.alias("o"), on, "left_anti"))
    drop(cards)


def process_batch(tables: Tables, batch: DataFrame, batch_id: str, as_of: Column, cfg: Config = DEFAULT, responses: DataFrame | None = None) -> None:
    """Clusters, scores and publishes one batch of stored reviews, which is staged, and marks all its rows enriched."""
    records = stage(cand.enrich(batch, cfg, batch_id, as_of, responses), "records")
    accepted = stage(cand.expand_variants(cand.accepted(records), cfg.variants, cfg.variant_min_evidence), "accepted")
    tables.candidates.upsert(cand.candidate_rows(accepted))
    tables.links.insert_new(publish.evidence_links(accepted, as_of, cfg.max_links).select(*tables.links.columns))
    tables.cards.upsert(publish.publish_cards(accepted))
    tables.rejects.upsert(cand.reject_rows(records))
    # Only the mark differs, so what is stored needs no comparing.
    done = batch.where(~F.col("enriched_at").eqNullSafe(as_of)).withColumn("enriched_at", as_of)
    tables.reviews.replace(done.select(*tables.reviews.columns))
    drop(records, accepted)


def enrich_run(
    tables: Tables, batch_id: str, as_of: Column, cfg: Config = DEFAULT, batch_size: int | None = None, max_batches: int = 1, reprocess: bool = False,
    rebuild_limit: int | None = None, spent: DataFrame | None = None, responses: DataFrame | None = None,
) -> Run:
    """One run: stops at the budget, works off batches, rebuilds cards and drops those with too little evidence.

    Without ``batch_size`` all pending reviews are one batch. With it each of up to ``max_batches`` batches takes so many, and
    ``reprocess`` fills a batch up with reviews enriched long ago. ``spent``: one row with the flag ``reached``.
    """
    if spent is not None and spent.where("reached").count():
        return Run(0, True)
    done = 0
    for number in range(max_batches if batch_size else 1):
        reviews = tables.reviews.read().withColumn("posted_ts", keys.parse_time(F.col("posted_at")))
        batch = stage(ingest.next_batch(reviews, as_of, batch_size, reprocess, cfg.cooldown_hours), "next")
        if batch.isEmpty():
            break
        process_batch(tables, batch, batch_id if not number else f"{batch_id}.{number}", as_of, cfg, responses)
        drop(batch)
        done += 1
    rebuild_and_clean(tables, as_of, rebuild_limit, cfg)
    return Run(done)


def publish_snapshot(tables: Tables, path: str, version: str) -> None:
    """The public tables of the newest versions, named live once all are written."""
    publish.write_snapshot({"idea_publish_cards": tables.cards.read(), "idea_candidates": tables.candidates.read(), "idea_evidence_map": tables.links.read()}, path, version)

