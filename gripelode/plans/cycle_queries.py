"""An ingest cycle and an enrichment run from landed rows to cards, over stored tables of their own."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from gripelode.config import DEFAULT
from gripelode.functions import text
from gripelode.operators import cycle, ingest, publish
from gripelode.operators import candidates as cand
from gripelode.plans import sql as S
from gripelode.plans.cluster_queries import as_of
from gripelode.plans.publish_queries import dated_records
from gripelode.plans.registry import cte, query
from gripelode.session import shared_dir, stage
from gripelode.sources.tables import landed_copies, reviews

SEARCH = "team export sync"
FIRST_DAY = "2024-01-16"


def tables(spark):
    return cycle.Tables.at(spark, f"{shared_dir(spark)}/gripelode/{uuid.uuid4().hex}")


def stored_reviews(spark, sf):
    """Reviews as a cycle stores them: without derived times, not enriched yet."""
    empty = {c: F.lit(None).cast(t) for c, t in (("raw_json", "string"), ("enriched_at", "timestamp_ntz"))}
    return reviews(spark, sf).withColumns(empty)


def landed(spark, sf):
    """Repeated crawls of all reviews; their seeds are entities, and every ninth entity is not enabled."""
    rows = landed_copies(stored_reviews(spark, sf).withColumn("raw_json", F.lit(None).cast("string")))
    return rows.withColumns({"query": F.lit(SEARCH), "seed_type": F.col("source"), "seed_key": F.concat(F.lit("k"), "entity_id")})


def _time(day: int):
    return F.lit(f"2024-03-0{day} 00:00:00").cast("timestamp_ntz")


cte("x_landed", f"""
  SELECT * FROM x_copies WHERE CAST(entity_id AS BIGINT) % 9 <> 0 AND CASE
    WHEN source IN ('play_store', 'app_store') THEN {S.mobile('comment_text')} WHEN source = 'reddit' THEN {S.community('comment_text')}
    WHEN source = 'hacker_news' THEN {S.forum('comment_text', S.q(SEARCH))} WHEN source = 'product_hunt' THEN {S.launch('comment_text', S.q(SEARCH))}
    WHEN source = 'upwork' THEN {S.job('comment_text')} ELSE {S.market('comment_text', 'source')} END""")
cte("x_cycle_seen", "SELECT source, posted_ts FROM x_copies WHERE CAST(entity_id AS BIGINT) % 9 <> 0")
cte("x_cycle_first", f"SELECT fingerprint, source, entity_id, country, posted_ts FROM x_landed WHERE posted_ts < TIMESTAMP '{FIRST_DAY} 00:00:00' AND copy = 1")
_HAS = "source IN ('play_store', 'app_store', 'reddit', 'upwork')"
cte("x_cycle_newest", f"SELECT source, entity_id, country, max(posted_ts) AS newest FROM x_cycle_first WHERE {_HAS} GROUP BY ALL")
cte("x_cycle_second", """
  SELECT fingerprint, l.source FROM x_landed l LEFT JOIN x_cycle_newest c USING (source, entity_id, country)
  WHERE copy = 1 AND (newest IS NULL OR posted_ts > newest) AND fingerprint NOT IN (SELECT fingerprint FROM x_cycle_first)""")
cte("x_cycle_counts", f"""
  SELECT 1 AS cycle, source, count(*) AS seen, 0 AS inserted FROM x_cycle_seen WHERE posted_ts < TIMESTAMP '{FIRST_DAY} 00:00:00' GROUP BY source
  UNION ALL SELECT c.cycle, source, count(*), 0 FROM x_cycle_seen, (SELECT unnest([2, 3]) AS cycle) c GROUP BY ALL
  UNION ALL SELECT 1, source, 0, count(*) FROM x_cycle_first GROUP BY source UNION ALL SELECT 2, source, 0, count(*) FROM x_cycle_second GROUP BY source""")


@query("ingest_cycle", """
SELECT cycle, source, CAST(grouping(source) AS INTEGER) AS is_total, CAST(sum(seen) AS BIGINT) AS seen, CAST(sum(inserted) AS BIGINT) AS inserted, 0::BIGINT AS errors,
  (SELECT count(*) FROM x_cycle_first) + CASE WHEN cycle > 1 THEN (SELECT count(*) FROM x_cycle_second) ELSE 0 END AS stored
FROM x_cycle_counts GROUP BY GROUPING SETS ((cycle, source), (cycle))""")
def ingest_cycle(spark, sf):
    """Three cycles: the first days, then everything landed, then all of it once more, which adds nothing."""
    t, rows = tables(spark), stage(landed(spark, sf), "all_landed")
    seeds = rows.select("seed_type", "seed_key", (F.substring("seed_key", 2, 20).cast("long") % 9 != 0).alias("enabled")).distinct()
    seeds = stage(seeds, "seeds")
    out = None
    for number, part in enumerate((rows.where(F.col("posted_ts") < F.lit(f"{FIRST_DAY} 00:00:00").cast("timestamp_ntz")), rows, rows), 1):
        stats = cycle.ingest_cycle(t, part.drop("posted_ts"), seeds, _time(number))
        told = stats.select(F.lit(number).alias("cycle"), "*", F.lit(sum(s.rows for s in t.reviews.segments())).cast("long").alias("stored"))
        out = told if out is None else out.unionByName(told)
    return out


cte("x_rebuilt_all", """
  SELECT c.candidate_id, left(split_part(pain_point, ' users ', 1) || ' Opportunity', 90) AS name, left(reasoning, 360) AS description, l.source || ', Pain Intelligence' AS categories,
    'Medium' AS difficulty, l.source, left(l.posted_at, 10) AS source_date, impact_label, round(boosted, 2) AS opportunity_score, least(n, 6) AS quotes
  FROM x_records c JOIN (SELECT *, row_number() OVER (PARTITION BY candidate_id ORDER BY support_rank DESC) AS link_rank FROM x_links) l USING (candidate_id) WHERE link_rank = 1""")
CARD = ["candidate_id", "name", "description", "categories", "difficulty", "source", "source_date", "impact_label", "opportunity_score"]


@query("rebuild_cards_all", "SELECT * FROM x_rebuilt_all")
def rebuild_cards_all(spark, sf):
    """Cards of all stored candidates, without a limit."""
    recs = stage(cand.accepted(dated_records(spark, sf)), "records")
    cards = publish.rebuild_cards(cand.candidate_rows(recs), publish.evidence_links(recs, as_of()), as_of())
    return cards.select(*CARD, text.json_items(F.col("supporting_evidence")).cast("long").alias("quotes"))


@query("enrich_run", """
SELECT b.*, r.n AS evidence_count, r.cluster_id, k.links, (SELECT count(*) FROM x_base) AS enriched, 1 AS batches, 0 AS batches_again, true AS unchanged
FROM x_rebuilt_all b JOIN x_records r USING (candidate_id) JOIN (SELECT candidate_id, count(*) AS links FROM x_links GROUP BY 1) k USING (candidate_id)""")
def enrich_run(spark, sf):
    """All stored reviews are pending: one run publishes them, a second one finds nothing and changes no table."""
    t = tables(spark)
    t.reviews.append(stored_reviews(spark, sf).select(*t.reviews.columns))
    first = cycle.enrich_run(t, "batch-1", as_of())
    before = t.versions()
    second = cycle.enrich_run(t, "batch-2", as_of())
    enriched = t.reviews.read().where("enriched_at is not null").count()
    links = t.links.read().groupBy("candidate_id").agg(F.count("*").alias("links"))
    cards = t.cards.read().select(*CARD, text.json_items(F.col("supporting_evidence")).cast("long").alias("quotes"))
    told = cards.join(t.candidates.read().select("candidate_id", "evidence_count", "cluster_id"), "candidate_id").join(links, "candidate_id")
    return told.select(
        "*", F.lit(enriched).cast("long").alias("enriched"), F.lit(first.batches).alias("batches"), F.lit(second.batches).alias("batches_again"), F.lit(before == t.versions()).alias("unchanged"),
    )


@query("enrich_batch_filled", """
SELECT fingerprint FROM x_reviews WHERE enriched_at IS NULL AND trim(comment_text) <> '' UNION ALL SELECT fingerprint FROM x_again""")
def enrich_batch_filled(spark, sf):
    """A batch with room for some more rows than are pending: the rows waiting longest since their enrichment fill it up."""
    revs = reviews(spark, sf)
    size = ingest.pending(revs).count() + DEFAULT.batch_size
    at = F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")
    return ingest.next_batch(revs, at, size, reprocess=True, cooldown_hours=DEFAULT.cooldown_hours).select("fingerprint")


_CANDIDATE = """candidate_id, cluster_id, pain_point, reasoning, n AS evidence_count, CAST(to_json(sources) AS VARCHAR) AS sources_present, willingness_signal, round(will, 2) AS willingness_score,
  round(base, 2) AS raw_opportunity_score, round(boosted, 2) AS boosted_opportunity_score, impact_label, frequency_label, suggested_solution, pricing_hint, round(conf, 2) AS confidence_score,
  round(conf * 100, 2) AS quality_score, 'accepted' AS quality_status"""


@query("candidate_store", f"SELECT {_CANDIDATE}, CASE WHEN impact_label = 'high' THEN 'batch-1' ELSE 'batch-0' END AS batch_id, 2 AS version FROM x_records")
def candidate_store(spark, sf):
    """All candidates stored, those of high impact replaced by a later batch, and that batch stored once more, which writes nothing."""
    rows = stage(cand.candidate_rows(cand.accepted(dated_records(spark, sf))), "candidates")
    store = tables(spark).candidates
    store.upsert(rows.withColumn("batch_id", F.lit("batch-0")))
    for _ in range(2):
        store.upsert(rows.where(F.col("impact_label") == "high"))
    return store.read().drop("quality_reason", "evidence_quotes", "generated_at").withColumn("version", F.lit(store.version()))
