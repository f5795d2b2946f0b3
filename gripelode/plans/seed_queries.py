"""Seed tables, progress, selection and generation over seeds derived from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from gripelode import lexicon as lx
from gripelode.functions import keys
from gripelode.operators import seeds
from gripelode.plans import sql as S
from gripelode.plans.registry import cte, query
from gripelode.sources import operations as ops
from gripelode.sources.tables import table

STAMP = "2024-01-20 00:00:00"
LIMIT = 40

cte("x_query_seeds", """
  SELECT p_partkey AS pos, p_name || ' ' || lower(p_brand) AS key, CASE WHEN p_partkey % 5 = 0 THEN '' ELSE p_type END AS category,
    p_partkey % 4 = 0 OR p_partkey % 2 = 0 AS enabled FROM part WHERE p_partkey % 9 <> 0""")
cte("x_seeds", f"""
  SELECT 'apps' AS seed_type, p_partkey AS pos, p_name || ' ' || (p_partkey % 50) AS name, CASE WHEN p_partkey % 3 = 0 THEN '' ELSE 'app.' || p_partkey END AS play_id,
    CASE WHEN p_partkey % 4 = 0 THEN CAST(p_partkey + 100000 AS VARCHAR) ELSE '' END AS apple_id, '' AS key,
    CASE WHEN p_partkey % 7 = 0 THEN 'Unknown' ELSE p_type END AS category, '' AS keywords, p_partkey % 3 <> 1 AS enabled FROM part
  UNION ALL SELECT 'reddit', c_custkey, '', '', '', lower(c_mktsegment) || '_' || c_custkey, 'reddit',
    CASE WHEN c_custkey % 5 = 0 THEN 'hate|wish' ELSE {S.q('|'.join(lx.PAIN_PHRASES))} END, c_custkey % 3 = 0 OR c_custkey % 2 = 0 FROM customer
  UNION ALL SELECT source, s_suppkey, product_name, '', '', url, CASE WHEN category = '' THEN 'Unknown' ELSE category END, '', enabled FROM x_market_seeds
  UNION ALL SELECT 'hackernews', pos, '', '', '', key, coalesce(nullif(category, ''), 'Startups'), '', enabled FROM x_query_seeds
  UNION ALL SELECT 'producthunt', pos, '', '', '', key, coalesce(nullif(category, ''), 'Productivity'), '', enabled FROM x_query_seeds
  UNION ALL SELECT 'upwork', pos, '', '', '', key, coalesce(nullif(category, ''), 'Operations'), '', enabled FROM x_query_seeds""")


@query("seed_projection", "SELECT * FROM x_seeds")
def seed_projection(spark, sf):
    return ops.all_seeds(spark, sf)


@query("enabled_seeds", "SELECT seed_type, pos, name, key FROM x_seeds WHERE enabled AND (seed_type = 'apps' OR key <> '')")
def enabled_seeds(spark, sf):
    return seeds.enabled_seeds(ops.all_seeds(spark, sf)).select("seed_type", "pos", "name", "key")


cte("x_seed_keys", """
  SELECT seed_type, seed_key, arg_max(enabled, pos) AS enabled FROM (
    SELECT seed_type, pos, enabled, 'play:' || play_id AS seed_key FROM x_seeds WHERE seed_type = 'apps' AND play_id <> ''
    UNION ALL SELECT seed_type, pos, enabled, 'apple:' || apple_id FROM x_seeds WHERE seed_type = 'apps' AND apple_id <> ''
    UNION ALL SELECT seed_type, pos, enabled, key FROM x_seeds WHERE seed_type <> 'apps' AND key <> '') GROUP BY 1, 2""")


@query("seed_keys", "SELECT * FROM x_seed_keys")
def seed_keys(spark, sf):
    return seeds.seed_keys(ops.all_seeds(spark, sf))


_ERR = "[" + ", ".join(S.q(e) for e in ops.ERRORS) + "]"
_TYPES = "[" + ", ".join(S.q(t) for t in ops.SEED_TYPES) + "]"
cte("x_progress", f"""
  SELECT ({_TYPES})[c_custkey % 7 + 1] AS seed_type, 'k' || c_custkey AS seed_key, c_acctbal > 0 AS enabled, (['done', 'error', 'running', 'pending', 'error'])[c_custkey % 5 + 1] AS status,
    CASE WHEN c_custkey % 6 <> 0 THEN c_custkey % 100 END AS total_seen, c_custkey % 10 AS total_inserted,
    CASE WHEN c_custkey % 5 <> 3 THEN TIMESTAMP '1997-01-01' + to_minutes(c_custkey % 1000) END AS last_run_at, CASE WHEN c_custkey % 5 <> 0 THEN ({_ERR})[c_custkey % 8 + 1] END AS last_error,
    c_custkey % 4 = 0 AS exhausted, TIMESTAMP '1997-01-01' + to_minutes(c_custkey % 1000) AS updated_at FROM customer""")
cte("x_runs", f"""
  SELECT ({_TYPES})[o_custkey % 7 + 1] AS seed_type, 'k' || o_custkey AS seed_key, o_orderdate AS run_at, o_orderkey AS run_seq,
    CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'error' ELSE 'running' END AS status, CAST(floor(o_totalprice / 1000) AS BIGINT) AS seen, o_orderkey % 4 AS inserted,
    ({_ERR})[o_orderkey % 8 + 1] AS error, o_orderpriority LIKE '1%' AS exhausted FROM orders""")
PROGRESS = ["seed_type", "seed_key", "enabled", "status", "total_seen", "total_inserted", "last_error", "exhausted"]


def progress_view(df):
    return df.select(*PROGRESS, keys.iso_utc(F.col("last_run_at")).alias("last_run_at"), keys.iso_utc(F.col("updated_at")).alias("updated_at"))


def _times(prefix: str = "") -> str:
    return f"{S.iso(prefix + 'last_run_at')} AS last_run_at, {S.iso(prefix + 'updated_at')} AS updated_at"


# Half of the stored progress belongs to keys that the new seeds still hold.
cte("x_known", """
  SELECT * FROM x_progress UNION ALL
  SELECT seed_type, seed_key, NOT enabled, 'done', 7, 3, NULL, NULL, true, TIMESTAMP '1997-02-01' FROM x_seed_keys WHERE seed_type IN ('reddit', 'g2')""")


@query("seed_upsert", f"""
SELECT seed_type, seed_key, coalesce(k.enabled, p.enabled) AS enabled, coalesce(p.status, 'pending') AS status,
  CASE WHEN p.status IS NULL THEN 0 ELSE p.total_seen END AS total_seen, CASE WHEN p.status IS NULL THEN 0 ELSE p.total_inserted END AS total_inserted, p.last_error,
  CASE WHEN p.status IS NULL THEN false ELSE p.exhausted END AS exhausted, {S.iso('p.last_run_at')} AS last_run_at,
  CASE WHEN k.enabled IS NOT NULL THEN {S.iso(f"TIMESTAMP '{STAMP}'")} ELSE {S.iso('p.updated_at')} END AS updated_at
FROM x_known p FULL JOIN x_seed_keys k USING (seed_type, seed_key)""")
def seed_upsert(spark, sf):
    new = seeds.seed_keys(ops.all_seeds(spark, sf))
    stored = new.where(F.col("seed_type").isin("reddit", "g2")).select(
        "seed_type", "seed_key", (~F.col("enabled")).alias("enabled"), F.lit("done").alias("status"), F.lit(7).cast("long").alias("total_seen"), F.lit(3).cast("long").alias("total_inserted"),
        F.lit(None).cast("timestamp_ntz").alias("last_run_at"), F.lit(None).cast("string").alias("last_error"), F.lit(True).alias("exhausted"),
        F.lit("1997-02-01 00:00:00").cast("timestamp_ntz").alias("updated_at"),
    )
    return progress_view(seeds.upsert_progress(ops.progress(spark, sf).unionByName(stored), new, F.lit(STAMP).cast("timestamp_ntz")))


@query("seed_progress_update", f"""
SELECT seed_type, seed_key, enabled, coalesce(r.status, p.status) AS status, coalesce(p.total_seen, 0) + coalesce(r.seen, 0) AS total_seen,
  coalesce(p.total_inserted, 0) + coalesce(r.inserted, 0) AS total_inserted, CASE WHEN r.status IS NULL THEN p.last_error ELSE r.error END AS last_error,
  coalesce(r.exhausted, p.exhausted) AS exhausted, {S.iso('coalesce(r.run_at, p.last_run_at)')} AS last_run_at, {S.iso('coalesce(r.run_at, p.updated_at)')} AS updated_at
FROM x_progress p LEFT JOIN (
  SELECT *, row_number() OVER (PARTITION BY seed_type, seed_key ORDER BY run_at DESC, run_seq DESC) AS rn, CAST(sum(seen) OVER w AS BIGINT) AS seen, CAST(sum(inserted) OVER w AS BIGINT) AS inserted
  FROM (SELECT * EXCLUDE (seen, inserted), seen, inserted FROM x_runs) WINDOW w AS (PARTITION BY seed_type, seed_key)) r USING (seed_type, seed_key) WHERE coalesce(r.rn, 1) = 1"""
    .replace("SELECT *, row_number()", "SELECT seed_type, seed_key, status, error, exhausted, run_at, row_number()"))
def seed_progress_update(spark, sf):
    return progress_view(seeds.update_progress(ops.progress(spark, sf), ops.runs(spark, sf)))


def _like(column: str, texts) -> str:
    return "(" + " OR ".join(f"lower(coalesce({column}, '')) LIKE '%{t}%'" for t in texts) + ")"


@query("seed_error_rules", f"""
SELECT seed_type, seed_key, CASE WHEN status = 'error' AND ({_like('last_error', lx.BLOCKED_ERROR_TEXTS)} OR seed_type IN ('g2', 'capterra', 'upwork', 'hackernews', 'producthunt')
  OR (seed_type = 'apps' AND {_like('last_error', lx.APP_GONE_TEXTS)})) THEN 'skipped' ELSE status END AS status FROM x_progress""")
def seed_error_rules(spark, sf):
    return seeds.normalize_error_states(ops.progress(spark, sf)).select("seed_type", "seed_key", "status")


@query("seed_status", f"""
SELECT run_seq, source, CASE
  WHEN source = 'play_store' THEN CASE WHEN error = '' THEN 'done' WHEN inserted = 0 AND {_like('error', lx.PLAY_GONE_TEXTS)} THEN 'skipped' ELSE 'error' END
  WHEN source = 'app_store' THEN CASE WHEN error = '' THEN 'done' WHEN inserted = 0 AND {_like('error', lx.APPLE_GONE_TEXTS)} THEN 'skipped' ELSE 'error' END
  WHEN source = 'reddit' THEN CASE WHEN {_like('error', lx.COMMUNITY_GONE_TEXTS)} THEN 'skipped' WHEN error = '' THEN 'done' ELSE 'error' END
  WHEN source = 'upwork' THEN CASE WHEN error = '' THEN 'done' WHEN inserted = 0 THEN 'skipped' ELSE 'error' END
  WHEN source = 'hacker_news' THEN CASE WHEN error <> '' THEN 'error' WHEN inserted = 0 THEN 'skipped' ELSE 'done' END
  ELSE CASE WHEN inserted = 0 THEN 'skipped' ELSE 'done' END END AS status
FROM (SELECT *, ({S.arr(lx.SOURCE_LABELS)})[run_seq // 8 % 8 + 1] AS source FROM x_runs)""")
def seed_status(spark, sf):
    from gripelode.sources.tables import pick

    runs = ops.runs(spark, sf).withColumn("source", pick(lx.SOURCE_LABELS, F.floor(F.col("run_seq") / 8) % 8))
    return runs.select("run_seq", "source", seeds.run_status(F.col("source"), F.col("inserted"), F.col("error")).alias("status"))


@query("seeds_exhausted", """
SELECT enabled_seeds, remaining, enabled_seeds > 0 AND remaining = 0 AS exhausted FROM (
  SELECT count(*) AS enabled_seeds, count(*) FILTER (NOT exhausted) AS remaining FROM x_progress WHERE seed_type <> 'reddit' AND enabled)""")
def seeds_exhausted(spark, sf):
    return seeds.static_exhausted(ops.progress(spark, sf))


cte("x_enabled", "SELECT *, row_number() OVER (PARTITION BY seed_type ORDER BY pos) - 1 AS position, count(*) OVER (PARTITION BY seed_type) AS total FROM x_seeds WHERE enabled AND (seed_type = 'apps' OR key <> '')")
cte("x_starts", "SELECT 'apps' AS seed_type, 25 AS start UNION ALL SELECT 'reddit', 1000000 UNION ALL SELECT 'upwork', 10")
cte("x_bounds", """
  SELECT e.*, CASE WHEN coalesce(s.start, 0) >= total THEN 0 ELSE coalesce(s.start, 0) END AS low, coalesce(s.start, 0) AS start FROM x_enabled e LEFT JOIN x_starts s USING (seed_type)""")
cte("x_slice", f"SELECT seed_type, pos, position, name, key FROM x_bounds WHERE total <= {LIMIT} OR position BETWEEN low AND low + {LIMIT - 1}")
STARTS = [("apps", 25), ("reddit", 1_000_000), ("upwork", 10)]


def _starts(spark):
    return spark.createDataFrame(STARTS, "seed_type string, start bigint")


@query("seed_slice", "SELECT seed_type, pos, position, name, key FROM x_slice")
def seed_slice(spark, sf):
    chosen = seeds.seed_slice(seeds.enabled_seeds(ops.all_seeds(spark, sf)), _starts(spark), LIMIT)
    return chosen.select("seed_type", "pos", F.col("position").cast("long").alias("position"), "name", "key")


@query("seed_cursor_next", f"""
SELECT DISTINCT seed_type, CAST(CASE WHEN total <= {LIMIT} THEN start WHEN low + {LIMIT} >= total THEN 0 ELSE low + {LIMIT} END AS BIGINT) AS start FROM x_bounds""")
def seed_cursor_next(spark, sf):
    return seeds.next_starts(seeds.enabled_seeds(ops.all_seeds(spark, sf)), _starts(spark), LIMIT)


@query("selected_counts", "SELECT seed_type, count(*) AS selected FROM x_slice GROUP BY 1")
def selected_counts(spark, sf):
    from gripelode.operators.observe import selected_counts as counts

    return counts(seeds.seed_slice(seeds.enabled_seeds(ops.all_seeds(spark, sf)), _starts(spark), LIMIT))


# 60 places, 15 of them for apps with a second-store id; the third slice adds nothing when both are filled.
cte("x_apps", "SELECT * FROM x_seeds WHERE seed_type = 'apps' AND enabled")
cte("x_picked", """
  SELECT 0 AS prio, pos, name, play_id, apple_id FROM (SELECT *, row_number() OVER (ORDER BY pos) - 1 AS rn FROM x_apps WHERE apple_id <> '') WHERE rn BETWEEN 5 AND 19
  UNION ALL SELECT 1, pos, name, play_id, apple_id FROM (SELECT *, row_number() OVER (ORDER BY pos) - 1 AS rn FROM x_apps WHERE apple_id = '') WHERE rn < 45""")


def _picked(spark, sf):
    apps = seeds.enabled_seeds(ops.all_seeds(spark, sf)).where(F.col("seed_type") == "apps")
    return seeds.select_apps(apps, 60, 15, {"apple": 5})


@query("select_apps", "SELECT prio, pos, name, play_id, apple_id FROM x_picked")
def select_apps(spark, sf):
    return _picked(spark, sf).select("prio", "pos", "name", "play_id", "apple_id")


@query("app_breakdown", """
SELECT count(*) FILTER (apple_id <> '') AS with_apple_id, count(*) FILTER (play_id <> '') AS with_play_id, count(*) FILTER (apple_id <> '' AND play_id <> '') AS both,
  count(*) FILTER (apple_id <> '' AND play_id = '') AS apple_only, count(*) FILTER (apple_id = '' AND play_id <> '') AS play_only FROM x_picked""")
def app_breakdown(spark, sf):
    return seeds.app_breakdown(_picked(spark, sf))


@query("seed_summary", "SELECT count(*) AS rows, count(*) FILTER (apple_id <> '') AS with_store_id, count(*) FILTER (enabled) AS enabled_rows FROM x_seeds WHERE seed_type = 'apps'")
def seed_summary(spark, sf):
    return seeds.seed_summary(seeds.app_seeds(ops.app_rows(spark, sf)))


@query("seed_cross", f"""
SELECT p_name || ' ' || p_partkey || ' ' || verb || ' ' || domain AS query FROM part, (SELECT unnest({S.arr(lx.JOB_VERBS)}) AS verb), (SELECT unnest({S.arr(lx.JOB_DOMAINS)}) AS domain)""")
def seed_cross(spark, sf):
    names = table(spark, sf, "part").select(F.concat_ws(" ", "p_name", "p_partkey").alias("task"))
    return seeds.phrase_product(names, "task", lx.JOB_VERBS, lx.JOB_DOMAINS).select("query")


@query("seed_cross_store", f"""
SELECT s_name || ' ' || term || ' ' || suffix AS query FROM supplier, (SELECT unnest({S.arr(lx.STORE_QUERY_TERMS)}) AS term), (SELECT unnest({S.arr(lx.STORE_QUERY_SUFFIXES)}) AS suffix)""")
def seed_cross_store(spark, sf):
    """Store searches for every supplier: each search term with each suffix."""
    return seeds.phrase_product(table(spark, sf, "supplier"), "s_name", lx.STORE_QUERY_TERMS, lx.STORE_QUERY_SUFFIXES).select("query")


cte("x_topics", f"SELECT p_partkey, p_name || ' ' || ({S.arr(lx.JOB_TASKS)})[p_partkey % 21 + 1] || ' ' || ({S.arr(lx.JOB_DOMAINS)})[p_partkey % 14 + 1] AS query FROM part")


def _topics(spark, sf):
    from gripelode.sources.tables import pick

    p = F.col("p_partkey")
    return table(spark, sf, "part").select("p_partkey", F.concat_ws(" ", "p_name", pick(lx.JOB_TASKS, p % 21), pick(lx.JOB_DOMAINS, p % 14)).alias("query"))


@query("category_map", "SELECT p_partkey, query, CASE " + " ".join(f"WHEN contains(lower(query), '{t}') THEN '{c}'" for t, c in lx.JOB_CATEGORY_RULES) + " ELSE 'Operations' END AS category FROM x_topics")
def category_map(spark, sf):
    return _topics(spark, sf).select("p_partkey", "query", seeds.query_category(F.col("query")).alias("category"))


@query("seed_shuffle", "SELECT q AS query, row_number() OVER (ORDER BY sha256('42|' || q), q) - 1 AS shuffle_rank FROM (SELECT query || ' ' || p_partkey AS q FROM x_topics)")
def seed_shuffle(spark, sf):
    queries = _topics(spark, sf).select(F.concat_ws(" ", "query", "p_partkey").alias("query"))
    return seeds.shuffled(queries, "query").select("query", F.col("shuffle_rank").cast("long").alias("shuffle_rank"))


cte("x_communities", """
  SELECT c_custkey, lower(CASE c_custkey % 5 WHEN 0 THEN c_name WHEN 1 THEN c_mktsegment || '_' || c_custkey WHEN 2 THEN 'é' || c_mktsegment WHEN 3 THEN '' ELSE c_mktsegment END) AS name,
    CASE WHEN c_custkey % 7 = 0 THEN true WHEN c_custkey % 7 < 4 THEN false END AS over18 FROM customer""")


@query("valid_communities", "SELECT c_custkey, name FROM x_communities WHERE c_custkey % 5 NOT IN (0, 3) AND over18 IS NOT TRUE")
def valid_communities(spark, sf):
    c = F.col("c_custkey")
    name = F.lower(
        F.when(c % 5 == 0, F.col("c_name")).when(c % 5 == 1, F.concat("c_mktsegment", F.lit("_"), c)).when(c % 5 == 2, F.concat(F.lit("é"), "c_mktsegment"))
        .when(c % 5 == 3, "").otherwise(F.col("c_mktsegment"))
    )
    found = table(spark, sf, "customer").select("c_custkey", name.alias("name"), F.when(c % 7 == 0, True).when(c % 7 < 4, False).alias("over18"))
    return found.where(seeds.valid_community(F.col("name"), F.col("over18"))).select("c_custkey", "name")


@query("store_id_match", "SELECT p_name || ' ' || p_partkey AS query_name, p_partkey || '-' || CASE p_partkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 0 ELSE 2 END AS store_id FROM part")
def store_id_match(spark, sf):
    return seeds.store_id_match(ops.search_results(spark, sf))


MIN_ROWS = 5000
cte("x_fallback", "SELECT * FROM (VALUES " + ", ".join(f"({i}, {S.q(n)}, {S.q(c)})" for i, (n, c) in enumerate(lx.FALLBACK_PRODUCTS)) + ") t(pos, name, category)")
cte("x_kept", """
  SELECT 0 AS prio, pos, product_name, url, category, enabled FROM (
    SELECT s_suppkey AS pos, CASE WHEN product_name = '' THEN 'Unknown Product' ELSE product_name END AS product_name, url, coalesce(nullif(category, ''), 'Unknown') AS category,
      CASE WHEN enabled THEN '1' ELSE '0' END AS enabled, row_number() OVER (PARTITION BY lower(url) ORDER BY s_suppkey) AS rn FROM x_market_seeds) WHERE rn = 1""")
cte("x_app_names", """
  SELECT * FROM (SELECT 1 AS prio, pos, name, category, CASE WHEN enabled THEN '1' ELSE '0' END AS enabled, row_number() OVER (PARTITION BY lower(name) ORDER BY pos) AS rn
  FROM x_seeds WHERE seed_type = 'apps') WHERE rn = 1""")
cte("x_names", f"""
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lower(name) ORDER BY prio, pos) AS nn FROM (
    SELECT prio, pos, name, category, enabled FROM x_app_names
    UNION ALL SELECT 2, pos, name, category, '1' FROM x_fallback WHERE (SELECT count(*) FROM x_app_names) < {MIN_ROWS})) WHERE nn = 1""")


@query("meta_seed_merge", f"""
SELECT prio, pos, product_name, url, category, enabled FROM x_kept
UNION ALL SELECT prio, pos, name, url, category, enabled FROM (
  SELECT *, row_number() OVER (ORDER BY prio, pos) AS place FROM (
    SELECT prio, pos, name, 'https://market.example/search?query=' || replace(url_encode(name), '%20', '+') AS url, category, enabled FROM x_names)
  WHERE lower(url) NOT IN (SELECT lower(url) FROM x_kept)) WHERE place <= {MIN_ROWS} - (SELECT count(*) FROM x_kept)""")
def meta_seed_merge(spark, sf):
    return seeds.merge_market_seeds(*_to_merge(spark, sf), MARKET, MIN_ROWS)


@query("meta_seed_merge_all", """
SELECT prio, pos, product_name, url, category, enabled FROM x_kept
UNION ALL SELECT prio, pos, name, url, category, enabled FROM (
  SELECT *, row_number() OVER (PARTITION BY lower(name) ORDER BY prio, pos) AS nn, 'https://market.example/search?query=' || replace(url_encode(name), '%20', '+') AS url FROM (
    SELECT prio, pos, name, category, enabled FROM x_app_names UNION ALL SELECT 2, pos, name, category, '1' FROM x_fallback))
WHERE nn = 1 AND lower(url) NOT IN (SELECT lower(url) FROM x_kept)""")
def meta_seed_merge_all(spark, sf):
    """The merge without a number to fill up to: no row is cut."""
    return seeds.merge_market_seeds(*_to_merge(spark, sf), MARKET)


MARKET = "https://market.example/search?query="


def _to_merge(spark, sf):
    fallback = spark.createDataFrame([(i, n, c, True) for i, (n, c) in enumerate(lx.FALLBACK_PRODUCTS)], "pos bigint, name string, category string, enabled boolean")
    return seeds.market_seeds(table(spark, sf, "supplier")), seeds.app_seeds(ops.app_rows(spark, sf)), fallback
