"""DuckDB SQL text for the checks, written from the rules and not from the Spark code."""

from __future__ import annotations

from gripelode import lexicon as lx
from gripelode.plans.registry import cte
from gripelode.sources.tables import COUNTRIES, PHRASES, SUFFIX

WS = r"[\s\x0b\x1c-\x1f\x{85}\pZ]"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def arr(words) -> str:
    return "[" + ", ".join(q(w) for w in words) + "]"


def clean(x: str) -> str:
    return f"trim(regexp_replace(replace(coalesce({x}, ''), chr(0), ' '), '{WS}+', ' ', 'g'))"


def norm(x: str) -> str:
    return f"trim(regexp_replace(lower(coalesce({x}, '')), '{WS}+', ' ', 'g'))"


def strip_html(x: str) -> str:
    out = f"regexp_replace({clean(x)}, '<[^>]+>', ' ', 'g')"
    for name, char in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("#39", "'"), ("middot", "·"), ("copy", "©"), ("amp", "&")):
        out = f"replace({out}, '&{name};', {q(char)})"
    return clean(out)


def tokens(x: str) -> str:
    return f"list_filter(regexp_extract_all({norm(x)}, '[a-z0-9]+'), lambda t: length(t) > 2)"


def terms(x: str) -> str:
    return f"list_filter({tokens(x)}, lambda t: NOT list_contains({arr(lx.STOPWORDS)}, t))"


def hits(x: str, words) -> str:
    return "(" + " + ".join(f"(length({x}) - length(replace({x}, {q(w)}, ''))) // {len(w)}" for w in words) + ")"


def sentiment(x: str) -> str:
    return f"({hits(x, lx.POSITIVE_WORDS)} - {hits(x, lx.NEGATIVE_WORDS)})"


def has(x: str, words) -> str:
    return "(" + " OR ".join(f"contains({x}, {q(w)})" for w in words) + ")"


def pain(x: str) -> str:
    return has(f"lower({x})", lx.PAIN_PHRASES)


def match(x: str, query: str) -> str:
    wanted = f"list_filter(regexp_split_to_array(lower({clean(query)}), '[^a-z0-9]+'), lambda t: length(t) >= 3)"
    return f"len(list_filter({wanted}, lambda t: contains(lower({clean(x)}), t)))"


def job(x: str) -> str:
    low = f"lower({x})"
    return f"({pain(x)} OR ({has(low, lx.JOB_WILLINGNESS_TERMS)} AND {has(low, lx.JOB_INEFFICIENCY_TERMS)}))"


def mobile(x: str, rating: str = "rating") -> str:
    return f"(coalesce({rating} <= 2, false) AND {pain(x)})"


def community(x: str) -> str:
    return f"({pain(x)} AND {sentiment(f'lower({x})')} <= -1)"


def market(x: str, source: str, rating: str = "rating") -> str:
    easy = f"({has(f'lower({x})', lx.MARKET_TERMS)} OR coalesce({rating} <= 3.5, false) OR length({x}) >= 120)"
    return f"(coalesce({rating} <= 2, false) OR {pain(x)} OR ({source} IN ('g2', 'capterra') AND {easy}))"


def forum(x: str, query: str) -> str:
    s = clean(x)
    return (f"(length({s}) >= 80 AND {match(x, query)} > 0 AND ({pain(s)} OR {has(f'lower({s})', lx.FORUM_PROBLEM_TERMS)}) "
            f"AND {sentiment(f'lower({s})')} <= 2)")


def launch(x: str, query: str) -> str:
    s = clean(x)
    return f"(length({s}) >= 80 AND {match(x, query)} > 0 AND {pain(s)} AND {sentiment(f'lower({s})')} <= 0)"


def let(value: str, name: str, body: str) -> str:
    return f"list_transform([{value}], lambda {name}: {body})[1]"


def title(x: str) -> str:
    c = r"\p{Lu}\p{Ll}\p{Lt}"
    head = "CASE r[1] WHEN 'ß' THEN 'Ss' ELSE upper(r[1]) END"
    return f"array_to_string(list_transform(regexp_extract_all({x}, '[{c}]+|[^{c}]+'), lambda r: {head} || lower(r[2:])), '')"


def location(x: str) -> str:
    ends = " OR ".join(f"p LIKE '%{s}'" for s in lx.LOCATION_SUFFIXES)
    near = let("regexp_extract_all(p, '[a-z]+')", "w", f"len(w) BETWEEN 1 AND 3 AND list_has_any(w, {arr(lx.LOCATIONS)})")
    known = f"p <> '' AND (list_contains({arr(lx.LOCATIONS)}, p) OR {ends} OR list_contains({arr(lx.LOCATION_CODES)}, p) OR {near})"
    return let(let(norm(x), "n", "CASE WHEN n LIKE 'r/%' THEN substring(n, 3) ELSE n END"), "p", known)


def tag(x: str) -> str:
    flat = f"trim(regexp_replace(trim(regexp_replace(coalesce({x}, ''), '[/_]+', ' ', 'g'), ' ,;'), '{WS}+', ' ', 'g'))"
    shown = let("trim(left(f, 40))", "s", f"CASE WHEN s = lower(s) THEN {title('s')} ELSE s END")
    dropped = f"f = '' OR list_contains({arr(lx.GENERIC_TAGS)}, lower(f)) OR {location('f')}"
    return let(flat, "f", f"CASE WHEN {dropped} THEN '' ELSE {shown} END")


def iso(ts: str) -> str:
    return (f"(strftime({ts}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN epoch_us({ts}) % 1000000 = 0 THEN '' "
            f"ELSE '.' || lpad(CAST(epoch_us({ts}) % 1000000 AS VARCHAR), 6, '0') END || '+00:00')")


def fp(source, item, entity, reviewer, comment, posted) -> str:
    parts = [f"lower(trim({c}))" for c in (source, item, entity, reviewer)]
    return f"sha256({' || chr(124) || '.join([*parts, f'lower({clean(comment)})', f'lower(trim({posted}))'])})"


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


cte("x_base", f"""
  SELECT event_id, ({arr(lx.SOURCE_LABELS)})[event_id % 8 + 1] AS source,
         'it' || CASE WHEN event_id % 23 = 0 THEN event_id - 8 ELSE event_id END AS source_item_id,
         CAST(entity AS VARCHAR) AS entity_id, p_brand AS entity_name,
         CASE WHEN event_id % 17 = 0 THEN 'Unknown' WHEN event_id % 19 = 0 THEN 'india' ELSE lower(p_type) END AS category,
         'user' || user_id AS reviewer_name,
         CASE WHEN event_id % 11 <> 0 THEN CAST(1 + event_id % 5 AS DOUBLE) END AS rating,
         ({arr(PHRASES)})[CAST((event_id + CAST(floor(value) AS BIGINT)) % 10 AS BIGINT) + 1] || p_name || ' ' || event_type
           || CASE WHEN event_id % 3 = 0 THEN {q(SUFFIX)} ELSE '' END AS comment_text,
         ts AS posted_ts, {iso('ts')} AS posted_at, 'https://x.example/' || event_id AS url,
         ({arr(COUNTRIES)})[event_id % 5 + 1] AS country, 'en' AS language,
         ts + INTERVAL 1 HOUR AS scraped_at,
         CASE WHEN event_id % 4 = 0 THEN ts + INTERVAL 2 HOUR END AS enriched_at
  FROM (SELECT e.*, user_id % parts AS entity FROM events e, (SELECT count(*) AS parts FROM part)) JOIN part ON p_partkey = entity""")
cte("x_reviews", f"""
  SELECT *, {fp('source', 'source_item_id', 'entity_id', 'reviewer_name', 'comment_text', 'posted_at')} AS fingerprint FROM x_base""")
cte("x_copies", """
  SELECT r.* EXCLUDE (scraped_at), r.scraped_at + to_days(CAST(c.copy - 1 AS INTEGER)) AS scraped_at, c.copy,
         event_id * 2 + c.copy AS ingest_seq
  FROM x_reviews r JOIN (SELECT 1 AS copy UNION ALL SELECT 2) c ON c.copy = 1 OR event_id % 13 = 0""")
cte("x_tagged", f"""
  SELECT *, coalesce(nullif({tag('category')}, ''), nullif({tag('entity_name')}, '')) AS tag, {terms('comment_text')} AS terms
  FROM x_reviews WHERE trim(comment_text) <> ''""")
cte("x_keyed", f"""
  SELECT *, {norm("coalesce(tag, 'General')")} || '::' || array_to_string(list_sort(list_distinct(terms[1:3])), '-') AS raw_key
  FROM x_tagged WHERE len(terms) > 0""")
cte("x_counts", "SELECT raw_key, split_part(raw_key, '::', 1) AS domain, count(*) AS n FROM x_keyed GROUP BY 1, 2")
cte("x_map", """
  SELECT raw_key, n, CASE WHEN n >= 2 THEN raw_key WHEN sum(n) FILTER (n < 2) OVER (PARTITION BY domain) >= 2 THEN domain || '::merged' END AS cluster_key
  FROM x_counts""")
cte("x_clustered", "SELECT k.*, m.cluster_key FROM x_keyed k JOIN x_map m USING (raw_key) WHERE m.cluster_key IS NOT NULL")
cte("x_stats", f"""
  SELECT cluster_key, count(*) AS n, list_sort(list(DISTINCT source)) AS sources, count(DISTINCT source) AS source_count,
         coalesce(avg(rating), 2.0) AS avg_rating, {big(f"sum({hits('lower(comment_text)', lx.WILLINGNESS_CUES)})")} AS cue_hits,
         max(scraped_at) AS last_scraped_at
  FROM x_clustered GROUP BY 1""")
cte("x_occurrences", """
  SELECT cluster_key, posted_ts, fingerprint, generate_subscripts(terms, 1) AS pos, unnest(terms) AS term FROM x_clustered""")
cte("x_occ_ranked", """
  SELECT cluster_key, term, row_number() OVER (PARTITION BY cluster_key ORDER BY posted_ts NULLS LAST, fingerprint, pos) AS seq FROM x_occurrences""")
cte("x_top_terms", """
  SELECT cluster_key, term, hits, rank FROM (
    SELECT cluster_key, term, count(*) AS hits, row_number() OVER (PARTITION BY cluster_key ORDER BY count(*) DESC, min(seq)) AS rank
    FROM x_occ_ranked GROUP BY 1, 2) WHERE rank <= 6""")
cte("x_term_lists", "SELECT cluster_key, list(term ORDER BY rank) AS top_terms FROM x_top_terms GROUP BY 1")
cte("x_domains", """
  SELECT cluster_key, coalesce(arg_min(tag, rn) FILTER (tag IS NOT NULL), 'Operations') AS domain FROM (
    SELECT cluster_key, tag, row_number() OVER (PARTITION BY cluster_key ORDER BY posted_ts NULLS LAST, fingerprint) AS rn FROM x_clustered)
  WHERE rn <= 6 GROUP BY 1""")
cte("x_scored_rows", f"""
  SELECT *, {hits('lower(comment_text)', lx.NEGATIVE_WORDS)} * 1.4e0 + {hits('lower(comment_text)', lx.WILLINGNESS_CUES)} * 1.1e0
         + least(2.5e0, length(comment_text) / 220e0) + CASE WHEN rating <= 2 THEN 2e0 WHEN rating <= 3 THEN 1e0 ELSE 0e0 END AS support_score
  FROM x_clustered""")
cte("x_repeats", """
  SELECT *, row_number() OVER (PARTITION BY cluster_key, source_item_id ORDER BY support_score DESC, posted_ts NULLS LAST, fingerprint) > 1 AS is_repeat
  FROM x_scored_rows""")
cte("x_support", """
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cluster_key ORDER BY is_repeat, support_score DESC, posted_ts NULLS LAST, fingerprint) AS support_rank
  FROM x_repeats) WHERE support_rank <= 14""")
cte("x_labeled", """
  SELECT *, least(100e0, cue_hits * 10e0 + least(60, n) * 0.9e0 + source_count * 8e0) AS hw,
         least(0.95e0, 0.45e0 + least(0.35e0, n * 0.03e0) + least(0.15e0, source_count * 0.04e0)) AS conf
  FROM x_stats""")
cte("x_scores", """
  SELECT *, CASE WHEN hw < 35 THEN 'low' WHEN hw < 70 THEN 'medium' ELSE 'high' END AS willingness_signal,
         greatest(hw, CASE WHEN hw < 35 THEN 30e0 WHEN hw < 70 THEN 55e0 ELSE 78e0 END) AS will FROM x_labeled""")
cte("x_final", """
  SELECT *, least(100e0, greatest(0e0, base + CASE least(6, source_count) WHEN 1 THEN 0e0 WHEN 2 THEN 10e0 WHEN 3 THEN 18e0 WHEN 4 THEN 24e0 WHEN 5 THEN 30e0 ELSE 35e0 END)) AS boosted
  FROM (SELECT *, least(100e0, 30e0 + least(45e0, n * 4e0) + least(18e0, source_count * 5.5e0) + will * 0.12e0 + conf * 12e0) AS base FROM x_scores)""")
cte("x_described", """
  SELECT f.*, t.top_terms, d.domain, sha1(f.cluster_key)[:16] AS cluster_id,
         CASE WHEN avg_rating <= 1.6e0 OR n >= 10 THEN 'high' WHEN avg_rating <= 2 OR n >= 5 THEN 'medium' ELSE 'low' END AS impact_label,
         CASE WHEN n >= 10 THEN 'high' WHEN n >= 5 THEN 'medium' ELSE 'low' END AS frequency_label,
         CASE willingness_signal WHEN 'high' THEN '$49-$199/mo per team' WHEN 'medium' THEN '$19-$79/mo per team' ELSE '$9-$29/mo starter' END AS pricing_hint,
         CASE WHEN boosted < 60 THEN 'Easy' WHEN boosted < 80 THEN 'Medium' ELSE 'Hard' END AS difficulty
  FROM x_final f JOIN x_term_lists t USING (cluster_key) JOIN x_domains d USING (cluster_key)""")
cte("x_told", """
  SELECT *, domain || ' users repeatedly report issues around ' || array_to_string(top_terms[:3], ', ')
           || ', causing delays, rework, and poor trust in existing tools.' AS pain_point,
         'Based on ' || n || ' negative complaints across ' || source_count || ' source(s) (' || array_to_string(sources, ', ')
           || '). Recurring signals center on: ' || array_to_string(top_terms[:5], ', ') || '.' AS reasoning,
         'Build a focused ' || domain || ' operations assistant that detects and resolves ' || array_to_string(top_terms[:2], ', ')
           || ' failures early, adds proactive alerts, and provides one-click remediation workflows.' AS suggested_solution
  FROM x_described""")
_titled = f"array_to_string(list_transform(top_terms[:2], lambda t: {title('t')}), ' ')"
_raw_tags = f"list_transform([domain] || top_terms[:3], lambda t: {tag('t')})"
cte("x_products", f"""
  SELECT *, left(domain || ' ' || {_titled} || ' Optimizer', 90) AS name,
         left('A SaaS platform that helps ' || lower(domain) || ' teams reduce issues related to ' || array_to_string(top_terms[:3], ', ')
           || ' by automating detection, prioritization, and guided resolution workflows.', 360) AS description,
         list_filter({_raw_tags}, lambda t: t <> '') AS raw_tags
  FROM x_told""")
cte("x_records", """
  SELECT *, CASE WHEN len(raw_tags) = 0 THEN 'Pain Intelligence' ELSE array_to_string(list_filter(raw_tags,
           lambda t, i: list_position(list_transform(raw_tags, lambda u: lower(u)), lower(t)) = i)[:4], ', ') END AS categories,
         sha1(cluster_id || pain_point || 'batch-1')[:24] AS candidate_id
  FROM x_products""")
