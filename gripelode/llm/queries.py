"""The operators' queries over whole tables, with production parameters, and the DuckDB SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gripelode.llm import centroids, decontaminate, embeddings, jaccard, licenses, lines, lm, packing, runs, sentencepiece_codec, toxicity, urls, warc

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            CHECKS[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reachable(links: str, nodes: str, node: str) -> str:
    """SQL of the smallest node reachable; ``links`` names a relation (a, b) with both directions."""
    return f"""reach AS (SELECT {node} AS node, {node} AS root FROM {nodes} UNION SELECT l.b, r.root FROM reach r JOIN {links} l ON l.a = r.node),
roots AS (SELECT node, min(root) AS component_id FROM reach GROUP BY node)"""


@query(
    "op1_ngram_jaccard",
    rf"""WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
  ELSE list_distinct(list_transform(generate_series(1, len(w) - 4), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM w),
e AS (SELECT doc_id, hash(unnest(s)) AS h FROM s),
o AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM e x JOIN e y ON x.h = y.h AND x.doc_id <> y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM o JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b WHERE 100 * n >= 80 * (len(x.s) + len(y.s) - n)),
{reachable("l", "s", "doc_id")}
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id FROM s JOIN roots ON node = doc_id""",
)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.classes(table(spark, sf_dir, "documents"), "doc_id", "text", size=5, percent=80).select("doc_id", "n_shingles", "component_id")


@query(
    "op2_embedding_dedup",
    f"""WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS v, coalesce(len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0, false) AS good FROM embeddings),
l AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.v) = len(y.v) WHERE x.good AND y.good AND list_cosine_similarity(x.v, y.v) >= 0.93),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a),
{reachable("l", "v", "vec_id")}
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept FROM v JOIN roots ON node = vec_id LEFT JOIN n ON a = vec_id""",
)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.93)


@query("op3_decontamination")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: doc_id, leaks, the items found and the best similarity."""
    docs = table(spark, sf_dir, "documents")
    found = decontaminate.leaks(docs, table(spark, sf_dir, "benchmark"))
    found = found.groupBy("doc_id").agg(F.sort_array(F.collect_set("item_id")).alias("items"), F.max("similarity").alias("similarity"))
    out = docs.select("doc_id").join(found, "doc_id", "left")
    return out.select("doc_id", F.col("items").isNotNull().alias("contaminated"), F.coalesce("items", F.array().cast("array<bigint>")).alias("item_ids"), "similarity")


BASE32 = " || ".join(
    f"substr('{warc.ALPHABET}', ((('0x' || substr(h, {1 + 5 * i}, 5))::INTEGER >> {shift}) & 31) + 1, 1)" for i in range(8) for shift in (15, 10, 5, 0)
)


@query(
    "op4_warc",
    f"""WITH p AS (SELECT page_id, coalesce(html, '') AS t, sha1(coalesce(html, '')) AS h FROM pages),
d AS (SELECT page_id, octet_length(encode(t)) AS n, {BASE32} AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest, n) AS first FROM d)
SELECT page_id, n::BIGINT AS payload_bytes, payload_digest, CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
CASE WHEN first < page_id THEN first END AS refers_to FROM f""",
)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(table(spark, sf_dir, "pages"), min_bytes=0)


HOST = r"lower(regexp_extract({0}, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1))"
PATH = r"regexp_extract({0}, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1)"
URL_SQL = rf"""WITH c AS (SELECT page_id, rtrim({HOST.format("url")}, '.') AS host, {PATH.format("url")} AS path, ts AS seen
  FROM (SELECT p.*, page_id % n AS event_id FROM pages p, (SELECT count(*) AS n FROM events)) JOIN events USING (event_id)),
p AS (SELECT page_id, rtrim({HOST.format("url")}, '.') AS host, {PATH.format("url")} AS path FROM pages),
e AS (SELECT 'list' || (user_id % 3) AS list, CASE event_id % 3 WHEN 0 THEN host WHEN 1 THEN regexp_replace(host, '^[^.]+\.', '') ELSE host || '/' || split_part(path, '/', 2) END AS pattern,
  CASE event_id % 4 WHEN 2 THEN 'allow' WHEN 3 THEN 'remove' ELSE 'block' END AS action, ts
  FROM (SELECT e.*, event_id % n AS page_id FROM events e, (SELECT count(*) AS n FROM pages)) JOIN p USING (page_id) WHERE host <> ''),
k AS (SELECT list, rtrim(pattern, './') AS pattern, ts AS f, max(action) AS action FROM e GROUP BY ALL),
i AS (SELECT list, split_part(pattern, '/', 1) AS domain, substr(pattern, length(split_part(pattern, '/', 1)) + 1) AS path, action, f, lead(f) OVER (PARTITION BY list, pattern ORDER BY f) AS t FROM k WHERE pattern <> ''),
h AS (SELECT page_id, list, arg_max(action, (length(domain) + length(i.path)) * 100000 + length(i.path)) AS action, count(*) AS n
  FROM (SELECT *, unnest(list_transform(range(1, len(l) + 1), lambda k: array_to_string(l[k:], '.'))) AS suffix FROM (SELECT *, string_split(host, '.') AS l FROM c)) c JOIN i
  ON suffix = domain AND (c.host = domain OR contains(domain, '.')) AND (i.path = '' OR c.path = i.path OR starts_with(c.path, i.path || '/')) AND seen >= f AND (t IS NULL OR seen < t)
  WHERE action <> 'remove' GROUP BY ALL),
v AS (SELECT page_id, sum(n) AS n, string_agg(list, ',' ORDER BY list) FILTER (action = 'block') AS lists FROM h GROUP BY page_id)
SELECT page_id, nullif(host, '') AS host, coalesce(n, 0)::BIGINT AS n_active, lists IS NOT NULL AS blocked, coalesce(lists, '') AS blocked_by FROM c LEFT JOIN v USING (page_id)"""


@query("op5_url_filter", URL_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captures are pages fetched at an event's time; list entries come from events about pages' hosts, domains and paths."""
    pages, events = table(spark, sf_dir, "pages").select("page_id", "url"), table(spark, sf_dir, "events")
    n = events.agg(F.count(F.lit(1)).alias("n_events")).crossJoin(pages.agg(F.count(F.lit(1)).alias("n_pages"))).first()  # two numbers
    when = events.select("event_id", F.col("ts").alias("fetched_at"))
    captures = pages.join(when, F.col("page_id") % n["n_events"] == F.col("event_id")).select("page_id", "url", "fetched_at")
    hosts = pages.select("page_id", urls.host_of(F.col("url")).alias("host"), urls.path_of(F.col("url")).alias("path")).where("host is not null")
    told = events.select("event_id", "user_id", "ts").join(hosts, F.col("event_id") % n["n_pages"] == F.col("page_id"))
    kind, act = F.col("event_id") % 3, F.col("event_id") % 4
    pattern = F.when(kind == 0, F.col("host")).when(kind == 1, F.regexp_replace("host", r"^[^.]+\.", "")).otherwise(F.concat_ws("/", "host", F.split_part("path", F.lit("/"), F.lit(2))))
    action = F.when(act == 2, "allow").when(act == 3, "remove").otherwise("block")
    entries = told.select(F.concat(F.lit("list"), (F.col("user_id") % 3).cast("string")).alias("list"), pattern.alias("pattern"), action.alias("action"), "ts")
    return urls.decide(captures, entries)


SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


@query(
    "op6_line_dedup",
    f"""WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
x AS (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS pos FROM d),
k AS (SELECT *, translate(trim(line, {SPACE}), '{UPPER}', '{LOWER}') AS key FROM x),
h AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
j AS (SELECT k.*, last IS NOT NULL AND doc_id < last AS gone FROM k LEFT JOIN h USING (key))
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256 FROM j GROUP BY doc_id""",
)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.report(table(spark, sf_dir, "documents"), min_chars=40, min_docs=5)


@query("op7_sentencepiece")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids, and whether decoding gives the text."""
    return sentencepiece_codec.encode(table(spark, sf_dir, "documents"), check=True)


@query("op8_packing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the matrices and returns the index of their lines."""
    return packing.write(table(spark, sf_dir, "documents"))


@query("op9_toxicity")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op10_lm_scoring")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.held_out_scores(table(spark, sf_dir, "documents"))


def _license_sql() -> str:
    """Every anchor word in every text proposes its template; a proposal is held against the text's words as in the operator."""
    index = licenses.build_index()
    postings = ", ".join(f"('{w}', {t}, {at})" for w, found in index.postings.items() for t, at in found)
    checks = ", ".join(f"({i}, '{c['label']}', {c['base']}, {0 if c['exact'] else licenses.SLACK}, {c['total']})" for i, c in enumerate(index.checks))
    anchors = ", ".join(f"({i}, {a['at']}, '{a['word']}', {a['weight']})" for i, c in enumerate(index.checks) for a in c["anchors"])
    phrases = ", ".join(f"({i}, {p['at']}, {p['n']}, '{p['text']}')" for i, c in enumerate(index.checks) for p in c["phrases"])
    return rf"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{licenses.SEPARATORS}'), lambda x: x <> '') AS w FROM documents),
posting(word, t, pos) AS (VALUES {postings}), checks(t, label, base, slack, total) AS (VALUES {checks}),
anchor(t, pos, word, weight) AS (VALUES {anchors}), phrase(t, pos, n, words) AS (VALUES {phrases}),
x AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS i FROM d),
p AS (SELECT DISTINCT r, t, i - pos AS start FROM x JOIN posting USING (word)),
f AS (SELECT r, t, start, sum(CASE WHEN start + pos >= 0 AND w[start + pos + 1] = word THEN weight ELSE 0 END) AS found FROM p JOIN d USING (r) JOIN anchor USING (t) GROUP BY ALL),
v AS (SELECT r, t, start, bool_and(contains(' ' || array_to_string(w[greatest(start + pos - slack, 0) + 1:greatest(start + pos + n + slack, 0)], ' ') || ' ', words)) AS good
  FROM p JOIN d USING (r) JOIN checks USING (t) JOIN phrase USING (t) GROUP BY ALL),
a AS (SELECT r, label, base, start, found / total AS part FROM f JOIN v USING (r, t, start) JOIN checks USING (t) WHERE good AND 100 * found >= {licenses.SHARE} * total),
g AS (SELECT r, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word, max(start) FILTER (base) AS last_word,
  string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(part) AS score FROM a GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score FROM d LEFT JOIN g USING (r)"""


@query("op11_license_scan", _license_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.report(table(spark, sf_dir, "documents"))


def _cluster_sql(k: int, rounds: int, dims: int) -> str:
    near = "min(ROW(x + y - 2 * list_inner_product(v, c), cluster))"
    parts = [
        f"""WITH q AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding::DOUBLE[], lambda x: floor(256 * x)) AS v FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        "k AS MATERIALIZED (SELECT r, vec_id, v, list_inner_product(v, v) AS x FROM q)",
        f"""c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h) - 1 AS cluster, v AS c, x AS y FROM (SELECT sha256('2:' || vec_id) AS h, v, x FROM k WHERE vec_id IS NOT NULL ORDER BY h LIMIT {k}))""",
    ]
    for i in range(rounds + 1):
        parts.append(f"a{i} AS MATERIALIZED (SELECT r, (m).d AS d, (m).cluster AS cluster FROM (SELECT r, {near.replace('ROW(', 'struct_pack(d := ').replace(', cluster)', ', cluster := cluster)')} AS m FROM k, c{i} GROUP BY r))")
        if i < rounds:
            parts += [
                f"""s{i} AS (SELECT cluster, j, sum(x::BIGINT) AS s, count(*) AS n FROM (SELECT cluster, unnest(v) AS x, generate_subscripts(v, 1) AS j FROM k JOIN a{i} USING (r)) GROUP BY cluster, j)""",
                f"""m{i} AS (SELECT cluster, list(((s - ((s % n) + n) % n) // n)::DOUBLE ORDER BY j) AS c FROM s{i} GROUP BY cluster)""",
                f"""c{i + 1} AS MATERIALIZED (SELECT cluster, c, list_inner_product(c, c) AS y FROM (SELECT cluster, coalesce(m{i}.c, c{i}.c) AS c FROM c{i} LEFT JOIN m{i} USING (cluster)))""",
            ]
    return ",\n".join(parts) + f"""
SELECT vec_id, cluster::INTEGER AS cluster, d::BIGINT AS distance, sum(d::BIGINT) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia, sum(d::BIGINT) OVER ()::BIGINT AS inertia,
sha256(array_to_string(list_transform(c, lambda x: x::BIGINT), ',')) AS centroid_sha256 FROM k JOIN a{rounds} USING (r) JOIN c{rounds} USING (cluster)"""


@query("op12_centroid_clusters", _cluster_sql(k=40, rounds=5, dims=64))
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"), k=40, rounds=5, dims=64, salt="2")


@query("op13_periodic_runs")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.report(table(spark, sf_dir, "documents"), planted=True)
