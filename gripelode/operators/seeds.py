"""Seed tables: scan, typed projection, keys, progress, selection and generation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gripelode import lexicon as lx
from gripelode.functions import text
from gripelode.operators.rank import positions
from gripelode.session import stage

SEED_COLUMNS = ["seed_type", "pos", "name", "play_id", "apple_id", "key", "category", "keywords", "enabled"]
QUERY_DEFAULTS = {"hackernews": "Startups", "producthunt": "Productivity", "upwork": "Operations"}
BUCKET = 100_000


# --- files -----------------------------------------------------------------------------------


def read_seed_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header: names cleaned and lower-cased, blank names dropped, all cells cleaned text."""
    raw = spark.read.option("header", True).option("inferSchema", False).option("escape", '"').option("multiLine", True).csv(path)
    named = {}
    for column in raw.columns:
        name = " ".join(column.replace("\0", " ").split()).lstrip("﻿").strip().strip('"').strip("'").lower()
        if name and not name.startswith("_c"):
            named[name] = text.clean(F.col(f"`{column}`"))
    return raw.select(*[c.alias(n) for n, c in named.items()])


def write_seed_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def starter_seeds(spark: SparkSession) -> dict[str, DataFrame]:
    """Small fixed starter tables by seed type, in the column layout of their files."""
    def queries(rows):
        return spark.createDataFrame([(q, "1", c) for q, c in rows], "query string, enabled string, category string")

    names = sorted(set(lx.STARTER_COMMUNITIES))
    return {
        "apps": spark.createDataFrame([(*a, "1") for a in lx.STARTER_APPS], "app_name string, play_id string, apple_id string, category string, enabled string"),
        "reddit": spark.createDataFrame([(n, "1", "|".join(lx.PAIN_PHRASES)) for n in names], "subreddit string, enabled string, keywords string"),
        "hackernews": queries(lx.STARTER_FORUM_QUERIES), "producthunt": queries(lx.STARTER_LAUNCH_QUERIES), "upwork": queries(lx.STARTER_JOB_QUERIES),
    }


# --- typed projection ------------------------------------------------------------------------


def _cell(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def _typed(df: DataFrame, seed_type: Column, enabled: Column, **cols: Column) -> DataFrame:
    blank = F.lit("")
    made = {"name": blank, "play_id": blank, "apple_id": blank, "key": blank, "keywords": blank, **cols, "seed_type": seed_type, "enabled": enabled, "pos": F.col("pos")}
    return df.select(*[made[c].alias(c) for c in SEED_COLUMNS])


def _category(df: DataFrame, default: str) -> Column:
    return text.or_default(text.clean(_cell(df, "category")), default)


def app_seeds(df: DataFrame) -> DataFrame:
    return _typed(
        df, F.lit("apps"), text.truthy(F.coalesce(_cell(df, "enabled"), F.lit("0"))), name=text.clean(_cell(df, "app_name")),
        play_id=text.clean(_cell(df, "play_id")), apple_id=text.clean(_cell(df, "apple_id")), category=_category(df, "Unknown"),
    )


def community_seeds(df: DataFrame) -> DataFrame:
    bare = F.btrim(F.lower(text.clean(_cell(df, "subreddit"))), F.lit("/"))
    keywords = text.clean(F.coalesce(_cell(df, "keywords"), F.lit("|".join(lx.PAIN_PHRASES))))
    return _typed(
        df, F.lit("reddit"), text.truthy(F.coalesce(_cell(df, "enabled"), F.lit("1"))), key=F.regexp_replace(bare, "^r/", ""),
        keywords=keywords, category=F.lit("reddit"),
    )


def marketplace_seeds(df: DataFrame, source_on: bool = True) -> DataFrame:
    """(source, product_name, url, category, enabled)"""
    return _typed(
        df, F.col("source"), F.lit(source_on) & text.truthy(F.coalesce(_cell(df, "enabled").cast("string"), F.lit("0"))),
        name=text.clean(_cell(df, "product_name")), key=text.clean(_cell(df, "url")), category=_category(df, "Unknown"),
    )


def query_seeds(df: DataFrame, seed_type: str, source_on: bool = True) -> DataFrame:
    made = _typed(
        df, F.lit(seed_type), F.lit(source_on) & text.truthy(F.coalesce(_cell(df, "enabled"), F.lit("1"))),
        key=text.clean(_cell(df, "query")), category=_category(df, QUERY_DEFAULTS[seed_type]),
    )
    return made.where(F.col("key") != "")


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def enabled_seeds(seeds: DataFrame) -> DataFrame:
    """Enabled seeds that can be run: apps always, other types with a key."""
    return seeds.where(F.col("enabled") & ((F.col("seed_type") == "apps") | (F.col("key") != "")))


def market_seeds(supplier: DataFrame) -> DataFrame:
    """Marketplace seed rows, one per supplier."""
    s = F.col("s_suppkey")
    searched = F.when(s % 6 == 0, "").otherwise(F.concat("s_name", F.lit(" a+b")))
    return supplier.select(
        F.when(s % 2 == 0, "g2").otherwise("capterra").alias("source"), F.when(s % 3 == 0, "").otherwise(F.col("s_name")).alias("product_name"),
        F.when(s % 4 == 0, "").otherwise("Sales").alias("category"), (F.col("s_acctbal") > 0).alias("enabled"), s.alias("s_suppkey"),
        F.concat(F.lit("https://market.example/search?query="), text.query_encode(searched)).alias("url"), s.alias("pos"),
    )


# --- progress --------------------------------------------------------------------------------


def seed_keys(seeds: DataFrame) -> DataFrame:
    """(seed_type, seed_key, enabled); an app gives one key per store, of equal keys the last row counts."""
    app_keys = F.array(
        F.when(F.col("play_id") != "", F.concat(F.lit("play:"), "play_id")), F.when(F.col("apple_id") != "", F.concat(F.lit("apple:"), "apple_id"))
    )
    own = F.array(F.when(F.col("key") != "", F.col("key")))
    all_keys = seeds.select("seed_type", "pos", "enabled", F.explode(F.when(F.col("seed_type") == "apps", app_keys).otherwise(own)).alias("seed_key"))
    return all_keys.where(F.col("seed_key").isNotNull()).groupBy("seed_type", "seed_key").agg(F.max_by("enabled", "pos").alias("enabled"))


def upsert_progress(progress: DataFrame, keys_: DataFrame, as_of: Column) -> DataFrame:
    """Known seeds take the new enabled flag; unknown ones start as pending."""
    new = keys_.select("seed_type", "seed_key", F.col("enabled").alias("_enabled"))
    joined = progress.withColumn("_known", F.lit(True)).join(new, ["seed_type", "seed_key"], "full_outer")
    is_new, touched = F.col("_known").isNull(), F.col("_enabled").isNotNull()
    return joined.select(
        "seed_type", "seed_key", F.coalesce("_enabled", "enabled").alias("enabled"), F.when(is_new, "pending").otherwise(F.col("status")).alias("status"),
        *[F.when(is_new, F.lit(0).cast("long")).otherwise(F.col(c)).alias(c) for c in ("total_seen", "total_inserted")],
        "last_run_at", "last_error", F.when(is_new, False).otherwise(F.col("exhausted")).alias("exhausted"),
        F.when(touched, as_of).otherwise(F.col("updated_at")).alias("updated_at"),
    )


def update_progress(progress: DataFrame, runs: DataFrame) -> DataFrame:
    """Add each seed's run counters; status, error and exhaustion come from its last run.

    ``runs``: seed_type, seed_key, run_at, run_seq, status, seen, inserted, exhausted, error.
    """
    last = F.max(F.struct("run_at", "run_seq", "status", "error", "exhausted"))
    totals = runs.groupBy("seed_type", "seed_key").agg(F.sum("seen").alias("_seen"), F.sum("inserted").alias("_inserted"), last.alias("_last"))
    joined = progress.join(totals, ["seed_type", "seed_key"], "left")
    ran = F.col("_last").isNotNull()
    return joined.select(
        "seed_type", "seed_key", "enabled", F.when(ran, F.col("_last.status")).otherwise(F.col("status")).alias("status"),
        (F.coalesce("total_seen", F.lit(0)) + F.coalesce("_seen", F.lit(0))).alias("total_seen"),
        (F.coalesce("total_inserted", F.lit(0)) + F.coalesce("_inserted", F.lit(0))).alias("total_inserted"),
        F.when(ran, F.col("_last.run_at")).otherwise(F.col("last_run_at")).alias("last_run_at"),
        F.when(ran, F.col("_last.error")).otherwise(F.col("last_error")).alias("last_error"),
        F.when(ran, F.col("_last.exhausted")).otherwise(F.col("exhausted")).alias("exhausted"),
        F.when(ran, F.col("_last.run_at")).otherwise(F.col("updated_at")).alias("updated_at"),
    )


def normalize_error_states(progress: DataFrame) -> DataFrame:
    """Errors that only mean blocked, best-effort or delisted become ``skipped``."""
    err = F.lower(F.coalesce("last_error", F.lit("")))
    skipped = (
        text.contains_any(err, lx.BLOCKED_ERROR_TEXTS) | F.col("seed_type").isin(lx.BEST_EFFORT_SEED_TYPES)
        | ((F.col("seed_type") == "apps") & text.contains_any(err, lx.APP_GONE_TEXTS))
    )
    return progress.withColumn("status", F.when((F.col("status") == "error") & skipped, "skipped").otherwise(F.col("status")))


def run_status(source: Column, inserted: Column, error: Column) -> Column:
    """Final seed status of one run from its error text and inserted rows."""
    err = F.lower(F.coalesce(error, F.lit("")))
    failed, none = err != "", inserted == 0
    base = F.when(failed, "error").otherwise("done")
    return (
        F.when((source == "play_store") & failed & none & text.contains_any(err, lx.PLAY_GONE_TEXTS), "skipped")
        .when((source == "app_store") & failed & none & text.contains_any(err, lx.APPLE_GONE_TEXTS), "skipped")
        .when((source == "reddit") & text.contains_any(err, lx.COMMUNITY_GONE_TEXTS), "skipped")
        .when((source == "upwork") & failed & none, "skipped")
        .when((source == "hacker_news") & none & ~failed, "skipped")
        .when(source.isin("product_hunt", "g2", "capterra"), F.when(none, "skipped").otherwise("done"))
        .otherwise(base)
    )


def static_exhausted(progress: DataFrame) -> DataFrame:
    static = progress.where(F.col("seed_type").isin(lx.STATIC_SEED_TYPES) & F.col("enabled"))
    return static.agg(F.count("*").alias("enabled_seeds"), F.count_if(~F.col("exhausted")).alias("remaining")).select(
        "enabled_seeds", "remaining", ((F.col("enabled_seeds") > 0) & (F.col("remaining") == 0)).alias("exhausted")
    )


# --- selection -------------------------------------------------------------------------------


def in_file_order(seeds: DataFrame, group: list[str]) -> DataFrame:
    return positions(seeds, group, [F.col("pos")], F.floor(F.col("pos") / BUCKET))


def seed_slice(seeds: DataFrame, starts: DataFrame, limit: int) -> DataFrame:
    """Next ``limit`` seeds of every type from its cursor on; a cursor past the end restarts at 0.

    ``starts``: seed_type, start. A type with no more than ``limit`` seeds is taken whole.
    """
    totals = seeds.groupBy("seed_type").agg(F.count("*").alias("_total"))
    bounds = totals.join(starts, "seed_type", "left").select(
        "seed_type", "_total", F.when(F.coalesce("start", F.lit(0)) >= F.col("_total"), 0).otherwise(F.coalesce("start", F.lit(0))).alias("_from")
    )
    ordered = in_file_order(seeds, ["seed_type"]).join(F.broadcast(bounds), "seed_type")  # one row per seed type
    whole = F.lit(limit <= 0) | (F.col("_total") <= limit)
    return ordered.where(whole | F.col("position").between(F.col("_from"), F.col("_from") + limit - 1)).drop("_total", "_from")


def next_starts(seeds: DataFrame, starts: DataFrame, limit: int) -> DataFrame:
    """Cursor of every type after a slice; 0 at the end, unchanged for types taken whole."""
    totals = seeds.groupBy("seed_type").agg(F.count("*").alias("total"))
    joined = totals.join(starts, "seed_type", "left").withColumn("start", F.coalesce("start", F.lit(0)))
    end = F.when(F.col("start") >= F.col("total"), 0).otherwise(F.col("start")) + limit
    moved = F.when(end >= F.col("total"), 0).otherwise(end)
    return joined.select("seed_type", F.when(F.col("total") <= limit, F.col("start")).otherwise(moved).cast("long").alias("start"))


def _first_by_key(df: DataFrame, key: Column, order: list[str]) -> DataFrame:
    """First row of every key; a partial aggregate, so a key with many rows is no hot group."""
    rest = [c for c in df.columns if c not in order]
    first = F.min(F.struct(*order, F.struct(*rest).alias("rest")))
    return df.groupBy(key.alias("_key")).agg(first.alias("r")).select(*[f"r.{c}" for c in order], "r.rest.*").select(*df.columns)


def select_apps(apps: DataFrame, limit: int, apple_target: int, starts: dict[str, int] | None = None) -> DataFrame:
    """Up to ``apple_target`` apps with a second-store id, then others, then any, without repeats."""
    starts = starts or {}
    key = F.concat_ws("|", F.lower("name"), "play_id", "apple_id")

    def taken(rows: DataFrame, name: str, room: Column, prio: int) -> DataFrame:
        placed = in_file_order(rows, ["seed_type"])
        total = F.coalesce(rows.agg(F.count("*")).scalar(), F.lit(0))
        start = F.when(F.lit(starts.get(name, 0)) >= total, 0).otherwise(F.lit(starts.get(name, 0)))
        cut = placed.where((room > 0) & ((room >= total) | F.col("position").between(start, start + room - 1)))
        # At most ``limit`` rows, read again by the later steps.
        return stage(_first_by_key(cut.drop("position").withColumn("prio", F.lit(prio)), key, ["prio", "pos"]), f"apps_{name}")

    with_apple = taken(apps.where(F.col("apple_id") != ""), "apple", F.lit(min(max(0, apple_target), limit)), 0)
    room = F.lit(limit) - with_apple.agg(F.count("*")).scalar()
    others = taken(apps.where(F.col("apple_id") == ""), "nonapple", room, 1)
    chosen = with_apple.unionByName(others)
    left = F.lit(limit) - chosen.agg(F.count("*")).scalar()
    rest = taken(apps, "all", left, 2)
    merged = _first_by_key(chosen.unionByName(rest), key, ["prio", "pos"])
    return merged.orderBy("prio", "pos").limit(limit)


def app_breakdown(selected: DataFrame) -> DataFrame:
    apple, play = F.col("apple_id") != "", F.col("play_id") != ""
    return selected.agg(
        F.count_if(apple).alias("with_apple_id"), F.count_if(play).alias("with_play_id"), F.count_if(apple & play).alias("both"),
        F.count_if(apple & ~play).alias("apple_only"), F.count_if(play & ~apple).alias("play_only"),
    )


# --- generation ------------------------------------------------------------------------------


def phrase_product(df: DataFrame, column: str, *vocabularies: list[str]) -> DataFrame:
    """Every phrase of ``column`` followed by one word group of each fixed vocabulary."""
    for i, vocabulary in enumerate(vocabularies):
        df = df.withColumn(f"_w{i}", F.explode(text.words(vocabulary)))
    made = F.concat_ws(" ", column, *[f"_w{i}" for i in range(len(vocabularies))])
    return df.withColumn("query", made).drop(*[f"_w{i}" for i in range(len(vocabularies))])


def query_category(query: Column) -> Column:
    """Category of the first rule whose token occurs in the query; Operations when none does."""
    low = F.lower(query)
    chain = reduce(lambda w, rule: w.when(low.contains(rule[0]), rule[1]), lx.JOB_CATEGORY_RULES, F)
    return chain.otherwise("Operations")


def shuffled(df: DataFrame, column: str, seed: int = 42) -> DataFrame:
    """Deterministic shuffle: ``shuffle_rank`` by the hash of seed and text."""
    hashed = df.withColumn("_h", F.sha2(F.concat(F.lit(f"{seed}|"), column), 256))
    bucket = F.conv(F.substring("_h", 1, 3), 16, 10).cast("int")
    return positions(hashed, [], [F.col("_h"), F.col(column)], bucket, "shuffle_rank").drop("_h")


def valid_community(name: Column, over18: Column) -> Column:
    return (name != "") & name.rlike(r"^[\p{L}\p{N}_]+$") & ~F.coalesce(over18, F.lit(False))


def store_id_match(results: DataFrame) -> DataFrame:
    """Per searched name the first result whose name contains it or is contained in it, else the first."""
    a, b = F.lower("query_name"), F.lower("track_name")
    rank = F.struct((~(b.contains(a) | a.contains(b))).alias("miss"), F.col("pos"))
    return results.groupBy("query_name").agg(F.min_by("track_id", rank).alias("store_id"))


def merge_market_seeds(existing: DataFrame, apps: DataFrame, fallback: DataFrame, url_prefix: str, min_rows: int | None = None) -> DataFrame:
    """Existing seeds, then app names, then fallback products; with ``min_rows`` only filled up to so many rows.

    ``existing``: pos, product_name, url, category, enabled; ``apps`` and ``fallback``: pos, name, category, enabled. The first
    row per name and the first per URL wins, ignoring case; ``prio`` says where a row is from, and rows follow (prio, pos).
    Existing seeds always stay. Two shuffles and, with ``min_rows``, a top-k; fallback products need no rule of their own, since
    they come last.
    """
    flag = F.when(F.col("enabled"), "1").otherwise("0")

    def rows(df: DataFrame, prio: int, name: Column, url: Column | None) -> DataFrame:
        made = df.select(
            F.lit(prio).alias("prio"), "pos", name.alias("product_name"), text.or_default(text.clean(F.col("category")), "Unknown").alias("category"), flag.alias("enabled"),
            *([url.alias("url")] if url is not None else []),
        )
        if url is not None:
            return made.withColumn("_name", F.concat(F.lit("url "), F.lower("url"))).where(F.col("url") != "")
        derived = made.withColumn("url", F.concat(F.lit(url_prefix), text.query_encode(F.col("product_name"))))
        return derived.withColumn("_name", F.concat(F.lit("name "), F.lower("product_name"))).where(F.col("product_name") != "")

    name = text.clean(F.col("name"))
    kept = rows(existing, 0, text.or_default(text.clean(F.col("product_name")), "Unknown Product"), text.clean(F.col("url")))
    every = kept.unionByName(rows(apps, 1, name, None)).unionByName(rows(fallback, 2, name, None))
    order = [F.col("prio"), F.col("pos")]
    first = every.withColumn("_place", F.row_number().over(Window.partitionBy("_name").orderBy(*order))).where("_place = 1")
    first = first.withColumn("_place", F.row_number().over(Window.partitionBy(F.lower("url")).orderBy(*order))).where("_place = 1")
    merged = first.select("prio", "pos", "product_name", "url", "category", "enabled")
    if min_rows is None:
        return merged
    merged = stage(merged, "merged")
    return merged.where("prio = 0").unionByName(merged.orderBy(*order).limit(min_rows).where("prio > 0"))


def seed_summary(apps: DataFrame) -> DataFrame:
    return apps.agg(
        F.count("*").alias("rows"), F.count_if(F.col("apple_id") != "").alias("with_store_id"), F.count_if(F.col("enabled")).alias("enabled_rows")
    )
