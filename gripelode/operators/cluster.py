"""Clustering of reviews by domain and leading terms, and per-cluster aggregates.

Row order inside a cluster is fixed to (posted_ts nulls last, fingerprint). No operator here
gathers a whole cluster: totals are partial aggregates, selections are row_number limits that
Spark applies on the map side before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gripelode import lexicon as lx
from gripelode.functions import keys, text
from gripelode.operators.skew import attach_totals
from gripelode.session import stage


def row_order() -> list[Column]:
    return [F.col("posted_ts").asc_nulls_last(), F.col("fingerprint").asc()]


def order_struct() -> Column:
    """``row_order`` as one comparable value; structs sort nulls first, hence the flag."""
    return F.struct(F.col("posted_ts").isNull().alias("late"), F.col("posted_ts"), F.col("fingerprint"))


def top_rows(df: DataFrame, key: list[str], order: list[Column], limit: int, rank: str = "rank") -> DataFrame:
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where(F.col(rank) <= limit)


def key_reviews(reviews: DataFrame) -> DataFrame:
    """Non-blank reviews with domain tag, content terms and cluster key; no terms, no key.

    Rows without a key stay in: a filter on the terms would be pushed below the projection and
    extract them twice. The grouping steps leave them out.
    """
    category, entity = (text.clean_tag(F.col(c)) for c in ("category", "entity_name"))
    key = keys.cluster_key(F.coalesce("tag", F.lit("General")), F.col("terms"))
    return (
        reviews.where("trim(comment_text) <> ''")
        .withColumns({"terms": text.content_terms(F.col("comment_text")), "tag": F.coalesce(category, entity)})
        .withColumn("raw_key", F.when(F.size("terms") > 0, key))
    )


def clusterable(keyed: DataFrame) -> DataFrame:
    return keyed.where(F.col("raw_key").isNotNull())


def cluster_counts(keyed: DataFrame) -> DataFrame:
    return keyed.groupBy("raw_key").agg(F.count("*").alias("n"))


def merge_map(counts: DataFrame, min_size: int) -> DataFrame:
    """raw_key -> cluster_key: small clusters pool per domain; pools under the minimum get NULL.

    If nothing in the whole batch survives, every raw cluster is kept as it is.
    """
    sized = counts.where(F.col("raw_key").isNotNull()).withColumn("domain", keys.key_domain(F.col("raw_key")))
    pools = sized.where(F.col("n") < min_size).groupBy("domain").agg(
        F.sum("n").alias("pool_n"), F.count("*").alias("pool_keys")
    )
    pooled = F.coalesce(F.col("pool_n") >= min_size, F.lit(False))
    pool_key = F.concat("domain", F.lit("::merged"))
    # A pool takes the place of a cluster that happens to carry its name; all other large clusters need no lookup.
    asks = (F.col("n") < min_size) | (F.col("raw_key") == pool_key)
    # The number of raw keys behind a pool, not of rows, decides how hot the domain is here.
    found = attach_totals(sized.where(asks), pools, "domain", "pool_keys", ["raw_key"])
    found = found.withColumn("merged_key", F.when(F.col("n") < min_size, F.when(pooled, pool_key)).when(~pooled, F.col("raw_key")))
    large = sized.where(~asks).withColumn("merged_key", F.col("raw_key"))
    out = found.select("raw_key", "n", "merged_key").unionByName(large.select("raw_key", "n", "merged_key"))
    kept = out.agg(F.count("merged_key")).scalar()
    return out.select("raw_key", "n", F.when(kept == 0, F.col("raw_key")).otherwise(F.col("merged_key")).alias("cluster_key"))


def merge_small_clusters(keyed: DataFrame, min_size: int) -> DataFrame:
    """Reviews with their final cluster key; rows of dropped pools are left out."""
    # Staged, every text is taken apart once for both the counts and the rows.
    keyed = stage(keyed, "keyed")
    counts = stage(cluster_counts(keyed), "cluster_counts")
    # Staged, the map has a known size, so Spark broadcasts it when it is small enough.
    mapping = stage(merge_map(counts, min_size), "cluster_map")
    sized = attach_totals(keyed, mapping, "raw_key", "n", ["fingerprint"])
    return sized.where(F.col("cluster_key").isNotNull()).drop("n")


def cue_hits(c: Column) -> Column:
    return text.count_all(F.lower(text.text_of(c)), lx.WILLINGNESS_CUES)


def cluster_totals(clustered: DataFrame) -> DataFrame:
    """Size, sources, mean rating and willingness cues per cluster in one partial aggregation."""
    return clustered.groupBy("cluster_key").agg(
        F.count("*").alias("n"),
        # Bounded by the number of source labels.
        F.array_sort(F.collect_set(F.nullif(F.col("source"), F.lit("")))).alias("sources"),
        F.coalesce(F.avg("rating"), F.lit(2.0)).alias("avg_rating"),
        F.sum(cue_hits(F.col("comment_text"))).alias("cue_hits"),
        F.max("scraped_at").alias("last_scraped_at"),
    ).withColumn("source_count", F.greatest(F.size("sources"), F.lit(1)))


def top_terms(clustered: DataFrame, limit: int = 6) -> DataFrame:
    """Most frequent content terms per cluster; ties go to the first occurrence in row order.

    Counts and first times have a fixed width, so all terms are counted by hash and not sorted. Only rows of the times at
    which terms of the same count begin are looked at again for their place.
    """
    times = [F.col("hits").desc(), F.col("first_ts").asc_nulls_last()]
    found = clustered.select("cluster_key", "posted_ts", F.explode("terms").alias("term"))
    counted = found.groupBy("cluster_key", "term").agg(F.count("*").alias("hits"), F.min("posted_ts").alias("first_ts"))
    best = counted.withColumn("_rank", F.rank().over(Window.partitionBy("cluster_key").orderBy(*times))).where(F.col("_rank") <= limit)
    best = stage(best.drop("_rank"), "best_terms")
    tied = best.groupBy("cluster_key", "hits", "first_ts").agg(F.count("*").alias("_n")).where("_n > 1").select("cluster_key", "first_ts").distinct()
    at = F.col("r.cluster_key").eqNullSafe(F.col("t.cluster_key")) & F.col("r.posted_ts").eqNullSafe(F.col("t.first_ts"))
    rows = clustered.select("cluster_key", "posted_ts", "fingerprint", "terms").alias("r").join(tied.alias("t"), at, "left_semi")
    places = rows.select("cluster_key", F.col("posted_ts").alias("first_ts"), "fingerprint", F.posexplode("terms").alias("pos", "term"))
    same = F.col("b.cluster_key").eqNullSafe(F.col("p.cluster_key")) & (F.col("b.term") == F.col("p.term"))
    places = places.alias("p").join(best.alias("b"), same & F.col("b.first_ts").eqNullSafe(F.col("p.first_ts")), "left_semi")
    places = places.groupBy("cluster_key", "term").agg(F.min(F.struct("fingerprint", "pos")).alias("first"))
    placed = best.alias("b").join(places.alias("p"), same, "left").select("b.*", "p.first")
    return top_rows(placed, ["cluster_key"], [*times, F.col("first").asc()], limit).select("cluster_key", "rank", "term", "hits")


def top_term_lists(ranked: DataFrame) -> DataFrame:
    listed = F.array_sort(F.collect_list(F.struct("rank", "term")))
    return ranked.groupBy("cluster_key").agg(F.transform(listed, lambda s: s["term"]).alias("top_terms"))


def cluster_domain(clustered: DataFrame) -> DataFrame:
    """Display domain: first clean tag among the first six rows, else Operations."""
    head = top_rows(clustered.select("cluster_key", "tag", "posted_ts", "fingerprint"), ["cluster_key"], row_order(), 6)
    first = F.min(F.when(F.col("tag").isNotNull(), F.struct("rank", "tag")))
    return head.groupBy("cluster_key").agg(F.coalesce(first["tag"], F.lit("Operations")).alias("domain"))


def support_score(comment: Column, rating: Column) -> Column:
    bonus = F.when(rating <= 2.0, 2.0).when(rating <= 3.0, 1.0).otherwise(0.0)

    def wording(txt: Column) -> Column:
        low = F.lower(txt)
        return (
            text.count_all(low, lx.NEGATIVE_WORDS) * F.lit(1.4) + text.count_all(low, lx.WILLINGNESS_CUES) * F.lit(1.1)
            + F.least(F.lit(2.5), F.length(txt) / F.lit(220.0))
        )

    return text.let(text.strip(text.text_of(comment)), wording) + bonus


def support_rows(clustered: DataFrame, limit: int) -> DataFrame:
    """Best ``limit`` rows per cluster: one per item id first, then repeats, each by score.

    Repeats of an item past the limit can never be selected, so the first step may drop them; a
    blank item id never counts as a repeat.
    """
    scored = clustered.withColumn("support_score", support_score(F.col("comment_text"), F.col("rating"))).withColumn(
        "item", text.strip(text.text_of(F.col("source_item_id")))
    )
    by_score = [F.col("support_score").desc(), *row_order()]
    per_item = top_rows(scored, ["cluster_key", "item"], by_score, limit, "item_rank")
    per_item = per_item.withColumn("is_repeat", (F.col("item_rank") > 1) & (F.col("item") != ""))
    return top_rows(per_item, ["cluster_key"], [F.col("is_repeat").asc(), *by_score], limit, "support_rank").drop("item", "item_rank")
