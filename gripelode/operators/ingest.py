"""Insert-if-new, duplicate removal, cursors and batch selection over the reviews table.

Upserts are anti-join plus union: the result is a new table version, never an overwrite of
the path being read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gripelode.functions import gates, keys, text
from gripelode.operators.rank import slice_rows
from gripelode.operators.skew import salted_lookup

REVIEW_COLUMNS = [
    "source", "source_item_id", "entity_id", "entity_name", "category", "reviewer_name", "rating", "comment_text",
    "posted_at", "url", "country", "language", "fingerprint", "scraped_at", "raw_json", "enriched_at",
]


def canonical(df: DataFrame, scraped_at: Column) -> DataFrame:
    """Normalised source rows in the shape of the reviews table, with their fingerprint."""
    names = ["source", "source_item_id", "entity_id", "entity_name", "category", "reviewer_name", "comment_text", "posted_at", "url", "country", "language"]
    cleaned = text.with_clean(df.select(*names, F.col("rating").cast("double").alias("rating"), "raw_json"), names)
    cleaned = cleaned.withColumns({"category": text.or_default(F.col("category"), "Unknown"), "language": text.or_default(F.col("language"), "en")})
    fp = keys.clean_fingerprint(*[F.col(c) for c in ("source", "source_item_id", "entity_id", "reviewer_name", "comment_text", "posted_at")])
    return (
        cleaned.withColumn("fingerprint", fp).withColumn("scraped_at", scraped_at)
        .withColumn("enriched_at", F.lit(None).cast("timestamp_ntz")).select(*REVIEW_COLUMNS)
    )


def newest_per_fingerprint(df: DataFrame, seq: str = "ingest_seq") -> DataFrame:
    """The latest crawl of every fingerprint; ``seq`` breaks ties."""
    return _one_per_fingerprint(df, [F.col("scraped_at").desc(), F.col(seq).desc()])


def first_per_fingerprint(df: DataFrame, order: list[str]) -> DataFrame:
    return _one_per_fingerprint(df, [F.col(c).asc() for c in order])


def _one_per_fingerprint(df: DataFrame, order: list[Column]) -> DataFrame:
    """Spark applies the limit of one before the shuffle too, so a review that was crawled very often is no hot group."""
    return cap_per_seed(df, ["fingerprint"], order, 1).select(*df.columns)


def insert_if_new(incoming: DataFrame, existing: DataFrame, order: list[str]) -> DataFrame:
    """Incoming rows whose fingerprint is new; of several equal ones the first by ``order``."""
    return first_per_fingerprint(incoming, order).join(existing.select("fingerprint"), "fingerprint", "left_anti")


def duplicate_report(df: DataFrame) -> DataFrame:
    sizes = df.groupBy("fingerprint").agg(F.count("*").alias("n"))
    return sizes.agg(
        F.sum("n").alias("total_before"), F.count("*").alias("total_after"), (F.sum("n") - F.count("*")).alias("purged"),
        F.max("n").alias("most_copies"),
    )


def cursor_filter(rows: DataFrame, cursors: DataFrame, key: Column) -> DataFrame:
    """Rows newer than their cursor; rows without a time or without a cursor pass."""
    seen = cursors.select(F.col("cursor_key").alias("_key"), keys.parse_time(F.col("cursor_value")).alias("_cursor"))
    joined = salted_lookup(rows.withColumn("_row_key", key), seen, "_row_key", "_key", ["posted_ts"])
    return joined.where(gates.after_cursor(F.col("posted_ts"), F.col("_cursor"))).drop("_row_key", "_key", "_cursor")


def cursor_advance(inserted: DataFrame, prefix: str, item: str, country: str) -> DataFrame:
    """Newest inserted time per item and country, and per item under ``:max``."""
    dated = inserted.where(F.col("posted_ts").isNotNull())
    newest = dated.groupingSets([[F.col(item), F.col(country)], [F.col(item)]], item, country).agg(
        F.max("posted_ts").alias("newest"), F.grouping(country).alias("all_countries")
    )
    part = F.when(F.col("all_countries") == 1, "max").otherwise(F.lower(country))
    return newest.select(
        F.concat_ws(":", F.lit(prefix), F.col(item), part).alias("cursor_key"), keys.iso_utc(F.col("newest")).alias("cursor_value")
    )


def cursor_upsert(current: DataFrame, new: DataFrame, updated_at: Column) -> DataFrame:
    """New values replace old ones, but a cursor never moves backwards."""
    old = current.select("cursor_key", F.col("cursor_value").alias("_old"), F.col("updated_at").alias("_old_at"))
    joined = old.join(new.select("cursor_key", F.col("cursor_value").alias("_new")), "cursor_key", "full_outer")
    old_ts, new_ts = keys.parse_time(F.col("_old")), keys.parse_time(F.col("_new"))
    advanced = F.col("_new").isNotNull() & (old_ts.isNull() | (new_ts > old_ts))
    return joined.select(
        "cursor_key", F.when(advanced, F.col("_new")).otherwise(F.col("_old")).alias("cursor_value"),
        F.when(advanced, updated_at).otherwise(F.col("_old_at")).alias("updated_at"),
    )


def cap_per_seed(rows: DataFrame, seed: list[str], order: list[Column], limit: int) -> DataFrame:
    """First ``limit`` rows of every seed; Spark applies the limit before the shuffle too."""
    rn = F.row_number().over(Window.partitionBy(*seed).orderBy(*order))
    return rows.withColumn("seed_rank", rn).where(F.col("seed_rank") <= limit)


def _has_text() -> Column:
    return F.col("comment_text").isNotNull() & (F.trim("comment_text") != "")


def pending(reviews: DataFrame) -> DataFrame:
    return reviews.where(F.col("enriched_at").isNull() & _has_text())


def reprocessable(reviews: DataFrame, as_of: Column, cooldown_hours: int) -> DataFrame:
    cutoff = F.timestamp_add("HOUR", F.lit(-cooldown_hours), as_of)
    return reviews.where(F.col("enriched_at").isNotNull() & (F.col("enriched_at") <= cutoff) & _has_text())


def reprocess_order() -> list[Column]:
    return [F.col("enriched_at").asc(), F.col("scraped_at").desc(), F.col("fingerprint").asc()]


def reprocess_top(reviews: DataFrame, as_of: Column, cooldown_hours: int, limit: int) -> DataFrame:
    """The rows waiting longest since their enrichment (a top-k, not a full sort)."""
    return slice_rows(reprocessable(reviews, as_of, cooldown_hours), reprocess_order(), 0, limit)


def enrich_batch(reviews: DataFrame, as_of: Column, cooldown_hours: int, reprocess_limit: int) -> DataFrame:
    """All pending rows, then up to ``reprocess_limit`` cooled-down rows not among them."""
    todo = pending(reviews).withColumn("reprocess", F.lit(False))
    again = reprocess_top(reviews, as_of, cooldown_hours, reprocess_limit).withColumn("reprocess", F.lit(True))
    return todo.unionByName(again.join(todo.select("fingerprint").distinct(), "fingerprint", "left_anti"))


def next_batch(reviews: DataFrame, as_of: Column, batch_size: int | None = None, reprocess: bool = False, cooldown_hours: int = 24, batch_no: int = 0) -> DataFrame:
    """The ``batch_no``-th batch of pending rows, oldest crawl first; without ``batch_size`` all pending rows.

    With ``reprocess``, and only where fewer rows are pending than a batch takes, the batch is filled up from the rows that
    wait longest since their enrichment: twice as many as there is room for are looked at, and those in the batch are skipped.
    """
    todo = pending(reviews)
    if batch_size is None:
        return todo
    order = [F.col("scraped_at").asc(), F.col("fingerprint").asc()]
    left = todo.count() - batch_no * batch_size
    # A batch with room for all that is pending needs no order.
    taken = todo if not batch_no and left <= batch_size else slice_rows(todo, order, batch_no * batch_size, batch_size)
    room = batch_size - max(left, 0)
    if not reprocess or room <= 0:
        return taken
    looked_at = reprocess_top(reviews, as_of, cooldown_hours, 2 * room)
    again = looked_at.join(taken.select("fingerprint"), "fingerprint", "left_anti")
    return taken.unionByName(slice_rows(again, reprocess_order(), 0, room).select(*taken.columns))


def mark_enriched(reviews: DataFrame, batch: DataFrame, as_of: Column) -> DataFrame:
    """Stamp the batch's rows; all other rows are unchanged."""
    done = batch.select(F.col("fingerprint").alias("_done")).distinct()
    joined = reviews.join(done, F.col("fingerprint") == F.col("_done"), "left")
    return joined.withColumn("enriched_at", F.when(F.col("_done").isNotNull(), as_of).otherwise(F.col("enriched_at"))).drop("_done")
