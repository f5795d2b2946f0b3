"""Joining per-key totals to rows when one key may hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_HOT_KEYS = 1000
MAX_BROADCAST = 50_000  # rows of two short columns: some 10 MB in the driver


def attach_totals(rows: DataFrame, totals: DataFrame, key: str, size_col: str, spread_by: list[str]) -> DataFrame:
    """Left-join ``totals`` (one row per key) to ``rows`` without a hot task.

    A key is hot when it has more than 1/MAX_HOT_KEYS of all rows, so there are fewer than
    MAX_HOT_KEYS hot keys whatever the data: that side is broadcast. The rows it answers get a
    spread join key that matches nothing, and so do not pile up in the shuffled join.
    """
    values = [c for c in totals.columns if c != key]
    all_rows = totals.agg(F.sum(size_col)).scalar()
    hot = totals.where(F.col(size_col) * MAX_HOT_KEYS > all_rows).select(
        F.col(key).alias("_hot_key"), F.struct(*values).alias("_hot")
    )
    cold = totals.select(F.col(key).alias("_cold_key"), F.struct(*values).alias("_cold"))
    spread = F.concat(F.lit("\0"), F.xxhash64(*spread_by))
    joined = (
        rows.join(F.broadcast(hot), F.col(key) == F.col("_hot_key"), "left")
        .withColumn("_join_key", F.when(F.col("_hot_key").isNull(), F.coalesce(F.col(key), spread)).otherwise(spread))
        .join(cold, F.col("_join_key") == F.col("_cold_key"), "left")
        .withColumn("_total", F.coalesce("_hot", "_cold"))
    )
    return joined.select(*rows.columns, *[F.col("_total")[v].alias(v) for v in values])


def salted_lookup(rows: DataFrame, lookup: DataFrame, row_key: str, lookup_key: str, spread_by: list[str], salts: int = 32) -> DataFrame:
    """Left join to a lookup with one row per key, far fewer rows than ``rows``.

    A lookup of at most MAX_BROADCAST rows, which is counted, is broadcast, and the rows stay where they are. A larger one is
    shuffled, and rows without a key are spread; Spark splits the partitions of hot keys. In streams, where it splits none,
    the lookup is repeated once per salt, so that the rows of one key are shared by ``salts`` tasks.
    """
    if lookup.limit(MAX_BROADCAST + 1).count() <= MAX_BROADCAST:
        return rows.join(F.broadcast(lookup), F.col(row_key) == F.col(lookup_key), "left")
    if not rows.isStreaming:
        spread = F.concat(F.lit("\0"), F.xxhash64(*spread_by).cast("string"))
        joined = rows.withColumn("_join_key", F.coalesce(F.col(row_key).cast("string"), spread))
        return joined.join(lookup, F.col("_join_key") == F.col(lookup_key).cast("string"), "left").drop("_join_key")
    salted = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    spread = rows.withColumn("_row_salt", F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int"))
    on = (F.col(row_key) == F.col(lookup_key)) & (F.col("_row_salt") == F.col("_salt"))
    return spread.join(salted, on, "left").drop("_row_salt", "_salt")
