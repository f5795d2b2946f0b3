"""Row positions over data too large for one ordered task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gripelode.session import stage

TOP_ROWS = 100_000  # as many rows one task sorts out


def positions(df: DataFrame, group: list[str], order: list[Column], bucket: Column, name: str = "position") -> DataFrame:
    """Zero-based position of every row in its group.

    ``bucket`` must not decrease along ``order`` and should cut a group into moderate pieces:
    rows are numbered inside a bucket, and only bucket sizes are summed up across one.
    """
    cut = df.withColumn("_bucket", bucket)
    by = [*group, "_bucket"]
    sizes = cut.groupBy(*by).agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*by, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    numbered = cut.withColumn("_rn", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    return numbered.join(starts, by).withColumn(name, F.col("_start") + F.col("_rn") - 1).drop("_bucket", "_start", "_rn")


def slice_rows(df: DataFrame, order: list[Column], start: int, count: int) -> DataFrame:
    """``count`` rows of the frame after the first ``start`` in ``order``.

    A limit of very many rows would bring them all into one task. Instead the rows are staged in ranges of the order; ranges
    that lie inside are taken whole, and only the two at the ends are numbered.
    """
    if start + count <= TOP_ROWS:
        return df.orderBy(*order).offset(start).limit(count)
    ranged = stage(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranged")
    whole, cut, at = [], {}, 0
    for part, n in sorted((r["_range"], r["count"]) for r in ranged.groupBy("_range").count().collect()):  # one row per partition
        first, last = max(start - at, 0), min(start + count - at, n)
        if (first, last) == (0, n):
            whole.append(part)
        elif first < last:
            cut[part] = (first, last)
        at += n
    out = ranged.where(F.col("_range").isin(whole))
    for part, (first, last) in cut.items():
        rn = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
        out = out.unionByName(ranged.where(F.col("_range") == part).withColumn("_rn", rn).where((F.col("_rn") > first) & (F.col("_rn") <= last)).drop("_rn"))
    return out.drop("_range")
