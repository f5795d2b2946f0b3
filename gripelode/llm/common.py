"""Helpers shared by the operators: staged tables, checked broadcasts, link components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a two-column side that may be broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 500_000
_local: dict[str, str] = {}


def prepare(spark: SparkSession, rows_per_batch: int = 512) -> SparkSession:
    """Small Arrow batches, so that a Python worker holds few long texts at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows_per_batch))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where it is unset, a temporary one, in local mode only."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    return _local.setdefault(app, "file://" + tempfile.mkdtemp(prefix="llm-"))


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/llm/{uuid.uuid4().hex}/{name}"


#: Folders staged since the last ``staged_since``, by the list that asks for them.
_watchers: list[list[str]] = []


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage and outlives lost executors."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    for folders in _watchers:
        folders.append(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


def drop(*frames: DataFrame) -> None:
    """Removes the folders of staged frames that nothing reads any more; other frames stay as they are."""
    for frame in frames:
        if path := getattr(frame, "_staged_at", None):
            drop_folders(frame.sparkSession, [path])


def drop_folders(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def staged_into(folders: list[str]) -> Iterator[None]:
    """Within it, the folders of staged frames are added to ``folders``."""
    _watchers.append(folders)
    try:
        yield
    finally:
        _watchers.remove(folders)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Marked for broadcast if it has at most ``rows`` rows; otherwise as it is, for a shuffled join."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) of every node in links (a, b): root is the smallest node reachable.

    Alternates large-star and small-star steps, whose rows never exceed the links; a node with very many links is only
    ever a grouping key of a partial minimum. Each round is staged, and the loop ends when a round changes nothing. While
    the links are few enough, which is counted, the minima are broadcast and the links themselves stay where they are.
    """
    pair = lambda x, y: F.struct(F.col(x).alias("u"), F.col(y).alias("v"))
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    edges = stage(edges, name)
    before = (edges.count(), None)
    while True:
        few = 2 * before[0] <= BROADCAST_ROWS  # each link has two nodes
        both = edges.select(F.explode(F.array(pair("a", "b"), pair("b", "a"))).alias("e")).select("e.*")
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(F.broadcast(low) if few else low, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b") if few else large.where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(F.broadcast(low) if few else low, "a")
        star = joined.select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        last, edges = edges, stage(star.where("a <> b").distinct(), name)
        drop(last)
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    roots = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def joined_roots(roots: DataFrame, links: DataFrame) -> DataFrame:
    """Roots (node, root) with further links (a, b): only links between different components are worked on, as links of roots.

    Where roots change, the staged ones given are removed.
    """
    sides = links.join(roots.select(F.col("node").alias("a"), F.col("root").alias("_x")), "a", "left")
    sides = sides.join(roots.select(F.col("node").alias("b"), F.col("root").alias("_y")), "b", "left")
    ends = sides.select(F.coalesce("_x", "a").alias("a"), F.coalesce("_y", "b").alias("b")).where("a <> b").distinct()
    ends = stage(ends, "ends")
    if ends.isEmpty():
        drop(ends)
        return roots
    moved = stage(components(ends), "moved")
    drop(ends)
    kept = roots.join(moved.select(F.col("node").alias("root"), F.col("root").alias("_to")), "root", "left")
    kept = kept.select("node", F.coalesce("_to", "root").alias("root"))
    out = stage(kept.unionByName(moved.join(roots, "node", "left_anti")), "roots")
    drop(moved, roots)
    return out
