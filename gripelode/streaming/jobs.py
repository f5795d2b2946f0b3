"""Incremental twins of the batch jobs on Structured Streaming.

Sinks write one folder per micro-batch or a stored table that knows its last batch, so a batch that is retried after a
failure replaces its own output or changes nothing. State is kept in RocksDB, so it may exceed an executor's memory. Runs use ``availableNow``: they work off what has landed and stop.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gripelode.functions import keys
from gripelode.operators import ingest
from gripelode.session import drop, stage
from gripelode.stores import Store

BATCH = "batch_id"
HOUR = 3_600


def read_landed(spark: SparkSession, path: str, schema, glob: str = "*.parquet", files_per_batch: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("pathGlobFilter", glob).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")


def read_batches(spark: SparkSession, path: str, schema) -> DataFrame:
    """All batches written so far; empty before the first one."""
    try:
        rows = spark.read.schema(schema).option("basePath", path).parquet(f"{path}/{BATCH}=*")
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], schema).withColumn(BATCH, F.lit(-1))
    return rows.withColumn(BATCH, F.col(BATCH).cast("long"))


def run(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None], mode: str = "append") -> StreamingQuery:
    query = stream.writeStream.foreachBatch(each).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def ingest_stream(stream: DataFrame, table: Store, checkpoint: str, order: list[str]) -> StreamingQuery:
    """Add rows with a new key to the table; equal to ``insert_if_new`` over all batches.

    A batch reads the table's filters and of the stored rows only buckets whose filter answers. The table keeps the number of
    the last batch, so a batch that is retried after a failure adds nothing twice.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        if not table.done(checkpoint, batch_id):
            first = stage(ingest.first_per_fingerprint(batch, order), "batch")
            table.insert_new(first, checkpoint, batch_id)
            drop(first)

    return run(stream, checkpoint, each)


def with_watermark(stream: DataFrame, time: str, delay: str) -> DataFrame:
    """Watermarks need an instant; times here are UTC wall clocks in a UTC session."""
    return stream.withColumn("event_time", F.col(time).cast("timestamp")).withWatermark("event_time", delay)


def dedupe_stream(stream: DataFrame, time: str, delay: str = "1 day") -> DataFrame:
    """First row per fingerprint; state is dropped once the watermark has passed."""
    return with_watermark(stream, time, delay).dropDuplicatesWithinWatermark(["fingerprint"])


def cursor_stream(stream: DataFrame, cursors: Store, key: Column, path: str, checkpoint: str) -> StreamingQuery:
    """Rows newer than their own cursor, which then moves to the newest row let through.

    A watermark is one time for all keys, cursors are not; so they are a stored table (cursor_key, cursor_value, updated_at)
    that every batch looks up and moves on. The newest times are partial maxima, and no task gathers the rows of a key. A
    batch's rows are written before its cursors; one that has moved them is done and is not worked on again.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        if cursors.done(checkpoint, batch_id):
            return
        known = cursors.read()
        passed = stage(ingest.cursor_filter(batch, known, key).withColumn("_key", key), "passed")
        write_batch(passed.drop("_key"), path, batch_id)
        newest = passed.where("_key is not null and posted_ts is not null").groupBy(F.col("_key").alias("cursor_key")).agg(F.max("posted_ts").alias("newest"))
        moved = newest.select("cursor_key", keys.iso_utc(F.col("newest")).alias("cursor_value"))
        asked = known.join(moved.select("cursor_key"), "cursor_key", "left_semi")
        at = F.current_timestamp().cast("timestamp_ntz")
        cursors.upsert(ingest.cursor_upsert(asked, moved, at), checkpoint, batch_id)
        drop(passed)

    return run(stream, checkpoint, each)


def newest_per_key(stream: DataFrame, key: Column, time: str) -> DataFrame:
    return stream.where(F.col(time).isNotNull()).groupBy(key.alias("cursor_key")).agg(F.max(time).alias("newest"))


def panes(stream: DataFrame, key: str, time: str, delay: str = "1 day") -> DataFrame:
    """Events per key and second: the one state row that each of them needs, however wide the windows are."""
    found = with_watermark(stream, time, delay).groupBy(F.window("event_time", "1 second").alias("w"), key).agg(F.count("*").alias("n"))
    return found.select(key, F.unix_seconds("w.start").alias("second"), "n")


def sliding_from_panes(found: DataFrame, key: str, width: int = 60) -> DataFrame:
    """(key, from_second, to_second, events): how many events the window [t, t + width) of every second t holds.

    A pane raises the count of the windows that begin ``width`` - 1 seconds before it and lowers it after its own; between such
    changes the count stands. Running sums are split by hour, a pane that reaches into the next hour counts there from its
    start on, so no task gathers a key. Windows without events are left out.
    """
    first, after = F.col("second") - (width - 1), F.col("second") + 1
    hour = lambda t: F.floor(t / HOUR)
    change = lambda t, n: F.struct(hour(t).alias("hour"), t.cast("long").alias("t"), n.alias("d"))
    starts = F.transform(F.sequence(hour(first) + 1, F.greatest(hour(after), hour(first) + 1)), lambda h: change(h * HOUR, F.col("n")))
    none = F.array().cast("array<struct<hour:bigint,t:bigint,d:bigint>>")
    changes = F.concat(F.array(change(first, F.col("n")), change(after, -F.col("n"))), F.when(hour(after) > hour(first), starts).otherwise(none))
    told = found.select(key, F.explode(changes).alias("c")).select(key, "c.*").groupBy(key, "hour", "t").agg(F.sum("d").alias("d"))
    in_hour = Window.partitionBy(key, "hour").orderBy("t")
    counted = told.select(key, F.col("t").alias("from_second"), F.coalesce(F.lead("t").over(in_hour), (F.col("hour") + 1) * HOUR).alias("to_second"), F.sum("d").over(in_hour).alias("events"))
    return counted.where("events > 0 and to_second > from_second")


def sliding_counts(found: DataFrame, key: str, width: int = 60) -> DataFrame:
    """(key, window_start, events), one row per window that holds events."""
    seconds = F.sequence(F.col("from_second"), F.col("to_second") - 1)
    start = F.timestamp_add("SECOND", F.col("s"), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    return sliding_from_panes(found, key, width).select(key, "events", F.explode(seconds).alias("s")).select(key, start.alias("window_start"), "events")


def daily_counts_stream(stream: DataFrame, time: str, delay: str = "1 day") -> DataFrame:
    windows = with_watermark(stream, time, delay).groupBy(F.window("event_time", "1 day").alias("w")).agg(F.count("*").alias("n"))
    return windows.select(F.to_date("w.start").alias("day"), "n")


def update_stream(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write every batch's updated rows; ``latest_updates`` gives their current state."""
    return run(stream, checkpoint, lambda batch, batch_id: write_batch(batch, path, batch_id), "update")


def latest_updates(spark: SparkSession, path: str, schema, keys: list[str]) -> DataFrame:
    rows = read_batches(spark, path, schema)
    rest = [c for c in rows.columns if c not in (*keys, BATCH)]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), BATCH).alias("r"))
    return newest.select(*keys, "r.*")
