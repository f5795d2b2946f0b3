"""Cycle statistics, health, budget and rate reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gripelode.config import DEFAULT, Config
from gripelode.functions import keys


def cycle_stats(results: DataFrame) -> DataFrame:
    """Seen, inserted and errors per source, and in total where ``is_total`` is 1."""
    sums = [F.sum(c).alias(c) for c in ("seen", "inserted", "errors")]
    return results.rollup("source").agg(F.grouping("source").cast("int").alias("is_total"), *sums)


def selected_counts(selected: DataFrame) -> DataFrame:
    return selected.groupBy("seed_type").agg(F.count("*").alias("selected"))


def run_log_row(stats: DataFrame, run_at: Column, mode: str, total_records: Column) -> DataFrame:
    """One run-log row from the per-source and total rows of ``cycle_stats``."""
    counters = F.struct("seen", "inserted", "errors")
    total = F.max(F.when(F.col("is_total") == 1, counters))
    by_source = F.sort_array(F.collect_list(F.when(F.col("is_total") == 0, F.struct("source", "seen", "inserted", "errors"))))
    folded = stats.agg(total.alias("t"), by_source.alias("sources"))
    body = F.struct("t.seen", "t.inserted", "t.errors", "sources")
    return folded.select(run_at.alias("run_at"), F.lit(mode).alias("mode"), F.to_json(body).alias("stats_json"), total_records.alias("total_records"))


def append_run_log(row: DataFrame, table_path: str, lines_path: str) -> None:
    row.write.mode("append").parquet(table_path)
    row.write.mode("append").json(lines_path)


STATS = "struct<seen:bigint,inserted:bigint,errors:bigint>"


def latest_cycle(run_log: DataFrame) -> DataFrame:
    """Mode, totals and counters of the newest run."""
    newest = F.max_by(F.struct("run_at", "mode", "total_records", "stats_json"), "run_at")
    stats = F.from_json("r.stats_json", STATS)
    return run_log.agg(newest.alias("r")).select(
        F.col("r.mode").alias("latest_cycle_mode"), F.col("r.total_records").alias("latest_cycle_total_records"),
        stats["inserted"].alias("latest_cycle_inserted"), stats["seen"].alias("latest_cycle_seen"), stats["errors"].alias("latest_cycle_errors"),
        keys.iso_utc(F.col("r.run_at")).alias("latest_cycle_run_at"),
    )


def latest_cycle_file(spark: SparkSession, path: str) -> DataFrame:
    """Newest run of the most recently written stats file under ``path``."""
    lines = spark.read.schema("run_at timestamp_ntz, mode string, stats_json string, total_records bigint").option("recursiveFileLookup", True).json(path)
    stamped = lines.select("*", F.col("_metadata.file_modification_time").alias("_written"))
    newest = stamped.agg(F.max_by(F.struct("run_at", "mode", "stats_json", "total_records"), F.struct("_written", "run_at")).alias("r"))
    return latest_cycle(newest.select("r.*"))


def health_counts(reviews: DataFrame, candidates: DataFrame, run_log: DataFrame, progress: DataFrame) -> DataFrame:
    def rows(df: DataFrame) -> Column:
        return df.agg(F.count("*")).scalar()

    return reviews.sparkSession.range(1).select(
        rows(reviews).alias("reviews_count"), rows(candidates).alias("ideas_count"), rows(run_log).alias("run_log_count"),
        progress.agg(F.count_if(F.col("status") == "running")).scalar().alias("seed_running_count"),
        progress.agg(F.count_if(F.col("status") == "error")).scalar().alias("seed_error_count"),
    )


def latest_snapshot(history: DataFrame, at: str = "taken_at") -> DataFrame:
    """Newest row of an appended health history."""
    return history.agg(F.max_by(F.struct(*history.columns), at).alias("r")).select("r.*")


def write_health(snapshot: DataFrame, path: str) -> None:
    """Adds a health row to the history under ``path`` and makes it the latest one, which readers find by itself.

    The history comes first: a run that dies in between leaves a latest row that is one snapshot old, never a broken one.
    """
    row = snapshot if "taken_at" in snapshot.columns else snapshot.withColumn("taken_at", F.current_timestamp())
    row.write.mode("append").json(f"{path}/history")
    latest_snapshot(snapshot.sparkSession.read.json(f"{path}/history")).coalesce(1).write.mode("overwrite").json(f"{path}/latest")


def budget_flags(days: DataFrame, ledger: DataFrame, budget: float) -> DataFrame:
    """Per day whether the spend booked for it has reached the budget; days without entries spent 0."""
    spent = ledger.groupBy("ledger_date").agg(F.sum("total_inr").alias("_spent"))
    joined = days.join(spent, days["day"] == spent["ledger_date"], "left")
    return joined.select("day", F.coalesce("_spent", F.lit(0.0)).alias("spent"), (F.coalesce("_spent", F.lit(0.0)) >= budget).alias("reached"))


def daily_counts(candidates: DataFrame) -> DataFrame:
    return candidates.groupBy(F.to_date("generated_at").alias("day")).agg(F.count("*").alias("n"))


DAY = 86_400
SPANS = {"last_second": 1, "last_minute": 60, "last_day": DAY}


def rate_budget_report(log: DataFrame, key: str, ts: str, cfg: Config = DEFAULT) -> DataFrame:
    """Events per key in the last second, minute and day at every event time, with budget flags.

    An event exactly one window old is out. No task holds a whole key: event times are counted
    first, then split by second (a second has at most a million of them); full seconds come from
    rolling sums over per-second counts, which are split by day.
    """
    counted = log.groupBy(key, keys.epoch_micros(F.col(ts)).alias("us")).agg(F.count("*").alias("n"))
    timed = counted.select(key, F.floor(F.col("us") / 1_000_000).alias("sec"), F.pmod("us", F.lit(1_000_000)).alias("off"), "n")

    # Each time also goes to the second that ends its window, where only later offsets still count.
    copies = timed.withColumn("span", F.explode(F.array(*[F.lit(s) for s in (0, *SPANS.values())]))).withColumn("sec", F.col("sec") + F.col("span"))
    upto = Window.partitionBy(key, "sec").orderBy("off").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(key, "sec")

    def part(span: int) -> Column:
        return F.when(F.col("span") == span, F.col("n")).otherwise(0)

    edges = copies.select(
        key, "sec", "off", "n", "span", F.sum(part(0)).over(upto).alias("own"),
        *[(F.sum(part(s)).over(whole) - F.sum(part(s)).over(upto)).alias(f"edge_{s}") for s in SPANS.values()],
    ).where(F.col("span") == 0)

    # Full seconds between the two edges: what came up to the second before, less what has left the window by now. Both are
    # running sums over the day and the day before it, so a second is added once and taken away once, however long the window.
    seconds = timed.groupBy(key, "sec").agg(F.sum("n").alias("n"))
    long = [s for s in SPANS.values() if s > 1]
    moved = seconds.withColumn("span", F.explode(F.array(*[F.lit(s) for s in (0, *long)]))).withColumn("ahead", F.explode(F.array(F.lit(0), F.lit(1))))
    moved = moved.withColumns({"day": F.floor(F.col("sec") / DAY) + F.col("ahead"), "sec": F.col("sec") + F.col("span")}).where(F.col("sec") < (F.col("day") + 1) * DAY)
    by_day = Window.partitionBy(key, "day").orderBy("sec")
    before, left = by_day.rangeBetween(Window.unboundedPreceding, -1), by_day.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    rolling = moved.select(
        key, "sec", "ahead", "span", *[(F.coalesce(F.sum(part(0)).over(before), F.lit(0)) - F.sum(part(s)).over(left)).alias(f"full_{s}") for s in long],
    ).where((F.col("ahead") == 0) & (F.col("span") == 0)).drop("ahead", "span").withColumn("full_1", F.lit(0))

    joined = edges.join(rolling, [key, "sec"])
    at = F.timestamp_add("MICROSECOND", F.col("sec") * 1_000_000 + F.col("off"), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    totals = joined.select(
        key, at.alias(ts), F.col("n").alias("events"),
        *[(F.col("own") + F.col(f"edge_{s}") + F.col(f"full_{s}")).alias(name) for name, s in SPANS.items()],
    )
    caps = {"last_second": cfg.rate_per_second, "last_minute": cfg.rate_per_minute, "last_day": cfg.rate_per_day}
    return totals.withColumns({f"over_{name}": F.col(name) > cap for name, cap in caps.items()})
