"""Reviews and operational tables derived from the given tables, row for row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gripelode import lexicon as lx
from gripelode.functions import keys
from gripelode.functions.text import words

PHRASES = [
    "I hate this, the export is broken and slow: ", "Frustrated with pricing, would pay for an alternative to ",
    "Wish it had sync. Missing reports, terrible bug in ", "Love it, great and easy ",
    "Need better support; subscription cost is too expensive for ",
    "Struggling with manual spreadsheet entry, budget: $50 hourly for ", "Awful issue, fail fail fail on ",
    "Excellent helpful tool ", "Pain point: copy paste between ", "ok ",
]
SUFFIX = ". The whole team reports it every week and nobody answers the ticket."
COUNTRIES = ["US", "GB", "CA", "AU", "IN"]
ROWS_PER_TASK = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(values: list[str], index: Column) -> Column:
    return F.element_at(words(values), (index + 1).cast("int"))


def _sql_list(values: list[str]) -> str:
    return "array(" + ", ".join("'" + v.replace("'", "\\'") + "'" for v in values) + ")"


def spread(scan: DataFrame) -> DataFrame:
    """A scan of fewer tasks than there are cores, or of very many rows a task, dealt out before costly work on its rows."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    tasks = cores * max(1, -(-scan.count() // (cores * ROWS_PER_TASK)))
    return scan.repartition(tasks) if scan.rdd.getNumPartitions() < tasks else scan


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reviews_of(spread(table(spark, sf_dir, "events")), table(spark, sf_dir, "part"))


def reviews_of(events: DataFrame, part: DataFrame) -> DataFrame:
    """One canonical review per event; the part it is about gives the entity."""
    # p_partkey numbers the parts from 0, so every part can be an entity, and there are more of them as the tables grow.
    keyed = events.withColumn("entity", F.col("user_id") % part.agg(F.count(F.lit(1))).scalar())
    made = keyed.join(part, F.expr("entity = p_partkey")).selectExpr(
        "event_id",
        f"element_at({_sql_list(lx.SOURCE_LABELS)}, int(event_id % 8 + 1)) AS source",
        "concat('it', CASE WHEN event_id % 23 = 0 THEN event_id - 8 ELSE event_id END) AS source_item_id",
        "string(entity) AS entity_id", "p_brand AS entity_name",
        "CASE WHEN event_id % 17 = 0 THEN 'Unknown' WHEN event_id % 19 = 0 THEN 'india' ELSE lower(p_type) END AS category",
        "concat('user', user_id) AS reviewer_name",
        "CASE WHEN event_id % 11 <> 0 THEN double(1 + event_id % 5) END AS rating",
        f"concat(element_at({_sql_list(PHRASES)}, int((event_id + floor(value)) % 10 + 1)), p_name, ' ', event_type, "
        f"CASE WHEN event_id % 3 = 0 THEN '{SUFFIX}' ELSE '' END) AS comment_text",
        "ts AS posted_ts",
        "concat('https://x.example/', event_id) AS url",
        f"element_at({_sql_list(COUNTRIES)}, int(event_id % 5 + 1)) AS country", "'en' AS language",
        "timestampadd(HOUR, 1, ts) AS scraped_at",
        "CASE WHEN event_id % 4 = 0 THEN timestampadd(HOUR, 2, ts) END AS enriched_at",
    )
    fields = ("source", "source_item_id", "entity_id", "reviewer_name", "comment_text", "posted_at")
    dated = made.withColumn("posted_at", keys.iso_utc(F.col("posted_ts")))
    return dated.withColumn("fingerprint", keys.fingerprint(*[F.col(c) for c in fields]))


def landed_copies(revs: DataFrame) -> DataFrame:
    """Reviews as landed by repeated crawls: every thirteenth comes again a day later."""
    copies = F.sequence(F.lit(1), F.when(F.col("event_id") % 13 == 0, 2).otherwise(1))
    return (
        revs.withColumn("copy", F.explode(copies))
        .withColumn("scraped_at", F.timestamp_add("DAY", F.col("copy") - 1, F.col("scraped_at")))
        .withColumn("ingest_seq", F.col("event_id") * 2 + F.col("copy"))
    )
