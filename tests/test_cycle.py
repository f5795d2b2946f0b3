import uuid
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from gripelode.config import DEFAULT
from gripelode.operators import cycle, ingest, publish
from gripelode.session import shared_dir



def at(day=1):
    return F.lit(f"2024-03-0{day} 00:00:00").cast("timestamp_ntz")


LANDED = (
    "source string, source_item_id string, entity_id string, entity_name string, category string, reviewer_name string, rating double, comment_text string, "
    "posted_at string, url string, country string, language string, fingerprint string, scraped_at timestamp_ntz, raw_json string, enriched_at timestamp_ntz, "
    "query string, seed_type string, seed_key string, ingest_seq long"
)


@pytest.fixture
def tables(spark):
    return cycle.Tables.at(spark, f"{shared_dir(spark)}/cycle/{uuid.uuid4().hex}", buckets=2)


def row(n, source="play_store", text="I hate this export", rating=1.0, day=1, seed="k1", seq=0, entity="e1"):
    when = datetime(2024, 1, day)
    return (source, f"it{n}", entity, "App", "tools", "u", rating, text, when.isoformat() + "+00:00", "", "US", "en", f"fp{n}", when, None, None, "export", source, seed, seq)


def landed(spark, rows):
    return spark.createDataFrame(rows, LANDED)


def seeds(spark, keys):
    return spark.createDataFrame(keys, "seed_type string, seed_key string, enabled boolean")


def total(stats):
    return next(((r["seen"], r["inserted"]) for r in stats.collect() if r["is_total"]), None)


def test_cycles_gate_move_cursors_count_and_log(spark, tables):
    known = seeds(spark, [("play_store", "k1", True), ("g2", "k2", True), ("play_store", "off", False)])
    first = [row(1), row(1, seq=1), row(2, text="lovely"), row(3, rating=5.0), row(4, source="g2", rating=3.0, seed="k2"), row(9, seed="off")]
    assert total(cycle.ingest_cycle(tables, landed(spark, first), known, at())) == (5, 2)
    assert {r["fingerprint"] for r in tables.reviews.read().collect()} == {"fp1", "fp4"}
    assert [tuple(r) for r in tables.cursors.read().select("cursor_key", "cursor_value").collect()] == [("play_store:e1:us", "2024-01-01T00:00:00+00:00")]
    # An older and an equally old row stay out because of the cursor, a newer one comes in; g2 has no cursor.
    second = [row(5), row(6, day=2), row(7, source="g2", day=1, rating=1.0, seed="k2")]
    assert total(cycle.ingest_cycle(tables, landed(spark, second), known, at(2))) == (3, 2)
    assert {r["fingerprint"] for r in tables.reviews.read().collect()} == {"fp1", "fp4", "fp6", "fp7"}
    progress = {(r["seed_type"], r["seed_key"]): r for r in tables.progress.read().collect()}
    assert (progress["play_store", "k1"]["total_seen"], progress["play_store", "k1"]["total_inserted"]) == (6, 2)
    assert progress["play_store", "off"]["status"] == "pending" and progress["g2", "k2"]["status"] == "done"
    assert [r["total_records"] for r in tables.run_log.read().orderBy("run_at").collect()] == [2, 4]
    # The fast mode looks behind the cursors.
    fast = cycle.ingest_cycle(tables, landed(spark, [row(5), row(6, day=2)]), known, at(3), "fast_backfill")
    assert total(fast) == (2, 1)


def test_an_empty_cycle(spark, tables):
    stats = cycle.ingest_cycle(tables, landed(spark, []), seeds(spark, []), at())
    assert total(stats) is None and tables.reviews.version() == 0


def reviews(spark, tables, n, enriched=None):
    rows = [row(i, text=f"export broken sync report number{i % 3} export", entity=f"e{i % 2}") for i in range(n)]
    tables.reviews.append(landed(spark, rows).withColumn("enriched_at", F.lit(enriched).cast("timestamp_ntz")).select(*tables.reviews.columns))


def test_a_run_publishes_and_a_second_one_changes_nothing(spark, tables):
    reviews(spark, tables, 12)
    assert cycle.enrich_run(tables, "b1", at()) == cycle.Run(1)
    cards, candidates = tables.cards.read().collect(), tables.candidates.read().collect()
    assert cards and len(cards) == len(candidates)
    assert all(c["name"].endswith(" Opportunity") for c in cards)
    assert tables.reviews.read().where("enriched_at is null").count() == 0
    before = tables.versions()
    assert cycle.enrich_run(tables, "b2", at(2)) == cycle.Run(0)
    assert tables.versions() == before


def test_batches_and_budget(spark, tables):
    reviews(spark, tables, 10)
    spent = spark.createDataFrame([(True,)], "reached boolean")
    assert cycle.enrich_run(tables, "b", at(), spent=spent) == cycle.Run(0, True)
    assert cycle.enrich_run(tables, "b", at(), batch_size=4, max_batches=2) == cycle.Run(2)
    assert tables.reviews.read().where("enriched_at is null").count() == 2
    path = f"{shared_dir(spark)}/public/{uuid.uuid4().hex}"
    cycle.publish_snapshot(tables, path, "v1")
    assert publish.read_snapshot(spark, path, "idea_publish_cards").count() == tables.cards.read().count()


def test_a_batch_with_room_is_filled_up(spark):
    def review(i, enriched, scraped):
        return (f"f{i}", "text", datetime(2024, 1, enriched) if enriched else None, datetime(2024, 1, scraped))

    rows = [review(i, None, 1 + i) for i in range(3)] + [review(10 + i, 1 + i, 1) for i in range(6)]
    frame = spark.createDataFrame(rows, "fingerprint string, comment_text string, enriched_at timestamp_ntz, scraped_at timestamp_ntz")

    def taken(**options):
        return sorted(r["fingerprint"] for r in ingest.next_batch(frame, at(), cooldown_hours=24, **options).collect())

    assert taken() == ["f0", "f1", "f2"]
    assert taken(batch_size=2) == ["f0", "f1"] and taken(batch_size=2, batch_no=1) == ["f2"] and taken(batch_size=2, reprocess=True) == ["f0", "f1"]
    assert taken(batch_size=5) == ["f0", "f1", "f2"]
    assert taken(batch_size=5, reprocess=True) == ["f0", "f1", "f10", "f11", "f2"]
    assert DEFAULT.batch_size == 300


def test_a_time_alone_does_not_write_a_card_again(spark, tables):
    reviews(spark, tables, 6)
    cycle.enrich_run(tables, "b", at())
    version = tables.cards.version()
    cycle.rebuild_and_clean(tables, at(9), None)
    assert tables.cards.version() == version
