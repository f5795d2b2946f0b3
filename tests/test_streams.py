"""Streams over several files and runs against the batch result."""

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gripelode import schema
from gripelode.stores import Store
from gripelode.streaming import jobs

ROWS = "fingerprint string, cursor string, posted_ts timestamp_ntz, n long"
T0 = datetime(2024, 1, 1)


@pytest.fixture
def landing(spark, tmp_path):
    """Adds one file to what has landed and gives a stream that reads a file per batch."""

    def land(rows):
        spark.createDataFrame(rows, ROWS).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    def stream():
        return jobs.read_landed(spark, str(tmp_path / "in"), spark.createDataFrame([], ROWS).schema, files_per_batch=1)

    return land, stream


def at(seconds):
    return T0 + timedelta(seconds=seconds)


def test_ingest_over_files_and_runs_equals_batch(spark, tmp_path, landing):
    land, stream = landing
    table = Store(spark, str(tmp_path / "table"), ROWS, ["fingerprint"], buckets=2)
    rng, seen = random.Random(1), set()
    for _ in range(2):
        for _ in range(2):
            rows = [(f"f{rng.randrange(40)}", "c", at(1), rng.randrange(100)) for _ in range(25)]
            land(rows)
            seen |= {r[0] for r in rows}
        jobs.ingest_stream(stream(), table, str(tmp_path / "cp"), ["n"])
        assert sorted(r["fingerprint"] for r in table.read().collect()) == sorted(seen)
    version = table.version()
    jobs.ingest_stream(stream(), table, str(tmp_path / "cp"), ["n"])  # nothing landed
    assert table.version() == version


def test_cursors_drop_late_rows_over_files_and_restarts(spark, tmp_path, landing):
    land, stream = landing
    cursors = Store(spark, str(tmp_path / "cursors"), schema.SOURCE_CURSORS, ["cursor_key"], buckets=2, filtered=False)
    cursors.upsert(spark.createDataFrame([("a", "2024-01-01T00:00:05+00:00", T0)], schema.SOURCE_CURSORS))
    out = str(tmp_path / "out")

    def passed():
        return sorted(r["fingerprint"] for r in jobs.read_batches(spark, out, stream().schema).collect())

    land([("a-late", "a", at(5), 1), ("a-new", "a", at(9), 1), ("a-timeless", "a", None, 1), ("b", "b", at(1), 1), ("free", None, at(0), 1)])
    jobs.cursor_stream(stream(), cursors, F.col("cursor"), out, str(tmp_path / "cp"))
    assert passed() == ["a-new", "a-timeless", "b", "free"]
    land([("a-late2", "a", at(9), 1), ("a-newer", "a", at(10), 1), ("b-late", "b", at(0), 1), ("free2", None, at(0), 1)])
    jobs.cursor_stream(stream(), cursors, F.col("cursor"), out, str(tmp_path / "cp"))
    assert passed() == ["a-new", "a-newer", "a-timeless", "b", "free", "free2"]
    assert {r["cursor_key"]: r["cursor_value"][17:19] for r in cursors.read().collect()} == {"a": "10", "b": "01"}


def test_a_retried_batch_is_not_measured_by_its_own_cursors(spark, tmp_path, landing):
    """A batch that moved the cursors and then died before its commit would find all its rows late."""
    land, stream = landing
    cursors = Store(spark, str(tmp_path / "cursors"), schema.SOURCE_CURSORS, ["cursor_key"], buckets=2, filtered=False)
    out, checkpoint = str(tmp_path / "out"), tmp_path / "cp"
    land([("x", "a", at(3), 1)])
    jobs.cursor_stream(stream(), cursors, F.col("cursor"), out, str(checkpoint))
    for commit in (checkpoint / "commits").iterdir():
        commit.unlink()
    jobs.cursor_stream(stream(), cursors, F.col("cursor"), out, str(checkpoint))
    assert [r["fingerprint"] for r in jobs.read_batches(spark, out, stream().schema).collect()] == ["x"]


def test_dedupe_keeps_state_between_files(spark, tmp_path, landing):
    land, stream = landing
    for part in range(3):
        land([(f"f{(part * 5 + i) % 12}", "c", at(part), i) for i in range(8)])
        jobs.run(jobs.dedupe_stream(stream(), "posted_ts"), str(tmp_path / "cp"), lambda batch, i: jobs.write_batch(batch, str(tmp_path / "out"), i))
    got = Counter(r["fingerprint"] for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert set(got) == {f"f{i}" for i in range(12)} and set(got.values()) == {1}


def test_newest_and_daily_counts_keep_state_between_files(spark, tmp_path, landing):
    land, stream = landing
    days = [("a", 0), ("b", 1), ("a", 1), ("a", 0), ("b", 0), ("c", 2)]
    for part in range(3):
        land([("f", key, T0 + timedelta(days=day), 1) for key, day in days[2 * part : 2 * part + 2]])
        newest, daily = jobs.newest_per_key(stream(), F.col("cursor"), "posted_ts"), jobs.daily_counts_stream(stream(), "posted_ts", "30 days")
        jobs.update_stream(newest, str(tmp_path / "newest"), str(tmp_path / "cp1"))
        jobs.update_stream(daily, str(tmp_path / "daily"), str(tmp_path / "cp2"))
    got = jobs.latest_updates(spark, str(tmp_path / "newest"), newest.schema, ["cursor_key"]).collect()
    assert {r["cursor_key"]: r["newest"].day for r in got} == {"a": 2, "b": 2, "c": 3}
    got = jobs.latest_updates(spark, str(tmp_path / "daily"), daily.schema, ["day"]).collect()
    assert {r["day"].day: r["n"] for r in got} == {1: 3, 2: 2, 3: 1}


def test_panes_give_every_sliding_window(spark, tmp_path, landing):
    land, stream = landing
    rng = random.Random(2)
    seconds = [rng.choice([rng.randrange(3500, 3700), rng.randrange(7190, 7210), 7199, 7200]) for _ in range(90)]
    for part in range(3):
        land([("f", "ab"[s % 2], at(s + 0.25), 1) for s in seconds[30 * part : 30 * part + 30]])
        jobs.update_stream(jobs.panes(stream(), "cursor", "posted_ts"), str(tmp_path / "panes"), str(tmp_path / "cp"))
    found = jobs.latest_updates(spark, str(tmp_path / "panes"), jobs.panes(stream(), "cursor", "posted_ts").schema, ["cursor", "second"])
    assert found.count() == len(set(seconds))
    for width in (1, 60, 4000):
        expected = Counter(("ab"[s % 2], s - back) for s in seconds for back in range(width))
        got = {(r["cursor"], int((r["window_start"] - T0).total_seconds())): r["events"] for r in jobs.sliding_counts(found, "cursor", width).collect()}
        assert got == expected
    changes = jobs.sliding_from_panes(found, "cursor", 60).count()
    assert changes <= 3 * found.count()
