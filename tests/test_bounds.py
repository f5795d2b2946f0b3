"""What one task or the driver holds does not grow with the tables."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gripelode.operators import cluster, ingest, rank, skew
from gripelode.sources import payloads, tables

START = datetime(2024, 1, 1)


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_scan_of_many_rows_is_dealt_out_by_rows(spark, monkeypatch):
    monkeypatch.setattr(tables, "ROWS_PER_TASK", 10)
    assert tables.spread(spark.range(0, 200, 1, 2)).rdd.getNumPartitions() == 20


def test_terms_are_counted_without_sorting_them(spark):
    rows = [("c", None, "b", ["x", "y"]), ("c", None, "a", ["z", "x"]), ("c", START, "z", ["y", "w", "w"]), (None, None, "q", ["n", "m"]), ("d", START, "f2", ["b", "a"]), ("d", START, "f1", ["a", "c", "b"])]
    df = spark.createDataFrame(rows, "cluster_key string, posted_ts timestamp_ntz, fingerprint string, terms array<string>")
    top = cluster.top_terms(df, 3)
    got = sorted(map(tuple, top.collect()), key=str)
    assert got == sorted([("c", 1, "y", 2), ("c", 2, "w", 2), ("c", 3, "x", 2), (None, 1, "n", 1), (None, 2, "m", 1), ("d", 1, "a", 2), ("d", 2, "b", 2), ("d", 3, "c", 1)], key=str)
    # A least place among all terms has no fixed width and would sort every one of them.
    counts = [line for line in plan(top).splitlines() if "Aggregate" in line and "count(" in line]
    assert not any("min(struct" in line or "min(named_struct" in line for line in counts)


def numbered(spark, n):
    rows = [(f"f{i * 7 % n:03d}", START + timedelta(hours=i % 5)) for i in range(n)]
    return spark.createDataFrame(rows, "fingerprint string, scraped_at timestamp_ntz"), sorted(rows, key=lambda r: (r[1], r[0]))


@pytest.mark.parametrize("start, count", [(0, 50), (13, 61), (95, 50), (200, 5), (0, 100)])
def test_many_rows_are_cut_out_without_one_task_for_all(spark, monkeypatch, start, count):
    monkeypatch.setattr(rank, "TOP_ROWS", 3)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    df, ordered = numbered(spark, 100)
    cut = rank.slice_rows(df, [F.col("scraped_at").asc(), F.col("fingerprint").asc()], start, count)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(map(tuple, cut.collect())) == sorted(ordered[start:start + count]) and "GlobalLimit" not in plan(cut)


def test_a_batch_with_room_for_all_has_no_limit(spark):
    df = numbered(spark, 20)[0].withColumns({"comment_text": F.lit("text"), "enriched_at": F.lit(None).cast("timestamp_ntz")})
    batch = ingest.next_batch(df, F.lit("2024-03-01").cast("timestamp_ntz"), 20)
    assert batch.count() == 20 and "GlobalLimit" not in plan(batch)


def test_a_large_lookup_is_neither_broadcast_nor_repeated(spark, monkeypatch):
    monkeypatch.setattr(skew, "MAX_BROADCAST", 1)
    rows = spark.createDataFrame([(i, None if i % 4 == 0 else "hot" if i % 3 else f"k{i}") for i in range(100)], "id int, key string")
    lookup = spark.createDataFrame([("hot", 1), ("k3", 2), (None, 3)], "lk string, v int")
    got = skew.salted_lookup(rows, lookup, "key", "lk", ["id"])
    assert got.columns == ["id", "key", "lk", "v"] and "Generate" not in plan(got) and "broadcast" not in plan(got)
    want = rows.join(lookup, F.col("key") == F.col("lk"), "left").select("id", "v")
    assert sorted(map(str, got.select("id", "v").collect())) == sorted(map(str, want.collect()))


def test_shallow_payloads_are_walked_in_their_rows(spark):
    bodies = spark.createDataFrame([(1, '{"a": [{"b": 1}, {"c": {}}], "s": "{x"}')], "id int, body string")
    found = payloads.json_objects(bodies)
    assert "Window" not in plan(found)
    assert [(r["pos"], r["depth"], r["object"]) for r in found.orderBy("pos").collect()][1:] == [(1, 2, '{"c":{}}'), (2, 3, "{}"), (3, 2, '{"b":1}')]


def test_texts_of_entries_are_made_once(spark):
    feeds = spark.createDataFrame([("q", "c", "<feed/>")], "query string, category string, body string")
    assert plan(payloads.atom_reviews(feeds)).count("<[^>]+>") == 1
