import uuid

import pytest
from pyspark.sql import functions as F

from gripelode.session import shared_dir
from gripelode.stores import Store

SCHEMA = "k string, v long, t string"


@pytest.fixture
def store(spark):
    return Store(spark, f"{shared_dir(spark)}/stores/{uuid.uuid4().hex}", SCHEMA, ["k"], buckets=4, most_folders=5)


def rows(spark, pairs):
    return spark.createDataFrame([(k, v, "x") for k, v in pairs], SCHEMA)


def held(frame):
    return sorted((r["k"], r["v"]) for r in frame.collect())


def test_an_upsert_writes_only_buckets_with_a_change(spark, store):
    assert store.version() == 0 and held(store.read()) == []
    first = {f"k{i}": i for i in range(40)}
    assert store.upsert(rows(spark, first.items())) == 1
    before = {s.bucket: s.folder for s in store.segments()}
    assert len(before) == 4
    assert store.upsert(rows(spark, [("k7", 700), ("k8", 8)])) == 2  # k8 is as it was
    after = {s.bucket: s.folder for s in store.segments()}
    assert sum(before[b] != after[b] for b in before) == 1
    assert held(store.read()) == sorted((first | {"k7": 700}).items())
    assert held(store.read(1)) == sorted(first.items())
    assert store.upsert(rows(spark, [("k7", 700), ("k8", 8)])) == 2  # nothing changes, nothing is written
    assert store.upsert(rows(spark, [])) == 2
    store.drop_old()
    assert store.versions() == [2] and held(store.read()) == sorted((first | {"k7": 700}).items())


def test_replaced_rows_are_not_staged_or_compared(spark, store, monkeypatch):
    store.upsert(rows(spark, [(f"k{i}", i) for i in range(40)]))
    before = {s.bucket: s.folder for s in store.segments()}
    monkeypatch.setattr("gripelode.stores.stage", None)
    assert store.replace(rows(spark, [("k7", 700), ("new", 1)])) == 2
    assert held(store.read()) == sorted([(f"k{i}", 700 if i == 7 else i) for i in range(40)] + [("new", 1)])
    assert 1 <= sum(before[s.bucket] != s.folder for s in store.segments()) <= 2
    assert store.replace(rows(spark, [])) == 2


def test_null_keys_and_values(spark, store):
    store.upsert(rows(spark, [(None, 1), ("a", None)]))
    assert store.upsert(rows(spark, [(None, 1), ("a", None)])) == 1
    assert store.read().count() == 2


def test_a_write_that_dies_before_its_manifest_changes_nothing(spark, store, monkeypatch):
    store.upsert(rows(spark, [("a", 1), ("b", 2)]))

    def dies(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(store, "_commit", dies)
    with pytest.raises(RuntimeError):
        store.upsert(rows(spark, [("a", 9)]))
    with pytest.raises(RuntimeError):
        store.append(rows(spark, [("c", 3)]))
    monkeypatch.undo()
    assert held(store.read()) == [("a", 1), ("b", 2)]
    gone = store.drop_old()
    assert {g.split("/")[0] for g in gone} == {"data", "filters"} and held(store.read()) == [("a", 1), ("b", 2)]
    assert store.upsert(rows(spark, [("a", 9)])) == 2 and held(store.read()) == [("a", 9), ("b", 2)]


def test_a_second_writer_of_a_version_fails(spark, store):
    store.upsert(rows(spark, [("a", 1)]))
    with pytest.raises(Exception, match="already exists"):
        store._commit(1, [], {})


def test_a_retried_batch_adds_nothing(spark, store):
    assert store.insert_new(rows(spark, [("a", 1)]), "s", 0) == 1
    assert store.insert_new(rows(spark, [("b", 1)]), "s", 0) == 1  # the same batch again
    assert store.append(rows(spark, []), "s", 1) == 2
    assert held(store.read()) == [("a", 1)]


def test_filters_answer_for_every_stored_key_and_hardly_any_other(spark, store):
    n = 20_000
    frame = spark.range(n).select(F.concat(F.lit("key"), "id").alias("k"), F.col("id").alias("v"), F.lit("x").alias("t"))
    store.append(frame)
    assert sum(s.slots for s in store.segments()) >= n / 1600
    assert store.known(frame).count() == n
    strange = spark.range(40).select(F.concat(F.lit("other"), "id").alias("k"))
    assert store.known(strange).count() == 0 and store.lookup.segments <= 1


def test_micro_batches_read_a_constant_number_of_rows(spark, store):
    """Each batch brings 50 new keys and one that the batch before has brought: only that one's bucket is read."""
    read, expected = [], 0
    for batch in range(9):
        keys = [f"b{batch}-{i}" for i in range(50)] + ([f"b{batch - 1}-0"] if batch else [])
        store.insert_new(rows(spark, [(k, batch) for k in keys]), "s", batch)
        expected += 50
        read.append(store.lookup.rows)
        assert max(sum(s.bucket == b for s in store.segments()) for b in range(4)) <= 6
    assert store.read().count() == expected
    # A merged bucket holds the keys of at most six batches, an unmerged one those of one.
    assert read[0] == 0 and all(0 < r <= 6 * 50 for r in read[1:])
    assert sorted(read[1:])[len(read) // 2] <= 30
    assert store.known(rows(spark, [("new1", 1), ("new2", 2)])).count() == 0
    assert (store.lookup.rows, store.lookup.segments) == (0, 0)
