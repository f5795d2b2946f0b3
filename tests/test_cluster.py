"""Clustering against plain restatements on small frames."""

import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gripelode.functions import scores
from gripelode.config import DEFAULT, STRICT
from gripelode.operators import cluster
from gripelode.operators.skew import attach_totals, salted_lookup

START = datetime(2024, 1, 1)
FIELDS = "fingerprint string, source string, source_item_id string, category string, entity_name string, comment_text string, rating double, posted_ts timestamp_ntz, scraped_at timestamp_ntz"


def review(i, category, comment, source="reddit", item=None, rating=None):
    at = START + timedelta(minutes=i)
    return (f"fp{i:04d}", source, f"it{i}" if item is None else item, category, "Brand", comment, rating, at, at)


def clusters(spark, rows, min_size=2):
    keyed = cluster.key_reviews(spark.createDataFrame(rows, FIELDS))
    got = cluster.merge_small_clusters(keyed, min_size).select("cluster_key", "fingerprint").collect()
    out = defaultdict(set)
    for key, fp in got:
        out[key].add(fp)
    return dict(out)


def test_small_clusters_pool_and_small_pools_are_dropped(spark):
    rows = [review(0, "crm", "slow sync"), review(1, "crm", "slow sync"), review(2, "crm", "lost notes"), review(3, "crm", "bad export"), review(4, "tax", "odd form")]
    assert clusters(spark, rows) == {"crm::slow-sync": {"fp0000", "fp0001"}, "crm::merged": {"fp0002", "fp0003"}}


def test_nothing_survives_keeps_all(spark):
    assert clusters(spark, [review(0, "crm", "slow sync"), review(1, "tax", "odd form")]) == {"crm::slow-sync": {"fp0000"}, "tax::form-odd": {"fp0001"}}


def test_pool_replaces_a_cluster_of_its_name(spark):
    rows = [review(0, "crm", "merged"), review(1, "crm", "merged"), review(2, "crm", "lost notes"), review(3, "crm", "bad export")]
    assert clusters(spark, rows) == {"crm::merged": {"fp0002", "fp0003"}}


def test_rows_without_terms_are_left_out(spark):
    assert clusters(spark, [review(0, "crm", "the app"), review(1, "crm", "slow"), review(2, "crm", "slow"), review(3, "crm", "  ")]) == {"crm::slow": {"fp0001", "fp0002"}}


@pytest.fixture(scope="module")
def skewed(spark):
    """One cluster holds more than a third of the rows, one item id most of that."""
    rng = random.Random(7)
    words = ["slow", "hate", "budget", "sync", "export", "pay", "bug", "fine", "notes", "charge"]
    rows = []
    for i in range(400):
        key = "hot" if rng.random() < 0.4 else f"k{rng.randrange(12)}"
        item = rng.choice(["", "same", f"it{rng.randrange(6)}"])
        rows.append((key, *review(i, "crm", " ".join(rng.choices(words, k=rng.randrange(1, 9))), rng.choice(["a", "b", "c"]), item, rng.choice([None, 1.0, 2.0, 3.0, 5.0]))))
    df = spark.createDataFrame(rows, "cluster_key string, " + FIELDS)
    return rows, cluster.key_reviews(df).withColumn("cluster_key", F.col("cluster_key"))


def plain_support(rows, limit):
    def score(r):
        low = r[6].lower()
        neg = sum(low.count(w) for w in ("hate", "slow", "bug"))
        cues = sum(low.count(w) for w in ("budget", "pay", "charge"))
        bonus = 0.0 if r[7] is None else 2.0 if r[7] <= 2 else 1.0 if r[7] <= 3 else 0.0
        return neg * 1.4 + cues * 1.1 + min(2.5, len(low) / 220.0) + bonus

    ordered = sorted(rows, key=lambda r: -score(r))
    first, repeats, seen = [], [], set()
    for r in ordered:
        (repeats if r[3] and r[3] in seen else first).append(r[1])
        seen.add(r[3])
    return (first + repeats)[:limit]


@pytest.mark.parametrize("limit", [6, 14])
def test_support_rows_equal_greedy_selection(skewed, limit):
    rows, keyed = skewed
    got = defaultdict(dict)
    for r in cluster.support_rows(keyed, limit).select("cluster_key", "support_rank", "fingerprint").collect():
        got[r[0]][r[1]] = r[2]
    for key in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == key]
        assert [got[key][k] for k in sorted(got[key])] == plain_support(mine, limit)


def test_top_terms_equal_counter(skewed):
    rows, keyed = skewed
    got = {r[0]: r[1] for r in cluster.top_term_lists(cluster.top_terms(keyed)).collect()}
    for key in {r[0] for r in rows}:
        counted = Counter(t for r in rows if r[0] == key for t in r[6].split())
        assert got[key] == [t for t, _ in counted.most_common(6)]


def test_attach_totals_equals_join_with_hot_and_missing_keys(spark):
    rows = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i}" if i % 2 else None) for i in range(300)], "id int, key string")
    totals = rows.where("key is not null").groupBy("key").agg(F.count("*").alias("n"), F.min("id").alias("low")).where("key <> 'k3'")
    got = attach_totals(rows, totals, "key", "n", ["id"])
    want = rows.join(totals, "key", "left").select("id", "key", "n", "low")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_salted_lookup_equals_join(spark):
    rows = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i}") for i in range(100)], "id int, key string")
    lookup = spark.createDataFrame([("hot", 1), ("k3", 2)], "lk string, v int")
    got = salted_lookup(rows, lookup, "key", "lk", ["id"]).select("id", "v")
    want = rows.join(lookup, F.col("key") == F.col("lk"), "left").select("id", "v")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_gate_boundaries(spark):
    cases = spark.createDataFrame([(n, s) for n in (1, 2, 4, 5, 6, 9, 10, 11) for s in range(1, 8)], "n long, sc int")
    confidence = scores.heuristic_confidence(F.col("n"), F.col("sc"))
    rows = cases.select("n", "sc", confidence.alias("c"), scores.quality_reason(F.col("n"), F.col("sc"), confidence, DEFAULT).alias("d"),
                        scores.quality_reason(F.col("n"), F.col("sc"), confidence, STRICT).alias("s")).collect()
    for n, sc, c, default, strict in rows:
        assert c == min(0.95, 0.45 + min(0.35, n * 0.03) + min(0.15, sc * 0.04))
        assert default == ("insufficient_evidence" if n < 2 else "accepted")
        assert strict == ("insufficient_evidence" if n < 2 else "insufficient_sources" if sc < 3 and n < 6 else "accepted" if c >= 0.70 else "low_confidence")
