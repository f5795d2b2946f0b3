"""Ingest, seeds, reports, publishing and streams on small frames."""

import random
from collections import Counter
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from gripelode import lexicon as lx
from gripelode.operators import candidates as cand
from gripelode.operators import ingest, observe, publish, seeds
from gripelode.operators.rank import positions
from gripelode.sources import payloads

T0 = datetime(2024, 1, 1)
LANDED = "fingerprint string, ingest_seq long, scraped_at timestamp_ntz, comment_text string"


def landed(n, copies_of=None):
    """Rows of which a third are copies of one review."""
    return [("hot" if i % 3 == 0 else f"f{i % 20}", i, T0 + timedelta(hours=i % 7), f"text {i}") for i in range(n)]


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_newest_per_fingerprint_is_idempotent(spark):
    df = spark.createDataFrame(landed(90), LANDED)
    once = ingest.newest_per_fingerprint(df)
    want = {}
    for r in landed(90):
        if r[0] not in want or (r[2], r[1]) > (want[r[0]][2], want[r[0]][1]):
            want[r[0]] = r
    assert rows(once) == sorted(want.values(), key=str)
    assert rows(ingest.newest_per_fingerprint(once)) == rows(once)


def test_second_ingest_inserts_nothing(spark):
    df = spark.createDataFrame(landed(60), LANDED)
    new = ingest.insert_if_new(df, df.limit(0), ["scraped_at", "ingest_seq"])
    assert new.count() == len({r[0] for r in landed(60)})
    assert ingest.insert_if_new(df, new, ["scraped_at", "ingest_seq"]).count() == 0


def test_cursor_never_moves_back_and_upsert_twice_is_once(spark):
    old = spark.createDataFrame([("a", "2024-01-05T00:00:00+00:00", T0), ("b", "2024-01-01T00:00:00+00:00", T0)], "cursor_key string, cursor_value string, updated_at timestamp_ntz")
    new = spark.createDataFrame([("a", "2024-01-04T00:00:00+00:00"), ("b", "2024-01-02T00:00:00+00:00"), ("c", "2024-01-03T00:00:00+00:00")], "cursor_key string, cursor_value string")
    stamp = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    once = ingest.cursor_upsert(old, new, stamp)
    assert {r[0]: r[1][:10] for r in once.collect()} == {"a": "2024-01-05", "b": "2024-01-02", "c": "2024-01-03"}
    assert rows(ingest.cursor_upsert(once, new, stamp)) == rows(once)


def test_rate_report_equals_brute_force(spark):
    rng = random.Random(3)
    span = 2 * 86_400 * 1_000_000
    times = [("hot" if rng.random() < 0.5 else "k", rng.choice([rng.randrange(span), rng.randrange(20) * 500_000, 86_400_000_000 + rng.randrange(5) * 500_000])) for _ in range(300)]
    log = spark.createDataFrame([(k, T0 + timedelta(microseconds=u)) for k, u in times], "k string, ts timestamp_ntz")
    got = {(r["k"], r["ts"]): (r["events"], r["last_second"], r["last_minute"], r["last_day"]) for r in observe.rate_budget_report(log, "k", "ts").collect()}
    for k, u in set(times):
        mine = [v for key, v in times if key == k]
        want = tuple(sum(u - w < v <= u for v in mine) for w in (1, 1_000_000, 60_000_000, 86_400_000_000))
        assert got[(k, T0 + timedelta(microseconds=u))] == want
    assert len(got) == len(set(times))


def test_rates_of_a_long_window_are_differences_of_running_sums(spark):
    log = spark.createDataFrame([("a", T0)], "k string, ts timestamp_ntz")
    plan = observe.rate_budget_report(log, "k", "ts")._jdf.queryExecution().analyzed().toString()
    # A frame with two moving ends is added up again at every row.
    assert "RangeFrame, unboundedpreceding$()" in plan and "RangeFrame, cast(-" not in plan and "RangeFrame, -" not in plan


def test_positions_count_within_groups(spark):
    data = [("g" if i % 4 else "h", (i * 37) % 101) for i in range(101)]
    df = spark.createDataFrame(data, "g string, v int")
    got = {(r.g, r.v): r.position for r in positions(df, ["g"], [F.col("v")], F.floor(F.col("v") / 10)).collect()}
    for g in "gh":
        for i, v in enumerate(sorted(v for k, v in data if k == g)):
            assert got[(g, v)] == i


def test_seed_csv_round_trip(spark, tmp_path):
    path = tmp_path / "seeds.csv"
    path.write_bytes('﻿"Query" ,ENABLED,,category\n manual   data ,1,x,Ops\nonly\n'.encode())
    got = seeds.read_seed_csv(spark, str(path))
    assert got.columns == ["query", "enabled", "category"]
    assert rows(got) == [("manual data", "1", "Ops"), ("only", "", "")]
    seeds.write_seed_csv(got, str(tmp_path / "out"))
    assert rows(seeds.read_seed_csv(spark, str(tmp_path / "out"))) == rows(got)


def test_starter_seeds(spark):
    made = seeds.starter_seeds(spark)
    assert made["reddit"].count() == len(set(lx.STARTER_COMMUNITIES)) and made["upwork"].count() == 20
    assert made["reddit"].first().keywords.split("|") == lx.PAIN_PHRASES


def test_select_apps_fills_up_from_all(spark):
    data = [(i, f"app{i % 9}", f"p{i % 9}", "7" if i in (0, 9, 18) else "") for i in range(27)]
    apps = spark.createDataFrame(data, "pos long, name string, play_id string, apple_id string").select(
        F.lit("apps").alias("seed_type"), "*", F.lit("").alias("key"), F.lit("x").alias("category"), F.lit("").alias("keywords"), F.lit(True).alias("enabled"))
    got = [(r.prio, r.pos) for r in seeds.select_apps(apps, 12, 2).collect()]
    # The two store-id rows share a key, the next eleven rows hold eight keys, the last slice only repeats.
    assert got == [(0, 0), *[(1, i) for i in range(1, 9)]]


def test_deep_json_walk_visits_every_object(spark):
    body = '{"a": [{"b": {"c": [[{"d": 1}]]}}, {"e": {}}], "t": "x"}'
    deep = '{"n":' * 60 + "1" + "}" * 60
    got = payloads.json_objects(spark.createDataFrame([(1, body), (2, "broken"), (3, deep)], "id int, body string"))
    assert Counter(r.id for r in got.collect()) == {1: 6, 3: 60}
    assert [r.object for r in got.where("id = 1").orderBy("pos").collect()][1:3] == ['{"e":{}}', "{}"]


def test_appstore_entry_as_object_and_bad_ratings(spark):
    def entry(rating, i):
        return f'{{"im:rating": {{"label": "{rating}"}}, "content": {{"label": "I hate  it"}}, "updated": {{"label": "2024-01-02T00:00:00-07:00"}}, "id": {{"label": "{i}"}}}}'

    one = f'{{"feed": {{"entry": {entry(1, "a")}}}}}'
    many = f'{{"feed": {{"entry": [{entry(2, "b")}, {entry("x", "c")}, {entry(5, "d")}, {{"id": {{"label": "e"}}}}]}}}}'
    df = spark.createDataFrame([("1", "App", "Cat", "us", b) for b in (one, many, "junk", '{"feed": {}}')], "apple_id string, app_name string, category string, country string, body string")
    got = payloads.appstore_reviews(df).select("source_item_id", "rating", "comment_text", "posted_at", "country").collect()
    assert sorted(map(tuple, got)) == [("a", 1.0, "I hate it", "2024-01-02T07:00:00+00:00", "US"), ("b", 2.0, "I hate it", "2024-01-02T07:00:00+00:00", "US")]


def test_remap_support(spark):
    pool = [(i, f"fp{i}") for i in range(8)]
    df = spark.createDataFrame([(k, pool, ids) for k, ids in enumerate([[7, 7, 2, 99, -1], [3], [], None, list(range(8))])], "k int, pool array<struct<i:int,fp:string>>, ids array<int>")
    got = [[s.i for s in r.s] for r in df.select("k", cand.remap_support(F.col("pool"), F.col("ids")).alias("s")).orderBy("k").collect()]
    assert got == [[7, 2], [3, 0, 1, 2, 4, 5], [0, 1, 2, 3, 4, 5], [0, 1, 2, 3, 4, 5], [0, 1, 2, 3, 4, 5]]


def test_links_snapshot_and_run_log(spark, tmp_path):
    links = spark.createDataFrame([("c1", "a", "old"), ("c1", "b", "old")], "candidate_id string, review_fingerprint string, link_method string")
    new = spark.createDataFrame([("c1", "b", "new"), ("c2", "b", "new")], links.schema)
    merged = publish.add_links(links, new)
    assert rows(merged) == [("c1", "a", "old"), ("c1", "b", "old"), ("c2", "b", "new")]
    assert rows(publish.add_links(merged, new)) == rows(merged)

    path = str(tmp_path / "public")
    publish.write_snapshot({"links": links}, path, "v1")
    publish.write_snapshot({"links": merged}, path, "v2")
    assert publish.read_snapshot(spark, path, "links").count() == 3

    stats = spark.createDataFrame([("a", 0, 5, 2, 0), ("b", 0, 1, 1, 1), (None, 1, 6, 3, 1)], "source string, is_total int, seen long, inserted long, errors long")
    for day in ("2024-01-01 00:00:00", "2024-01-02 00:00:00"):
        row = observe.run_log_row(stats, F.lit(day).cast("timestamp_ntz"), "incremental", F.lit(9).cast("long"))
        observe.append_run_log(row, str(tmp_path / "run_log"), str(tmp_path / "lines"))
    want = ("incremental", 9, 3, 6, 1, "2024-01-02T00:00:00+00:00")
    assert rows(observe.latest_cycle(spark.read.parquet(str(tmp_path / "run_log")))) == [want]
    assert rows(observe.latest_cycle_file(spark, str(tmp_path / "lines"))) == [want]


def test_exports_write_one_day(spark, tmp_path):
    fields = "candidate_id string, pain_point string, boosted_opportunity_score double, pricing_hint string, suggested_solution string, quality_status string, generated_at timestamp_ntz"
    cands = spark.createDataFrame([("a", "P a!", 5.0, "h", "s", "accepted", T0), ("b", "Q", 7.0, "h", "s", "rejected", T0), ("c", "R", 1.0, "h", "s", "accepted", T0 + timedelta(days=1))], fields)
    cards = spark.createDataFrame([("a", 5.0, 0.6, T0)], "candidate_id string, opportunity_score double, confidence_score double, generated_at timestamp_ntz")
    publish.write_exports(cands, cards, "2024-01-01", str(tmp_path))
    counts = {n: spark.read.json(f"{tmp_path}/{n}").count() for n in ("ideas", "opportunity_clusters", "page_seed", "publish_cards")}
    assert counts == {"ideas": 2, "opportunity_clusters": 2, "page_seed": 1, "publish_cards": 1}
    assert spark.read.json(f"{tmp_path}/page_seed").first().slug == "p-a"


def test_health_snapshots_are_appended_and_the_newest_is_latest(spark, tmp_path):
    path = str(tmp_path / "health")
    for at, n in (("2024-01-01T00:00:00Z", 1), ("2024-01-03T00:00:00Z", 3), ("2024-01-02T00:00:00Z", 2)):
        observe.write_health(spark.createDataFrame([(n, at)], "reviews_count long, taken_at string"), path)
    assert [r["reviews_count"] for r in spark.read.json(f"{path}/latest").collect()] == [3]
    assert spark.read.json(f"{path}/history").count() == 3


def test_market_seeds_merge_by_name_and_url(spark):
    existing = spark.createDataFrame([(0, "Kept", "https://m/?q=Alpha", "", True), (1, "Again", "HTTPS://m/?q=alpha", "x", False), (2, "", "u2", "c", False), (3, "no url", " ", "c", True)], "pos long, product_name string, url string, category string, enabled boolean")
    named = "pos long, name string, category string, enabled boolean"
    apps = spark.createDataFrame([(0, "Beta", "", True), (1, "BETA", "", True), (2, "alpha", "", True), (3, " ", "", True), (4, "É", "", True), (5, "é", "", True)], named)
    fallback = spark.createDataFrame([(0, "beta", "F", True), (1, "Gamma", "F", True)], named)

    def merged(limit=None):
        return sorted((r["prio"], r["pos"], r["product_name"], r["url"]) for r in seeds.merge_market_seeds(existing, apps, fallback, "https://m/?q=", limit).collect())

    everything = [(0, 0, "Kept", "https://m/?q=Alpha"), (0, 2, "Unknown Product", "u2"), (1, 0, "Beta", "https://m/?q=Beta"), (1, 4, "É", "https://m/?q=%C3%89"), (2, 1, "Gamma", "https://m/?q=Gamma")]
    assert merged() == everything
    assert merged(4) == everything[:4] and merged(1) == everything[:2] and merged(100) == everything
