"""Named queries against their SQL; GRIPELODE_CHECKS=all runs every one of them."""

import os

import pytest
from compare import duck, mismatch

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
QUICK = [
    "fn_clean", "fn_parse_ts", "fn_strip_html", "gate_market", "norm_appstore", "norm_jobs", "norm_market_pages", "json_walk_order", "dedupe_latest", "merged_clusters",
    "seed_keys", "rate_budget_report", "cursor_filter", "enrich_batch_filled", "meta_seed_merge_all", "rebuild_cards_all", "stream_rate", "stream_cursor",
]
NAMES = list(entry.queries()) if os.environ.get("GRIPELODE_CHECKS") == "all" else QUICK


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, con, name):
    assert mismatch(spark, con, entry.queries()[name], entry.oracle_sql().get(name), SF) is None


def test_every_check_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
