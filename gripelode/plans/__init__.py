"""All named queries; importing this package registers them."""

from gripelode.plans import cluster_queries, cycle_queries, ingest_queries, publish_queries, seed_queries, source_queries, stream_queries, text_queries  # noqa: F401
from gripelode.plans.registry import QUERIES, oracles

__all__ = ["QUERIES", "oracles"]
