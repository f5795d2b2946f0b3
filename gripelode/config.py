"""Thresholds of the enrichment and ingest jobs.

Every operator takes the settings it needs as arguments; ``Config`` only holds the defaults
that a whole run shares.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Config:
    min_cluster_size: int = 2
    min_sources: int = 1
    min_confidence: float = 0.55
    max_quotes: int = 6
    support_pool: int = 14
    min_supporting: int = 2
    max_links: int = 8
    variants: int = 1
    variant_min_evidence: int = 4
    batch_size: int = 300
    cooldown_hours: int = 24
    daily_budget: float = 500.0
    relaxed_market: bool = True
    rate_per_second: int = 8
    rate_per_minute: int = 240
    rate_per_day: int = 35000


DEFAULT = Config()

# The default gate accepts every kept cluster, so reject reports use these thresholds.
STRICT = Config(min_sources=3, min_confidence=0.70)
