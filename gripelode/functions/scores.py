"""Scores, labels and the quality gate. Operand order is fixed: results sit on gate edges."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from gripelode import lexicon as lx
from gripelode.config import Config


def capped(limit: float, c: Column) -> Column:
    return F.least(F.lit(limit), c)


def heuristic_willingness(n: Column, source_count: Column, cues: Column) -> Column:
    return capped(100.0, cues * F.lit(10.0) + F.least(F.lit(60), n) * F.lit(0.9) + source_count * F.lit(8.0))


def willingness_label(score: Column) -> Column:
    return F.when(score < 35, "low").when(score < 70, "medium").otherwise("high")


def heuristic_confidence(n: Column, source_count: Column) -> Column:
    return capped(0.95, F.lit(0.45) + capped(0.35, n * F.lit(0.03)) + capped(0.15, source_count * F.lit(0.04)))


def willingness_score(heuristic: Column, label: Column) -> Column:
    floor = reduce(lambda w, kv: w.when(label == kv[0], kv[1]), lx.WILLINGNESS_FLOOR.items(), F)
    return F.greatest(heuristic, floor)


def raw_score(n: Column, source_count: Column, willingness: Column, confidence: Column) -> Column:
    return capped(
        100.0,
        F.lit(30.0) + capped(45.0, n * F.lit(4.0)) + capped(18.0, source_count * F.lit(5.5))
        + willingness * F.lit(0.12) + confidence * F.lit(12.0),
    )


def boosted_score(score: Column, source_count: Column) -> Column:
    sc = F.greatest(F.lit(1), F.least(F.lit(6), source_count))
    boost = reduce(lambda w, kv: w.when(sc == kv[0], kv[1]), lx.SOURCE_BOOST.items(), F)
    return F.least(F.lit(100.0), F.greatest(F.lit(0.0), score + boost))


def difficulty(boosted: Column) -> Column:
    return F.when(boosted < 60, "Easy").when(boosted < 80, "Medium").otherwise("Hard")


def impact(avg_rating: Column, n: Column) -> Column:
    return F.when((avg_rating <= 1.6) | (n >= 10), "high").when((avg_rating <= 2.0) | (n >= 5), "medium").otherwise("low")


def frequency(n: Column) -> Column:
    return F.when(n >= 10, "high").when(n >= 5, "medium").otherwise("low")


def pricing_hint(label: Column) -> Column:
    return reduce(lambda w, kv: w.when(label == kv[0], kv[1]), lx.PRICING_HINTS.items(), F)


def quality_reason(n: Column, source_count: Column, confidence: Column, cfg: Config) -> Column:
    enough_sources = source_count >= cfg.min_sources
    enough_volume = n >= max(6, cfg.min_cluster_size * 3)
    return (
        F.when(n < cfg.min_cluster_size, "insufficient_evidence")
        .when(~enough_sources & ~enough_volume, "insufficient_sources")
        .when(confidence >= cfg.min_confidence, "accepted")
        .otherwise("low_confidence")
    )


def quality_status(reason: Column) -> Column:
    return F.when(reason == "accepted", "accepted").otherwise("rejected")
