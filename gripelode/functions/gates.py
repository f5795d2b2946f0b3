"""Source gates as boolean Columns. Matching is by substring, never by word."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gripelode import lexicon as lx
from gripelode.functions.text import clean, contains_any, let, query_match, sentiment, text_of


def _pain(low: Column) -> Column:
    return contains_any(low, lx.PAIN_PHRASES)


def pain(c: Column) -> Column:
    return let(F.lower(text_of(c)), _pain)


def mobile(rating: Column, c: Column) -> Column:
    return F.coalesce(rating <= 2, F.lit(False)) & pain(c)


def community(c: Column) -> Column:
    return let(F.lower(text_of(c)), lambda low: _pain(low) & (sentiment(low) <= -1))


def market_strict(rating: Column, c: Column) -> Column:
    return F.coalesce(rating <= 2, F.lit(False)) | pain(c)


def market(rating: Column, c: Column, source: Column, relaxed: bool = True) -> Column:
    if not relaxed:
        return market_strict(rating, c)
    eased = F.lower(clean(source)).isin("g2", "capterra")
    easy = let(F.lower(text_of(c)), lambda low: contains_any(low, lx.MARKET_TERMS)) | (rating <= 3.5) | (F.length(text_of(c)) >= 120)
    return market_strict(rating, c) | (eased & F.coalesce(easy, F.lit(False)))


def job(c: Column) -> Column:
    return let(F.lower(text_of(c)), lambda low: _pain(low) | (
        contains_any(low, lx.JOB_WILLINGNESS_TERMS) & contains_any(low, lx.JOB_INEFFICIENCY_TERMS)
    ))


def forum(c: Column, query: Column) -> Column:
    def passes(low: Column) -> Column:
        return (F.length(low) >= 80) & (_pain(low) | contains_any(low, lx.FORUM_PROBLEM_TERMS)) & (sentiment(low) <= 2)

    return let(F.lower(clean(c)), passes) & (query_match(c, query) > 0)


def launch(c: Column, query: Column) -> Column:
    return let(F.lower(clean(c)), lambda low: (F.length(low) >= 80) & _pain(low) & (sentiment(low) <= 0)) & (query_match(c, query) > 0)


def blocked(c: Column, launch_page: bool = False) -> Column:
    def hit(low: Column) -> Column:
        found = contains_any(low, lx.BLOCKED_TERMS)
        return found | (low.contains("forbidden") & low.contains("403")) if launch_page else found

    return let(F.lower(text_of(c)), hit)


def job_chunk(c: Column) -> Column:
    priced = let(F.lower(text_of(c)), lambda low: contains_any(low, ["$", "hourly", "fixed-price"]))
    return (F.length(c) >= 120) & priced & job(c)


def after_cursor(posted: Column, cursor: Column) -> Column:
    """Unknown times and missing cursors pass."""
    return cursor.isNull() | posted.isNull() | (posted > cursor)
