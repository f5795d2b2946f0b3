"""URL filters as a temporal list join, in DataFrame functions only.

Dated entries (list, pattern, action, time) become validity intervals: an entry holds until the next entry of the same list
and pattern. A pattern is a host or a domain, and may go on with a path. Every capture is looked up under all its host
suffixes, and of the intervals of a suffix only those active at the fetch time count. The longest pattern decides per list,
and a capture is blocked if any list blocks it.

Intervals are cut at period bounds, so that captures and intervals meet by (pattern, period): the captures of a hot host
spread over periods, and the join below may be split by Spark, since it is a plain equi-join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gripelode.llm import common

PERIOD_S = 14_400


def host_of(url: Column) -> Column:
    """Lower-case host without user, port and final dot; null if the URL has none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.nullif(F.rtrim(host, F.lit(".")), F.lit(""))


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def intervals(entries: DataFrame) -> DataFrame:
    """(list, domain, path, blocks, valid_from, valid_to): entries are (list, pattern, action, ts) with action ``block``,
    ``allow`` or ``remove``. Of entries of one list, pattern and time the greatest action name holds; those with nulls are left out. Bounds are
    microseconds since 1970; the last entry of a pattern has no end."""
    said = F.col("pattern").cast("string")
    host = F.substring_index(said, "/", 1)
    said = F.concat(F.lower(host), F.expr("substring(cast(pattern as string), length(substring_index(cast(pattern as string), '/', 1)) + 1)"))  # a path keeps its case
    known = entries.select(F.col("list").cast("string"), F.rtrim(said, F.lit("./")).alias("pattern"), "action", F.unix_micros(F.col("ts").cast("timestamp")).alias("valid_from"))
    known = known.where("list is not null and pattern <> '' and action in ('block', 'allow', 'remove') and valid_from is not null")
    known = known.groupBy("list", "pattern", "valid_from").agg(F.max("action").alias("action"))
    until = F.lead("valid_from").over(Window.partitionBy("list", "pattern").orderBy("valid_from"))
    domain = F.substring_index("pattern", "/", 1)
    rows = known.withColumn("valid_to", until).where("action <> 'remove'")
    return rows.select("list", domain.alias("domain"), F.expr("substring(pattern, length(substring_index(pattern, '/', 1)) + 1)").alias("path"), (F.col("action") == "block").alias("blocks"), "valid_from", "valid_to")


def suffixes(host: Column) -> Column:
    """The host and its parent domains of at least two labels; a host of one label is itself."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    return F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.array_join(F.slice(labels, i, n), "."))


def decide(captures: DataFrame, entries: DataFrame, id_col: str = "page_id", url_col: str = "url", ts_col: str = "fetched_at", period_s: int = PERIOD_S) -> DataFrame:
    """One row per capture: page_id, host, n_active (active entries that match), blocked, blocked_by (sorted list names).

    Captures with a null URL, a URL without a host, or a null time match nothing and are kept. Repeated rows each get a row.
    """
    width = period_s * 1_000_000
    seen = captures.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), F.unix_micros(F.col(ts_col).cast("timestamp")).alias("at"))
    seen = seen.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url"))).withColumn("row", F.monotonically_increasing_id())
    seen = common.stage(seen.drop("url"), "captures")
    bounds = seen.agg(F.min("at").alias("low"), F.max("at").alias("high"))
    spans = intervals(entries).crossJoin(F.broadcast(bounds)).where("valid_from <= high and (valid_to is null or valid_to > low)")  # one row of bounds
    first, last = F.greatest("valid_from", "low"), F.least(F.coalesce(F.col("valid_to") - 1, F.col("high")), "high")
    spans = spans.withColumn("period", F.explode(F.sequence(F.floor(first / width), F.floor(last / width)))).drop("low", "high")
    asked = seen.where("host is not null and at is not null").select("row", "at", "path", F.explode(suffixes(F.col("host"))).alias("domain"))
    asked = asked.withColumn("period", F.floor(F.col("at") / width)).withColumnRenamed("path", "asked_path")
    inside = (F.col("path") == "") | (F.col("asked_path") == F.col("path")) | F.expr("startswith(asked_path, concat(path, '/'))")
    active = (F.col("at") >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col("at") < F.col("valid_to")))
    hits = asked.join(spans, ["domain", "period"]).where(inside & active)
    longest = hits.groupBy("row", "list").agg(F.max_by("blocks", F.struct(F.length("domain") + F.length("path"), F.length("path"))).alias("blocks"), F.count(F.lit(1)).alias("n"))
    verdict = longest.groupBy("row").agg(F.sum("n").alias("n_active"), F.sort_array(F.collect_list(F.when(F.col("blocks"), F.col("list")))).alias("blocked_by"))
    out = seen.select("row", "page_id", "host").join(verdict, "row", "left")
    names = F.coalesce("blocked_by", F.array().cast("array<string>"))
    return out.select("page_id", "host", F.coalesce("n_active", F.lit(0)).alias("n_active"), (F.size(names) > 0).alias("blocked"), F.array_join(names, ",").alias("blocked_by"))
