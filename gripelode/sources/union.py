"""All payload shapes as one landed table, and their normalised rows as one frame.

A landed payload is (shape, attributes, body): attributes are its other fields as VARIANT. The table is written by shape, so
each normaliser reads its own part, and the union of all of them reads the table once.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gripelode.session import stage
from gripelode.sources import payloads


@dataclass(frozen=True)
class Shape:
    """Attributes (name and type) that a payload of this shape carries besides its body, and what makes review rows of it."""

    attributes: dict[str, str]
    normalise: Callable[[DataFrame], DataFrame]


def _strings(*names: str) -> dict[str, str]:
    return dict.fromkeys(names, "string")


def _job_nodes(rows: DataFrame) -> DataFrame:
    items = payloads.job_nodes(payloads.json_objects(rows))
    return payloads.job_reviews(payloads.first_items(items, ["payload_id"], [F.col("pos").asc()], None))


def _job_page(rows: DataFrame) -> DataFrame:
    found = payloads.job_page_chunks(rows, None)
    return payloads.job_reviews(found.withColumn("category", F.lit(None).cast("string")))


SHAPES: dict[str, Shape] = {
    "play": Shape(_strings("play_id", "app_name", "category", "country"), payloads.play_reviews),
    "appstore": Shape(_strings("apple_id", "app_name", "category", "country"), payloads.appstore_reviews),
    "community": Shape(_strings("community"), payloads.community_posts),
    "forum": Shape(_strings("query", "category"), payloads.forum_chunks),
    "launch": Shape(_strings("query", "category"), payloads.launch_chunks),
    "atom": Shape(_strings("query", "category"), payloads.atom_reviews),
    "rss": Shape(_strings("query", "category"), lambda rows: payloads.job_reviews(payloads.rss_items(rows))),
    "dataset": Shape(_strings("query", "category"), lambda rows: payloads.job_reviews(payloads.dataset_items(rows))),
    "job_nodes": Shape(_strings("payload_id", "query", "category"), _job_nodes),
    "job_page": Shape(_strings("query"), _job_page),
    "market": Shape(_strings("source", "url", "product_name", "category"), lambda rows: payloads.market_reviews(rows.withColumnRenamed("body", "html"))),
}


def landed(frames: dict[str, DataFrame]) -> DataFrame:
    """Payloads of all shapes as (shape, attributes, body), staged by shape."""
    out = None
    for name, frame in frames.items():
        held = F.struct(*[F.col(c).cast(t).alias(c) for c, t in SHAPES[name].attributes.items()])
        rows = frame.select(F.lit(name).alias("shape"), F.to_variant_object(held).alias("attributes"), "body")
        out = rows if out is None else out.unionByName(rows)
    return stage(out, "landed", by="shape")


def of_shape(rows: DataFrame, name: str) -> DataFrame:
    """The payloads of one shape with their attributes as columns."""
    held = [F.try_variant_get("attributes", f"$.{c}", t).alias(c) for c, t in SHAPES[name].attributes.items()]
    return rows.where(F.col("shape") == name).select(*held, "body")


def normalised(rows: DataFrame, signals: DataFrame | None = None) -> DataFrame:
    """Review rows of all landed payloads; ``signals``: demand rows made of seeds without a payload."""
    parts = [shape.normalise(of_shape(rows, name)) for name, shape in SHAPES.items()]
    out = parts[0] if signals is None else parts[0].unionByName(signals)
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
