"""Embedding near-dedup with int8 tile products.

Vectors are scaled to length 1 and quantised to int8 with one scale per vector. With q the rounded vector and e = |v - q|
its rounding error, the cosine of two vectors lies within e1 + e2 + e1 * e2 of the product of their rounded forms. Only
pairs whose upper bound reaches the threshold are computed again in double precision.

Equal vectors of one label are one class with a count. The classes of a label are dealt into tiles by hash; each pair of
tiles is one group of at most two tiles, which returns the number of links of its vectors and a spanning forest of the links
instead of all linked pairs.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gripelode.llm import common

TILE = 1024
TILES_AT_ONCE = 64


def _unit(values: pd.Series) -> np.ndarray:
    v = np.stack([np.asarray(x, np.float64) for x in values])
    v = v / np.abs(v).max(axis=1, keepdims=True)  # keeps squares in range
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(int8 rows, scale of each row, bound of each row's rounding error)."""
    scale = np.abs(unit).max(axis=1) / 127
    q = np.rint(unit / scale[:, None]).astype(np.int8)
    error = np.sqrt(((unit - q * scale[:, None]) ** 2).sum(axis=1))
    return q, scale, error * (1 + 1e-9) + 1e-12


def linked_pairs(x: np.ndarray, y: np.ndarray, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    (qx, sx, ex), (qy, sy, ey) = quantise(x), quantise(y)
    # Products of int8 values are exact in float32 while the sum stays below 2**24, in float64 beyond.
    kind = np.float32 if x.shape[1] * 127 * 127 < 1 << 24 else np.float64
    product = (qx.astype(kind) @ qy.astype(kind).T).astype(np.float64) * sx[:, None] * sy[None, :]
    slack = ex[:, None] + ey[None, :] + ex[:, None] * ey[None, :]
    a, b = np.nonzero(product + slack >= threshold - 1e-9)
    if same:
        a, b = a[a < b], b[a < b]
    exact = np.einsum("ij,ij->i", x[a], y[b]) if len(a) else np.empty(0)
    return a[exact >= threshold], b[exact >= threshold]


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> list[tuple[int, int]]:
    parent = list(range(n))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    out = []
    for i, j in zip(a.tolist(), b.tolist()):
        x, y = find(i), find(j)
        if x != y:
            parent[y] = x
            out.append((i, j))
    return out


def _tile_pair(threshold: float):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        i, j = rows["i"].iat[0], rows["j"].iat[0]
        counts: dict[str, list] = {"node": [], "other": [], "links": []}
        for _, same_size in rows.groupby(rows["unit"].map(len), sort=False):  # vectors of other lengths don't link
            left = same_size[same_size["t"] == i].reset_index(drop=True)
            right = left if i == j else same_size[same_size["t"] == j].reset_index(drop=True)
            if not len(left) or not len(right):
                continue
            a, b = linked_pairs(_unit(left["unit"]), _unit(right["unit"]), threshold, i == j)
            if not len(a):
                continue
            ln, lc, rn, rc = left["node"].to_numpy(), left["n"].to_numpy(), right["node"].to_numpy(), right["n"].to_numpy()
            total_l = np.bincount(a, rc[b], len(left)).astype(np.int64)
            total_r = np.bincount(b, lc[a], len(right)).astype(np.int64)
            for node, total in ((ln, total_l), (rn, total_r)):
                k = np.flatnonzero(total)
                counts["node"] += node[k].tolist()
                counts["other"] += [None] * len(k)
                counts["links"] += total[k].tolist()
            offset = 0 if i == j else len(left)
            nodes = ln if i == j else np.concatenate((ln, rn))
            for x, y in _forest(a, b + offset, len(nodes)):
                counts["node"].append(nodes[x])
                counts["other"].append(nodes[y])
                counts["links"].append(0)
        # Built with their types: pandas makes numbers beside None floating, which loses digits.
        return pd.DataFrame({k: pd.array(v, "Int64") for k, v in counts.items()})

    return run


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = 0.93, tile: int = TILE) -> DataFrame:
    """One row per input row: vec_id, n_links, component_id, kept (the smallest id of its component).

    Rows with a null label and vectors that are null, empty, zero or hold null or non-finite components link with nothing.
    Vectors of different lengths don't link. Rows that repeat an id count as separate vectors. Other columns are not read.
    """
    common.prepare(vectors.sparkSession, 4096)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = rows.withColumn("good", F.coalesce(F.col("label").isNotNull() & F.col("v").isNotNull() & finite, F.lit(False)))
    v = F.transform("v", lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x))  # one zero
    rows = rows.withColumn("key", F.when(F.col("good"), F.sha2(F.concat(F.col("label"), F.lit("\0"), F.array_join(v.cast("array<string>"), ",")), 256)))
    same = rows.where("good").groupBy("key").agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("n"), F.any_value("label").alias("label"), F.any_value("v").alias("unit"))
    classes = common.stage(same.withColumn("node", F.xxhash64("key")), "vectors")
    sizes = classes.groupBy("label").agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("tiles"))
    dealt = classes.join(common.small(sizes), "label").withColumn("t", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
    dealt = dealt.withColumn("s", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    dealt = dealt.select("label", F.least("t", "s").alias("i"), F.greatest("t", "s").alias("j"), "t", "node", "n", "unit")
    found = dealt.groupBy("label", "i", "j").applyInPandas(_tile_pair(threshold), "node long, other long, links long")
    found = common.stage(found, "links")
    direct = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = common.components(found.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")))
    known = classes.select("node", "key", "first", "n").join(direct, "node", "left").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    known = common.stage(known.select("key", "first", "root", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")), "classes")
    smallest = known.groupBy("root").agg(F.min("first").alias("component_id"))
    known = known.join(smallest, "root").select("key", "n_links", "component_id")
    out = rows.select("vec_id", "key").join(known, "key", "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
