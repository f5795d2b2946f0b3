"""N-gram Jaccard join by parity sketches.

A text's distinct word shingles are hashed into blocks; the XOR of a block's hashes is its parity sketch. Each shingle in
which two sets differ changes one block, so the number of unequal blocks never exceeds the symmetric difference. Sets with
intersection / union >= p/100 differ in at most D = (100 - p) / (100 + p) * (a + b) shingles: with D + 1 + s blocks per
size band at least s + 1 blocks are equal, and a set with at most s empty blocks need not send them. Sets with more empty
blocks also send blocks under another seed.

Blocks held by at most COLD sets give all their pairs; a pair goes on if its blocks, with the empty and the hot ones that it
may share, are the s + 1 that a link needs. The holders of a block held by more sets are one group, named by its pivot, the
holder of most such blocks; groups whose pivots hold a block of a better pivot are merged. Every member is compared with the
pivot. What is left are the pairs of a group in different components: the members meet in tiles of at most PAIRED x PAIRED
sets, where sets with too few shingles that another set of the tile holds go first and the others are compared by matrix
products. A tile gives one link for each two components that it joins, so neither rows nor memory grow with the pairs of a
group. A set with at most s empty or hot blocks leaves its hot blocks, since any link of it shows in another block.
All candidate pairs are verified on the full sets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gripelode.llm import common, words

COLD, SEEDS, JUMPS = 16, 3, 1
PAIRED = 2048  # sets of a tile's side
TILE_BYTES = 4 << 20  # of the shingles of a tile's side
BLOCK, COLUMNS = 1024, 2048  # of a tile's matrix products
FLUSH = 700_000  # block keys that a task holds before it hands them on
PER_BUCKET = 1_000_000
HOT_KEYS = 1_000_000  # hot keys that are broadcast; with more, the keys of all sets are shuffled
U = np.uint64


def bands(percent: int, longest: int = 1 << 40) -> np.ndarray:
    """First sizes of the bands: sets that can link are in the same or in neighbouring bands."""
    edges = [1]
    while edges[-1] <= longest:
        edges.append(max(edges[-1] + 1, -(-edges[-1] * 100 // percent)))
    return np.array(edges, np.int64)


def block_keys(sets: np.ndarray, sizes: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(set number, key, free blocks) for all sets at once; ``sets`` holds their sorted hashes one after the other.

    Free blocks: how many hot keys the set may leave, negative where it had to take another seed.
    """
    edges = bands(percent, int(sizes.max(initial=1)) * 2)
    band = np.searchsorted(edges, sizes, "right") - 1
    for up in (0, 1):
        chosen = sizes > 0 if not up else (sizes > 0) & (sizes * 100 // percent >= edges[band + 1])
        which = np.flatnonzero(chosen)
        space = band[which] + up
        differ = (100 - percent) * 2 * (edges[space + 1] - 1) // (100 + percent)
        spare = np.where(differ > 8, (differ + 1) // 10 + 1, 0)
        count = differ + 1 + spare
        values = sets[np.repeat(chosen, sizes)]
        n, free = sizes[which], np.full(len(which), -1)
        for seed in range(SEEDS + 1):
            if not len(which):
                break
            owner = np.repeat(np.arange(len(which)), n)
            if seed:
                values = words.mix(values + U(seed))
                order = np.lexsort((values, owner))
                values = values[order]
            block = ((values >> U(32)) * np.repeat(count, n).astype(U)) >> U(32)
            first = np.flatnonzero(np.concatenate(([True], (owner[1:] != owner[:-1]) | (block[1:] != block[:-1]))))
            owners = owner[first]
            tag = (U(seed) << U(58)) | (np.repeat(space, n)[first].astype(U) << U(44)) | block[first]
            keys = words.mix(np.bitwise_xor.reduceat(values, first) ^ words.mix(tag))
            empty = count - np.bincount(owners, minlength=len(which))
            left = spare - empty
            if not seed:
                free = left
            yield which[owners], keys, free[owners]
            again = left < 0
            if seed == SEEDS - 1 and again.any():  # no seed has few empty blocks: send these too
                for i in np.flatnonzero(again):
                    gone = np.setdiff1d(np.arange(count[i]), block[first][owners == i].astype(np.int64)).astype(U)
                    tags = (U(seed) << U(58)) | (U(space[i]) << U(44)) | gone
                    yield np.full(len(gone), which[i]), words.mix(words.mix(tags)), np.full(len(gone), -1)
                break
            values, which, space, n = values[np.repeat(again, n)], which[again], space[again], n[again]
            count, spare, free = count[again], spare[again], free[again]


def _node(hashes: np.ndarray) -> int:
    return int(words.mix(np.array([hashes.sum(dtype=U) + U(len(hashes))]))[0].astype(np.int64)) if len(hashes) else 0


def _sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[list, list[np.ndarray]]]:
    for batch in batches:
        yield batch.column(0).to_pylist(), list(words.shingle_sets(batch.column(1).to_pylist(), size))


def _ints(values) -> pa.Array:
    return pa.array(np.asarray(values, np.int64))


def _nodes(size: int) -> Callable:
    def run(batches):
        for ids, sets in _sets(batches, size):
            yield pa.record_batch([pa.array(ids, pa.int64()), _ints([len(s) for s in sets]), _ints([_node(s) for s in sets])], ["doc_id", "n_shingles", "node"])

    return run


def _flushes(batches: Iterator, size: int, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(key, node and free blocks of each key, sets as rows node, size, least free) of different sets, in runs of about FLUSH keys."""
    held: dict[int, np.ndarray] = {}
    total = 0

    def out():
        sizes = np.fromiter((len(s) for s in held.values()), np.int64, len(held))
        nodes = np.fromiter(held, np.int64, len(held))
        parts = list(block_keys(np.concatenate(list(held.values())), sizes, percent))
        who, keys, free = (np.concatenate([p[i] for p in parts]) for i in range(3))
        least = np.full(len(nodes), np.iinfo(np.int64).max)
        np.minimum.at(least, who, free)
        return keys, nodes[who], free, np.stack((nodes, sizes, least), 1)

    for _, sets in _sets(batches, size):
        for s in sets:
            if len(s) and (node := _node(s)) not in held:
                held[node] = s
                total += len(s)
                if total >= FLUSH:
                    yield out()
                    held, total = {}, 0
    if held:
        yield out()


def _bucket(hashed: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashed >> U(32)) * U(buckets)) >> U(32)


def _dealt(size: int, percent: int, buckets: int) -> Callable:
    """Rows (bucket, keys, nodes); of a key's holders in one flush at most COLD + 1 go on, which shows that it is hot."""

    def run(batches):
        for keys, nodes, _, each in _flushes(batches, size, percent):
            order = np.argsort(keys, kind="stable")
            keys, nodes = keys[order], nodes[order]
            first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            rank = np.arange(len(keys)) - np.repeat(first, np.diff(np.append(first, len(keys))))
            keys, nodes = keys[rank <= COLD], nodes[rank <= COLD]
            cuts = np.searchsorted(_bucket(keys, buckets), np.arange(buckets + 1))  # sorted, as the keys are
            own = _bucket(each[:, 0].astype(U), buckets)
            each, own = each[np.argsort(own, kind="stable")], np.sort(own)
            each_cuts = np.searchsorted(own, np.arange(buckets + 1))
            full = np.flatnonzero(np.diff(cuts) + np.diff(each_cuts))
            parts = [[x[c[b] : c[b + 1]].tobytes() for b in full] for x, c in ((keys, cuts), (nodes, cuts), (each, each_cuts))]
            yield pa.record_batch([pa.array(full, pa.int32()), *(pa.array(x, pa.binary()) for x in parts)], ["bucket", "keys", "nodes", "sets"])

    return run


PAIR, HOT, SET = range(3)


def _runs(batches):
    """Rows (kind, a, b, n): pairs and in how many cold keys of the bucket they are, hot keys, and sets with size and free blocks."""
    rows = [[batch.column(i).to_pylist() for i in (1, 2, 3)] for batch in batches]
    if not rows:
        return
    keys, nodes, sets = (np.frombuffer(b"".join(x for r in rows for x in r[i]), t) for i, t in ((0, U), (1, np.int64), (2, np.int64)))
    sets = np.unique(sets.reshape(-1, 3), axis=0)
    order = np.lexsort((nodes, keys))
    keys, nodes = keys[order], nodes[order]
    new = np.concatenate(([True], (keys[1:] != keys[:-1]) | (nodes[1:] != nodes[:-1])))[: len(keys)]
    keys, nodes = keys[new], nodes[new]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))[: len(keys)])
    n = np.diff(np.append(first, len(keys)))
    a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for k in range(2, COLD + 1):
        at = first[n == k]
        for i in range(k):
            for j in range(i + 1, k):
                a.append(nodes[at + i])
                b.append(nodes[at + j])
    pairs, times = np.unique(np.stack((np.concatenate(a), np.concatenate(b)), 1), axis=0, return_counts=True)
    hot = keys[first[n > COLD]].astype(np.int64)
    nothing = np.zeros(len(hot), np.int64)
    kind = np.repeat([PAIR, HOT, SET], [len(pairs), len(hot), len(sets)])
    columns = [(pairs[:, 0], hot, sets[:, 0]), (pairs[:, 1], nothing, sets[:, 1]), (times, nothing, sets[:, 2])]
    yield pa.record_batch([pa.array(kind, pa.int32()), *(_ints(np.concatenate(c)) for c in columns)], ["kind", "a", "b", "n"])


def _held(size: int, percent: int, hot) -> Callable:
    """Rows (node, free, keys) with all keys of a set, or the hot ones if they are given; free: the least of its keys."""

    def run(batches):
        wanted = None if hot is None else np.sort(np.frombuffer(hot.value, np.int64))
        for keys, nodes, free, _ in _flushes(batches, size, percent):
            keys = keys.astype(np.int64)
            if wanted is not None:
                at = np.minimum(np.searchsorted(wanted, keys), len(wanted) - 1)
                keep = wanted[at] == keys
                keys, nodes, free = keys[keep], nodes[keep], free[keep]
            if not len(keys):
                continue
            order = np.argsort(nodes, kind="stable")
            keys, nodes, free = keys[order], nodes[order], free[order]
            first = np.flatnonzero(np.concatenate(([True], nodes[1:] != nodes[:-1])))
            ends = pa.array(np.append(first, len(keys)), pa.int32())
            yield pa.record_batch([_ints(nodes[first]), _ints(np.minimum.reduceat(free, first)), pa.ListArray.from_arrays(ends, _ints(keys))], ["node", "free", "keys"])

    return run


def _bytes(size: int) -> Callable:
    def run(batches):
        for _, sets in _sets(batches, size):
            yield pa.record_batch([_ints([_node(s) for s in sets]), pa.array([s.tobytes() for s in sets], pa.binary())], ["node", "shingles"])

    return run


def _verify(percent: int) -> Callable:
    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = np.frombuffer(x, U), np.frombuffer(y, U)
                both = len(x) + len(y)
                if min(len(x), len(y)) * 100 < percent * max(len(x), len(y)):
                    keep.append(False)
                    continue
                merged = np.sort(np.concatenate((x, y)))
                keep.append(bool(np.count_nonzero(merged[1:] == merged[:-1]) * (100 + percent) >= percent * both))
            yield pa.record_batch([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def linked_sets(sets: list[np.ndarray], roots: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links (i, j) that join all sets of different roots that link, one for each two components that they join."""
    sizes = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    values, column, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    left, found = len(sets) + 1, np.ones(len(sets), bool)
    while found.sum() < left:  # a shingle that one set holds links nothing; sets go that have too few others
        left = found.sum()
        shared = np.bincount(owner, (held > 1)[column], len(sets))
        found &= shared * 100 >= percent * sizes
        keep = found[owner]
        owner, column = owner[keep], column[keep]
        held = np.bincount(column, minlength=len(values))
    which = np.flatnonzero(found)
    new = np.cumsum(held > 1) - 1
    keep = held[column] > 1
    owner, column = np.searchsorted(which, owner[keep]), new[column[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    label = np.unique(roots, return_inverse=True)[1][which]
    out = []
    for a in range(0, len(which), BLOCK):
        both = np.zeros((min(BLOCK, len(which) - a), len(which)), np.float32)
        for c in range(0, int(new[-1]) + 1, COLUMNS):
            part = slice(*np.searchsorted(column, (c, c + COLUMNS)))
            for b in range(a // BLOCK * BLOCK, len(which), BLOCK):
                x, y = (np.zeros((min(BLOCK, len(which) - at), COLUMNS), np.float32) for at in (a, b))
                for to, at in ((x, a), (y, b)):
                    mine = (owner[part] >= at) & (owner[part] < at + len(to))
                    to[owner[part][mine] - at, column[part][mine] - c] = 1
                both[:, b : b + len(y)] += x @ y.T
        for i, row in enumerate(both.astype(np.int64), a):
            near = np.flatnonzero((row * (100 + percent) >= percent * (sizes[which] + sizes[which[i]])) & (label != label[i]))
            for j in near[np.unique(label[near], return_index=True)[1]]:
                out.append((int(which[i]), int(which[j])))
                label[label == label[j]] = label[i]
    return out


def _tile(percent: int) -> Callable:
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        sets = [np.frombuffer(s, U) for s in rows["shingles"]]
        nodes = rows["node"].to_numpy()
        links = np.array(linked_sets(sets, rows["root"].to_numpy(), percent), np.int64).reshape(-1, 2)
        return pd.DataFrame({"a": nodes[links[:, 0]], "b": nodes[links[:, 1]]})

    return run


def _sides(which: Column) -> Column:
    """How many sides of tiles the rows need."""
    return F.greatest(F.ceil(F.count_if(which) / max(PAIRED, 1)), F.ceil(F.coalesce(F.sum(F.when(which, F.col("bytes"))), F.lit(0)) / TILE_BYTES)).cast("int")


def _tiled(members: DataFrame, roots: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that join all members of one group that link; members: gid, node, where the gid is a node too.

    Members in the component of their gid meet all others of the group, and these each other.
    """
    known = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    known = common.stage(known.join(sets.select("node", F.octet_length("shingles").alias("bytes")), "node"), "known")
    main = known.where("gid = node").select("gid", F.col("root").alias("main"))
    known = known.join(common.small(main), "gid").withColumn("other", F.col("root") != F.col("main"))
    sides = known.groupBy("gid").agg(_sides(~F.col("other")).alias("x"), _sides(F.col("other")).alias("y")).where("y > 0")
    known = known.join(common.small(common.stage(sides, "sides")), "gid")
    own = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    known = known.withColumn("t", F.when(F.col("other"), F.col("x") + own("y")).otherwise(own("x")))
    known = known.withColumn("s", F.explode(F.sequence(F.when(F.col("other"), F.lit(0)).otherwise(F.col("x")), F.col("x") + F.col("y") - 1)))
    dealt = known.select("gid", F.least("t", "s").alias("i"), F.greatest("t", "s").alias("j"), "node", "root").join(sets, "node")
    return dealt.groupBy("gid", "i", "j").applyInPandas(_tile(percent), "a long, b long")


def _groups(held: DataFrame) -> DataFrame:
    """Groups (gid, node) in which any two holders of one key meet; held: node, keys. A group's gid is the node of its pivot."""
    each = held.select("node", F.struct(F.size("keys").alias("weight"), "node").alias("me"), F.explode("keys").alias("key"))
    pivots = each.groupBy("key").agg(F.max("me").alias("pivot"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    members = common.stage(each.join(common.small(common.stage(pivots, "pivots")), "key").select("node", "pivot").distinct(), "members")
    for _ in range(JUMPS):
        better = members.groupBy(F.col("node").alias("_of")).agg(F.max("pivot").alias("_to"))
        better = better.join(members.select(F.col("pivot.node").alias("_of")).distinct(), "_of", "left_semi")
        members = members.join(common.small(better), members["pivot.node"] == F.col("_of")).select("node", F.col("_to").alias("pivot")).distinct()
    members = members.select(F.col("pivot.node").alias("gid"), "node")
    return members.unionByName(members.select("gid", F.col("gid").alias("node"))).distinct()


def _hot_roots(members: DataFrame, links: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Components (node, root) of the links in groups (gid, node) and those given."""
    against = members.where("gid <> node").select(F.col("gid").alias("a"), F.col("node").alias("b"))
    linked = _verified(against, sets, percent)
    roots = common.stage(common.components(links.unionByName(linked)), "roots")
    return common.joined_roots(roots, common.stage(_tiled(members, roots, sets, percent), "links"))


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (smallest id reachable by links), n_copies (rows with an
    equal shingle set, itself included).

    Texts without words and null texts have 0 shingles and link with nothing; texts of fewer than ``size`` words are one
    shingle. Rows with a null id keep their row and never name a component that has another id. Other columns are not read.
    Sets are told apart by 64-bit hashes of their shingle hashes.
    """
    spark = common.prepare(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = common.stage(texts.mapInArrow(_nodes(size), "doc_id long, n_shingles long, node long"), "sets")
    nodes = rows.where("n_shingles > 0").groupBy("node").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n_copies"))
    roots = find_roots(spark, texts, rows, size, percent)
    found = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    found = common.stage(found, "classes")
    smallest = found.groupBy("root").agg(F.min("first").alias("component_id"))
    found = found.join(smallest, "root").select("node", "component_id", "n_copies")
    linked = rows.join(found, (rows["node"] == found["node"]) & (rows["n_shingles"] > 0), "left")
    return linked.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("n_copies", F.lit(1)).alias("n_copies"))


def find_roots(spark: SparkSession, texts: DataFrame, rows: DataFrame, size: int, percent: int) -> DataFrame:
    """(node, root) of all shingle sets that link with another one: root is the smallest node reachable."""
    total = rows.agg(F.sum("n_shingles")).first()[0] or 0
    buckets = max(common.partitions(spark), total // PER_BUCKET + 1)
    dealt = texts.mapInArrow(_dealt(size, percent, buckets), "bucket int, keys binary, nodes binary, sets binary").repartition(buckets, "bucket")
    found = common.stage(dealt.mapInArrow(_runs, "kind int, a long, b long, n long"), "pairs")
    hot = found.where(F.col("kind") == HOT).select(F.col("a").alias("key")).distinct()
    n_hot = hot.limit(HOT_KEYS + 1).count()
    some = None
    if n_hot <= HOT_KEYS:
        some = spark.sparkContext.broadcast(np.array([r[0] for r in hot.collect()], np.int64).tobytes())
    shape = "node long, free long, keys array<long>"
    held = texts.mapInArrow(_held(size, percent, some), shape).dropDuplicates(["node"]) if n_hot else spark.createDataFrame([], shape)
    if n_hot > HOT_KEYS:
        held = held.select("node", "free", F.explode("keys").alias("key")).join(hot, "key", "left_semi").groupBy("node").agg(F.min("free").alias("free"), F.collect_set("key").alias("keys"))
    held = common.stage(held, "held")
    # Linked sets have s + 1 blocks in common: all but the empty ones and the hot ones show among the cold keys.
    sets = found.where(F.col("kind") == SET).select(F.col("a").alias("node"), F.col("b").alias("size"), F.col("n").alias("free")).distinct()
    sets = sets.join(held.select("node", F.size("keys").alias("hot")), "node", "left").select("node", F.struct("size", "free", F.coalesce("hot", F.lit(0)).alias("hot")).alias("about"))
    sets = common.stage(sets, "sizes")
    pairs = found.where(F.col("kind") == PAIR).groupBy("a", "b").agg(F.sum("n").alias("n"))
    pairs = pairs.join(sets.withColumnsRenamed({"node": "a", "about": "x"}), "a").join(sets.withColumnsRenamed({"node": "b", "about": "y"}), "b")
    pairs = pairs.where(F.least("x.size", "y.size") * 100 >= F.greatest("x.size", "y.size") * percent).where(F.col("n") + F.least("x.hot", "y.hot") > F.greatest("x.free", "y.free"))
    pairs = common.stage(pairs.select("a", "b"), "candidates")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    links = common.stage(_verified(pairs, set_bytes(texts, rows, wanted, size), percent), "links")
    held = held.where((F.col("free") < 0) | (F.size("keys") > F.col("free")))
    if held.isEmpty():
        return common.components(links)
    members = common.stage(_groups(held), "groups")
    sets = set_bytes(texts, rows, members.select("node").distinct(), size)
    return _hot_roots(members, links, sets, percent)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    shown = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a").join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b")
    return shown.select("a", "b", "x", "y").mapInArrow(_verify(percent), "a long, b long")


def set_bytes(texts: DataFrame, rows: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """(node, shingles) of the given sets, staged; each from the row of the smallest id that holds it, or from rows without one."""
    owners = rows.join(nodes, "node", "left_semi").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    owners = common.stage(owners, "owners")
    chosen = texts.join(common.small(owners.select("doc_id").where("doc_id is not null").distinct()), "doc_id", "left_semi")
    if not owners.where("doc_id is null").isEmpty():  # sets that only rows with a null id hold
        chosen = chosen.unionByName(texts.where("doc_id is null"))
    made = chosen.mapInArrow(_bytes(size), "node long, shingles binary")
    return common.stage(made.join(owners.select("node"), "node", "left_semi").dropDuplicates(["node"]), "sets")
