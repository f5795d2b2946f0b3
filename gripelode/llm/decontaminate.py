"""Benchmark decontamination with anchors: the rarest word shingles of every item.

A passage that is alike shares at least ``percent`` of the weight of the item's shingles, so it holds one of any set of
shingles that weighs more than the rest: each item's rarest shingles, as many as that takes, are its anchors. Every document
that holds an anchor is compared with the item, and the best passage by exact weighted Jaccard similarity of word shingles
decides, so no passage is lost, wherever and however it was changed.

``fingerprints`` and ``near_prints`` compare windows by SimHash; the search does not use them, since a passage that is alike
may be further than any fixed radius.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gripelode.llm import common, words

RADIUS = 7  # bits, of near_prints
#: Words of all items together that are sent to the executors; larger benchmarks are searched in such parts.
PART_WORDS = 2_000_000
U = np.uint64
EPSILON = 1e-9  # sums of weights are compared up to it


class Items:
    """The shingles, their weights and the anchors of the different texts of a benchmark."""

    def __init__(self, ids: list[list[int]], hashes: list[np.ndarray], shared: list[dict[int, int]], size: int, percent: int):
        """For each text its ids, word hashes, and of its shingles that more texts hold how many do."""
        self.ids, self.percent = ids, percent
        self.sizes = [min(size, len(h)) for h in hashes]
        #: For each item its distinct shingles, how often it holds each, and their weights; a shingle of many items says less about each.
        self.own, self.other = [], []
        for h, n, many in zip(hashes, self.sizes, shared):
            values, times = np.unique(words.shingle_hashes(h, n), return_counts=True)
            weight = 1 / np.array([many.get(v, 1) for v in values.view(np.int64).tolist()], float)
            self.own.append((values, times, weight))
            self.other.append(float((times * weight).sum() / times.sum()))  # a shingle that the item does not hold weighs as its own on average
        self.anchors = self._anchors()

    def _anchors(self) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """For each length of shingles: (maybe, values, first, item), where ``item[first[i]:first[i + 1]]`` have ``values[i]`` as an
        anchor, and a value whose low bits are not set in ``maybe`` is none."""
        found: dict[int, list[tuple[np.ndarray, int]]] = {}
        for k, (values, times, weight) in enumerate(self.own):
            order = np.argsort(-weight, kind="stable")
            reached = np.cumsum((times * weight)[order])
            n = np.searchsorted(reached, reached[-1] * (100 - self.percent) / 100 + EPSILON, "right") + 1
            found.setdefault(self.sizes[k], []).append((values[order[:n]], k))
        out = {}
        for size, of in found.items():
            value = np.concatenate([v for v, _ in of])
            order = np.argsort(value, kind="stable")
            values, first = np.unique(value[order], return_index=True)
            maybe = np.zeros(1 << max(16, (8 * len(values)).bit_length()), bool)
            maybe[values & U(len(maybe) - 1)] = True
            out[size] = maybe, values, np.append(first, len(value)), np.repeat([k for _, k in of], [len(v) for v, _ in of])[order]
        return out

    def best(self, k: int, shingles: np.ndarray) -> tuple[float, int, int]:
        """(similarity, first, end) of the passage most alike to item k, in shingles of a text; of equals the first. Below
        ``percent`` the similarity may be given as 0.

        A best passage begins and ends with shingles of the item, and its union weighs at most what the least similarity leaves.
        """
        values, times, weight = self.own[k]
        at = np.minimum(np.searchsorted(values, shingles), len(values) - 1)
        place = np.flatnonzero(values[at] == shingles)
        which = at[place]
        total, other = float((times * weight).sum()), self.other[k]
        found, least = (0.0, 0, 0), self.percent / 100 - EPSILON
        if (np.minimum(np.bincount(which, minlength=len(values)), times) * weight).sum() < least * total:
            return found
        sums = np.concatenate(([0.0], np.cumsum(weight[which])))
        most = total * (1 / max(least, EPSILON) - 1) + EPSILON  # what a passage may hold besides the item
        # Positions that lie so far that what is between would weigh too much; hits weigh at least something, so this only bounds by others.
        ends = np.searchsorted(place - np.arange(len(place)), place - np.arange(len(place)) + most / other, "right")
        for i in range(len(place)):
            if min(total, sums[ends[i]] - sums[i]) < max(least, found[0]) * total - EPSILON:
                continue
            seen, both, over = {}, 0.0, 0.0
            for j in range(i, int(ends[i])):
                s = int(which[j])
                seen[s] = n = seen.get(s, 0) + 1
                if n <= times[s]:
                    both += weight[s]
                else:
                    over += weight[s]
                more = over + other * float(place[j] - place[i] - (j - i))
                if more > most:
                    break
                if (now := both / (total + more)) > found[0] + EPSILON:
                    found = (min(float(now), 1.0), int(place[i]), int(place[j]) + 1)
            if found[0] > 1 - EPSILON:
                return (1.0, *found[1:])
        return found


def near_values(values: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(any, first, print): the prints whose block value is within the radius of v are ``print[first[v]:first[v + 1]]``."""
    flips = [U(sum(1 << b for b in bits)) for n in range(radius + 1) for bits in combinations(range(16), n)]
    near = np.concatenate([values ^ f for f in flips]).astype(np.int64)
    order = np.argsort(near, kind="stable")
    first = np.searchsorted(near[order], np.arange((1 << 16) + 1)).astype(np.int32)
    return first[1:] > first[:-1], first, np.tile(np.arange(len(values), dtype=np.int32), len(flips))[order]


def near_prints(prints: np.ndarray, wanted: np.ndarray, tables: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position, number of the print wanted, distance) of all pairs within RADIUS, each once or more."""
    out = []
    for b, (some, first, owner) in enumerate(tables):
        value = ((prints >> U(16 * b)) & U(0xFFFF)).astype(np.uint16)
        at = np.flatnonzero(some[value])
        begin = first[value[at]]
        n = first[value[at].astype(np.int32) + 1] - begin
        which = owner[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - begin, n)]
        at = np.repeat(at, n)
        distance = np.bitwise_count(prints[at] ^ wanted[which])
        near = distance <= RADIUS
        out.append((at[near], which[near], distance[near]))
    return tuple(np.concatenate(x) for x in zip(*out))


#: The bits of a byte, one in each byte of a 64-bit number.
_LANES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).view(U).ravel()


def fingerprints(hashed: np.ndarray, sizes: list[int]) -> dict[int, np.ndarray]:
    """For each window size the fingerprint of every window; a bit is set if more than half of its words have it set.

    Eight counters share a number: below 256 words the difference of two running sums has no carry between them.
    """
    n, out = len(hashed), {}
    octets = np.ascontiguousarray(hashed).view(np.uint8).reshape(n, 8)
    sums = np.zeros((8, n + 1), U)
    for j in range(8):
        np.cumsum(_LANES[octets[:, j]], out=sums[j, 1:])
    for w in sizes:
        if w > n:
            continue
        if w < 256:
            above = (sums[:, w:] - sums[:, :-w]).view(np.uint8) > w // 2
            packed = np.packbits(above.ravel()).reshape(8, -1).T
        else:
            bits = np.unpackbits(octets, axis=1)
            many = np.zeros((n + 1, 64), np.uint32)
            np.cumsum(bits, axis=0, dtype=np.uint32, out=many[1:])
            packed = np.packbits((many[w:] - many[:-w]) > w // 2, axis=1)
        out[w] = np.ascontiguousarray(packed).view(U).ravel()
    return out


def _search(items: Items):
    def candidates(size: int, shingles: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int]]:
        """(document, item) of all documents that hold an anchor of the item."""
        maybe, values, first, item = items.anchors[size]
        at = np.flatnonzero(maybe[shingles & U(len(maybe) - 1)])
        i = np.minimum(np.searchsorted(values, shingles[at]), len(values) - 1)
        hit = values[i] == shingles[at]
        at, i = at[hit], i[hit]
        doc = np.searchsorted(offsets, at, "right") - 1
        inside = at + size <= offsets[doc + 1]  # else a shingle over two documents
        pairs = np.unique(np.stack((doc[inside], i[inside]), 1), axis=0)
        return sorted({(int(d), int(k)) for d, v in pairs for k in item[first[v] : first[v + 1]]})

    def run(batches):
        for batch in batches:
            ids, texts, out = batch.column(0).to_pylist(), batch.column(1).to_pylist(), []
            for first, hashed, offsets in words.words(texts) if items.ids else ():
                for size in items.anchors:
                    shingles = words.shingle_hashes(hashed, size)
                    for doc, k in candidates(size, shingles, offsets):
                        similarity, a, b = items.best(k, shingles[offsets[doc] : offsets[doc + 1] - size + 1])
                        if similarity * 100 >= items.percent - 100 * EPSILON and similarity > 0:
                            out += [(ids[first + doc], item, similarity, a, b - 1 + size) for item in items.ids[k]]
            columns = list(zip(*out)) if out else [[]] * 5
            yield pa.record_batch([pa.array(columns[i], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()))], ["doc_id", "item_id", "similarity", "first_word", "end_word"])

    return run


def _word_hashes(batches):
    """(item_id, words): the word hashes of items that have words."""
    for batch in batches:
        out, ids = [], batch.column(0).to_pylist()
        for first, hashed, offsets in words.words(batch.column(1).to_pylist()):
            out += [(ids[first + i], hashed[a:b].tobytes()) for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:])) if b > a]
        yield pa.record_batch([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.binary())], ["item_id", "words"])


def weighed(benchmark: DataFrame, size: int) -> DataFrame:
    """(ids, words, shared) of each different text of (item_id, text): its ids, word hashes, and a map from those of its
    shingles that more texts hold to how many of all texts do."""
    items = benchmark.mapInArrow(_word_hashes, "item_id long, words binary").groupBy("words").agg(F.collect_set("item_id").alias("ids"))
    items = common.stage(items.withColumn("key", F.sha2("words", 256)), "items")

    def shingles(batches):
        for batch in batches:
            found = [np.unique(words.shingle_hashes(h, min(size, len(h)))) for h in (np.frombuffer(w, U) for w in batch.column(1).to_pylist())]
            keys = np.repeat(batch.column(0).to_pylist(), [len(f) for f in found]).tolist()
            yield pa.record_batch([pa.array(keys, pa.string()), pa.array(np.concatenate([*found, np.empty(0, U)]).view(np.int64))], ["key", "shingle"])

    held = items.select("key", "words").mapInArrow(shingles, "key string, shingle long")
    many = common.stage(held.groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "shared")
    shared = held.join(common.small(many), "shingle").groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("shingle", "n"))).alias("shared"))
    return items.join(shared, "key", "left").select("ids", "words", "shared")


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, item_id, similarity, first_word, end_word): each document and item of which it holds a passage.

    Passages are all runs of words of a document. A passage counts if the weighted Jaccard similarity of its word shingles and the item's is at least ``percent`` / 100;
    the best passage of each item is given, the first of equals. A shingle weighs 1 / (number of different texts of the whole
    benchmark that hold it), one that the item does not hold as much as the item's own on average. Items and texts that are null, empty or hold no words match nothing; items with
    fewer words than ``size`` are one shingle. The benchmark is a stated query set: it is read by the driver in
    parts of PART_WORDS words, and each is searched for in all documents as soon as it is read.
    """
    common.prepare(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    texts = texts.where("doc_id is not null and text is not null")
    asked = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text).cast("string").alias("text")).where("text is not null and item_id is not null").distinct()
    schema = "doc_id long, item_id long, similarity double, first_word long, end_word long"
    found, held, count = [], [], 0
    search = lambda part: texts.mapInArrow(_search(Items([r["ids"] for r in part], [np.frombuffer(r["words"], U) for r in part], [r["shared"] or {} for r in part], size, percent)), schema)
    for row in common.stage(weighed(asked, size), "weighed").toLocalIterator():
        held.append(row)
        count += len(row["words"]) // 8
        if count > PART_WORDS:
            found.append(common.stage(search(held), "leaks"))
            held, count = [], 0
    if held or not found:
        found.append(search(held))
    found = reduce(DataFrame.unionByName, found)
    return found.groupBy("doc_id", "item_id").agg(F.max_by(F.struct("similarity", "first_word", "end_word"), F.struct("similarity", -F.col("first_word"))).alias("m")).select("doc_id", "item_id", "m.*")


def without_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of docs that hold no passage of the benchmark; rows with a null id stay."""
    bad = leaks(docs, benchmark, id_col=id_col, **options).select(F.col("doc_id").alias("_leak")).distinct()
    return docs.join(bad, F.col(id_col) == F.col("_leak"), "left_anti")
