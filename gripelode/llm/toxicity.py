"""Toxicity by nearest labelled examples under exact TF-IDF cosine, found with a block-max inverted index.

Features are words and their first bytes. Labelled training documents, all of them, tell which features go with the label:
every feature whose shares differ by MIN_RATIO, beyond chance, is a term, so the test means the same at every size. Document frequencies of the terms are counted over all documents. A bounded sample of labelled
examples is indexed as sparse postings: examples lie in blocks, and each term stores its largest weight per block. A document's blocks are
visited in order of their bounds until no block can hold a better neighbour, so the K nearest are exact. Neighbours vote
with their squared cosine, and a logistic curve fitted on further labelled rows turns the vote into a probability.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gripelode.llm import common, words

EXAMPLES = 2048  # indexed examples of each label; as many again of each fit the curve
MIN_DOCS, MIN_Z, MIN_RATIO = 5, 5.0, 2.0
PREFIXES = (4, 5, 6)  # bytes
K, BLOCK, PRIOR = 32, 64, 0.25
HELD = 2_000_000
U = np.uint64


def features(texts: list[str | None]):
    """(text number, feature) of every word and prefix, for runs of texts: (first text, texts, numbers, features)."""
    for first, end, raw, bounds in words.chunks(texts):
        starts, ends = words.spans(raw)
        owner = np.searchsorted(bounds, starts, "right") - 1
        own, found = [owner], [words.hashes(raw, starts, ends)]
        for n in PREFIXES:
            long = ends - starts > n
            own.append(owner[long])
            found.append(words.mix(words.hashes(raw, starts[long], starts[long] + n) + U(n)))
        yield first, end - first, np.concatenate(own), np.concatenate(found)


def _labelled_counts(batches):
    """(feature, documents labelled 1, documents labelled 0)."""
    held, total = [], 0

    def out():
        values, back = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
        ones = np.bincount(back, np.concatenate([h[1] for h in held]), len(values)).astype(np.int64)
        zeros = np.bincount(back, np.concatenate([h[2] for h in held]), len(values)).astype(np.int64)
        return values, ones, zeros

    for batch in batches:
        label = np.array(batch.column(0).to_pylist(), np.int64)
        for first, n, owner, found in features(batch.column(1).to_pylist()):
            mixed = _distinct(owner, found)
            values, back = np.unique(mixed[1], return_inverse=True)
            one = label[first + mixed[0]]
            ones = np.bincount(back, one, len(values))
            held.append((values, ones, np.bincount(back, minlength=len(values)) - ones))
            total += len(values)
            if total > HELD:
                held = [out()]
                total = len(held[0][0])
                if total > HELD // 2:
                    yield _count_batch(*held[0])
                    held, total = [], 0
    if held:
        yield _count_batch(*out())


def _distinct(owner: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each feature once per text."""
    order = np.lexsort((found, owner))
    owner, found = owner[order], found[order]
    new = np.concatenate(([True], (owner[1:] != owner[:-1]) | (found[1:] != found[:-1]))) if len(owner) else np.empty(0, bool)
    return owner[new], found[new]


def _count_batch(values, ones, zeros) -> pa.RecordBatch:
    return pa.record_batch([pa.array(values.astype(np.int64)), pa.array(ones.astype(np.int64)), pa.array(zeros.astype(np.int64))], ["feature", "ones", "zeros"])


class Terms:
    def __init__(self, ids: np.ndarray, weight: np.ndarray | None = None):
        self.ids = np.sort(ids.astype(np.int64).view(U))
        self.weight = weight

    def counts(self, texts: list[str | None]):
        """(texts of the run, text numbers, term numbers, times), sorted by text and term."""
        for first, n, owner, found in features(texts):
            if not len(self.ids):
                yield first, n, np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
                continue
            at = np.minimum(np.searchsorted(self.ids, found), len(self.ids) - 1)
            hit = self.ids[at] == found
            key, times = np.unique(owner[hit] * len(self.ids) + at[hit], return_counts=True)
            yield first, n, key // len(self.ids), key % len(self.ids), times

    def vectors(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each text its terms and weights, scaled to length 1."""
        out = []
        for _, n, owner, term, times in self.counts(texts):
            value = (1 + np.log(times)) * self.weight[term] if len(term) else np.empty(0)
            cuts = np.searchsorted(owner, np.arange(n + 1))
            for a, b in zip(cuts[:-1], cuts[1:]):
                v = value[a:b]
                out.append((term[a:b], v / np.sqrt((v * v).sum()) if b > a else v))
        return out


def _ranges(first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(numbers first[i] to first[i] + size[i] - 1 of all i, size)."""
    return np.arange(size.sum()) - np.repeat(np.cumsum(size) - size - first, size), size


class Index:
    """Examples in blocks, with the largest weight of each term per block."""

    def __init__(self, n_terms: int, examples: list[tuple[int, int, np.ndarray, np.ndarray]]):
        """examples: (doc_id, label, terms, weights), in any order."""
        # Examples with the same leading term lie together, so that bounds are tight.
        examples = sorted((e for e in examples if len(e[2])), key=lambda e: (int(e[2][np.argmax(e[3])]), e[1], e[0]))
        self.doc, self.label = (np.array([e[i] for e in examples], np.int64) for i in (0, 1))
        self.blocks = -(-len(examples) // BLOCK)
        term = np.concatenate([e[2] for e in examples]).astype(np.int64) if examples else np.empty(0, np.int64)
        weight = np.concatenate([e[3] for e in examples]).astype(float) if examples else np.empty(0)
        place = np.repeat(np.arange(len(examples)), [len(e[2]) for e in examples])
        order = np.lexsort((place, term))
        term, self.place, self.weight = term[order], place[order], weight[order]
        # Entries are the pairs of term and block that hold postings; those of term t are first[t] to first[t + 1].
        pair = term * max(self.blocks, 1) + self.place // BLOCK
        self.start = np.flatnonzero(np.diff(pair, prepend=-1))
        self.size = np.diff(np.append(self.start, len(pair)))
        self.block = self.place[self.start] // BLOCK
        self.most = np.maximum.reduceat(self.weight, self.start) if len(pair) else np.empty(0)
        self.first = np.searchsorted(term[self.start], np.arange(n_terms + 1))

    @property
    def weights(self) -> np.ndarray:
        """The postings as a dense table of terms and examples; for small indexes."""
        out = np.zeros((len(self.first) - 1, self.blocks * BLOCK), np.float32)
        out[np.repeat(np.searchsorted(self.first, np.arange(len(self.start)), "right") - 1, self.size), self.place] = self.weight
        return out

    def nearest(self, term: np.ndarray, weight: np.ndarray, k: int = K) -> tuple[np.ndarray, np.ndarray]:
        """(example numbers, cosines) of the k nearest with a cosine above 0; ties go to the smaller number."""
        if not len(term) or not self.blocks:
            return np.empty(0, np.int64), np.empty(0)
        entry, times = _ranges(self.first[term], self.first[term + 1] - self.first[term])
        weight, block = np.repeat(weight, times), self.block[entry]
        bound = np.bincount(block, weight * self.most[entry], self.blocks) * 1.00001
        order = np.argsort(-bound, kind="stable")
        which, value, least, at, some_at_once = np.empty(0, np.int64), np.empty(0), 0.0, 0, 4
        while at < len(order):
            some = order[at : at + some_at_once]  # a few blocks at a time
            some = some[(bound[some] > 0) & (bound[some] >= least)]
            if not len(some):
                break
            wanted = np.zeros(self.blocks, bool)
            wanted[some] = True
            mine = np.flatnonzero(wanted[block])
            posting, n = _ranges(self.start[entry[mine]], self.size[entry[mine]])
            cosine = np.bincount(self.place[posting], np.repeat(weight[mine], n) * self.weight[posting])
            place = np.flatnonzero(cosine)
            which, value = np.concatenate((which, place)), np.concatenate((value, cosine[place]))
            top = np.lexsort((which, -value))[:k]
            which, value = which[top], value[top]
            if len(value) == k:
                least = value[-1]
            at += some_at_once
        found = value > 0
        return which[found], value[found]

    def vote(self, term: np.ndarray, weight: np.ndarray) -> tuple[float, list[int]]:
        """(share of squared cosine that label 1 holds, with PRIOR added to the other side; documents of the best evidence)."""
        which, cosine = self.nearest(term, weight)
        power = cosine * cosine
        return float((power * self.label[which]).sum() / (power.sum() + PRIOR)), self.doc[which[:3]].tolist()


def fit_curve(votes: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of the logistic curve of largest weighted likelihood, with a small penalty on the slope."""
    x, w = np.stack((votes, np.ones(len(votes))), 1), np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weights * (p - labels)) + np.array([1e-2 * w[0], 1e-6 * w[1]])
        hessian = (x.T * (weights * p * (1 - p) + 1e-9)) @ x + np.diag([1e-2, 1e-6])
        step = np.linalg.solve(hessian, gradient)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", folds: int = 5) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted, evidence (up to 3 ids of the nearest examples).

    Labels are learned from rows whose crc32(doc_id as text) is not divisible by ``folds``. Of several labels of one id the largest counts; null
    labels and labels of unknown ids are no labels. Texts without terms, empty and null texts get the score of a vote of 0; without
    any label every score is 0.5, and with labels of one kind it is their smoothed share.
    """
    spark = common.prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == 0, F.lit(False))
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label")).where("doc_id is not null and label in (0, 1)")
    known = common.stage(known.groupBy("doc_id").agg(F.max("label").alias("label")).where(~held_out), "labels")
    trained = rows.join(common.small(known), "doc_id")
    totals = {r["label"]: r["n"] for r in trained.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    ones, zeros = totals.get(1, 0), totals.get(0, 0)
    # Terms: two-proportion z of the features' document shares, over all training documents.
    counted = trained.select("label", "text").mapInArrow(_labelled_counts, "feature long, ones long, zeros long").groupBy("feature").agg(F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros"))
    n = F.col("ones") + F.col("zeros")
    share = n / F.lit(float(max(ones + zeros, 1)))
    gap = F.col("ones") / F.lit(float(max(ones, 1))) - F.col("zeros") / F.lit(float(max(zeros, 1)))
    z = gap / F.sqrt(share * (1 - share) * F.lit(1 / max(ones, 1) + 1 / max(zeros, 1)) + 1e-12)
    # Smoothed, so that a feature of one label alone has a ratio.
    ratio = (F.col("ones") + 0.5) / F.lit(ones + 1.0) / ((F.col("zeros") + 0.5) / F.lit(zeros + 1.0))
    best = counted.where((n >= MIN_DOCS) & (F.abs(z) >= MIN_Z) & (F.greatest(ratio, 1 / ratio) >= MIN_RATIO))
    ids = best.select("feature").toArrow().column(0).to_numpy()  # the words that go with a label
    terms = Terms(ids)

    def frequencies(batches):
        seen, total = np.zeros(len(terms.ids), np.int64), 0
        for batch in batches:
            for _, n, _, term, _ in terms.counts(batch.column(0).to_pylist()):
                seen += np.bincount(term, minlength=len(seen))
                total += n
        held = np.flatnonzero(seen)
        yield pa.record_batch([pa.array(np.append(-1, held)), pa.array(np.append(total, seen[held]))], ["term", "n"])

    found = rows.select("text").mapInArrow(frequencies, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    counts = found.toArrow()  # a row for each term and one more
    frequency = np.zeros(len(terms.ids) + 1, np.int64)
    frequency[counts.column(0).to_numpy()] = counts.column(1).to_numpy()  # the last is the number of documents, from term -1
    terms.weight = np.log((frequency[-1] + 1) / (frequency[:-1] + 1)) + 1
    # A bounded sample of labelled rows, the smallest hashes of each label: first the examples, then those for the curve.
    order = F.xxhash64("doc_id", F.lit("example"))
    picked = [known.where(F.col("label") == label).withColumn("order", order).orderBy("order", "doc_id").limit(2 * EXAMPLES) for label in (0, 1)]
    picked = F.broadcast(picked[0].unionByName(picked[1]))

    def sample(batches):
        for batch in batches:
            made = terms.vectors(batch.column(2).to_pylist())
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array([t.tolist() for t, _ in made], pa.list_(pa.int64())), pa.array([w.tolist() for _, w in made], pa.list_(pa.float64())), batch.column(3)], ["doc_id", "label", "terms", "weights", "order"])

    taken = rows.join(picked, "doc_id").select("doc_id", "label", "text", "order").dropDuplicates(["doc_id"])
    taken = taken.mapInArrow(sample, "doc_id long, label int, terms array<long>, weights array<double>, order long").orderBy("order", "doc_id").collect()  # at most 4 * EXAMPLES
    vectors = [(r["doc_id"], r["label"], np.array(r["terms"], np.int64), np.array(r["weights"])) for r in taken]
    halves = {label: [v for v in vectors if v[1] == label] for label in (0, 1)}
    shown = [v for label in (0, 1) for v in halves[label][: len(halves[label]) // 2]]
    rest = [v for label in (0, 1) for v in halves[label][len(halves[label]) // 2 :]]
    index = Index(len(terms.ids), shown)
    votes, truth = np.array([index.vote(t, w)[0] for _, _, t, w in rest]), np.array([v[1] for v in rest], float)
    per = {label: totals.get(label, 0) / max(1, sum(v[1] == label for v in rest)) for label in (0, 1)}
    slope, intercept = (0.0, float(np.log((ones + 0.5) / (zeros + 0.5)))) if not ones or not zeros else fit_curve(votes, truth, np.array([per[v[1]] for v in rest]))
    model = spark.sparkContext.broadcast((terms, index, slope, intercept))  # the index is bounded by EXAMPLES

    def scored(batches):
        terms, index, slope, intercept = model.value
        for batch in batches:
            voted = [index.vote(t, w) for t, w in terms.vectors(batch.column(1).to_pylist())]
            p = 1 / (1 + np.exp(-np.clip(slope * np.array([v for v, _ in voted]) + intercept, -30, 30)))
            yield pa.record_batch([batch.column(0), pa.array(p, pa.float64()), pa.array([e for _, e in voted], pa.list_(pa.int64()))], ["doc_id", "score", "evidence"])

    out = rows.mapInArrow(scored, "doc_id long, score double, evidence array<long>")
    return out.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence")
