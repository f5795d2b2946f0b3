"""Interpolated modified Kneser-Ney bigram model, counted in Spark and scored from sorted hash arrays.

Words are counted per task and dealt to ranges of their hashes; each range becomes a file of sorted hashes with counts, and a
word's number is its place in the files. Bigrams of word numbers are counted per task and dealt to ranges of a mixed code;
each range becomes a file of sorted codes with counts, and hands on what it adds to the statistics of the words in it: how
often a word begins a bigram, how many bigrams of one, two and more counts it begins, how many it ends. The files lie in the
shared folder. Workers map them into memory and look up the sorted distinct words and bigrams of many texts at once, so no
process holds the model.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gripelode.llm import common, words

U = np.uint64
START = words.mix(np.array([1], U))[0]  # context of a text's first word; never counted as a token
RUN_TOKENS = 2_000_000
PER_FILE = 4_000_000  # words or bigrams that one file holds, about


def _ranges(hashed: np.ndarray, files: int) -> np.ndarray:
    return (((hashed >> U(32)) * U(files)) >> U(32)).astype(np.int64)


def local_path(folder: str) -> str | None:
    return folder[7:] if folder.startswith("file://") else folder[5:] if folder.startswith("file:/") else folder if folder.startswith("/") else None


def save(folder: str, name: str, array: np.ndarray) -> None:
    """Write an array file; a retried task replaces it as a whole."""
    raw = np.ascontiguousarray(array)
    if path := local_path(folder):
        os.makedirs(path, exist_ok=True)
        raw.tofile(temporary := f"{path}/.{name}.{uuid.uuid4().hex}")
        os.replace(temporary, f"{path}/{name}")
    else:
        from pyarrow import fs

        store, inner = fs.FileSystem.from_uri(folder)
        store.create_dir(inner)
        with store.open_output_stream(f"{inner}/{name}") as out:
            out.write(raw.tobytes())


def load(folder: str, name: str, kind) -> np.ndarray:
    """The array of a file, mapped into memory; a store that can't be mapped is read."""
    if path := local_path(folder):
        return np.memmap(f"{path}/{name}", kind, "r") if os.path.getsize(f"{path}/{name}") else np.empty(0, kind)
    from pyarrow import fs

    store, inner = fs.FileSystem.from_uri(folder)
    with store.open_input_file(f"{inner}/{name}") as file:
        return np.frombuffer(file.read(), kind)


class Sorted:
    """Files of sorted 64-bit keys, one per range of hashes; with arrays of values beside them."""

    def __init__(self, folder: str, name: str, sizes: list[int]):
        self.folder, self.name, self.sizes = folder, name, sizes
        self.first = np.concatenate(([0], np.cumsum(sizes)))

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each sorted key among all keys, or -1."""
        out = np.full(len(keys), -1, np.int64)
        cuts = np.searchsorted(_ranges(keys, len(self.sizes)), np.arange(len(self.sizes) + 1))
        for b in np.flatnonzero(np.diff(cuts)):
            part = slice(cuts[b], cuts[b + 1])
            if self.sizes[b]:
                held = load(self.folder, f"{self.name}-{b}.keys", U)
                at = np.minimum(np.searchsorted(held, keys[part]), len(held) - 1)
                out[part] = np.where(held[at] == keys[part], at + self.first[b], -1)
        return out

    def at(self, places: np.ndarray, field: str, kind) -> np.ndarray:
        """Values at the places, which rise but for those that are -1 and have 0."""
        out, known = np.zeros(len(places), kind), np.flatnonzero(places >= 0)
        cuts = np.searchsorted(places[known], self.first)
        for b in np.flatnonzero(np.diff(cuts)):
            part = known[cuts[b] : cuts[b + 1]]
            out[part] = load(self.folder, f"{self.name}-{b}.{field}", kind)[places[part] - self.first[b]]
        return out

    def counts(self, places: np.ndarray) -> np.ndarray:
        """What save_counts has written, at places as for at()."""
        out = self.at(places, "count", np.uint8).astype(np.int64)
        full = np.flatnonzero(out == 255)
        cuts = np.searchsorted(places[full], self.first)
        for b in np.flatnonzero(np.diff(cuts)):
            part = full[cuts[b] : cuts[b + 1]]
            at = np.searchsorted(load(self.folder, f"{self.name}-{b}.many", np.int64), places[part] - self.first[b])
            out[part] = load(self.folder, f"{self.name}-{b}.manycount", np.int64)[at]
        return out


def save_counts(folder: str, name: str, counts: np.ndarray) -> None:
    """One byte per count; those of 255 and more are in files of their own."""
    many = np.flatnonzero(counts >= 255)
    save(folder, f"{name}.count", np.minimum(counts, 255).astype(np.uint8))
    save(folder, f"{name}.many", many)
    save(folder, f"{name}.manycount", counts[many])


def _tokens(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, int, np.ndarray, np.ndarray]]:
    """(batch, first text, hashes, bounds) of texts as words with END after each."""
    for batch in batches:
        for first, hashed, offsets in words.words(batch.column(column).to_pylist()):
            yield batch, first, np.insert(hashed, offsets[1:], words.END), offsets + np.arange(len(offsets))


def _runs(batches, column: int = 0):
    """Lists of (hashes, bounds) of about RUN_TOKENS tokens."""
    held, total = [], 0
    for _, _, hashed, bounds in _tokens(batches, column):
        held.append((hashed, bounds))
        total += len(hashed)
        if total >= RUN_TOKENS:
            yield held
            held, total = [], 0
    if held:
        yield held


def _blobs(files: int, keys: np.ndarray, *values: np.ndarray) -> pa.RecordBatch:
    """A row for each range: its sorted keys and their values, as bytes."""
    cuts = np.searchsorted(_ranges(keys, files), np.arange(files + 1))
    full = np.flatnonzero(np.diff(cuts))
    columns = [pa.array([x[cuts[b] : cuts[b + 1]].tobytes() for b in full], pa.binary()) for x in (keys, *values)]
    return pa.record_batch([pa.array(full, pa.int32()), *columns], ["file", *"abcdefg"[: len(columns)]])


def _summed(rows: list[dict], *kinds) -> tuple[np.ndarray, ...]:
    """Sorted distinct keys of the blobs and the sums of their values."""
    keys, *values = (np.frombuffer(b"".join(r[c] for r in rows), k) for c, k in zip("abcdefg", kinds))
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.empty(0, np.int64)
    return keys[first], *(np.add.reduceat(v[order].astype(np.int64), first) if len(first) else np.empty(0, np.int64) for v in values)


def _by_file(batches) -> Iterator[tuple[int, list[dict]]]:
    """The blobs of each file of a partition sorted by file."""
    now, rows = None, []
    for batch in batches:
        for r in batch.to_pylist():
            if r["file"] != now and rows:
                yield now, rows
                rows = []
            now = r["file"]
            rows.append(r)
    if rows:
        yield now, rows


def _dealt(rows: DataFrame, files: int) -> DataFrame:
    return rows.repartition(files, "file").sortWithinPartitions("file")


def _count_words(files: int) -> Callable:
    def run(batches):
        for held in _runs(batches):
            keys, counts = np.unique(np.concatenate([h for h, _ in held]), return_counts=True)
            if START not in keys:
                at = np.searchsorted(keys, START)
                keys, counts = np.insert(keys, at, START), np.insert(counts, at, 0)
            yield _blobs(files, keys, counts.astype(np.uint32))

    return run


def _store_words(folder: str) -> Callable:
    def run(batches):
        for file, rows in _by_file(batches):
            keys, counts = _summed(rows, U, np.uint32)
            save(folder, f"words-{file}.keys", keys)
            save(folder, f"words-{file}.count", counts)
            yield pa.record_batch([pa.array([file], pa.int32()), pa.array([len(keys)]), pa.array([int(counts.sum())]), pa.array([int((counts > 0).sum())])], ["file", "size", "tokens", "types"])

    return run


def _numbers(held: list, vocabulary: Sorted) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(distinct word hashes, their numbers, of each bigram the two positions in these, text bounds) for a run of texts."""
    parts, ends = [], []
    at = 0
    for hashed, bounds in held:
        parts.append(hashed)
        ends.append(bounds[1:] + at)
        at += len(hashed)
    ends = np.concatenate(ends)
    tokens = np.concatenate(parts)
    distinct, second = np.unique(np.append(tokens, START), return_inverse=True)
    second, start = second[:-1], second[-1]
    first = np.empty_like(second)
    first[1:] = second[:-1]
    first[0] = start
    first[ends[:-1]] = start  # every text has at least its end
    return distinct, vocabulary.find(distinct), first, second, np.concatenate(([0], ends))


def _code(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """The key of two word numbers below 2**32."""
    return words.mix((first.astype(U) << U(32)) | second.astype(U))


def squeezed(numbers: np.ndarray) -> bytes:
    """Sorted numbers as compressed differences, byte by byte."""
    steps = np.diff(numbers, prepend=U(0))
    return len(steps).to_bytes(8, "little") + pa.compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes(), codec="zstd", asbytes=True)


def unsqueezed(raw: bytes) -> np.ndarray:
    n = int.from_bytes(raw[:8], "little")
    planes = np.frombuffer(pa.decompress(raw[8:], decompressed_size=8 * n, codec="zstd", asbytes=True), np.uint8).reshape(8, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view(U).ravel(), dtype=U)


def _count_bigrams(vocabulary: Sorted, files: int) -> Callable:
    def run(batches):
        for held in _runs(batches):
            _, number, first, second, _ = _numbers(held, vocabulary)
            pairs, counts = np.unique((number[first].astype(U) << U(32)) | number[second].astype(U), return_counts=True)
            file = _ranges(words.mix(pairs), files)
            order = np.argsort(file, kind="stable")  # pairs stay sorted within a file
            cuts = np.searchsorted(file[order], np.arange(files + 1))
            full = np.flatnonzero(np.diff(cuts))
            parts = [order[cuts[b] : cuts[b + 1]] for b in full]
            yield pa.record_batch([pa.array(full, pa.int32()), pa.array([squeezed(pairs[x]) for x in parts], pa.binary()), pa.array([counts[x].astype(np.uint32).tobytes() for x in parts], pa.binary())], ["file", "a", "b"])

    return run


def _store_bigrams(folder: str, vocabulary: Sorted) -> Callable:
    """Writes the files of bigrams; rows: what each adds to its words, dealt by the words' files, and at file -1 its counts of counts."""

    def run(batches):
        for file, rows in _by_file(batches):
            raw = np.concatenate([unsqueezed(r["a"]) for r in rows])
            order = np.argsort(keys := words.mix(raw), kind="stable")
            keys, pairs = keys[order], raw[order]
            begin = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            counts = np.add.reduceat(np.frombuffer(b"".join(r["b"] for r in rows), np.uint32)[order].astype(np.int64), begin)
            keys, pairs = keys[begin], pairs[begin]
            save(folder, f"pairs-{file}.keys", keys)
            save_counts(folder, f"pairs-{file}", counts)
            of_counts = [int((counts == k).sum()) for k in (1, 2, 3, 4)]
            left, right = (pairs >> U(32)).astype(np.int64), (pairs & U(0xFFFFFFFF)).astype(np.int64)
            number, back = np.unique(np.concatenate((left, right)), return_inverse=True)
            of_left, of_right = back[: len(left)], back[len(left) :]
            fields = [np.bincount(of_left, counts, len(number))] + [np.bincount(of_left, here, len(number)) for here in (counts == 1, counts == 2, counts > 2)] + [np.bincount(of_right, minlength=len(number))]
            owner = np.searchsorted(vocabulary.first, number, "right") - 1
            cuts = np.searchsorted(owner, np.arange(len(vocabulary.sizes) + 1))
            full = np.flatnonzero(np.diff(cuts))
            columns = [number.astype(np.uint32), fields[0].astype(np.uint64), *(f.astype(np.uint32) for f in fields[1:])]
            blobs = [[x[cuts[b] : cuts[b + 1]].tobytes() for b in full] for x in columns]
            blobs[0].append(np.array([file, len(keys), *of_counts], np.int64).tobytes())
            yield pa.record_batch([pa.array([*full.tolist(), -1], pa.int32()), *(pa.array(x if len(x) > len(full) else [*x, b""], pa.binary()) for x in blobs)], ["file", *"abcdef"])

    return run


KINDS = {"count": np.int64, "begins": np.int64, "ones": np.uint32, "twos": np.uint32, "more": np.uint32, "ends": np.uint32}
FIELDS = ("begins", "ones", "twos", "more", "ends")


def _store_statistics(folder: str, vocabulary: Sorted) -> Callable:
    def run(batches):
        for file, rows in _by_file(batches):
            if file < 0:
                for r in rows:
                    yield pa.record_batch([pa.array(["pairs"]), pa.array([np.frombuffer(r["a"], np.int64).tolist()], pa.list_(pa.int64()))], ["kind", "values"])
                continue
            number, *sums = _summed(rows, np.uint32, np.uint64, *[np.uint32] * 4)
            place = number.astype(np.int64) - vocabulary.first[file]
            for name, s in zip(FIELDS, sums):
                dense = np.zeros(vocabulary.sizes[file], KINDS[name])
                dense[place] = s
                save(folder, f"words-{file}.{name}", dense)
            ends = sums[-1]
            yield pa.record_batch([pa.array(["ends"]), pa.array([[file, int((ends > 0).sum()), *(int((ends == k).sum()) for k in (1, 2, 3, 4)), int(ends.sum())]], pa.list_(pa.int64()))], ["kind", "values"])

    return run


def discounts(n1: int, n2: int, n3: int, n4: int) -> np.ndarray:
    """Discounts of counts 0, 1, 2 and more from the counts of counts; 0.5, 1 and 1.5 where these say nothing."""
    if min(n1, n2, n3, n4) == 0:
        return np.array([0, 0.5, 1.0, 1.5])
    y = n1 / (n1 + 2 * n2)
    return np.array([0, *(min(max(k - (k + 1) * y * b / a, 0.0), float(k)) for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4)))])


class Model:
    """Probabilities from the files; all that it holds itself are sizes and discounts."""

    def __init__(self, vocabulary: Sorted, pairs: Sorted, tokens: int, types: int, pair_discounts: np.ndarray, end_discounts: np.ndarray, end_totals: tuple[int, int, int, int]):
        self.vocabulary, self.pairs, self.tokens, self.types = vocabulary, pairs, tokens, types
        self.d, self.e = pair_discounts, end_discounts
        self.bigrams, n1, n2, more = end_totals
        #: Weight that the discounts of the lower order leave to the uniform distribution over all types and one unknown.
        self.rest = (self.e[1] * n1 + self.e[2] * n2 + self.e[3] * more) / self.bigrams if self.bigrams else 1.0

    def probabilities(self, held: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(probability, unigram count of each token, text bounds) of a run of texts."""
        distinct, number, first, second, bounds = _numbers(held, self.vocabulary)
        get = lambda field: self.vocabulary.at(number, field, KINDS[field]).astype(np.int64)
        count, begins, ends = get("count"), get("begins"), get("ends")
        lower = np.maximum(ends - self.e[np.minimum(ends, 3)], 0) / max(1, self.bigrams) + self.rest / (self.types + 1)
        kept = self.d[1] * get("ones") + self.d[2] * get("twos") + self.d[3] * get("more")
        back = np.where(begins > 0, kept / np.maximum(begins, 1), 1.0)
        known = (number[first] >= 0) & (number[second] >= 0)
        keys, at = np.unique(_code(np.where(known, number[first], 0), np.where(known, number[second], 0)), return_inverse=True)
        together = np.where(known, self.pairs.counts(self.pairs.find(keys))[at], 0)
        direct = np.maximum(together - self.d[np.minimum(together, 3)], 0) / np.maximum(begins[first], 1)
        return direct + back[first] * lower[second], count[second], bounds


def train(docs: DataFrame, text_col: str = "text", folder: str | None = None) -> Model:
    """Count all texts of docs (null texts are empty) and write the model's files to ``folder`` in the shared folder."""
    spark = common.prepare(docs.sparkSession)
    folder = folder or common.new_folder(spark, "lm")
    texts = docs.select(F.col(text_col).cast("string").alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    files = max(common.partitions(spark), int(size) // 6 // PER_FILE + 1)
    blob = "file int, a binary, b binary"
    rows = _dealt(texts.mapInArrow(_count_words(files), blob), files).mapInArrow(_store_words(folder), "file int, size long, tokens long, types long").collect()  # a row per file
    sizes = [0] * files
    for r in rows:
        sizes[r["file"]] = r["size"]
    tokens, types = sum(r["tokens"] for r in rows), sum(r["types"] for r in rows)
    vocabulary = Sorted(folder, "words", sizes)
    if sum(sizes) >= 1 << 32:
        raise ValueError("more than 2**32 different words")
    dealt = _dealt(texts.mapInArrow(_count_bigrams(vocabulary, files), blob), files)
    stored = dealt.mapInArrow(_store_bigrams(folder, vocabulary), f"{blob}, c binary, d binary, e binary, f binary")
    said = _dealt(stored, files).mapInArrow(_store_statistics(folder, vocabulary), "kind string, values array<long>").collect()  # two rows per file
    pair_sizes, of_pairs, of_ends, ended, bigrams = [0] * files, np.zeros(4, np.int64), np.zeros(4, np.int64), 0, 0
    for r in said:
        v = r["values"]
        if r["kind"] == "pairs":
            pair_sizes[v[0]] = v[1]
            of_pairs += v[2:6]
        else:
            ended += v[1]
            of_ends += v[2:6]
            bigrams += v[6]
    more = ended - int(of_ends[0]) - int(of_ends[1])
    return Model(vocabulary, Sorted(folder, "pairs", pair_sizes), tokens, types, discounts(*of_pairs.tolist()), discounts(*of_ends.tolist()), (bigrams, int(of_ends[0]), int(of_ends[1]), more))


def _log_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, bounds[:-1]) if len(bounds) > 1 else np.empty(0)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_tokens, n_known, train_tokens, base_score, score, perplexity.

    A null text is empty and has one token, its end. With a model of no tokens every score is that of the uniform
    distribution over one unknown word, and base_score is that of (0 + 0.1) / 0.1.
    """
    common.prepare(docs.sparkSession)

    def run(batches):
        ids, held, total = [], [], 0
        for batch in batches:
            ids += batch.column(0).to_pylist()
            for _, _, hashed, bounds in _tokens(iter([batch]), 1):
                held.append((hashed, bounds))
                total += len(hashed)
            if total >= RUN_TOKENS // 2:
                yield scored(ids, held)
                ids, held, total = [], [], 0
        if held:
            yield scored(ids, held)

    def scored(ids, held):
        p, count, bounds = model.probabilities(held)
        sizes = np.diff(bounds)
        base = _log_sums(np.log10((count + 0.1) / (model.tokens + 0.1 * (model.types + 1))), bounds)
        own = _log_sums(np.log10(p), bounds)
        known = _log_sums((count > 0).astype(np.int64), bounds)
        return pa.record_batch(
            [pa.array(ids, pa.int64()), pa.array(sizes.astype(np.int64)), pa.array(known.astype(np.int64)), pa.array(np.full(len(sizes), model.tokens, np.int64)), pa.array(base), pa.array(own), pa.array(10 ** (-own / sizes))],
            ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"],
        )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double")


def held_out_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 10) -> DataFrame:
    """Scores of all rows under a model of those whose crc32(id as text) is not divisible by ``folds``; a null id trains."""
    out = F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == 0, F.lit(False))
    scored = score(docs, train(docs.where(~out), text_col), id_col, text_col)
    return scored.withColumn("held_out", F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == 0, F.lit(False)))
