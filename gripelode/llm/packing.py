"""Token ids packed into rows of fixed length by best-fit-decreasing, and written as binary matrices.

Each task tokenises its documents and packs them in runs of GROUP_TOKENS tokens, so memory is bounded and nothing is
shuffled. Documents longer than a row are cut into full rows and a rest; every segment names its document and the place in
it, so the documents can be put together again. A segment tree over the capacities left finds, for the next longest segment,
the fullest row that still holds it.

``write`` saves each run's rows as three files of little-endian numbers in the shared folder: the id matrix (16 bits, ``row``
per line), position ids of the same shape, which begin again at 0 with each segment, and the cumulative segment lengths (32
bits: for each line how many follow, then they). What it returns is the index of the lines. A run that a lost executor has
written twice leaves files that no line of the index names.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Callable, Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gripelode.llm import common
from gripelode.llm.lm import load, save

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
END_ID, ROW, GROUP_TOKENS = 50256, 2048, 2_000_000
SCHEMA = "doc_ids array<long>, doc_offsets array<long>, cu_seqlens array<int>, n_tokens int, ids binary"
INDEX = "doc_ids array<long>, doc_offsets array<long>, cu_seqlens array<int>, n_tokens int, file string, line int"
KINDS = {"doc_ids": pa.list_(pa.int64()), "doc_offsets": pa.list_(pa.int64()), "cu_seqlens": pa.list_(pa.int32()), "n_tokens": pa.int32(), "ids": pa.binary(), "file": pa.string(), "line": pa.int32()}


class Capacities:
    """Rows by the capacity they have left; finds the least capacity that is enough."""

    def __init__(self, most: int):
        self.size = 1 << most.bit_length()
        self.count = [0] * (2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(most + 1)]

    def add(self, capacity: int, row: int) -> None:
        self.rows[capacity].append(row)
        at = capacity + self.size
        while at:
            self.count[at] += 1
            at >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """(capacity, row) of the fullest row with room for ``need``, which leaves the tree."""
        at = need + self.size
        if not self.count[at]:
            while at > 1 and (at & 1 or not self.count[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.size:
                at = 2 * at if self.count[2 * at] else 2 * at + 1
        capacity = at - self.size
        while at:
            self.count[at] -= 1
            at >>= 1
        return capacity, self.rows[capacity].pop()


def best_fit_decreasing(lengths: list[int], row: int) -> list[list[int]]:
    """Numbers of the segments in each row; lengths are 1 to ``row``."""
    tree, rows = Capacities(row), []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        capacity, at = tree.take(lengths[i]) or (row, len(rows))
        if at == len(rows):
            rows.append([])
        rows[at].append(i)
        if capacity > lengths[i]:
            tree.add(capacity - lengths[i], at)
    return rows


def positions(cu_seqlens: np.ndarray) -> np.ndarray:
    """Position ids of a row: they begin again at 0 with each segment."""
    sizes = np.diff(cu_seqlens)
    return np.arange(int(cu_seqlens[-1])) - np.repeat(cu_seqlens[:-1], sizes)


@lru_cache(maxsize=2)
def _encoding(raw: bytes):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines())}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def _lines(held: list[tuple[int, np.ndarray]], row: int, end_id: int) -> dict[str, list]:
    """Columns of the packed rows of one run of documents."""
    segments = [(d, at, ids[at : at + row]) for d, ids in held for at in range(0, len(ids), row)]
    out: dict[str, list] = {"doc_ids": [], "doc_offsets": [], "cu_seqlens": [], "n_tokens": [], "ids": []}
    for members in best_fit_decreasing([len(s[2]) for s in segments], row):
        of = [segments[i] for i in members]
        bounds = np.concatenate(([0], np.cumsum([len(s[2]) for s in of]))).astype(np.int32)
        filled = np.full(row, end_id, "<u2")
        filled[: bounds[-1]] = np.concatenate([s[2] for s in of])
        for name, value in zip(out, ([s[0] for s in of], [s[1] for s in of], bounds.tolist(), int(bounds[-1]), filled.tobytes())):
            out[name].append(value)
    return out


def _save(folder: str, row: int) -> Callable[[dict[str, list]], dict[str, list]]:
    """Writes the three files of a run and puts the file's name and the line in place of the ids."""

    def run(lines: dict[str, list]) -> dict[str, list]:
        name, n = uuid.uuid4().hex, len(lines["ids"])
        at = np.zeros((n, row), "<u2")
        for i, bounds in enumerate(lines["cu_seqlens"]):
            at[i, : bounds[-1]] = positions(np.array(bounds))
        save(folder, f"{name}.ids", np.frombuffer(b"".join(lines["ids"]), "<u2"))
        save(folder, f"{name}.positions", at)
        save(folder, f"{name}.lengths", np.concatenate([[len(b), *b] for b in lines["cu_seqlens"]]).astype("<i4"))
        return {k: v for k, v in lines.items() if k != "ids"} | {"file": [name] * n, "line": list(range(n))}

    return run


def _packing(docs: DataFrame, id_col: str, text_col: str, row: int, ranks: str, end_id: int, group_tokens: int, schema: str, made: Callable) -> DataFrame:
    if end_id > 65535 or row > 65536:
        raise ValueError("ids and positions are stored in 16 bits")
    table = common.prepare(docs.sparkSession).sparkContext.broadcast(Path(ranks).read_bytes())  # the vocabulary's size

    def emit(held: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
        lines = made(_lines(held, row, end_id))
        return pa.record_batch([pa.array(v, KINDS[k]) for k, v in lines.items()], list(lines))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = [], 0
        encoding = _encoding(table.value)
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.array([*encoding.encode_ordinary(text or ""), end_id], "<u2")
                held.append((doc, ids))
                total += len(ids)
                if total >= group_tokens:
                    yield emit(held)
                    held, total = [], 0
        if held:
            yield emit(held)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, schema)


def packed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row: int = ROW, ranks: str = RANKS, end_id: int = END_ID, group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """One row per packed row: doc_ids and doc_offsets (document and first token of each segment), cu_seqlens (bounds of the
    segments, where positions begin again), n_tokens, and ids: the row of the matrix as little-endian 16-bit numbers, filled
    up with ``end_id``.

    Every document ends with ``end_id``; null and empty texts are that token alone. Rows that repeat an id are packed each.
    """
    return _packing(docs, id_col, text_col, row, ranks, end_id, group_tokens, SCHEMA, lambda lines: lines)


def write(docs: DataFrame, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text", row: int = ROW, ranks: str = RANKS, end_id: int = END_ID, group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """Writes the packed rows below ``folder`` (a new one in the shared folder) and gives their staged index.

    The index has doc_ids, doc_offsets, cu_seqlens and n_tokens as ``packed``, and ``file`` and ``line``: where the row is in
    <file>.ids, <file>.positions and <file>.lengths. Filled-up places have position 0. No rows, no files.
    """
    folder = folder or common.new_folder(docs.sparkSession, "matrices")
    index = common.stage(_packing(docs, id_col, text_col, row, ranks, end_id, group_tokens, INDEX, _save(folder, row)), "index")
    return index.withColumn("file", F.concat(F.lit(f"{folder}/"), "file"))


def files(index: DataFrame, row: int = ROW) -> DataFrame:
    """(file, n_lines, n_tokens, n_bytes) of what ``write`` has written: bytes of the three files together."""
    lengths = 4 * F.sum(F.size("cu_seqlens").cast("long") + 1)
    return index.groupBy("file").agg(F.count(F.lit(1)).alias("n_lines"), F.sum("n_tokens").alias("n_tokens"), (4 * row * F.count(F.lit(1)) + lengths).alias("n_bytes"))


def read(index: DataFrame, row: int = ROW) -> DataFrame:
    """(file, line, ids, positions, cu_seqlens) read from the files that an index names, file by file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                folder, name = path.rsplit("/", 1)
                ids, at = (np.asarray(load(folder, f"{name}.{end}", "<u2")).reshape(-1, row) for end in ("ids", "positions"))
                lengths, start, bounds = np.asarray(load(folder, f"{name}.lengths", "<i4")), 0, []
                while start < len(lengths):
                    bounds.append(lengths[start + 1 : start + 1 + lengths[start]])
                    start += 1 + int(lengths[start])
                columns = [pa.array([path] * len(ids)), pa.array(np.arange(len(ids)), pa.int32()), *(pa.array(list(x.astype(np.int32)), pa.list_(pa.int32())) for x in (ids, at)), pa.array(bounds, pa.list_(pa.int32()))]
                yield pa.record_batch(columns, ["file", "line", "ids", "positions", "cu_seqlens"])

    return index.select("file").distinct().mapInArrow(run, "file string, line int, ids array<int>, positions array<int>, cu_seqlens array<int>")


def unpacked(rows: DataFrame) -> DataFrame:
    """(doc_id, offset, ids): the segments of packed rows; a document's segments in order of offset are its tokens."""

    def run(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                ids = np.frombuffer(r["ids"], "<u2")
                out += [(d, at, ids[a:b].astype(np.int32)) for d, at, a, b in zip(r["doc_ids"], r["doc_offsets"], r["cu_seqlens"][:-1], r["cu_seqlens"][1:])]
            yield pa.record_batch([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64()), pa.array([o[2] for o in out], pa.list_(pa.int32()))], ["doc_id", "offset", "ids"])

    return rows.mapInArrow(run, "doc_id long, offset long, ids array<int>")
