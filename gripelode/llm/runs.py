"""Periodic runs of words by online dyadic square catching.

Words are appended to a stream. For each power of two b a catcher waits on every completed block of b words that starts at a
multiple of b; it compares the block with the suffix of b words that each appended word completes, at the distances b + 1 to
2b (the smallest catcher also at 1 to b). A suffix that equals the block is the sign of a square; it is extended word by word
to the longest stretch in which words q apart are equal, and squares of one period that meet are one stretch. A stretch that
touches the end of the stream stays open and grows with the words appended next. A block inside a run of period r that
catches itself a multiple of r away says nothing new and is left out, so texts of one repeated word stay cheap.

Nothing is missed: a run of period q has at least 2q words that are equal to those q later, and at least 16 where q <= 8, so
a whole block of b < q <= 2b words, or of 8, lies among them. Blocks and words are compared by 64-bit hashes of
whole words; a stretch is always extended over the words themselves, never over block hashes.

Documents of similar length share a stream, with a separator that equals no word between them.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gripelode.llm import common

LEAST = 24  # words of a run
PERIODS = 3  # periods of a run
BLOCK = 8  # words of the smallest block
APPEND = 1 << 19  # words appended at once
STREAM = 1 << 19  # words of the documents that share a stream; a longer document has its own
HELD = 2_000_000  # characters of the texts that a worker holds as words at once; a longer text is alone

_NONE = (1 << 31) - 1
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _pair(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Hash of the block x followed by the block y."""
    z = x * _A + (y ^ (y >> np.uint64(29))) * _B
    z ^= z >> np.uint64(32)
    z *= _A
    z ^= z >> np.uint64(29)
    return z


def _equal_ahead(x: np.ndarray, y: np.ndarray) -> int:
    """How many leading items of x and y are equal; looks at growing pieces, so a short answer is cheap."""
    n, at, step = min(len(x), len(y)), 0, 16
    while at < n:
        end = min(n, at + step)
        differs = x[at:end] != y[at:end]
        if differs.any():
            return at + int(differs.argmax())
        at, step = end, 2 * step
    return n


class _Level:
    """Suffix hashes for blocks of b words; those that no later word needs are dropped."""

    def __init__(self, size: int):
        self.size, self.first, self.hashes = size, 0, np.empty(0, np.uint64)

    @property
    def end(self) -> int:
        return self.first + len(self.hashes)

    def at(self, i: np.ndarray) -> np.ndarray:
        return self.hashes[i - self.first]

    def between(self, a: int, b: int) -> np.ndarray:
        return self.hashes[a - self.first : b - self.first]

    def extend(self, more: np.ndarray) -> None:
        self.hashes = np.concatenate((self.hashes, more)) if len(self.hashes) else more

    def trim(self) -> None:
        drop = max(0, len(self.hashes) - 2 * self.size - 1)
        self.first, self.hashes = self.first + drop, self.hashes[drop:]


class Catchers:
    """An online detector; ``longest`` bounds the words of a document and so the periods looked for."""

    def __init__(self, longest: int, least: int = LEAST, periods: int = PERIODS):
        if least < PERIODS * BLOCK or periods < PERIODS:
            raise ValueError(f"shorter runs than {PERIODS * BLOCK} words or {PERIODS} periods may hold no whole block")
        self.least, self.periods, self.n = least, periods, 0
        sizes = [BLOCK]
        while periods * (2 * sizes[-1] + 1) <= longest:
            sizes.append(2 * sizes[-1])
        self.levels = [_Level(b) for b in sizes]
        self._words = np.empty(1024, np.uint64)
        # Of the run that reaches farthest from a word its end and period, and of the one of smallest period all three.
        self._reach, self._period = np.zeros(1024, np.int32), np.ones(1024, np.int32)
        self._first, self._end, self._least = np.zeros(1024, np.int32), np.zeros(1024, np.int32), np.full(1024, _NONE, np.int32)
        self.stretches: dict[int, list[list[int]]] = {}  # period: [first, end) of words that equal those a period later
        self._open: list[tuple[int, list[int]]] = []

    def _grow(self, n: int) -> None:
        if n > len(self._words):
            size = max(n, 2 * len(self._words))
            for name, fill in (("_words", 0), ("_reach", 0), ("_period", 1), ("_first", 0), ("_end", 0), ("_least", _NONE)):
                old = getattr(self, name)
                new = np.full(size, fill, old.dtype)
                new[: self.n] = old[: self.n]
                setattr(self, name, new)

    def append(self, words: np.ndarray) -> None:
        """Words as 64-bit hashes; one word at a time or many give the same runs."""
        before = self.n
        self._grow(before + len(words))
        self._words[before : before + len(words)] = words
        self.n = before + len(words)
        still_open = []
        for q, stretch in self._open:
            self._extend(q, stretch, still_open)
        self._open = still_open
        for k, level in enumerate(self.levels):
            fresh = self._fresh(k, level)
            if not len(fresh):
                break  # larger blocks have none either
            start = level.end
            level.extend(fresh)
            suffixes = np.arange(start, level.end)
            if k == 0:
                self._catch(level, fresh, suffixes, 1)
            self._catch(level, fresh, suffixes, level.size + 1)
        for level in self.levels:
            level.trim()

    def _fresh(self, k: int, level: _Level) -> np.ndarray:
        """Hashes of the suffixes of b words that the appended words have completed."""
        a, b, half = level.end, self.n - level.size + 1, level.size // 2
        if b <= a:
            return np.empty(0, np.uint64)
        if k:
            below = self.levels[k - 1]
            return _pair(below.between(a, b), below.between(a + half, b + half))
        out = self._words[a : b + level.size - 1]
        step = 1
        while step < level.size:
            out = _pair(out[:-step], out[step:])
            step *= 2
        return out

    def _catch(self, level: _Level, fresh: np.ndarray, suffixes: np.ndarray, nearest: int) -> None:
        """Compares each suffix with the one block that is ``nearest`` to nearest + b - 1 words before it."""
        b = level.size
        blocks = (suffixes - nearest) // b * b
        some = int(np.searchsorted(suffixes, nearest))  # before that there is no block
        if some >= len(suffixes):
            return
        blocks, suffixes, fresh = blocks[some:], suffixes[some:], fresh[some:]
        hit = np.flatnonzero(level.at(blocks) == fresh)
        if not len(hit):
            return
        blocks, periods = blocks[hit], suffixes[hit] - blocks[hit]
        new = ~(self._inside(blocks, periods, b) | self._passing(blocks, periods, b))
        blocks, periods = blocks[new], periods[new]
        order = np.lexsort((blocks, periods))
        for s, q in zip(blocks[order].tolist(), periods[order].tolist()):
            if self._reach[s] >= s + q + b and q % int(self._period[s]) == 0:
                continue
            known = self.stretches.setdefault(q, [])
            if known and s < known[-1][1]:  # blocks of one period come in order
                continue
            w = self._words
            if (w[s : s + b] != w[s + q : s + q + b]).any():
                continue  # equal hashes of different blocks
            back = _equal_ahead(w[:s][::-1], w[q : s + q][::-1])
            stretch = [s - back, s + b]
            known.append(stretch)
            self._extend(q, stretch, self._open)

    def _inside(self, blocks: np.ndarray, periods: np.ndarray, b: int) -> np.ndarray:
        """Squares inside one run whose period divides theirs."""
        return (self._reach[blocks] >= blocks + periods + b) & (periods % self._period[blocks] == 0)

    def _passing(self, blocks: np.ndarray, periods: np.ndarray, b: int) -> np.ndarray:
        """Equal blocks inside two runs of one period that end and begin at other distances than the blocks'.

        What equals its copy there ends with the shorter run at either side, so it is no run of this period.
        """
        later = blocks + periods
        end, end2, period = self._end[blocks], self._end[later], self._least[blocks]
        both = (end >= blocks + b) & (end2 >= later + b) & (np.minimum(end + periods, end2) < self.n) & (period == self._least[later]) & (period <= b)
        return both & (end + periods != end2) & (self._first[blocks] + periods != self._first[later])

    def _extend(self, q: int, stretch: list[int], still_open: list) -> None:
        w = self._words
        stretch[1] += _equal_ahead(w[stretch[1] : self.n - q], w[stretch[1] + q : self.n])
        first, end = stretch[0], stretch[1] + q
        if end - first >= self.periods * q:
            inside = slice(first, end)
            farther = self._reach[inside] < end
            self._reach[inside][farther] = end
            self._period[inside][farther] = q
            smaller = self._least[inside] >= q
            for name, value in (("_first", first), ("_end", end), ("_least", q)):
                getattr(self, name)[inside][smaller] = value
        if end == self.n:
            still_open.append((q, stretch))

    def runs(self) -> list[tuple[int, int, int]]:
        """(start, length, period) of the runs so far, by start, then period; a run has its smallest period."""
        best: dict[tuple[int, int], int] = {}
        for q, found in self.stretches.items():
            for first, end in found:
                key = (first, end + q)
                if key[1] - first >= max(self.least, self.periods * q) and q < best.get(key, q + 1):
                    best[key] = q
        return sorted((first, end - first, q) for (first, end), q in best.items())


def find_runs(documents: list[np.ndarray], least: int = LEAST, periods: int = PERIODS, append: int = APPEND) -> list[list[tuple[int, int, int]]]:
    """Runs of each document, given as word hashes; documents of similar length share a stream."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in documents]
    by_length = sorted((i for i, d in enumerate(documents) if len(d) >= least), key=lambda i: len(documents[i]))
    at = 0
    while at < len(by_length):
        first, size, end = len(documents[by_length[at]]), 0, at
        while end < len(by_length) and (end == at or (size + len(documents[by_length[end]]) <= STREAM and len(documents[by_length[end]]) <= 2 * first)):
            size += len(documents[by_length[end]]) + 1
            end += 1
        members = by_length[at:end]
        # The separator after the i-th document is a hash of its number: no two are equal, and a word is one by chance only.
        marks = _pair(np.arange(len(members), dtype=np.uint64), np.full(len(members), 0xD1B54A32D192ED03, np.uint64))
        stream = np.concatenate([x for i, m in zip(members, marks) for x in (documents[i], [m])])
        starts = np.cumsum([0] + [len(documents[i]) + 1 for i in members])
        catchers = Catchers(len(documents[members[-1]]), least, periods)
        for a in range(0, len(stream), append):
            catchers.append(stream[a : a + append])
        found = catchers.runs()
        owners = np.searchsorted(starts, [r[0] for r in found], side="right") - 1
        for (start, length, q), owner in zip(found, owners):
            out[members[owner]].append((start - int(starts[owner]), length, q))
        at = end
    return out


def split_words(text: str | None) -> list[bytes]:
    """Words between blanks and U+0009 to U+000D, which are the blanks of bytes.split()."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def hashed(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that any run holds after its first period."""
    if not runs:
        return words
    keep = np.ones(len(words), bool)
    for start, length, q in runs:
        keep[start + q : start + length] = False
    return [words[i] for i in np.flatnonzero(keep)]


def planted_tail(doc_id: str | None, words: list[bytes]) -> list[bytes]:
    """The query's test pattern: of ids whose checksum ends in 0, the words from some place on repeat with a period."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(doc_id.encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    tail = words[a : a + p]
    return words[:a] + (tail * ((n - a) // p + 1))[: n - a]


COLUMNS = ("n_runs long", "start long", "length long", "period long", "exponent_milli long", "runs_sha256 string", "collapsed_sha256 string")


def _strongest(runs: list[tuple[int, int, int]]) -> tuple:
    """Greatest exact length / period; ties: smallest start, then period."""
    best = None
    for start, length, q in runs:  # by start, then period
        if best is None or length * best[2] > best[1] * q:
            best = (start, length, q)
    return (*best, 1000 * best[1] // best[2]) if best else (None, None, None, None)


def _groups(ids: list[str | None], texts: list[str | None]) -> Iterator[tuple[list[str | None], list[str | None]]]:
    first, size = 0, 0
    for i, text in enumerate(texts):
        if i > first and size + len(text or "") > HELD:
            yield ids[first:i], texts[first:i]
            first, size = i, 0
        size += len(text or "")
    if len(texts) > first:
        yield ids[first:], texts[first:]


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, periods: int = PERIODS, planted: bool = False) -> DataFrame:
    """One row per row of docs: doc_id, n_runs, the run of greatest exponent, digests of all runs and of the text without repeats.

    ``planted`` puts the test pattern of ``planted_tail`` into the words first. Null and empty texts have no words and no
    runs; rows that repeat an id are worked on each by itself; a null id has no test pattern.
    """
    docs = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    names = [c.split()[0] for c in COLUMNS]

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for ids, texts in _groups([None if pd.isna(i) else i for i in batch["doc_id"]], [t or None for t in batch["text"]]):
                words = [split_words(t) for t in texts]
                if planted:
                    words = [planted_tail(i, w) for i, w in zip(ids, words)]
                out = []
                for i, held, runs in zip(ids, words, find_runs([hashed(w) for w in words], least, periods)):
                    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()
                    digests = (hashlib.sha256(lines).hexdigest(), hashlib.sha256(b" ".join(collapsed(held, runs))).hexdigest())
                    out.append((i, len(runs), *_strongest(runs), *digests))
                yield pd.DataFrame(out, columns=["doc_id", *names]).astype({c: "Int64" for c in names[:5]})

    common.prepare(docs.sparkSession)
    return docs.mapInPandas(rows, ", ".join(("doc_id string", *COLUMNS))).withColumn("doc_id", F.col("doc_id").cast("long"))
