"""Word and shingle hashes of whole texts, computed for many texts at once with numpy.

Words are maximal runs of characters other than space and U+0009 to U+000D, with A-Z lower-cased. A word's hash is a
polynomial over its bytes modulo 2**64, finished with a mixer, so equal words have equal hashes everywhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

CHUNK_BYTES = 2_000_000
END = np.uint64(0x9E3779B97F4A7C15)  # the hash of the token that ends a text
_BASE = 0x5851F42D4C957F2D
_STEP = np.uint64(_BASE)
_BACK = np.uint64(pow(_BASE, -1, 1 << 64))


def _byte_values() -> np.ndarray:
    values = mix(np.arange(1, 257, dtype=np.uint64))
    values[65:91] = values[97:123]
    return values


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_VALUES = _byte_values()
_POWERS = np.ones(1, np.uint64)
_INVERSE = np.ones(1, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POWERS, _INVERSE
    if len(_POWERS) < n:
        size = max(n, CHUNK_BYTES + 1)
        for name, base in (("_POWERS", _STEP), ("_INVERSE", _BACK)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            globals()[name] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS, _INVERSE


def chunks(texts: list[str | None]) -> Iterator[tuple[int, int, bytes, np.ndarray]]:
    """(first, end, joined bytes, start of each text) for runs of texts of about CHUNK_BYTES; a longer text is alone."""
    first, size, parts = 0, 0, []
    for i, text in enumerate(texts):
        raw = (text or "").encode("utf-8", "surrogatepass")
        if parts and size + len(raw) > CHUNK_BYTES:
            yield first, i, *_joined(parts)
            first, size, parts = i, 0, []
        parts.append(raw)
        size += len(raw) + 1
    if parts:
        yield first, len(texts), *_joined(parts)


def _joined(parts: list[bytes]) -> tuple[bytes, np.ndarray]:
    lengths = np.fromiter((len(p) + 1 for p in parts), np.int64, len(parts))
    return b" ".join(parts) + b" ", np.concatenate(([0], np.cumsum(lengths)))


def spans(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word in joined bytes that end with a space."""
    data = np.frombuffer(raw, np.uint8)
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside))))
    return edges[::2], edges[1::2]


def hashes(raw: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    data = np.frombuffer(raw, np.uint8)
    up, down = _powers(len(data) + 1)
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_VALUES[data] * up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def words(texts: list[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first text, word hashes, offsets): words of text ``first + i`` are ``hashes[offsets[i]:offsets[i + 1]]``."""
    for first, _, raw, bounds in chunks(texts):
        starts, ends = spans(raw)
        yield first, hashes(raw, starts, ends), np.searchsorted(starts, bounds)


def shingle_hashes(word_hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words; run i begins at word i."""
    n = len(word_hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = (out ^ word_hashes[k : k + n]) * _STEP + np.uint64(k + 1)
    return mix(out)


def shingle_sets(texts: list[str | None], size: int = 5) -> Iterator[np.ndarray]:
    """For each text its sorted distinct shingle hashes; a text of fewer words is one shingle, one without words none."""
    for _, hashed, offsets in words(texts):
        runs = shingle_hashes(hashed, size)
        for a, b in zip(offsets[:-1], offsets[1:]):
            if b - a >= size:
                run = np.sort(runs[a : b - size + 1])
                yield run[np.concatenate(([True], run[1:] != run[:-1]))]
            elif b > a:
                yield shingle_hashes(hashed[a:b], b - a)
            else:
                yield np.empty(0, np.uint64)
