"""SentencePiece encoding and decoding with a batched numpy Viterbi search.

A text becomes units: a run of word marks and the characters up to the next mark. The distinct units of a batch of texts are
laid out in one array; substring hashes probe a hash table of the pieces for all positions at once. Units then advance
together position by position, and the best piece that ends there is stored as a backpointer.

For a unigram model the best piece maximises the sum of scores. For a byte-pair model the sum of scores does not give the
library's segmentation, so the maximum runs over another value: 1 if the piece can follow the last piece of the prefix it
continues, which is so when merging the two in order of rank ends in just these two. The segmentation of a prefix is a
prefix of the segmentation, and exactly one piece can follow at each position, so the search returns the merges' result.

Few very long units, as texts without blanks are, gain nothing from advancing together. Their pieces are still found for
whole stretches at once, one probe per piece length; then one pass over the found pieces stores the backpointers. The work
is in proportion to the characters, whatever the length of a unit.
"""

from __future__ import annotations

import re
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gripelode.llm import common, words

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = 0x2581
LEAF = -1
U = np.uint64
CHUNK_CHARS = 3_000_000
CACHE_BITS = 20
FEW, LONG = 32, 64  # the FEW longest units of more than LONG characters are searched one by one
STRETCH = 1 << 16  # characters whose pieces are found at once
PAIRS_KEPT = 2_000_000


class Pieces:
    """The pieces of a model as hash table, with ranks and last merges where it is a byte-pair model."""

    def __init__(self, model: bytes, unigram: bool = False):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = sp.get_piece_size()
        names = [sp.id_to_piece(i) for i in range(size)]
        plain = [i for i in range(size) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        if sp.normalize("ﬁ  a") != "▁ﬁ▁▁a":
            raise ValueError("only models with the identity normaliser and a leading word mark are supported")
        if any("▁" in names[i].lstrip("▁") for i in plain):
            raise ValueError("pieces with a word mark inside are not supported")
        self.unigram, self.unk = unigram, sp.unk_id()
        self.bytes_of = [bytes([int(names[i][3:5], 16)]) if sp.is_byte(i) else b"" if sp.is_control(i) else " ⁇ ".encode() if sp.is_unknown(i) else names[i].replace("▁", " ").encode() for i in range(size)]
        self.byte_ids = np.full(256, sp.unk_id(), np.int32)
        self.has_bytes = False
        for i in range(size):
            if sp.is_byte(i):
                self.byte_ids[int(names[i][3:5], 16)], self.has_bytes = i, True
        self.longest = max(len(names[i]) for i in plain)
        self.score = np.array([sp.get_score(i) for i in range(size)])
        self.unknown_score = min(self.score[plain]) - 10.0  # as the library has it
        self._fill([names[i] for i in plain], np.array(plain, np.int32))
        if not unigram:
            self._merges(names, plain)

    def _fill(self, names: list[str], ids: np.ndarray) -> None:
        keys = np.concatenate([hashes_of(code_points(n), np.array([0]), np.array([len(n)])) for n in names])
        if len(np.unique(keys)) < len(keys):
            raise ValueError("two pieces have one hash")
        self.mask = (1 << (len(keys) * 4).bit_length()) - 1
        self.keys, self.values = np.zeros(self.mask + 1, U), np.full(self.mask + 1, -1, np.int32)
        for key, i in zip(keys.tolist(), ids.tolist()):
            at = key & self.mask
            while self.values[at] >= 0:
                at = (at + 1) & self.mask
            self.keys[at], self.values[at] = key, i

    def probe(self, keys: np.ndarray) -> np.ndarray:
        """The piece of each hash, or -1."""
        at = (keys & U(self.mask)).astype(np.int64)
        out = self.values[at]
        open_ = np.flatnonzero((out >= 0) & (self.keys[at] != keys))
        at = at[open_]
        while len(open_):
            at = (at + 1) & self.mask
            out[open_] = self.values[at]
            more = (out[open_] >= 0) & (self.keys[at] != keys[open_])
            open_, at = open_[more], at[more]
        return out

    def _merges(self, names: list[str], plain: list[int]) -> None:
        """Rank of each piece (LEAF for one character), and the two pieces of its last merge."""
        of = {names[i]: i for i in plain}
        order = np.unique(-self.score[[i for i in plain if len(names[i]) > 1]])
        self.rank = np.full(len(names), LEAF, np.int64)
        self.left, self.right = np.arange(len(names)), np.arange(len(names))
        reached = np.zeros(len(names), bool)
        pair = {}
        for i in plain:
            if len(names[i]) > 1:
                self.rank[i] = np.searchsorted(order, -self.score[i])
        for i in plain:
            parts, last = [of.get(c, -1) for c in names[i]], (i, i)
            while len(parts) > 1:
                best = None
                for k in range(len(parts) - 1):
                    key = (parts[k], parts[k + 1])
                    if key not in pair:
                        pair[key] = of.get(names[key[0]] + names[key[1]], -1) if min(key) >= 0 else -1
                    if pair[key] >= 0 and (best is None or self.rank[pair[key]] < self.rank[pair[parts[best], parts[best + 1]]]):
                        best = k
                if best is None:
                    break
                last = (parts[best], parts[best + 1])
                parts[best : best + 2] = [pair[last]]
            reached[i] = parts == [i]
            if reached[i]:
                self.left[i], self.right[i] = last
                if len(names[i]) > 1 and max(self.rank[last[0]], self.rank[last[1]]) > self.rank[i]:
                    raise ValueError("a piece ranks before its parts: not a byte-pair model that this search can follow")
        self.reached = reached
        both = sorted((a * len(names) + b, c) for (a, b), c in pair.items() if c >= 0)
        # All pairs of pieces that merge, not only those met above.
        both = dict(both)
        for i in plain:
            for k in range(1, len(names[i])):
                a, b = of.get(names[i][:k], -1), of.get(names[i][k:], -1)
                if a >= 0 and b >= 0:
                    both[a * len(names) + b] = i
        self.pair_keys = np.array(sorted(both), np.int64)
        self.pair_rank = self.rank[np.array([both[k] for k in self.pair_keys.tolist()], np.int64)] if both else np.empty(0, np.int64)

    def follows(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Whether merging the characters of both pieces in order of rank ends in these two pieces."""
        a, b = first.astype(np.int64), second.astype(np.int64)
        n, out = len(self.rank), np.ones(len(a), bool)
        limit = np.full(len(a), np.iinfo(np.int64).max)
        open_ = np.arange(len(a))
        while len(open_):
            key = a * n + b
            at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
            crossed = (self.pair_keys[at] == key) & (self.pair_rank[at] < limit)
            out[open_[crossed]] = False
            ra, rb = self.rank[a], self.rank[b]
            done = crossed | ((ra == LEAF) & (rb == LEAF))
            # Undo the later of the two last merges; of equals the right one, since merges of one rank go from the left.
            undo_a = ra > rb
            limit = np.where(undo_a, ra, rb + 1)
            a, b = np.where(undo_a, self.right[a], a), np.where(undo_a, b, self.left[b])
            keep = ~done
            open_, a, b, limit = open_[keep], a[keep], b[keep], limit[keep]
        return out


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def hashes_of(points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return substring_hashes(prefix_sums(points), starts, ends)


def prefix_sums(points: np.ndarray) -> np.ndarray:
    up, _ = words._powers(len(points) + 1)
    sums = np.zeros(len(points) + 1, U)
    np.cumsum(words.mix(points.astype(U) + U(1)) * up[: len(points)], out=sums[1:])
    return sums


def substring_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    _, down = words._powers(len(sums))
    return words.mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U))


class Codec:
    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.seen = np.zeros(1 << CACHE_BITS, np.int64) - 1
        self.seen_value = np.zeros(1 << CACHE_BITS, bool)
        self.pairs: dict[int, bool] = {}
        self.merged: dict[int, int] | None = None

    def _can_follow(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Pieces.follows with the answers of recent pairs kept."""
        key = first.astype(np.int64) * len(self.pieces.rank) + second
        slot = (words.mix(key.view(U)) >> U(64 - CACHE_BITS)).astype(np.int64)
        out, hit = self.seen_value[slot], self.seen[slot] == key
        miss = np.flatnonzero(~hit)
        if len(miss):
            some, back = np.unique(key[miss], return_inverse=True)
            value = self.pieces.follows(some // len(self.pieces.rank), some % len(self.pieces.rank))
            out[miss] = value[back]
            self.seen[slot[miss]], self.seen_value[slot[miss]] = key[miss], value[back]
        return out

    def _search(self, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(tokens, number of tokens of each unit); units must be in order of falling length. -1 - c is the unknown character c."""
        lengths = ends - starts
        common_length = max(LONG, int(lengths[FEW]) if len(lengths) > FEW else 0)
        alone = int(np.searchsorted(-lengths, -common_length, "left"))  # longer than all that advance together
        found = [self._search_one(points[a:b]) for a, b in zip(starts[:alone], ends[:alone])]
        tokens, count = self._search_all(points, starts[alone:], ends[alone:])
        return np.concatenate([*found, tokens]), np.concatenate((np.array([len(x) for x in found], np.int64), count))

    def _search_one(self, points: np.ndarray) -> np.ndarray:
        """The tokens of one unit."""
        p, n = self.pieces, len(points)
        sums = prefix_sums(points)
        last, back, best = [-1] * (n + 1), [1] * (n + 1), [0.0] * (n + 1)
        for first in range(0, n, STRETCH):
            end = np.arange(first + 1, min(n, first + STRETCH) + 1)
            at, size, ids = [], [], []
            for k in range(min(p.longest, int(end[-1])), 0, -1):
                e = end[end >= k]
                piece = p.probe(substring_hashes(sums, e - k, e))
                good = piece >= 0 if p.unigram else (piece >= 0) & p.reached[piece]
                at.append(e[good])
                size.append(np.full(int(good.sum()), k))
                ids.append(piece[good])
            at, size, ids = np.concatenate(at), np.concatenate(size), np.concatenate(ids)
            order = np.argsort(at, kind="stable")  # longer pieces of one place stay in front
            cuts = np.searchsorted(at[order], np.append(end, end[-1] + 1)).tolist()
            size, ids = size[order].tolist(), ids[order].tolist()
            for e, a, b in zip(end.tolist(), cuts[:-1], cuts[1:]):
                if p.unigram:
                    best[e] = float("-inf")
                    for j in range(a, b):
                        value = best[e - size[j]] + float(p.score[ids[j]])
                        if value > best[e]:
                            best[e], last[e], back[e] = value, ids[j], size[j]
                    # A character that is a piece is no unknown one.
                    if (a == b or size[b - 1] > 1) and best[e - 1] + p.unknown_score > best[e]:
                        best[e], last[e], back[e] = best[e - 1] + p.unknown_score, -1, 1
                else:
                    for j in range(a, b):
                        before = last[e - size[j]] if size[j] < e else -1
                        if before < 0 or self._pair_follows(before, ids[j]):
                            last[e], back[e] = ids[j], size[j]
                            break
        out, e = [], n
        while e > 0:
            out.append(last[e] if last[e] >= 0 else -1 - int(points[e - 1]))
            e -= back[e]
        return np.array(out[::-1], np.int64)

    def _pair_follows(self, a: int, b: int) -> bool:
        """Pieces.follows for one pair, kept."""
        p = self.pieces
        if self.merged is None:
            self.rank, self.left, self.right = p.rank.tolist(), p.left.tolist(), p.right.tolist()
            self.merged = dict(zip(p.pair_keys.tolist(), p.pair_rank.tolist()))
        size = len(self.rank)
        asked = a * size + b
        if (known := self.pairs.get(asked)) is not None:
            return known
        limit, out = float("inf"), True
        while True:
            if self.merged.get(a * size + b, limit) < limit:
                out = False
                break
            ra, rb = self.rank[a], self.rank[b]
            if ra == LEAF and rb == LEAF:
                break
            if ra > rb:
                limit, a = ra, self.right[a]
            else:
                limit, b = rb + 1, self.left[b]
        if len(self.pairs) > PAIRS_KEPT:
            self.pairs.clear()
        self.pairs[asked] = out
        return out

    def _search_all(self, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``_search`` with all units advancing together."""
        p = self.pieces
        sums, lengths = prefix_sums(points), ends - starts
        n = len(points)
        # back[x] and last[x]: length and id of the piece that ends before character x of the array, for the unit around it.
        last, back, best = np.full(n + 1, -1, np.int64), np.zeros(n + 1, np.int32), np.zeros(n + 1)
        for i in range(1, int(lengths.max(initial=0)) + 1):
            begin = starts[: np.searchsorted(-lengths, -i, "right")]
            end = begin + i
            left = np.arange(len(end))
            top = np.full(len(end), -np.inf)
            for k in range(min(i, p.longest), 0, -1):
                e = end[left]
                piece = p.probe(substring_hashes(sums, e - k, e))
                unknown = (piece < 0) & (k == 1)
                if p.unigram:
                    value = np.where(unknown, p.unknown_score, p.score[piece]) + np.where(k < i, best[e - k], 0.0)
                    better = ((piece >= 0) | unknown) & (value > top)
                    top[better] = value[better]
                else:
                    better = unknown | ((piece >= 0) & p.reached[piece])
                    ask = np.flatnonzero(better & ~unknown) if k < i else np.empty(0, np.int64)
                    before = last[e[ask] - k]
                    ask, before = ask[before >= 0], before[before >= 0]
                    better[ask] = self._can_follow(before, piece[ask])
                at = e[better]
                last[at], back[at] = np.where(unknown[better], -1, piece[better]), k
                if p.unigram:
                    best[at] = top[better]
                else:
                    left = left[~better]
                    if not len(left):
                        break
        count, tokens, at, unit = np.zeros(len(starts), np.int64), [], ends.copy(), np.arange(len(starts))
        while len(unit):
            k = back[at]
            token = np.where(last[at] >= 0, last[at], -1 - points[at - 1].astype(np.int64))
            tokens.append((unit, token))
            count[unit] += 1
            at = at - k
            more = at > starts[unit]
            at, unit = at[more], unit[more]
        where = np.cumsum(count)
        out, place = np.empty(int(count.sum()), np.int64), where - 1
        for unit, token in tokens:
            out[place[unit]] = token
            place[unit] -= 1
        return out, count

    def _expanded(self, tokens: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Unknown characters as the pieces of their UTF-8 bytes, or as the unknown piece."""
        odd = np.flatnonzero(tokens < 0)
        if not len(odd):
            return tokens, count
        made = [self.pieces.byte_ids[list(chr(-1 - c).encode("utf-8", "surrogatepass"))] if self.pieces.has_bytes else np.array([self.pieces.unk]) for c in tokens[odd].tolist()]
        size = np.ones(len(tokens), np.int64)
        size[odd] = [len(m) for m in made]
        first = np.cumsum(size) - size
        out = np.empty(int(size.sum()), np.int64)
        plain = tokens >= 0
        out[first[plain]] = tokens[plain]
        for at, ids in zip(first[odd], made):
            out[at : at + len(ids)] = ids
        bounds = np.concatenate(([0], np.cumsum(count)))
        total = np.concatenate(([0], np.cumsum(size)))
        return out, np.diff(total[bounds])

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        held, size = [], 0
        for text in texts:
            held.append(text or "")
            size += len(held[-1])
            if size >= CHUNK_CHARS:
                out += self._encode(held)
                held, size = [], 0
        return out + (self._encode(held) if held else [])

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        marked = ["▁" + t.replace(" ", "▁") if t else "" for t in texts]
        points = code_points("".join(marked))
        bounds = np.concatenate(([0], np.cumsum([len(m) for m in marked])))
        if not len(points):
            return [np.empty(0, np.int32) for _ in texts]
        mark = points == MARK
        begins = mark.copy()
        begins[1:] &= ~mark[:-1]
        begins[bounds[:-1][np.diff(bounds) > 0]] = True
        starts = np.flatnonzero(begins)
        ends = np.append(starts[1:], len(points))
        sums = prefix_sums(points)
        _, first, back = np.unique(substring_hashes(sums, starts, ends), return_index=True, return_inverse=True)
        order = np.argsort(starts[first] - ends[first], kind="stable")
        first = first[order]
        lengths = (ends - starts)[first]
        own = np.cumsum(lengths) - lengths
        gathered = points[np.repeat(starts[first] - own, lengths) + np.arange(int(lengths.sum()))]
        tokens, count = self._expanded(*self._search(gathered, own, own + lengths))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        unit = rank[back]
        size, at = count[unit], (np.cumsum(count) - count)[unit]
        total = np.cumsum(size)
        flat = tokens[np.repeat(at - (total - size), size) + np.arange(int(total[-1]))].astype(np.int32)
        cuts = np.concatenate(([0], total))[np.searchsorted(starts, bounds)]
        return [flat[a:b] for a, b in zip(cuts[:-1], cuts[1:])]

    def decode(self, ids: np.ndarray) -> str:
        """The text; bytes that are no UTF-8 become U+FFFD."""
        raw = b"".join([self.pieces.bytes_of[i] for i in ids])
        return raw.removeprefix(b" ").decode("utf-8", "replace")


@lru_cache(maxsize=4)
def codec(pieces_key: bytes) -> Codec:
    import pickle

    return Codec(pickle.loads(pieces_key))


@lru_cache(maxsize=4)
def _packed(path: str) -> bytes:
    import pickle

    return pickle.dumps(Pieces(Path(path).read_bytes()))


def _shared(spark, model: str):
    """The piece tables, read by the driver and sent to the executors: their size is that of the vocabulary."""
    return spark.sparkContext.broadcast(_packed(model))


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = MODEL, check: bool = False) -> DataFrame:
    """One row per input row: doc_id, n_tokens, ids; with ``check`` also round_trip, whether decoding gives the text.

    Null and empty texts have no tokens. A text that holds U+2581 decodes with spaces in its place.
    """
    tables = _shared(common.prepare(docs.sparkSession, 1536), model)

    def run(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            own = codec(tables.value)
            ids = own.encode(texts)
            offsets = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
            flat = np.concatenate(ids) if ids else np.empty(0, np.int32)
            columns = [batch.column(0), pa.array(np.diff(offsets).astype(np.int64)), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))]
            if check:
                columns.append(pa.array([own.decode(x) == re.sub("▁", " ", t or "") for x, t in zip(ids, texts)], pa.bool_()))
            yield pa.record_batch(columns, ["doc_id", "n_tokens", "ids", "round_trip"][: len(columns)])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids array<int>" + ", round_trip boolean" * check)


def decode(rows: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", model: str = MODEL) -> DataFrame:
    """(doc_id, text) of encoded rows; null ids give a null text. Ids outside the vocabulary fail the job."""
    tables = _shared(common.prepare(rows.sparkSession), model)

    def run(batches):
        for batch in batches:
            own = codec(tables.value)
            yield pa.record_batch([batch.column(0), pa.array([None if x is None else own.decode(x) for x in batch.column(1).to_pylist()], pa.string())], ["doc_id", "text"])

    return rows.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids")).mapInArrow(run, "doc_id long, text string")
