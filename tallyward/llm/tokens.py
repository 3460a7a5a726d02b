"""Byte-level BPE: texts to token ids and back, with the ranks of a given vocabulary.

The vocabulary is a file of ``base64(token) rank`` lines. It is read once by the driver, checked
to be small, and broadcast as arrays. A task splits texts by the vocabulary's pattern, looks each
different piece up once, and merges unknown ones together: pieces of similar length stand in the
rows of a padded matrix, and in every round each row merges its leftmost pair of minimum rank.
"""

from __future__ import annotations

import base64
import heapq
import os
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tallyward.llm.text import add_columns, binary_array

MAX_VOCABULARY = 1 << 20  # tokens; more would be no vocabulary to broadcast
MAX_PIECES = 200_000  # different pieces that a task remembers before it starts afresh
MAX_ROW = 512  # longer pieces merge one at a time, by a heap
LONG_TEXT = 1 << 21

_NONE = np.int32(2**31 - 1)
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def read_ranks(spark: SparkSession, path: str) -> dict[bytes, int]:
    """Tokens and their ranks, from a file of the driver or, if it has none, from Spark's store."""
    if os.path.exists(path):
        with open(path) as file:
            lines = list(islice(file, MAX_VOCABULARY + 1))
    else:
        lines = [r.value for r in spark.read.text(path).take(MAX_VOCABULARY + 1)]
    if len(lines) > MAX_VOCABULARY:
        raise ValueError(f"{path} has more than {MAX_VOCABULARY} tokens")
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


class Vocabulary:
    """Ranks as arrays: an open-addressing table of pairs, and the bytes of every token."""

    def __init__(self, ranks: dict[bytes, int]):
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"bytes without a token: {missing[:5]}")
        self.whole = ranks
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = [
            (ranks[t[:i]], ranks[t[i:]], rank)
            for t, rank in ranks.items()
            for i in range(1, len(t))
            if t[:i] in ranks and t[i:] in ranks
        ]
        bits = max(4, int(np.ceil(np.log2(max(1, len(pairs)) * 2.5))))
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.ranks = np.full(1 << bits, _NONE, np.int32)
        table = np.array(pairs, np.int64).reshape(-1, 3)
        keys, values = (table[:, 0] << 32) | table[:, 1], table[:, 2].astype(np.int32)
        place, left = self._home(keys), np.arange(len(keys))
        while len(left):  # a slot goes to one of those that want it, the others move on
            free = self.keys[place] == -1
            _, winner = np.unique(place[free], return_index=True)
            won = np.flatnonzero(free)[winner]
            self.keys[place[won]], self.ranks[place[won]] = keys[left[won]], values[left[won]]
            lost = np.ones(len(left), bool)
            lost[won] = False
            left, place = left[lost], (place[lost] + 1) & self.mask
        size = max(ranks.values()) + 1
        tokens = [b""] * size
        for token, rank in ranks.items():
            tokens[rank] = token
        self.length = np.array([len(t) for t in tokens], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.data = np.frombuffer(b"".join(tokens), np.uint8)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _MULTIPLIER) >> self.shift).astype(np.int64)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of tokens once merged; a large number if they never are."""
        shape, keys = left.shape, ((left.astype(np.int64) << 32) | right).ravel()
        result, place = np.full(keys.shape, _NONE, np.int32), self._home(keys)
        todo = np.flatnonzero((left.ravel() >= 0) & (right.ravel() >= 0))
        place = place[todo]
        while len(todo):
            found = self.keys[place]
            hit = found == keys[todo]
            result[todo[hit]] = self.ranks[place[hit]]
            on = ~hit & (found != -1)
            todo, place = todo[on], (place[on] + 1) & self.mask
        return result.reshape(shape)

    def merge_rows(self, rows: np.ndarray) -> list[np.ndarray]:
        """Merge padded rows of byte tokens (-1 behind the end) until no pair is left."""
        results: list[np.ndarray] = [None] * len(rows)
        alive = np.arange(len(rows))
        ranks = self.pair_ranks(rows[:, :-1], rows[:, 1:])
        while len(alive):
            width = rows.shape[1]
            best = ranks.argmin(1) if width > 1 else np.zeros(len(rows), np.int64)
            here = np.arange(len(rows))
            rank = ranks[here, best] if width > 1 else np.full(len(rows), _NONE)
            done = rank == _NONE
            if done.any():
                for i in np.flatnonzero(done):
                    results[alive[i]] = rows[i][rows[i] >= 0]
                keep = ~done
                rows, ranks, alive = rows[keep], ranks[keep], alive[keep]
                best, rank = best[keep], rank[keep]
                if not len(alive):
                    break
                here = np.arange(len(rows))
            rows[here, best] = rank
            columns = np.arange(width - 1)
            rows = np.take_along_axis(rows, columns + (columns > best[:, None]), 1)
            columns = np.arange(width - 2)
            ranks = np.take_along_axis(ranks, columns + (columns > best[:, None]), 1)
            if width > 2:
                at = np.minimum(best, width - 3)
                ranks[here, at] = self.pair_ranks(rows[here, at], rows[here, at + 1])
                inner = np.flatnonzero(best > 0)
                at = best[inner] - 1
                ranks[inner, at] = self.pair_ranks(rows[inner, at], rows[inner, at + 1])
        return results

    def merge_long(self, piece: bytes) -> np.ndarray:
        """The same rule for one long piece: a heap of (rank, place), leftmost first."""
        tokens = self.byte[np.frombuffer(piece, np.uint8)]
        first = self.pair_ranks(tokens[:-1], tokens[1:])
        tokens, n = tokens.tolist(), len(tokens)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, tokens[i], tokens[i + 1]) for i, r in enumerate(first.tolist()) if r != _NONE]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if tokens[i] != a or j >= n or tokens[j] != b:
                continue
            tokens[i], tokens[j] = rank, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right < n:
                    r = int(self.pair_ranks(np.array([tokens[left]]), np.array([tokens[right]]))[0])
                    if r != _NONE:
                        heapq.heappush(heap, (r, left, tokens[left], tokens[right]))
        return np.array([t for t in tokens if t >= 0], np.int32)

    def encode_pieces(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Token ids of each piece."""
        results: list[np.ndarray] = [None] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            if (rank := self.whole.get(piece)) is not None:
                results[i] = np.array([rank], np.int32)
            elif len(piece) > MAX_ROW:
                results[i] = self.merge_long(piece)
            else:
                buckets.setdefault((len(piece) + 3) // 4 if len(piece) <= 32 else 8 + len(piece) // 32, []).append(i)
        for members in buckets.values():
            width = max(len(pieces[i]) for i in members)
            step = max(1, (1 << 20) // width)
            for at in range(0, len(members), step):
                some = members[at : at + step]
                size = np.array([len(pieces[i]) for i in some])
                flat = self.byte[np.frombuffer(b"".join(pieces[i] for i in some), np.uint8)]
                rows = np.full((len(some), width), -1, np.int32)
                rows[np.arange(width) < size[:, None]] = flat
                for i, ids in zip(some, self.merge_rows(rows)):
                    results[i] = ids
        return results

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of runs of ids, and where each run's bytes begin."""
        size = self.length[ids]
        ends = np.concatenate(([0], np.cumsum(size)))
        place = np.repeat(self.start[ids] - ends[:-1], size) + np.arange(int(ends[-1]))
        return self.data[place], ends[bounds]


class Encoder:
    """Splits texts and remembers the tokens of the pieces it has met, up to a bound."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.vocabulary, self.pattern = vocabulary, regex.compile(pattern)
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.flat, self.used = np.zeros(1 << 16, np.int32), 0
        self.begin, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _learn(self, found: list[str]) -> None:
        new = list(dict.fromkeys(p for p in found if p not in self.number))
        if not new:
            return
        ids = self.vocabulary.encode_pieces([p.encode() for p in new])
        self.number.update(zip(new, range(len(self.number), len(self.number) + len(new))))
        size = np.array([len(i) for i in ids], np.int64)
        begin = self.used + np.cumsum(size) - size
        self.used += int(size.sum())
        if self.used > len(self.flat):
            self.flat = np.concatenate((self.flat, np.zeros(max(len(self.flat), self.used), np.int32)))
        self.flat[int(begin[0]) : self.used] = np.concatenate(ids)
        self.begin, self.size = np.concatenate((self.begin, begin)), np.concatenate((self.size, size))

    def _ids(self, found: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.number) > MAX_PIECES:
            self._forget()
        self._learn(found)
        at = np.fromiter(map(self.number.__getitem__, found), np.int64, len(found))
        size = self.size[at]
        ends = np.concatenate(([0], np.cumsum(size)))
        return self.flat[np.repeat(self.begin[at] - ends[:-1], size) + np.arange(int(ends[-1]))], ends

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and where each text's ids begin."""
        if sum(map(len, texts)) > LONG_TEXT:
            parts, bounds = [], [0]
            for text in texts:
                total, matches = 0, self.pattern.finditer(text)
                while found := [m.group() for m in islice(matches, 1 << 17)]:
                    parts.append(self._ids(found)[0])
                    total += len(parts[-1])
                bounds.append(bounds[-1] + total)
            return np.concatenate([np.zeros(0, np.int32), *parts]), np.array(bounds)
        found, counts = [], [0]
        for text in texts:
            found += self.pattern.findall(text)
            counts.append(len(found))
        ids, ends = self._ids(found)
        return ids, ends[counts]


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` plus ``ids``: the token ids of each text as little-endian unsigned 32-bit integers.

    Each match of ``pattern`` is encoded separately, without special tokens. A null or empty text
    has no ids. Rows are independent, so repeated rows and ties change nothing; a column ``ids``
    that ``docs`` already has is replaced.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(Vocabulary(read_ranks(spark, path)))

    def make():
        encoder = Encoder(shared.value, pattern)

        def work(texts: pa.Array) -> list[pa.Array]:
            ids, bounds = encoder.encode([t or "" for t in texts.to_pylist()])
            return [binary_array(ids.astype("<u4").view(np.uint8), bounds * 4)]

        return work

    return add_columns(docs, make, [T.StructField("ids", T.BinaryType())], text)


def decode(docs: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """``docs`` plus ``decoded``: the bytes that packed token ids stand for (null ids: no bytes)."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(Vocabulary(read_ranks(spark, path)))

    def make():
        vocabulary = shared.value

        def work(packed: pa.Array) -> list[pa.Array]:
            rows = [b or b"" for b in packed.to_pylist()]
            bounds = np.concatenate(([0], np.cumsum([len(r) // 4 for r in rows]))).astype(np.int64)
            tokens = np.frombuffer(b"".join(rows), "<u4").astype(np.int64)
            return [binary_array(*vocabulary.decode(tokens, bounds))]

        return work

    return add_columns(docs, make, [T.StructField("decoded", T.BinaryType())], ids)
