"""Alignment of two tokenizers: groups, links, and how many documents hold each pair of ids.

Each document is tokenized by both, once, and its ids are written. Whatever follows aligns them again
from the ids: byte offsets where tokens of both end cut the tokens into groups, and two tokens are
linked if their bytes overlap. One pass counts for each task in how many documents a pair of ids is
linked. The distinct pairs get a minimal perfect hash; counts become dense vectors indexed by it and
are summed as a tree. The second pass aligns the documents again and looks their links up: a hash
gives each pair its place, and the key at that place confirms it.

Pairs are bounded by the two vocabularies, not by the documents. Up to ``MAX_PAIRS`` of them are
broadcast; more are not: then documents send each of their pairs once to its count, by a join.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import count
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyward.llm.text import binary_array, hash_slices, mix, pieces, ranges, utf8
from tallyward.session import materialise

MAX_FILE = 1 << 26  # bytes of a vocabulary file
PIECE = 1 << 18  # bytes of texts, or of their ids, that a task handles at once
MAX_KNOWN = 100_000  # pieces of text that a worker remembers, some 4 MB; those of one call come on top
ROW = 8192  # bytes of pieces that are encoded in a row
MAX_PAIRS = 1 << 22  # in the broadcast table, some 80 MB
PAIRS_AT_ONCE = 1 << 21  # that a task counts before it hands them over
SLICE = 1 << 16  # counters of a dense vector in one row
FAN_IN = 32  # vectors added up at once

# Vocabularies


def read_file(spark: SparkSession, path: str) -> bytes:
    """A vocabulary file of the driver or, if it has none, of Spark's store."""
    if os.path.exists(path):
        with open(path, "rb") as file:
            data = file.read(MAX_FILE + 1)
    else:
        data = bytes(spark.read.format("binaryFile").load(path).select(F.expr(f"substr(content, 1, {MAX_FILE + 1})")).first()[0])
    if len(data) > MAX_FILE:
        raise ValueError(f"{path} has more than {MAX_FILE} bytes")
    return data


def _byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies: printable Latin-1 characters for
    themselves, and for the other bytes, in order, the characters from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}


class ByteLevel:
    """A byte-level BPE of the ``tokenizers`` library; special tokens in texts are ordinary text.

    ``cuts`` says that the library cuts every text before a space that follows an ASCII character
    other than a space: so does the byte-level pattern, where nothing else touches the text.
    """

    def __init__(self, file: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        parts = json.loads(file)
        split = parts.get("pre_tokenizer") or {}
        self.cuts = (
            (split.get("type"), split.get("add_prefix_space"), split.get("use_regex", True)) == ("ByteLevel", False, True)
            and parts.get("normalizer") is None
            and all(t["special"] for t in parts.get("added_tokens", []))
        )
        self.tokenizer = Tokenizer.from_str(file.decode())
        self.tokenizer.encode_special_tokens = True
        alphabet = _byte_alphabet()
        names = self.tokenizer.get_vocab()
        self.tokens = [b""] * (max(names.values()) + 1)
        for name, i in names.items():
            known = all(c in alphabet for c in name)
            self.tokens[i] = bytes(alphabet[c] for c in name) if known else name.encode()

    def encode(self, texts: list[str]) -> list[list[int]]:
        coded = self.tokenizer.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)
        return [c.ids for c in coded]


class Pieces:
    """A ``sentencepiece`` model, which puts a space before the text itself.

    ``cuts`` says that no piece has a space behind another character, so that none reaches over such
    a place in a text.
    """

    def __init__(self, file: bytes):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_proto=file)
        pieces = self.model.id_to_piece(list(range(self.model.get_piece_size())))
        self.cuts = not any(re.search("[^▁]▁", p) for p in pieces)
        self.tokens = [
            bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


class Encoder:
    """Ids of texts. Where the tokenizer cuts texts anyhow, each different piece is encoded once, in a row
    with others, and remembered; those that were not met for longest go when there are too many.

    Pieces are told apart by a hash. Whatever comes out is compared with the text, byte by byte.
    """

    def __init__(self, tokenizer: ByteLevel | Pieces):
        self.tokenizer = tokenizer
        self.length = np.array([len(t) for t in tokenizer.tokens], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.data = np.frombuffer(b"".join(tokenizer.tokens), np.uint8)
        # What is remembered: hashes in order, the ids of each, and when it was last met.
        self.key, self.met = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.first, self.size, self.ids = (np.zeros(0, np.int64) for _ in range(3))
        self.now = 0

    def whole(self, text: str) -> list[int] | None:
        """Ids of a space and the text; None if their bytes are not the same."""
        ids = self.tokenizer.encode([text])[0]
        same = b"".join(map(self.tokenizer.tokens.__getitem__, ids)) == b" " + text.encode()
        return ids if same else None

    def _encode(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of some pieces and the number of each. Pieces that end like those before a cut are
        encoded in rows; where a row does not come back, its pieces are encoded alone."""
        size = end - start
        inner = (_is_word(data[end - 1]) & (size <= ROW)).astype(np.int64)
        order = np.argsort(1 - inner, kind="stable")
        row = np.cumsum(np.where(inner[order] == 1, 0, 1))  # those that are not get rows of their own
        before = np.cumsum(size[order] * inner[order])
        row = row * (int(before[-1]) // ROW + 2) + before // ROW
        counts, ids = np.zeros(len(start), np.int64), []
        while len(order):
            place, _ = ranges(start[order], size[order])
            flat, ends = data[place], np.cumsum(size[order])
            last = np.flatnonzero(np.concatenate((row[1:] != row[:-1], [True])))
            edges = [0, *ends[last].tolist()]
            texts = [flat[a + 1 : b].tobytes().decode() for a, b in zip(edges[:-1], edges[1:])]
            coded = self.tokenizer.encode(texts)
            again = []
            begin = 0
            for stop, codes in zip((last + 1).tolist(), coded):
                codes = np.array(codes, np.int64)
                tokens, pieces = np.cumsum(self.length[codes]), np.cumsum(size[order[begin:stop]])
                at = np.searchsorted(tokens, pieces)
                if stop - begin > 1 and (at[-1] >= len(codes) or (tokens[at] != pieces).any() or at[-1] + 1 < len(codes)):
                    again.append(order[begin:stop])
                else:
                    at = at + 1 if stop - begin > 1 else np.array([len(codes)])
                    counts[order[begin:stop]] = np.diff(at, prepend=0)
                    ids.append((order[begin:stop], codes))
                begin = stop
            order = np.concatenate(again) if again else order[:0]
            row = np.arange(len(order))
        first = np.zeros(len(start), np.int64)
        done = np.concatenate([o for o, _ in ids]) if ids else np.zeros(0, np.int64)
        first[done] = np.cumsum(counts[done]) - counts[done]
        flat = np.concatenate([c for _, c in ids]) if ids else np.zeros(0, np.int64)
        return flat[ranges(first, counts)[0]], counts

    def _remember(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The place of every piece among those remembered."""
        self.now += 1
        keys, where, piece = np.unique(hash_slices(data, start, end), return_index=True, return_inverse=True)
        at = np.searchsorted(self.key, keys)
        known = at < len(self.key)
        known[known] = self.key[at[known]] == keys[known]
        self.met[at[known]] = self.now
        if not known.all():
            if len(self.key) > MAX_KNOWN:
                keep = self.met >= np.sort(self.met)[len(self.met) // 2]
                some, _ = ranges(self.first[keep], self.size[keep])
                self.key, self.met, self.size, self.ids = self.key[keep], self.met[keep], self.size[keep], self.ids[some]
                self.first = np.cumsum(self.size) - self.size
            new = where[~known]
            ids, size = self._encode(data, start[new], end[new])
            order = np.argsort(key := np.concatenate((self.key, keys[~known])), kind="stable")
            first = np.concatenate((self.first, len(self.ids) + np.cumsum(size) - size))
            met = np.concatenate((self.met, np.full(len(new), self.now)))
            self.key, self.first, self.met = key[order], first[order], met[order]
            self.size, self.ids = np.concatenate((self.size, size))[order], np.concatenate((self.ids, ids))
            at = np.searchsorted(self.key, keys)
        return at[piece]

    def __call__(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids of texts that begin with a space, where each text's begin, and which texts have the bytes
        of their ids; the others have no ids."""
        docs = len(bounds) - 1
        is_start = np.zeros(len(data), bool)
        is_start[bounds[:-1][np.diff(bounds) > 0]] = True
        if self.tokenizer.cuts and len(data) > 2:
            word = _is_word(data)
            is_start[1:-1] |= (data[1:-1] == 32) & word[:-2] & word[2:]
        start = np.flatnonzero(is_start)
        if not len(start):
            return np.zeros(0, np.int64), np.zeros(docs + 1, np.int64), np.ones(docs, bool)
        end = np.concatenate((start[1:], [len(data)]))
        place = self._remember(data, start, end)
        size = self.size[place]
        ids = self.ids[ranges(self.first[place], size)[0]]
        doc = np.searchsorted(bounds, start, "right") - 1
        # Every piece must have the length of its tokens, and every byte must be the same.
        ends = np.concatenate(([0], np.cumsum(self.length[ids])))
        bytes_of = np.diff(ends[np.concatenate(([0], np.cumsum(size)))])
        good = np.ones(docs, bool)
        good[doc[bytes_of != end - start]] = False
        token_doc = np.repeat(doc, size)
        fine = good[token_doc]
        theirs = self.data[ranges(self.start[ids[fine]], self.length[ids[fine]])[0]]
        byte_doc = np.repeat(np.arange(docs), np.diff(bounds))
        kept = good[byte_doc]
        good[byte_doc[kept][theirs != data[kept]]] = False
        if not good.all():
            texts = {int(d): data[bounds[d] + 1 : bounds[d + 1]].tobytes().decode() for d in np.flatnonzero(~good)}
            found = {d: self.whole(t) for d, t in texts.items()}
            rest = good[token_doc]
            parts = [ids[rest], *[np.array(i, np.int64) for i in found.values() if i is not None]]
            owner = np.concatenate([token_doc[rest], *[np.full(len(i), d) for d, i in found.items() if i is not None]])
            order = np.argsort(owner, kind="stable")
            ids, token_doc = np.concatenate(parts)[order], owner[order]
            good[[d for d, i in found.items() if i is not None]] = True
        return ids, np.searchsorted(token_doc, np.arange(docs + 1)), good


def _is_word(data: np.ndarray) -> np.ndarray:
    return (data >= 0x21) & (data <= 0x7E)


@lru_cache(maxsize=4)  # a worker process keeps them from task to task
def encoder(file: bytes) -> Encoder:
    """JSON is a file of the ``tokenizers`` library, all else a ``sentencepiece`` model."""
    return Encoder(ByteLevel(file) if file.lstrip()[:1] == b"{" else Pieces(file))


def tokenize(texts: pa.Array, a: Encoder, b: Encoder) -> list[pa.Array]:
    """The packed ids of every text by both; none for null and empty texts, and none where the bytes of
    either's tokens are not a space and the text."""
    data, bounds = utf8(texts)
    some = np.diff(bounds) > 0
    data = np.insert(data, bounds[:-1][some], 32)
    bounds = bounds + np.concatenate(([0], np.cumsum(some)))
    coded = [e(data, bounds) for e in (a, b)]
    good = coded[0][2] & coded[1][2]
    out = []
    for e, (ids, first, _) in zip((a, b), coded):
        size = np.diff(first)
        kept = ids[np.repeat(good, size)].astype(kind(len(e.length)))
        ends = np.concatenate(([0], np.cumsum(size * good)))
        out.append(binary_array(kept.view(np.uint8), kept.itemsize * ends))
    return out


# Alignment of the ids of a piece of the table


class Aligned(NamedTuple):
    links: np.ndarray  # the pair of ids of every link, a * (ids of b) + b
    link_doc: np.ndarray  # the document of every link, ascending
    cut_a: np.ndarray  # for every group the number of a's tokens up to its end
    cut_b: np.ndarray
    cut_doc: np.ndarray


def kind(vocabulary: int) -> np.dtype:
    """How the ids of a vocabulary are packed."""
    return np.dtype("<u2" if vocabulary <= 1 << 16 else "<u4")


def unpack(column: pa.Array, vocabulary: int) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a column of packed ids, and where each document's begin."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    packed = kind(vocabulary)
    return raw.view(packed).astype(np.int64), (offsets - offsets[0]) // packed.itemsize


def align(a: np.ndarray, first_a: np.ndarray, b: np.ndarray, length_a: np.ndarray, length_b: np.ndarray) -> Aligned:
    """Documents one after the other; both tokenizations of each have the same bytes."""
    end_a, end_b = np.cumsum(length_a[a]), np.cumsum(length_b[b])
    is_a, is_b = (np.zeros(int(end_a[-1]) + 1 if len(a) else 1, bool) for _ in range(2))
    is_a[end_a] = is_b[end_b] = True
    ends = np.flatnonzero(is_a | is_b)  # each stretch between two ends belongs to one token of each
    cut_a, cut_b = is_a[ends], is_b[ends]
    to_a, to_b = np.cumsum(cut_a), np.cumsum(cut_b)  # tokens that end there or before
    token_doc = np.repeat(np.arange(len(first_a) - 1), np.diff(first_a))
    at_a, both = to_a - cut_a, cut_a & cut_b
    return Aligned(
        a[at_a] * len(length_b) + b[to_b - cut_b],
        token_doc[at_a],
        to_a[both],
        to_b[both],
        token_doc[at_a[both]],
    )


def distinct_pairs(aligned: Aligned, vocabulary: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(document, pair, links)``: each pair once for every document that holds it linked."""
    keys, times = np.unique(aligned.link_doc * vocabulary + aligned.links, return_counts=True)
    return keys // vocabulary, keys % vocabulary, times


# Minimal perfect hash


class PerfectHash:
    """Numbers 0..n-1 for n given keys, in about 5 bits each.

    Level by level, keys hash to bits of a field twice their number; those that are alone at their
    bit take it, the others go on to the next level. A key's number is the rank of its bit.
    """

    def __init__(self, keys: np.ndarray):
        self.levels: list[tuple[int, np.ndarray, np.ndarray]] = []
        placed, left = 0, keys
        for seed in count():
            if not len(left):
                break
            size = -(-max(64, 2 * len(left)) // 64) * 64
            at = self._hash(left, seed, size)
            alone = np.bincount(at, minlength=size) == 1
            words = np.packbits(alone, bitorder="little").view("<u8")
            ranks = placed + np.cumsum(np.bitwise_count(words), dtype=np.int64) - np.bitwise_count(words)
            self.levels.append((size, words, ranks))
            placed += int(alone.sum())
            left = left[~alone[at]]
        self.n = placed

    @staticmethod
    def _hash(keys: np.ndarray, seed: int, size: int) -> np.ndarray:
        salt = mix(np.array([seed + 1], np.uint64))
        return (mix(keys.astype(np.uint64) ^ salt) % np.uint64(size)).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key; for others any number, or -1."""
        result, todo = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for seed, (size, words, ranks) in enumerate(self.levels):
            at = self._hash(keys[todo], seed, size)
            word, bit = words[at >> 6], (at & 63).astype(np.uint64)
            here = (word >> bit) & np.uint64(1) == 1
            below = word & ((np.uint64(1) << bit) - np.uint64(1))
            result[todo[here]] = (ranks[at >> 6] + np.bitwise_count(below))[here]
            todo = todo[~here]
        return result


class PairTable(NamedTuple):
    number: PerfectHash
    keys: np.ndarray  # by number
    counts: np.ndarray  # documents that hold the pair linked
    best: np.ndarray  # whether no pair of the same first id has more

    def places(self, pairs: np.ndarray) -> np.ndarray:
        at = self.number(pairs)
        if not np.array_equal(self.keys[at], pairs):
            raise KeyError("a pair that was not counted")
        return at


def count_pairs(rows: DataFrame, length_a: np.ndarray, length_b: np.ndarray) -> DataFrame:
    """``(pair, n)``: for each task, the pairs and in how many of its documents they are linked."""
    vocabulary = len(length_a) * len(length_b)
    lengths = rows.sparkSession.sparkContext.broadcast((length_a, length_b))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length_a, length_b = lengths.value
        keys, sums = np.zeros(0, np.int64), np.zeros(0, np.int64)
        held, size = [], 0

        def folded() -> tuple[np.ndarray, np.ndarray]:
            pairs = np.concatenate([keys, *held])
            weight = np.concatenate([sums, np.ones(size, np.int64)])
            new, place = np.unique(pairs, return_inverse=True)
            return new, np.bincount(place, weight, len(new)).astype(np.int64)

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(sums)], ["pair", "n"])

        for batch in batches:
            for part in pieces(batch, "a_ids", PIECE // 2):
                (a, first_a), (b, _) = unpack(part.column("a_ids"), len(length_a)), unpack(part.column("b_ids"), len(length_b))
                held.append(distinct_pairs(align(a, first_a, b, length_a, length_b), vocabulary)[1])
                size += len(held[-1])
                if size >= PAIRS_AT_ONCE:
                    keys, sums = folded()
                    held, size = [], 0
                    if len(keys) >= PAIRS_AT_ONCE:
                        yield out()
                        keys, sums = keys[:0], sums[:0]
        keys, sums = folded()
        yield out()

    return rows.select("a_ids", "b_ids").mapInArrow(run, "pair long, n long")


def dense_counts(partial: DataFrame, number: PerfectHash) -> np.ndarray:
    """The sums of ``(pair, n)`` rows by the pairs' numbers. Every task makes one dense vector, in
    slices; slices of ``FAN_IN`` tasks are added up at a time until one is left."""
    shared = partial.sparkSession.sparkContext.broadcast(number)
    schema = "slice long, part long, counts binary"
    kinds = (pa.int64(), pa.int64(), pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value
        vector = np.zeros(-(-number.n // SLICE) * SLICE, np.int64)
        for batch in batches:
            np.add.at(vector, number(batch.column("pair").to_numpy()), batch.column("n").to_numpy())
        for k, counters in enumerate(vector.reshape(-1, SLICE)):
            if counters.any():
                row = (k, TaskContext.get().partitionId(), counters.tobytes())
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds)], ["slice", "part", "counts"])

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(c.as_buffer(), np.int64) for c in table.column("counts"))
        row = (table.column("slice")[0].as_py(), table.column("part")[0].as_py(), total.tobytes())
        return pa.table([pa.array([v], t) for v, t in zip(row, kinds)], ["slice", "part", "counts"])

    parts = partial.rdd.getNumPartitions()
    vectors = partial.mapInArrow(run, schema)
    while parts > 1:
        parts = -(-parts // FAN_IN)
        grouped = vectors.withColumn("part", F.floor(F.col("part") / FAN_IN)).groupBy("slice", "part")
        vectors = grouped.applyInArrow(add, schema)
    total = np.zeros(-(-number.n // SLICE) * SLICE, np.int64)
    for row in vectors.select("slice", "counts").toLocalIterator():  # as many counters as pairs
        total[row.slice * SLICE : (row.slice + 1) * SLICE] += np.frombuffer(row.counts, np.int64)
    return total[: number.n]


def pair_table(partial: DataFrame, pairs: DataFrame, length_a: np.ndarray, length_b: np.ndarray) -> PairTable:
    """The counts of the written ``(pair, n)`` rows, whose distinct ``pairs`` fit into a broadcast."""
    keys = pairs.toArrow().column("pair").to_numpy()
    number = PerfectHash(keys)
    ordered = np.zeros(len(keys), np.int64)
    ordered[number(keys)] = keys
    counts = dense_counts(partial, number)
    first = ordered // len(length_b)
    most = np.zeros(len(length_a), np.int64)
    np.maximum.at(most, first, counts)
    return PairTable(number, ordered, counts, counts == most[first])


# Documents

_OUT = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]


def group_texts(a: np.ndarray, b: np.ndarray, docs: int, aligned: Aligned) -> pa.Array:
    """``a1,a2|b1;a3|b2,b3``: the ids of every document's groups."""
    n, groups = len(a) + len(b), len(aligned.cut_a)
    before_b = np.concatenate(([0], aligned.cut_b))
    size_a, size_b = np.diff(aligned.cut_a, prepend=0), np.diff(aligned.cut_b, prepend=0)
    group_a, group_b = np.repeat(np.arange(groups), size_a), np.repeat(np.arange(groups), size_b)
    ids, mark = np.zeros(n, np.int64), np.full(n, ord(","), np.uint8)
    ids[np.arange(len(a)) + before_b[group_a]] = a
    ids[np.arange(len(b)) + aligned.cut_a[group_b]] = b
    ends = aligned.cut_a + aligned.cut_b
    mark[aligned.cut_a + before_b[:-1] - 1] = ord("|")
    mark[ends - 1] = ord(";")
    # One row of digits and a mark for each id; what stands before the first digit is left out.
    width = len(str(int(ids.max(initial=0))))
    rows, used = np.zeros((n, width + 1), np.uint8), np.ones((n, width + 1), bool)
    left = ids
    for k in range(width - 1, -1, -1):
        rows[:, k] = left % 10 + ord("0")
        left = left // 10
        if k:
            used[:, k - 1] = left > 0
    rows[:, width] = mark
    group_first = np.searchsorted(aligned.cut_doc, np.arange(docs + 1))
    last = ends[group_first[1:][np.diff(group_first) > 0] - 1] - 1
    used[last, width] = False  # no mark behind a document's last group
    size = np.concatenate(([0], np.cumsum(used.sum(1))))
    bounds = size[np.concatenate(([0], ends))[group_first]]
    return binary_array(rows[used], bounds).cast(pa.string())


def _describe(rows: DataFrame, length_a: np.ndarray, length_b: np.ndarray, table: PairTable | None) -> DataFrame:
    """The second pass: what each document has. Without a table the looked-up columns are null."""
    shared = rows.sparkSession.sparkContext.broadcast((length_a, length_b, table))
    kept = [f for f in rows.schema.fields if f.name not in ("a_ids", "b_ids")]
    names = [f.name for f in kept] + _OUT
    schema = T.StructType([*kept, *[T.StructField(n, T.StringType() if n == "groups" else T.LongType()) for n in _OUT]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length_a, length_b, table = shared.value
        for batch in batches:
            for part in pieces(batch, "a_ids", PIECE // 2):
                docs = part.num_rows
                (a, first_a), (b, first_b) = unpack(part.column("a_ids"), len(length_a)), unpack(part.column("b_ids"), len(length_b))
                found = align(a, first_a, b, length_a, length_b)
                n_groups, n_links = (np.bincount(d, minlength=docs) for d in (found.cut_doc, found.link_doc))
                looked_up = [None, None]
                if table is not None:
                    at = table.places(found.links) if len(found.links) else found.links
                    sums = np.concatenate(([0], np.cumsum(table.counts[at])))
                    first = np.searchsorted(found.link_doc, np.arange(docs + 1))
                    looked_up = [np.bincount(found.link_doc[table.best[at]], minlength=docs), np.diff(sums[first])]
                columns = [np.diff(first_a), np.diff(first_b), n_groups, n_links, *looked_up]
                arrays = [pa.nulls(docs, pa.int64()) if c is None else pa.array(c, pa.int64()) for c in columns]
                groups = group_texts(a, b, docs, found)
                yield pa.RecordBatch.from_arrays([*[part.column(f.name) for f in kept], *arrays, groups], names)

    return rows.mapInArrow(run, schema)


def _describe_by_join(rows: DataFrame, length_a: np.ndarray, length_b: np.ndarray, partial: DataFrame) -> DataFrame:
    """The same without a broadcast: every document sends each of its pairs once to the pair's count."""
    vocabulary = len(length_a) * len(length_b)
    lengths = rows.sparkSession.sparkContext.broadcast((length_a, length_b))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length_a, length_b = lengths.value
        for batch in batches:
            for part in pieces(batch, "a_ids", PIECE // 2):
                (a, first_a), (b, _) = unpack(part.column("a_ids"), len(length_a)), unpack(part.column("b_ids"), len(length_b))
                doc, pair, times = distinct_pairs(align(a, first_a, b, length_a, length_b), vocabulary)
                numbers = part.column("_row").to_numpy()[doc]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (numbers, pair, times)], ["_row", "pair", "times"])

    counts = partial.groupBy("pair").agg(F.sum("n").alias("n"))
    counts = materialise(counts.withColumn("a", F.floor(F.col("pair") / len(length_b))), "pair-counts")
    most = counts.groupBy("a").agg(F.max("n").alias("most"))
    counts = materialise(counts.join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "pair-counts")
    links = rows.select("_row", "a_ids", "b_ids").mapInArrow(run, "_row long, pair long, times long")
    sums = (
        links.join(counts, "pair")
        .groupBy("_row")
        .agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("_best"), F.sum(F.col("times") * F.col("n")).alias("_sum"))
    )
    zero = F.lit(0).cast("long")
    described = _describe(rows, length_a, length_b, None).join(sums, "_row", "left")
    return described.withColumn("n_best", F.coalesce("_best", zero)).withColumn("count_sum", F.coalesce("_sum", zero)).drop("_best", "_sum")


def align_tokenizers(
    docs: DataFrame, path_a: str, path_b: str, text: str = "text", max_pairs: int = MAX_PAIRS
) -> DataFrame:
    """``docs`` without its text, plus the alignment of its tokens by two vocabulary files.

    Both encode a space and the text; special tokens in texts are ordinary text. ``n_a``, ``n_b`` count
    tokens; ``n_groups`` and ``groups`` are the groups between bytes where tokens of both end, ids as
    ``a1,a2|b1;a3|b2,b3``; ``n_links`` counts pairs of tokens whose bytes overlap. A pair of ids has a
    count, the documents that hold it linked: ``count_sum`` adds them up over the links, ``n_best`` has
    the links whose count no other pair with the same first id exceeds.

    Null and empty texts have no tokens, nor do texts that either tokenizer does not give back byte by
    byte: all numbers are 0 and ``groups`` is empty. Texts of any length are tokenized whole. Rows that
    repeat are documents of their own. An empty table gives no rows. Other columns stay as they are, but
    columns with the names of new ones give way to them.
    """
    spark = docs.sparkSession
    files = spark.sparkContext.broadcast((read_file(spark, path_a), read_file(spark, path_b)))
    length_a, length_b = (encoder(f).length for f in files.value)
    if len(length_a) * len(length_b) >= 1 << 45:
        raise ValueError("the vocabularies have too many pairs")
    new = {c.lower() for c in [*_OUT, "a_ids", "b_ids", "_row"]}
    others = [c for c in docs.columns if c.lower() not in new and c != text]
    carried = {f"_c{i}": c for i, c in enumerate(others)}  # whatever they are called, dots and all
    plain = docs.select(*[F.col(f"`{c}`").alias(n) for n, c in carried.items()], F.col(f"`{text}`").alias("_text"))
    packed = [T.StructField("a_ids", T.BinaryType()), T.StructField("b_ids", T.BinaryType())]
    schema = T.StructType([*[f for f in plain.schema.fields if f.name != "_text"], *packed])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = (encoder(f) for f in files.value)
        for batch in batches:
            for part in pieces(batch, "_text", PIECE):
                ids = tokenize(part.column("_text"), a, b)
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in carried], *ids], schema.names)

    # Ids are written once; rows are numbered as they are written, so that the numbers stay.
    rows = materialise(plain.mapInArrow(run, schema).withColumn("_row", F.monotonically_increasing_id()), "token-ids")
    partial = materialise(count_pairs(rows, length_a, length_b), "pairs")
    pairs = materialise(partial.select("pair").distinct(), "distinct-pairs")
    if pairs.count() <= max_pairs:
        described = _describe(rows, length_a, length_b, pair_table(partial, pairs, length_a, length_b))
    else:
        described = _describe_by_join(rows, length_a, length_b, partial)
    return described.select(*[F.col(n).alias(c) for n, c in carried.items()], *_OUT)
