"""Texts in tasks: Arrow batches in bounded pieces, and all words of a piece at once.

Words are found on UTF-8 bytes: the word patterns used here treat every byte above 0x7F as part
of a word, so bytes and characters give the same words. Only A-Z are lower-cased, which leaves
byte positions unchanged.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import blake2b
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PIECE_BYTES = 1 << 20  # texts handled at once; one longer text is a piece of its own
_LONG_WORD = 4096

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _alphabet(ranges: list[tuple[int, int]]) -> np.ndarray:
    table = np.zeros(256, bool)
    for first, last in ranges:
        table[first : last + 1] = True
    return table


#: Digits, lower-case letters and everything beyond ASCII.
WORD_BYTES = _alphabet([(0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)])
#: Everything but space, tab, line feed, vertical tab, form feed and carriage return.
INK_BYTES = ~_alphabet([(0x20, 0x20), (0x09, 0x0D)])

_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS = np.cumprod(np.full(_LONG_WORD, _BASE, np.uint64), dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each begins (one more entry for the end)."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, bounds, data = column.buffers()
    bounds = np.frombuffer(bounds, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def pieces(batch: pa.RecordBatch, column: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in runs of about ``limit`` bytes of text."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    first = 0
    while first < len(ends):
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield batch.slice(first, last - first)
        first = last


class Words(NamedTuple):
    start: np.ndarray  # byte position of each word
    end: np.ndarray
    key: np.ndarray  # 64-bit hash of its bytes
    first: np.ndarray  # index of each text's first word, one more entry for the end


def split_words(data: np.ndarray, bounds: np.ndarray, alphabet: np.ndarray) -> Words:
    """All words of all texts: runs of ``alphabet`` bytes that end where a text ends."""
    inside = alphabet[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    before = np.concatenate(([False], inside[:-1])) if len(data) else inside
    start = np.flatnonzero(inside & (edge[:-1] | ~before))
    after = np.concatenate((inside[1:], [False])) if len(data) else inside
    end = np.flatnonzero(inside & (edge[1:] | ~after)) + 1
    first = np.searchsorted(start, bounds)
    return Words(start, end, _hash(data, start, end), first)


def ranges(start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the given ranges, one range after the other, and where each begins there."""
    begin = np.cumsum(size) - size
    return np.arange(int(size.sum())) - np.repeat(begin - start, size), begin


def hash_slices(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each slice."""
    return _hash(data, start, end)


def _hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    key = np.zeros(len(start), np.uint64)
    size = end - start
    short = np.flatnonzero(size <= _LONG_WORD)
    total = np.cumsum(size[short])
    at = 0
    while at < len(short):  # blocks, since this takes many bytes for each byte of text
        before = total[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(total, before + PIECE_BYTES, "right")))
        rows = short[at:to]
        n = size[rows]
        begin = np.cumsum(n) - n
        place = np.arange(int(n.sum())) - np.repeat(begin, n)
        symbols = data[np.repeat(start[rows], n) + place].astype(np.uint64) + np.uint64(1)
        key[rows] = np.add.reduceat(symbols * _POWERS[place], begin)
        at = to
    for i in np.flatnonzero(size > _LONG_WORD):
        key[i] = int.from_bytes(blake2b(data[start[i] : end[i]].tobytes(), digest_size=8).digest(), "little")
    return mix(key + size.astype(np.uint64))


_STEPS = mix(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def window_keys(words: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of every run of ``size`` consecutive words (``size`` <= 64)."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    key = np.zeros(n, np.uint64)
    for i in range(size):
        key += words[i : i + n] * _STEPS[i]
    return mix(key + np.uint64(size))


def binary_array(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Slices of a byte array as an Arrow column."""
    offsets = pa.py_buffer(np.ascontiguousarray(bounds, np.int32))
    return pa.Array.from_buffers(
        pa.binary(), len(bounds) - 1, [None, offsets, pa.py_buffer(np.ascontiguousarray(data))]
    )


Work = Callable[..., list[pa.Array]]


def fresh(name: str, docs: DataFrame) -> str:
    """``name``, with underscores behind it until no column of ``docs`` has it."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def add_columns(
    docs: DataFrame,
    make: Callable[[], Work],
    fields: list[T.StructField],
    text: str = "text",
    also: tuple[str, ...] = (),
    piece: int = PIECE_BYTES,
) -> DataFrame:
    """``docs`` plus columns computed from a text column, a bounded piece at a time.

    ``make`` runs once in each task; what it returns gets the texts of a piece, and the columns
    named in ``also``, and returns one Arrow array per new column. Columns of ``docs`` with the
    names of new ones give way to them.
    """
    new = {f.name.lower() for f in fields}
    kept = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in new or c == text])
    passed = [c for c in kept.columns if c.lower() not in new]
    schema = T.StructType([f for f in kept.schema.fields if f.name in passed] + fields)

    def run(batches):
        work = make()
        for batch in batches:
            for part in pieces(batch, text, piece):
                out = work(part.column(text), *[part.column(c) for c in also])
                names = [*passed, *[f.name for f in fields]]
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in passed], *out], names)
        pa.default_memory_pool().release_unused()  # the worker stays for later tasks

    return kept.mapInArrow(run, schema)
