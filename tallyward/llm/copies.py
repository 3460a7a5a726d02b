"""Exact copies: counting quotient filters of fingerprints, then a comparison of bytes.

A text's fingerprint is the first half of the digest of its bytes without white space. Each task
folds the fingerprints of its rows into counting quotient filters, one for each *block* (the
fingerprints that share their leading bits, so a block's filters have a bounded size). A filter
gives its fingerprints back whole, so the filters of a block merge without loss, by their sorted
remainders. Only fingerprints that occur twice or more go on: their texts are grouped by their
bytes, folded before the shuffle. A text that is alone never shuffles.

What is broadcast is a bitmap of the repeated fingerprints' leading bits, of at most ``MAX_BITMAP``
bits. It only spares work: the texts that it lets through in vain make groups of one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import blake2b, sha256
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyward.llm.text import INK_BYTES, add_columns, pieces, utf8
from tallyward.session import materialise

ROWS_PER_BLOCK = 1 << 17
FINGERPRINTS_AT_ONCE = 1 << 20  # a task's filters are handed over after so many
MAX_BITMAP = 1 << 29  # bits, 64 MB


class QuotientFilter(NamedTuple):
    """Sorted values with their counts, as a counting quotient filter.

    A value is cut into a quotient, its home slot, and a remainder. Remainders of one quotient
    stand together, in order, from the home slot on or behind what stood there already. A bit for
    each home says that it has a run, a bit for each slot that a run ends there. A value that occurs
    more often is followed by the digits of its further occurrences, in slots of the same width.
    """

    quotient_bits: int
    width: int  # bytes of a slot
    occupied: bytes
    run_ends: bytes
    digits: bytes
    slots: bytes


def _pack(bits: np.ndarray) -> bytes:
    return np.packbits(bits, bitorder="little").tobytes()


def _places(packed: bytes) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(np.frombuffer(packed, np.uint8), bitorder="little"))


def fold(values: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order, and how often each occurs."""
    order = np.argsort(values, kind="stable")
    values = values[order]
    first = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))) if len(values) else order
    if counts is None:
        return values[first], np.diff(np.concatenate((first, [len(values)])))
    return values[first], np.add.reduceat(counts[order], first) if len(values) else counts


def build_filter(values: np.ndarray, counts: np.ndarray, bits: int) -> QuotientFilter:
    """The filter of distinct ascending values below ``2 ** bits``."""
    q = max(0, min(bits - 1, int(1.25 * len(values)).bit_length()))
    rest = bits - q
    width = -(-rest // 8)
    home = (values >> np.uint64(rest)).astype(np.int64)
    more = counts.astype(np.uint64) - np.uint64(1)
    n_digits = np.zeros(len(values), np.int64)
    left = more.copy()
    while left.any():
        n_digits += left > 0
        left = left >> np.uint64(8 * width) if width < 8 else np.zeros_like(left)
    size = 1 + n_digits
    before = np.cumsum(size) - size
    at = before + np.maximum.accumulate(home - before)
    total = max(1 << q, int(at[-1] + size[-1])) if len(values) else 1 << q
    occupied, ends, digits = np.zeros(1 << q, bool), np.zeros(total, bool), np.zeros(total, bool)
    occupied[home] = True
    last = np.concatenate((home[1:] != home[:-1], [True])) if len(values) else np.zeros(0, bool)
    ends[(at + size - 1)[last]] = True
    slots = np.zeros(total, np.uint64)
    slots[at] = values & np.uint64((1 << rest) - 1)
    for k in range(int(n_digits.max(initial=0))):
        rows = np.flatnonzero(n_digits > k)
        digit = more[rows] >> np.uint64(8 * width * k) if k else more[rows]
        slots[at[rows] + 1 + k] = digit & np.uint64((1 << 8 * width) - 1)
        digits[at[rows] + 1 + k] = True
    narrow = slots.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return QuotientFilter(q, width, _pack(occupied), _pack(ends), _pack(digits), narrow.tobytes())


def read_filter(f: QuotientFilter, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The values and counts that the filter was built from."""
    home, ends = _places(f.occupied), _places(f.run_ends)
    if not len(home):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    wide = np.zeros((len(f.slots) // f.width, 8), np.uint8)
    wide[:, : f.width] = np.frombuffer(f.slots, np.uint8).reshape(-1, f.width)
    slots = wide.view("<u8").ravel()
    starts = np.maximum(home, np.concatenate(([0], ends[:-1] + 1)))
    size = ends - starts + 1
    run = np.repeat(np.arange(len(home)), size)
    used = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size) + starts[run]
    is_digit = np.zeros(len(slots), bool)
    is_digit[(d := _places(f.digits))[d < len(slots)]] = True
    is_digit = is_digit[used]
    first = np.flatnonzero(~is_digit)
    values = (home[run[first]].astype(np.uint64) << np.uint64(bits - f.quotient_bits)) | slots[used[first]]
    counts = np.ones(len(first), np.int64)
    owner = np.cumsum(~is_digit) - 1
    further = np.flatnonzero(is_digit)
    place = further - first[owner[further]] - 1
    np.add.at(counts, owner[further], (slots[used[further]] << (np.uint64(8 * f.width) * place.astype(np.uint64))).astype(np.int64))
    return values, counts


def merge_filters(filters: list[QuotientFilter], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The values of all filters with their counts added up."""
    parts = [read_filter(f, bits) for f in filters]
    return fold(np.concatenate([v for v, _ in parts]), np.concatenate([c for _, c in parts]))


# Texts


def _normal(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes and bounds of the texts, and of the texts without white space."""
    data, bounds = utf8(texts)
    ink = INK_BYTES[data]
    before = np.concatenate(([0], np.cumsum(ink)))
    return data, bounds, data[ink], before[bounds]


def _slices(data: np.ndarray, bounds: np.ndarray) -> Iterator[bytes]:
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        yield data[a:b].tobytes()


def _fingerprint(digest: bytes, bits: int) -> int:
    """The first ``bits`` bits of a digest at the top of a signed 64-bit integer."""
    value = int.from_bytes(digest[:8], "big") >> (64 - bits) << (64 - bits)
    return value - (1 << 64) if value >> 63 else value


def _describe(docs: DataFrame, text: str, names: list[str], bits: int) -> DataFrame:
    """``docs`` plus, by these names: the digest without white space, its fingerprint, the number of
    code points, and a short digest of the whole text."""

    def work(texts: pa.Array) -> list[pa.Array]:
        data, bounds, ink, ink_bounds = _normal(texts)
        digests = [sha256(t).digest() for t in _slices(ink, ink_bounds)]
        points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))[bounds]
        ties = [int.from_bytes(blake2b(t, digest_size=8).digest(), "big", signed=True) for t in _slices(data, bounds)]
        return [
            pa.array(digests, pa.binary()),
            pa.array([_fingerprint(d, bits) for d in digests], pa.int64()),
            pa.array(np.diff(points), pa.int64()),
            pa.array(ties, pa.int64()),
        ]

    kinds = [T.BinaryType(), T.LongType(), T.LongType(), T.LongType()]
    return add_columns(docs, lambda: work, [T.StructField(n, k) for n, k in zip(names, kinds)], text)


class Repeated(NamedTuple):
    bits: int  # of the bitmap's index
    bitmap: Broadcast


def repeated_fingerprints(rows: DataFrame, fingerprint: str, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """``(fingerprint, n)`` of the 64-bit fingerprints that several rows have; ``rows`` is written."""
    found = _merged_blocks(rows, fingerprint, rows_per_block)[0]

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for values, counts in zip(batch.column("values").to_pylist(), batch.column("counts").to_pylist()):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.frombuffer(values, np.int64)), pa.array(np.frombuffer(counts, np.int64))], ["fingerprint", "n"]
                )

    return found.mapInArrow(unpack, "fingerprint long, n long")


def _merged_blocks(rows: DataFrame, fingerprint: str, rows_per_block: int) -> tuple[DataFrame, int]:
    """A row for each block: repeated fingerprints, counts, and the block's part of the bitmap;
    and the bits of the bitmap's index."""
    spark = rows.sparkSession
    n = rows.count()
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lead = max(tasks - 1, n // rows_per_block).bit_length()
    bits = 64 - lead
    index = max(lead + 3, min(MAX_BITMAP, 8 * n + 1024).bit_length() - 1)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def filters(values: np.ndarray) -> pa.RecordBatch:
            values, counts = fold(values)
            block = values >> np.uint64(bits) if lead else np.zeros(len(values), np.uint64)
            edges = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1], [True])))
            made = [
                (int(block[a]), *build_filter(values[a:b] & np.uint64((1 << bits) - 1), counts[a:b], bits))
                for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())
            ]
            kinds = [pa.int64(), pa.int32(), pa.int32(), *[pa.binary()] * 4]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*made), kinds)], ["block", *QuotientFilter._fields]
            )

        held, size = [], 0
        for batch in batches:
            held.append(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
            size += len(held[-1])
            if size >= FINGERPRINTS_AT_ONCE:
                yield filters(np.concatenate(held))
                held, size = [], 0
        if size:
            yield filters(np.concatenate(held))

    def merge(table: pa.Table) -> pa.Table:
        block = table.column("block")[0].as_py()
        filters = [QuotientFilter(*[row[f] for f in QuotientFilter._fields]) for row in table.to_pylist()]
        values, counts = merge_filters(filters, bits)
        values, counts = values[counts > 1] | np.uint64((block << bits) % (1 << 64)), counts[counts > 1]
        part = np.zeros(1 << (index - lead), bool)
        part[(values >> np.uint64(64 - index)) & np.uint64(len(part) - 1)] = True
        packed = [values.view(np.int64).tobytes(), counts.astype(np.int64).tobytes(), _pack(part)]
        kinds = [pa.binary()] * 3
        return pa.table([pa.array([block], pa.int64()), *[pa.array([p], k) for p, k in zip(packed, kinds)]], ["block", "values", "counts", "part"])

    schema = "block long, quotient_bits int, width int, occupied binary, run_ends binary, digits binary, slots binary"
    built = rows.select(fingerprint).mapInArrow(build, schema)
    found = built.groupBy("block").applyInArrow(merge, "block long, values binary, counts binary, part binary")
    return materialise(found, "blocks"), index


def _bitmap(rows: DataFrame, fingerprint: str, rows_per_block: int) -> Repeated:
    found, index = _merged_blocks(rows, fingerprint, rows_per_block)
    bitmap = np.zeros(1 << (index - 3), np.uint8)
    for row in found.select("block", "part").toLocalIterator():
        bitmap[row.block * len(row.part) : (row.block + 1) * len(row.part)] = np.frombuffer(row.part, np.uint8)
    return Repeated(index, rows.sparkSession.sparkContext.broadcast(bitmap))


def _maybe(values: np.ndarray, index: int, bitmap: np.ndarray) -> np.ndarray:
    at = values.view(np.uint64) >> np.uint64(64 - index)
    return (bitmap[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _let_through(rows: DataFrame, fingerprint: str, repeated: Repeated, wanted: bool) -> DataFrame:
    """The rows whose fingerprint may be repeated, or those whose is not."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = repeated.bitmap.value
        for batch in batches:
            values = batch.column(fingerprint).to_numpy(zero_copy_only=False).astype(np.int64)
            yield batch.filter(pa.array(_maybe(values, repeated.bits, bitmap) == wanted))

    return rows.mapInArrow(run, rows.schema)


def _same_bytes(docs: DataFrame, text: str, repeated: Repeated, bits: int) -> DataFrame:
    """``(fingerprint, digest, n)`` of the texts that several rows share, compared by their bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = repeated.bitmap.value
        for batch in batches:
            for part in pieces(batch, "text"):
                _, _, ink, bounds = _normal(part.column("text"))
                raw = list(_slices(ink, bounds))
                digests = [sha256(t).digest() for t in raw]
                values = np.array([_fingerprint(d, bits) for d in digests], np.int64)
                some = np.flatnonzero(_maybe(values, repeated.bits, bitmap)).tolist()
                columns = [
                    pa.array(values[some]),
                    pa.array([digests[i] for i in some], pa.binary()),
                    pa.array([raw[i] for i in some], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["fingerprint", "digest", "ink"])

    plain = docs.select(F.col(f"`{text}`").alias("text"))
    through = plain.mapInArrow(run, "fingerprint long, digest binary, ink binary")
    texts = through.groupBy("fingerprint", "digest", "ink").agg(F.count(F.lit(1)).alias("n"))
    groups = texts.groupBy("fingerprint", "digest").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("texts"))
    one = F.when(F.col("texts") == 1, F.col("n")).otherwise(F.raise_error(F.lit("two texts have one SHA-256 digest")))
    return materialise(groups.select("fingerprint", "digest", one.alias("n")).filter("n > 1"), "same-bytes")


class _Found(NamedTuple):
    rows: DataFrame  # digest, fingerprint, points, tie and the id of every row; written
    classes: DataFrame  # of the texts of several rows: digest, fingerprint, n and the row that stays
    repeated: Repeated


def _find(docs: DataFrame, doc_id: str, text: str, bits: int, rows_per_block: int) -> _Found:
    plain = docs.select(F.col(f"`{doc_id}`").alias("_id"), F.col(f"`{text}`").alias("text"))
    rows = materialise(_describe(plain, "text", ["digest", "fingerprint", "points", "tie"], bits).drop("text"), "described")
    repeated = _bitmap(rows, "fingerprint", rows_per_block)
    same = _same_bytes(plain, "text", repeated, bits)
    # The row that stays has the most code points, then the smallest id; a null id comes last.
    best = F.min(F.struct((-F.col("points")).alias("less"), F.col("_id").isNull().alias("none"), "_id", "tie"))
    kept = _let_through(rows, "fingerprint", repeated, True).groupBy("fingerprint", "digest").agg(best.alias("best"))
    classes = same.join(kept, ["fingerprint", "digest"]).select("fingerprint", "digest", "n", "best")
    return _Found(rows, materialise(classes, "classes"), repeated)


def find_copies(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", *, bits: int = 64, rows_per_block: int = ROWS_PER_BLOCK
) -> DataFrame:
    """A row for every row of ``docs``: its id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are copies when they are identical without spaces, tabs, line feeds, vertical tabs, form
    feeds and carriage returns. The row with the most code points stays, then the one with the
    smallest id, then the one whose text has the smallest short digest; a null id comes last, and
    is the ``keep_id`` if it stays. Rows that agree in id and text have the same result. A null text
    counts as empty, and texts without any other character are copies of each other. Texts of any
    length are read whole. An empty table gives no rows. Other columns are not used, and whatever
    their names are they clash with nothing. ``bits`` may shorten the fingerprints.
    """
    found = _find(docs, doc_id, text, bits, rows_per_block)
    alone = _let_through(found.rows, "fingerprint", found.repeated, False).select(
        "_id", F.col("_id").alias("keep"), F.lit(1).cast("long").alias("n"), F.lit(True).alias("kept"), "digest"
    )
    # Classes are a written table: a small one is broadcast, and the rows of a large class may be split.
    several = _let_through(found.rows, "fingerprint", found.repeated, True).join(found.classes, ["fingerprint", "digest"], "left")
    stays = F.when(F.col("best").isNull(), True).otherwise(_is_best(F.col))
    several = several.select(
        "_id",
        F.when(F.col("best").isNull(), F.col("_id")).otherwise(F.col("best")["_id"]).alias("keep"),
        F.coalesce("n", F.lit(1).cast("long")).alias("n"),
        stays.alias("kept"),
        "digest",
    )
    return alone.unionByName(several).select(
        F.col("_id").alias(doc_id),
        F.col("keep").alias("keep_id"),
        F.col("n").alias("group_size"),
        "kept",
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def _is_best(col: Callable[[str], Column]) -> Column:
    best = col("best")
    return (best["_id"].eqNullSafe(col("_id"))) & (best["less"] == -col("points")) & (best["tie"] == col("tie"))


def remove_copies(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", *, bits: int = 64, rows_per_block: int = ROWS_PER_BLOCK
) -> DataFrame:
    """The rows of ``docs`` that stay, one of each group of copies, with all columns as they were.

    Texts that are alone pass without a shuffle. Of rows that agree in id and text one stays. Nulls,
    empty texts and ties are as in ``find_copies``.
    """
    found = _find(docs, doc_id, text, bits, rows_per_block)
    taken = {c.lower() for c in docs.columns}
    names = []
    for name in ("digest", "fingerprint", "points", "tie"):
        while name.lower() in taken:
            name += "_"
        names.append(name)
    digest, fingerprint, points, tie = names
    marked = _describe(docs, text, names, bits)
    best = F.col("best")
    stay = found.classes.select(
        F.col("digest").alias("_k1"), best["_id"].alias("_k2"), (-best["less"]).alias("_k3"), best["tie"].alias("_k4")
    )
    several = _let_through(marked, fingerprint, found.repeated, True)
    own = found.classes.select(F.col("digest").alias("_k1"))
    keys = [digest, doc_id, points, tie]
    key = F.struct(*[F.col(f"`{c}`") for c in keys])
    renamed = several.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), key.alias("_key"))
    renamed = renamed.select("_doc", *[F.col("_key")[c].alias(f"_k{k}") for k, c in enumerate(keys, 1)])
    chosen = renamed.join(stay, (renamed["_k1"] == stay["_k1"]) & renamed["_k2"].eqNullSafe(stay["_k2"])
                          & (renamed["_k3"] == stay["_k3"]) & (renamed["_k4"] == stay["_k4"]), "left_semi")
    one = chosen.dropDuplicates(["_k1"])
    alone = renamed.join(own, "_k1", "left_anti")
    rest = _let_through(marked, fingerprint, found.repeated, False).select(*[F.col(f"`{c}`") for c in docs.columns])
    return rest.unionByName(one.unionByName(alone).select("_doc.*"))
