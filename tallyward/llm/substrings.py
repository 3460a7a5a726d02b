"""Removal of byte strings that occur again elsewhere, by suffix arrays.

A corpus has no suffix array that fits a task, so the windows of ``SPAN`` bytes are dealt out first.
Equal windows choose equal anchors (the substring of smallest hash), and consecutive windows with
one anchor form a run. Runs with an anchor of their own repeat nothing; equal runs are counted. The
other runs of an anchor meet in one task, which builds a suffix array of their bytes by two-stage
sorting and takes windows whose common prefix with a neighbour reaches ``SPAN``. The runs of an
anchor that has too many for a task are cut into shorter ones, down to single windows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyward.llm.text import add_columns, binary_array, fresh, mix, pieces, utf8
from tallyward.session import discard, materialise

SPAN = 400  # bytes that must repeat
GRAM = 64  # bytes that choose an anchor
MAX_RUNS = 4_000  # different runs of one anchor that a task takes, some 2 MB
SHORT_RUN = 16  # windows of the runs that longer ones are cut into
SORT_BYTES = 1 << 19  # runs sorted together
SEGMENT = 1 << 20  # windows of one text handled together

_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_PLACE = np.uint64((1 << 22) - 1)


@lru_cache(8)
def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2^64 and of its inverse."""
    ahead, back = (np.full(size + 1, b, np.uint64) for b in (base, pow(base, -1, 1 << 64)))
    ahead[0] = back[0] = 1
    return np.cumprod(ahead, dtype=np.uint64), np.cumprod(back, dtype=np.uint64)


def _prefix_sums(data: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(16, int(len(data)).bit_length())
    ahead, back = _powers(base, size)
    terms = (data.astype(np.uint64) + np.uint64(1)) * ahead[: len(data)]
    return np.concatenate((np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64))), back


def anchors(data: np.ndarray, bounds: np.ndarray, span: int = SPAN, gram: int = GRAM) -> tuple:
    """The windows of ``span`` bytes inside each text, in runs that share an anchor.

    The anchor of a window is its ``gram``-byte string with the smallest hash, so equal windows
    have equal anchors at equal places. Returns, for each run: number of the text, first start,
    how many starts, how far the anchor is from the first, hash of the anchor, and hash of the
    run's bytes and the anchor's place in them.
    """
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < span:
        return none, none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    sums, back = _prefix_sums(data, _BASES[0])
    m = n - gram + 1
    grams = mix((sums[gram:] - sums[:-gram]) * back[:m])
    order = (grams & ~_PLACE) | np.arange(m, dtype=np.uint64)
    width = span - gram + 1
    padded = np.full(-(-m // width) * width, np.uint64(2**64 - 1))
    padded[:m] = order
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, 1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    count = n - span + 1
    place = (np.minimum(behind[:count], ahead[width - 1 : width - 1 + count]) & _PLACE).astype(np.int64)
    start = np.arange(count)
    owner = np.searchsorted(bounds, start, "right") - 1
    inside = start + span <= bounds[owner + 1]
    new = np.ones(count, bool)
    new[1:] = (place[1:] != place[:-1]) | (owner[1:] != owner[:-1]) | ~inside[:-1]
    first = np.flatnonzero(new & inside)
    # A run ends before the next run or the next window that leaves its text.
    stops = np.flatnonzero(new | ~inside)
    after = np.append(stops, count)[np.searchsorted(stops, first, "right")]
    sums, back = _prefix_sums(data, _BASES[1])
    whole = mix((sums[after - 1 + span] - sums[first]) * back[first])
    shift = place[first] - first
    whole = mix(whole + (shift.astype(np.uint64) << np.uint64(32)) + (after - first).astype(np.uint64))
    return owner[first], first - bounds[owner[first]], after - first, shift, grams[place[first]], whole


def two_stage_order(data: np.ndarray, wanted: np.ndarray, depth: int) -> np.ndarray:
    """The wanted suffixes of ``data`` in the order of their first ``depth`` bytes at least.

    ``wanted`` is a mask that has with each suffix all later ones up to the next that is smaller
    than its successor. Those are sorted directly; the others follow from a scan of the buckets of
    first bytes: whatever a suffix stands behind in its bucket, its predecessor does in its own.
    """
    n = len(data)
    ends = np.append(np.flatnonzero(data[1:] != data[:-1]), n - 1)  # of runs of one byte
    falls = np.append(data[ends[:-1]] > data[ends[:-1] + 1], True)
    larger = np.repeat(falls, np.diff(np.concatenate(([-1], ends))))  # than the suffix behind it
    direct = np.flatnonzero(wanted & ~larger)
    induced = wanted & larger
    in_bucket = np.bincount(data[direct], minlength=256), np.bincount(data[induced], minlength=256)
    head = np.cumsum(in_bucket[0] + in_bucket[1]) - in_bucket[0] - in_bucket[1]
    order = np.full(int(sum(in_bucket[0] + in_bucket[1])), -1, np.int64)

    raw = data.tobytes()
    second = np.append(data[1:], 0)
    pair = (data[direct].astype(np.int64) << 8) | second[direct]
    by_pair = direct[np.argsort(pair, kind="stable")]
    cuts = np.flatnonzero(np.diff(np.sort(pair))) + 1
    at = {c: int(head[c] + in_bucket[1][c]) for c in range(256)}
    for group in np.split(by_pair, cuts):
        if len(group):
            c = int(data[group[0]])
            order[at[c] : at[c] + len(group)] = sorted(group.tolist(), key=lambda i: raw[i : i + depth])
            at[c] += len(group)

    filled = head.copy()
    if induced[n - 1]:  # nothing is behind the last suffix
        order[filled[data[n - 1]]] = n - 1
        filled[data[n - 1]] += 1

    def induce(suffixes: np.ndarray) -> None:
        before = suffixes[suffixes > 0] - 1
        before = before[induced[before]]
        first = data[before]
        by_byte = np.argsort(first, kind="stable")
        before, first = before[by_byte], first[by_byte]
        counts = np.bincount(first, minlength=256)
        offset = np.arange(len(before)) - np.repeat(np.cumsum(counts) - counts, counts)
        order[filled[first] + offset] = before
        filled[:] = filled + counts

    for c in np.flatnonzero(in_bucket[0] + in_bucket[1]):
        done = head[c]
        while done < filled[c]:  # a suffix may place another one in the same bucket
            upto = filled[c]
            induce(order[done:upto])
            done = upto
        induce(order[head[c] + in_bucket[1][c] : head[c] + in_bucket[0][c] + in_bucket[1][c]])
    return order


def common_prefixes(data: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Length, up to ``depth``, of what each suffix has in common with the one before it."""
    padded = np.concatenate((data, np.zeros(depth + 16, np.uint8)))
    words = np.zeros(len(data) + depth + 8, np.uint64)
    for k in range(8):
        words |= padded[k : k + len(words)].astype(np.uint64) << np.uint64(8 * k)
    length = np.zeros(len(order), np.int64)
    left, right = order[:-1], order[1:]
    active = np.arange(len(left))
    for done in range(0, depth, 8):
        differ = words[left[active] + done] ^ words[right[active] + done]
        ended = differ != 0
        differ, at = differ[ended], active[ended] + 1
        for k in range(1, 8):
            length[at] += (differ & np.uint64((1 << (8 * k)) - 1)) == 0
        length[at] += done
        active = active[~ended]
    length[active + 1] = depth
    length[1:] = np.minimum(np.minimum(length[1:], len(data) - np.maximum(left, right)), depth)
    return length


def repeated_windows(runs: list[bytes], weights: list[int], span: int = SPAN) -> list[np.ndarray]:
    """For each run, which of its windows occur twice or more, counting each run ``weight`` times."""
    size = np.array([len(r) for r in runs])
    begin = np.cumsum(size) - size
    data = np.frombuffer(b"".join(runs), np.uint8)
    n = len(data)
    windows = np.zeros(n, bool)
    for b, s in zip(begin.tolist(), size.tolist()):
        windows[b : b + s - span + 1] = True
    ends = np.append(np.flatnonzero(data[1:] != data[:-1]), n - 1)
    falls = np.append(data[ends[:-1]] > data[ends[:-1] + 1], True)
    smaller = ~np.repeat(falls, np.diff(np.concatenate(([-1], ends))))
    # With each window, the suffixes up to the next that is smaller than its successor.
    anchor = np.append(np.flatnonzero(smaller), n - 1)
    last = np.flatnonzero(windows & ~np.append(windows[1:], False))
    wanted = windows.copy()
    for p, e in zip(last.tolist(), anchor[np.searchsorted(anchor, last)].tolist()):
        wanted[p : e + 1] = True
    order = two_stage_order(data, wanted, span)
    order = order[windows[order]]
    group = np.cumsum(common_prefixes(data, order, span) < span) - 1 if len(order) else order
    owner = np.searchsorted(begin, order, "right") - 1
    total = np.bincount(group, np.array(weights)[owner])
    repeated = np.zeros(n, bool)
    repeated[order[total[group] > 1]] = True
    return [repeated[b : b + s - span + 1] for b, s in zip(begin.tolist(), size.tolist())]


_RUN = "key binary, start int, n int, shift int, anchor long, run long"
_KINDS = {"binary": pa.binary(), "int": pa.int32(), "long": pa.int64()}


def _batch(rows: list[tuple] | None, schema: str, columns: list | None = None) -> pa.RecordBatch:
    names, kinds = zip(*(part.split() for part in schema.split(", ")))
    columns = columns if columns is not None else list(zip(*rows)) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, _KINDS[k]) for c, k in zip(columns, kinds)], list(names))


def _segments(data: np.ndarray, bounds: np.ndarray, span: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The texts of a piece as they are; one long text in parts that share ``span - 1`` bytes."""
    if len(bounds) > 2 or len(data) < SEGMENT + span:
        yield 0, data, bounds
        return
    for first in range(0, len(data) - span + 1, SEGMENT):
        part = data[first : first + SEGMENT + span - 1]
        yield first, part, np.array([0, len(part)])


def _runs_of(texts: DataFrame, span: int, gram: int) -> DataFrame:
    """The runs of every text of ``(key, text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                for first, data, bounds in _segments(*utf8(part.column("text")), span):
                    owner, start, n, shift, anchor, whole = anchors(data, bounds, span, gram)
                    keys = part.column("key").take(pa.array(owner, pa.int64()))
                    columns = [keys, start + first, n, shift, anchor.view(np.int64), whole.view(np.int64)]
                    yield _batch(None, _RUN, columns)

    return texts.mapInArrow(run, _RUN)


def _visit(texts: DataFrame, rows: DataFrame, make: Callable, schema: str) -> DataFrame:
    """``make(key, bytes, rows)`` for each text that has rows; it yields result rows."""
    listed = rows.groupBy("key").agg(F.collect_set(F.struct(*[c for c in rows.columns if c != "key"])).alias("rows"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                found = []
                for key, text, own in zip(*(part.column(c).to_pylist() for c in ("key", "text", "rows"))):
                    found.extend(make(key, text.encode(), own))
                yield _batch(found, schema)

    return texts.join(listed, "key").mapInArrow(run, schema)


def _resolve(texts: DataFrame, runs: DataFrame, length: int, span: int, max_runs: int) -> list[DataFrame]:
    """``(key, start, n)`` of the repeated windows in ``runs``, as several DataFrames."""
    seen = runs.groupBy("anchor").agg(
        F.count(F.lit(1)).alias("_n"), F.min("run").alias("_low"), F.max("run").alias("_high")
    )
    seen = seen.filter("_n > 1").select("anchor", (F.col("_low") != F.col("_high")).alias("mixed"))
    # Written, so that the join may split the rows of a frequent anchor.
    hits = materialise(runs.join(materialise(seen, "seen-anchors"), "anchor"), "repeated-anchors")
    discard(runs)
    equal = hits.filter("not mixed").select("key", "start", "n")
    mixed = hits.filter("mixed").drop("mixed")
    one = F.min(F.struct("key", "start", "n")).alias("one")
    distinct = materialise(mixed.groupBy("anchor", "run").agg(F.count(F.lit(1)).alias("weight"), one), "weights")
    sizes = materialise(distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("runs")), "sizes")
    distinct = materialise(distinct.join(sizes, "anchor"), "distinct-runs")
    few = distinct.filter(F.col("runs") <= max_runs).select("one.*", "anchor", "run", "weight")
    verdicts = materialise(_sort_runs(_cut_runs(texts, few, span), span), "sorted-runs")
    found = mixed.join(verdicts, ["anchor", "run"]).select(
        "key", (F.col("start") + F.col("offset")).alias("start"), F.col("length").alias("n")
    )
    results = [equal, found]
    large = materialise(distinct.filter(F.col("runs") > max_runs).select("anchor").distinct(), "large-anchors")
    if not large.isEmpty():
        rows = mixed.join(large, "anchor", "left_semi").select("key", "start", "n", "shift", "anchor")
        shorter = materialise(_shorten(texts, rows, length, span), "shorter-runs")
        results += _resolve(texts, shorter, 1, span, max_runs)
    return results


def _cut_runs(texts: DataFrame, rows: DataFrame, span: int) -> DataFrame:
    """The bytes of one occurrence of each run."""

    def make(key: bytes, text: bytes, own: list[dict]) -> Iterator[tuple]:
        for r in own:
            yield r["anchor"], r["run"], r["weight"], text[r["start"] : r["start"] + r["n"] + span - 1]

    cut = _visit(texts, rows, make, "anchor long, run long, weight long, bytes binary")
    return cut.dropDuplicates(["anchor", "run"])  # a text with copies is visited once for each


def _sort_runs(cut: DataFrame, span: int) -> DataFrame:
    """``(anchor, run, offset, length)``: stretches of repeated windows in each run."""
    schema = "anchor long, run long, offset int, length int"

    def judge(rows: list[tuple]) -> pa.RecordBatch:
        masks = repeated_windows([r[3] for r in rows], [r[2] for r in rows], span) if rows else []
        found = [(r[0], r[1], a, b - a) for r, m in zip(rows, masks) for a, b in _stretches(m)]
        return _batch(found, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("anchor", "run", "weight", "bytes"))):
                if size >= SORT_BYTES and row[0] != rows[-1][0]:  # the runs of an anchor stay together
                    yield judge(rows)
                    rows, size = [], 0
                rows.append(row)
                size += len(row[3])
        yield judge(rows)

    return cut.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(run, schema)


def _key64(data: bytes, *more: int) -> int:
    """A signed 64-bit hash of bytes and numbers."""
    digest = blake2b(data, digest_size=8, key=",".join(map(str, more)).encode()).digest()
    return int.from_bytes(digest, "little", signed=True)


def _shorten(texts: DataFrame, rows: DataFrame, length: int, span: int) -> DataFrame:
    """Runs of ``length`` windows at most; their new anchor is what all windows of a run share.

    Runs are cut at fixed distances from the old anchor, so that equal windows get equal anchors.
    """

    def make(key: bytes, text: bytes, own: list[dict]) -> Iterator[tuple]:
        for r in own:
            place, start, end = r["start"] + r["shift"], r["start"], r["start"] + r["n"]
            while start < end:
                number = (place - start) // length
                last = place - number * length
                stop = min(end, last + 1)
                shared = text[last : last - length + 1 + span]
                run = _key64(text[start : stop + span - 1], place - start)
                yield key, start, stop - start, place - start, _key64(shared, number, r["anchor"]), run
                start = stop

    return _visit(texts, rows, make, _RUN)


def _stretches(mask: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate(([0], mask.view(np.int8), [0]))))
    return [(a, b) for a, b in edges.reshape(-1, 2).tolist()]


def remove_repeats(
    docs: DataFrame, text: str = "text", span: int = SPAN, gram: int = GRAM, max_runs: int = MAX_RUNS
) -> DataFrame:
    """``docs`` plus ``n_bytes``, ``n_removed``, ``n_spans``, ``removed_spans`` and ``kept``.

    A byte goes if it is in a string of ``span`` bytes that also starts anywhere else in the column,
    the same text included; strings are judged on the input and never cross texts. ``removed_spans``
    are the maximal runs of such bytes, ``kept`` is the rest as bytes. All copies go, so repeated
    rows and ties are treated alike. Null and empty texts, and those shorter than ``span``, lose
    nothing; a long one is read in overlapping parts. Columns with the names of new ones are replaced,
    all others stay whatever their names.
    """
    fields = [
        T.StructField("n_bytes", T.LongType()),
        T.StructField("n_removed", T.LongType()),
        T.StructField("n_spans", T.LongType()),
        T.StructField(
            "removed_spans",
            T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])),
        ),
        T.StructField("kept", T.BinaryType()),
    ]
    own, listed = fresh("_key", docs), fresh("_spans", docs)
    keyed = docs.drop(*[f.name for f in fields]).withColumn(own, _text_key(F.col(text)))
    texts = keyed.filter(F.octet_length(text) >= span).select(F.col(own).alias("key"), F.col(text).alias("text"))
    runs = materialise(_runs_of(texts, span, gram), "runs")
    spans = None
    for part in _resolve(texts, runs, SHORT_RUN, span, max_runs):
        found = part.select("key", "start", (F.col("start") + F.col("n") + span - 1).alias("end"))
        spans = found if spans is None else spans.union(found)
    spans = spans.groupBy(F.col("key").alias(own)).agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias(listed))
    joined = keyed.join(materialise(spans, "spans"), own, "left").drop(own)

    def work(texts: pa.Array, found: pa.Array) -> list[pa.Array]:
        rows = []
        for value, cover in zip(texts.to_pylist(), found.to_pylist()):
            raw = (value or "").encode()
            gone = np.zeros(len(raw) + 1, np.int32)
            for s in cover or []:
                gone[s["start"]] += 1
                gone[s["end"]] -= 1
            mask = np.cumsum(gone[:-1]) > 0
            cuts = _stretches(mask)
            kept = np.frombuffer(raw, np.uint8)[~mask].tobytes()
            rows.append((len(raw), len(raw) - len(kept), len(cuts), [{"start": a, "end": b} for a, b in cuts], kept))
        pair = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pair, pa.binary()]
        return [pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)]

    return add_columns(joined, lambda: work, fields, text, (listed,)).drop(listed)


def _text_key(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))
