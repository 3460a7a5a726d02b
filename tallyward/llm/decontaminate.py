"""Benchmark decontamination: windows of benchmark words looked up in every document.

The benchmark's word windows become 64-bit hashes with a 128-bit digest each. They are counted
first; as many as a broadcast may hold go out at once, and a larger benchmark goes out in blocks,
one pass over the documents for each. A task hashes all words and windows of a piece of text
together, looks the windows up, and verifies each hit by the digest of its words.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyward.llm.text import LOWER, WORD_BYTES, add_columns, fresh, pieces, split_words, utf8, window_keys
from tallyward.session import materialise

WINDOW = 13
MAX_WINDOWS = 500_000  # windows in one broadcast, some 50 MB
PIECE = 1 << 18  # bytes of texts handled at once: their words and windows take many times that

_RUNS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def _digest(words: list[bytes]) -> bytes:
    return blake2b(b" ".join(words), digest_size=16).digest()


def benchmark_windows(benchmark: DataFrame, item: str, text: str, window: int = WINDOW) -> DataFrame:
    """Distinct ``(size, key, digest, item)`` of every window of every item with an id and words."""
    known = benchmark.select(F.col(item).cast("string").alias("item"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                data, bounds = utf8(part.column("text"))
                data = LOWER[data]
                words = split_words(data, bounds, WORD_BYTES)
                rows = []
                for i, name in enumerate(part.column("item").to_pylist()):
                    a, b = words.first[i], words.first[i + 1]
                    if a == b:
                        continue
                    size = min(window, int(b - a))
                    all_words = [data[words.start[j] : words.end[j]].tobytes() for j in range(a, b)]
                    for j, key in enumerate(window_keys(words.key[a:b], size).view(np.int64).tolist()):
                        rows.append((size, key, _digest(all_words[j : j + size]), name))
                columns = [list(c) for c in zip(*rows)] if rows else [[], [], [], []]
                kinds = (pa.int32(), pa.int64(), pa.binary(), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)], ["size", "key", "digest", "item"]
                )

    found = known.filter("item is not null").mapInArrow(
        run, "size int, key long, digest binary, item string"
    )
    return found.distinct()


class WindowSet:
    """Windows by size: sorted hashes behind a bitmap, and the items of each digest."""

    def __init__(self, rows: list):
        self.items: dict[bytes, list[str]] = {}
        keys: dict[int, list[int]] = {}
        for size, key, digest, item in rows:
            self.items.setdefault(bytes(digest), []).append(item)
            keys.setdefault(size, []).append(key)
        self.keys = {s: np.unique(np.array(k, np.int64).view(np.uint64)) for s, k in keys.items()}
        self.bitmap = {}
        for size, own in self.keys.items():
            self.bitmap[size] = np.zeros(1 << 20, bool)
            self.bitmap[size][own >> np.uint64(44)] = True

    def hits(self, size: int, windows: np.ndarray) -> np.ndarray:
        """Positions of windows whose hash is in the set."""
        near = np.flatnonzero(self.bitmap[size][windows >> np.uint64(44)])
        own, probe = self.keys[size], windows[near]
        at = np.minimum(np.searchsorted(own, probe), len(own) - 1)
        return near[own[at] == probe]


def _runs(mask: np.ndarray) -> list[dict]:
    edges = np.flatnonzero(np.diff(np.concatenate(([0], mask.view(np.int8), [0]))))
    return [{"start": a, "end": b} for a, b in edges.reshape(-1, 2).tolist()]


def _scan(docs: DataFrame, windows: list, text: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(windows)

    def make():
        known = WindowSet(shared.value)

        def work(texts: pa.Array) -> list[pa.Array]:
            data, bounds = utf8(texts)
            data = LOWER[data]
            words = split_words(data, bounds, WORD_BYTES)
            first = words.first
            runs: list[list] = [[] for _ in texts]
            items: list[list] = [[] for _ in texts]
            found: dict[int, tuple[np.ndarray, set]] = {}
            for size in known.keys:
                at = known.hits(size, window_keys(words.key, size))
                owner = np.searchsorted(first, at, "right") - 1
                inside = at + size <= first[owner + 1]  # windows do not cross texts
                for j, i in zip(at[inside].tolist(), owner[inside].tolist()):
                    digest = _digest([data[words.start[k] : words.end[k]].tobytes() for k in range(j, j + size)])
                    if (names := known.items.get(digest)) is None:
                        continue
                    if i not in found:
                        found[i] = np.zeros(first[i + 1] - first[i], bool), set()
                    found[i][0][j - first[i] : j - first[i] + size] = True
                    found[i][1].update(names)
            for i, (mask, names) in found.items():
                runs[i], items[i] = _runs(mask), sorted(names)
            counts = pa.array(np.diff(first), pa.int64())
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            return [counts, pa.array(runs, kind), pa.array(items, pa.list_(pa.string()))]

        return work

    fields = [
        T.StructField("n_words", T.LongType()),
        T.StructField("hit_runs", _RUNS),
        T.StructField("hit_items", T.ArrayType(T.StringType())),
    ]
    return add_columns(docs, make, fields, text, piece=PIECE)


def _merged(a: Column, b: Column) -> Column:
    """Union of two sorted lists of runs."""
    ordered = F.array_sort(F.concat(a, b))
    empty = F.array().cast("array<struct<start:bigint,end:bigint>>")

    def add(done, run):
        last = F.try_element_at(done, F.lit(-1))
        joins = F.coalesce(last["end"] >= run["start"], F.lit(False))
        longer = F.struct(last["start"].alias("start"), F.greatest(last["end"], run["end"]).alias("end"))
        return F.when(joins, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(longer))).otherwise(
            F.concat(done, F.array(run))
        )

    return F.aggregate(ordered, empty, add)


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    max_windows: int = MAX_WINDOWS,
) -> DataFrame:
    """``docs`` plus what the benchmark has in common with each text.

    ``n_words``; ``hit_runs``, the runs of word numbers inside an occurrence of a window (13
    consecutive words of an item, or all words of a shorter one); ``hit_items``, the ids of the
    items with such windows as sorted strings; ``n_hit``; ``contaminated`` if hit words are at
    least a twentieth of the words. Null and empty texts have no words and no hits. Items without
    an id or without words match nothing; long texts are read whole, a piece of rows at a time; repeated items and repeated documents each count as
    they stand. With an empty benchmark nothing is hit. Columns of these names are replaced.
    """
    windows = benchmark_windows(benchmark, item, item_text, window)
    n = windows.count()
    blocks = -(-n // max_windows)
    if blocks <= 1:
        marked = _scan(docs, [tuple(r) for r in windows.collect()], text)
    else:
        windows = materialise(windows, "benchmark-windows")
        block = F.pmod(F.xxhash64("digest"), F.lit(2 * blocks))
        marked, runs, items = None, fresh("_runs", docs), fresh("_items", docs)
        for i in range(2 * blocks):  # half full on average, so that none holds more than it may
            rows = [tuple(r) for r in windows.filter(block == i).collect()]
            if marked is None:
                marked = materialise(_scan(docs, rows, text), "scanned")
                continue
            before = marked.withColumnsRenamed({"hit_runs": runs, "hit_items": items})
            after = _scan(before, rows, text)
            marked = materialise(
                after.withColumn("hit_runs", _merged(F.col("hit_runs"), F.col(runs)))
                .withColumn("hit_items", F.array_sort(F.array_union("hit_items", items)))
                .drop(runs, items),
                "scanned",
            )
    n_hit = F.aggregate("hit_runs", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"])
    return marked.withColumn("n_hit", n_hit).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
    )


def remove_documents(marked: DataFrame) -> DataFrame:
    """The documents that are not contaminated, without the columns of the search."""
    return marked.filter(~F.col("contaminated")).drop(
        "n_words", "hit_runs", "hit_items", "n_hit", "contaminated"
    )


def remove_spans(marked: DataFrame, text: str = "text") -> DataFrame:
    """``marked`` plus ``clean_text``: the text from the first byte of each hit run to its last
    left out. A null text stays null."""

    def cut(value: str | None, runs: list[dict]) -> str | None:
        if value is None or not runs:
            return value
        raw = np.frombuffer(value.encode(), np.uint8)
        words = split_words(LOWER[raw], np.array([0, len(raw)]), WORD_BYTES)
        kept, at = [], 0
        for run in runs:
            kept.append(raw[at : words.start[run["start"]]])
            at = words.end[run["end"] - 1]
        return np.concatenate([*kept, raw[at:]]).tobytes().decode()

    def work(texts: pa.Array, runs: pa.Array) -> list[pa.Array]:
        return [pa.array([cut(t, r) for t, r in zip(texts.to_pylist(), runs.to_pylist())], pa.string())]

    field = T.StructField("clean_text", T.StringType())
    return add_columns(marked, lambda: work, [field], text, ("hit_runs",))
