"""Ranked lexical search in reverse: documents stream through an inverted index of the items.

The items are the queries. Their terms form an inverted index that is broadcast, in blocks of
bounded size. A first pass over the documents counts what the weights need: documents, terms, and
in how many documents each indexed term occurs. A second pass sends each document's term counts
through the index, adds up the scores of the items they reach, and keeps a heap of bounded size
for every item. The heaps of the tasks are merged, first in parts and then by item.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyward.llm.text import LOWER, WORD_BYTES, Words, pieces, ranges, split_words, utf8
from tallyward.session import materialise

K = 10
MAX_POSTINGS = 1_000_000  # (term, item) entries in one broadcast index, some 60 MB
UPDATES_AT_ONCE = 1 << 22
PARTS = 64  # of the heaps, merged before they meet by item

_LOW = (1 << 26) - 1


class Index(NamedTuple):
    """Terms by their hash, and for each the items that have it and how often."""

    key: np.ndarray  # ascending hashes
    start: np.ndarray  # where a term's bytes begin in ``data``
    length: np.ndarray
    data: np.ndarray
    first: np.ndarray  # of a term's postings, one more entry for the end
    item: np.ndarray
    times: np.ndarray
    items: int


def words_of(texts: pa.Array) -> tuple[np.ndarray, Words]:
    """Lower-cased bytes of the texts and the terms in them."""
    data, bounds = utf8(texts)
    data = LOWER[data]
    return data, split_words(data, bounds, WORD_BYTES)


def item_terms(items: DataFrame, item: str, text: str) -> DataFrame:
    """``(item, term, times)`` of all items with an id, terms as bytes.

    Repeated rows count once; several texts of one id are one item with the terms of all.
    """
    known = items.select(F.col(f"`{item}`").alias("item"), F.col(f"`{text}`").alias("text")).filter("item is not null")
    kind = known.schema["item"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                data, words = words_of(part.column("text"))
                rows = []
                for i, name in enumerate(part.column("item").to_pylist()):
                    a, b = words.first[i], words.first[i + 1]
                    counts = Counter(data[words.start[j] : words.end[j]].tobytes() for j in range(a, b))
                    rows += [(name, term, n) for term, n in counts.items()]
                columns = list(zip(*rows)) if rows else [[], [], []]
                kinds = (batch.schema.field("item").type, pa.binary(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["item", "term", "times"])

    fields = [T.StructField("item", kind), T.StructField("term", T.BinaryType()), T.StructField("times", T.LongType())]
    counted = known.distinct().mapInArrow(run, T.StructType(fields))
    return counted.groupBy("item", "term").agg(F.sum("times").alias("times"))


def build_index(rows: list[tuple[int, bytes, int]], items: int) -> Index:
    """The index of ``(item number, term, times)`` entries."""
    postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
    for number, term, times in rows:
        postings[term].append((number, times))
    terms = list(postings)
    words = words_of(pa.array([t.decode() for t in terms], pa.string()))[1]
    order = np.argsort(words.key, kind="stable")
    if len(np.unique(words.key)) < len(terms):
        raise ValueError("two terms of the items have one 64-bit hash")
    terms = [terms[i] for i in order]
    length = np.array([len(t) for t in terms], np.int64)
    sizes = np.array([len(postings[t]) for t in terms], np.int64)
    entries = np.array([p for t in terms for p in sorted(postings[t])], np.int64).reshape(-1, 2)
    return Index(
        words.key[order],
        np.cumsum(length) - length,
        length,
        np.frombuffer(b"".join(terms), np.uint8),
        np.concatenate(([0], np.cumsum(sizes))),
        entries[:, 0],
        entries[:, 1],
        items,
    )


def term_counts(index: Index, data: np.ndarray, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(text number, term number, times)`` of the indexed terms in the texts, by text. A term is
    found by its hash and confirmed by its bytes."""
    n = len(index.key)
    if not n or not len(words.key):
        return (np.zeros(0, np.int64),) * 3
    at = np.minimum(np.searchsorted(index.key, words.key), n - 1)
    size = words.end - words.start
    hit = np.flatnonzero((index.key[at] == words.key) & (index.length[at] == size))
    if len(hit):
        ours, begin = ranges(words.start[hit], size[hit])
        theirs, _ = ranges(index.start[at[hit]], size[hit])
        hit = hit[np.logical_and.reduceat(data[ours] == index.data[theirs], begin)]
    text = np.searchsorted(words.first, hit, "right") - 1
    pairs, times = np.unique(text * n + at[hit], return_counts=True)
    return pairs // n, pairs % n, times


class Statistics(NamedTuple):
    documents: int  # with a term
    terms: int  # in all of them, with repeats
    frequency: np.ndarray  # documents with each indexed term


def collect_statistics(docs: DataFrame, index: Index) -> Statistics:
    """One pass over ``docs`` (a column ``text``); a row for each indexed term and task comes out."""
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        documents = terms = 0
        frequency = np.zeros(len(index.key), np.int64)
        for batch in batches:
            for part in pieces(batch, "text"):
                data, words = words_of(part.column("text"))
                sizes = np.diff(words.first)
                documents, terms = documents + int((sizes > 0).sum()), terms + int(sizes.sum())
                frequency += np.bincount(term_counts(index, data, words)[1], minlength=len(index.key))
        some = np.flatnonzero(frequency)
        numbers, counts = [-1, -2, *some.tolist()], [documents, terms, *frequency[some].tolist()]
        yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array(counts, pa.int64())], ["term", "n"])

    counted = docs.select("text").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    found = dict(map(tuple, counted.collect()))  # a row for each term of the index at most
    frequency = np.array([found.get(t, 0) for t in range(len(index.key))], np.int64)
    return Statistics(found.get(-1, 0), found.get(-2, 0), frequency)


def weights(found: Statistics) -> np.ndarray:
    n = found.documents
    return np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1))) for df in found.frequency.tolist()], np.int64)


class Heaps:
    """The ``k`` best documents of every item: higher scores first, then smaller ids."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.heaps: list[list[tuple[int, int]]] = [[] for _ in range(items)]  # (score, -id), the worst on top
        self.score = np.zeros(items, np.int64)  # of the worst, once a heap is full
        self.id = np.full(items, np.iinfo(np.int64).max)

    def add(self, item: np.ndarray, score: np.ndarray, doc_id: np.ndarray) -> None:
        better = (score > self.score[item]) | ((score == self.score[item]) & (doc_id < self.id[item]))
        better &= score > 0
        item, score, doc_id = item[better], score[better], doc_id[better]
        order = np.lexsort((doc_id, -score, item))
        item, score, doc_id = item[order], score[order], doc_id[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        top = place < self.k  # no more of one batch can enter a heap
        for i, s, d in zip(item[top].tolist(), score[top].tolist(), doc_id[top].tolist()):
            heap = self.heaps[i]
            if len(heap) < self.k:
                heapq.heappush(heap, (s, -d))
            else:
                heapq.heappushpop(heap, (s, -d))
            if len(heap) == self.k:
                self.score[i], self.id[i] = heap[0][0], -heap[0][1]

    def rows(self) -> Iterator[tuple[int, int, int]]:
        for i, heap in enumerate(self.heaps):
            for score, negative in heap:
                yield i, -negative, score


def _add_scores(heaps: Heaps, index: Index, ids: np.ndarray, text: np.ndarray, term: np.ndarray, impact: np.ndarray) -> None:
    """Send the impacts of some texts' terms, in the order of the texts, through the postings."""
    rows = max(1, UPDATES_AT_ONCE // max(1, index.items))  # texts whose scores are held at once
    updates = np.cumsum(index.first[term + 1] - index.first[term])
    at = 0
    while at < len(text):
        last = np.searchsorted(text, text[at] + rows)
        full = np.searchsorted(updates, (updates[at - 1] if at else 0) + UPDATES_AT_ONCE, "right")
        if full < last:  # whole texts only, and at least one
            last = max(np.searchsorted(text, text[full]), np.searchsorted(text, text[at], "right"))
        some, first = slice(at, int(last)), int(text[at])
        size = index.first[term[some] + 1] - index.first[term[some]]
        posting, _ = ranges(index.first[term[some]], size)
        cell = np.repeat(text[some] - first, size) * index.items + index.item[posting]
        value = np.repeat(impact[some], size) * index.times[posting]
        cells = int(text[last - 1] - first + 1) * index.items
        # Sums of halves stay exact as doubles; added up they are exact integers.
        high = np.bincount(cell, value >> 26, cells).astype(np.int64)
        score = (high << 26) + np.bincount(cell, value & _LOW, cells).astype(np.int64)
        reached = np.flatnonzero(score)
        heaps.add(reached % index.items, score[reached], ids[first + reached // index.items])
        at = int(last)


def score_block(docs: DataFrame, index: Index, found: Statistics, k: int) -> DataFrame:
    """``(number, doc_id, score)``: the heaps of every task over ``docs`` (``doc_id``, ``text``)."""
    shared = docs.sparkSession.sparkContext.broadcast((index, weights(found)))
    n_documents, n_terms = found.documents, max(1, found.terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, weight = shared.value
        heaps = Heaps(index.items, k)
        for batch in batches:
            batch = batch.filter(batch.column("doc_id").is_valid())
            for part in pieces(batch, "text"):
                data, words = words_of(part.column("text"))
                text, term, times = term_counts(index, data, words)
                length = [25 + (75 * n * n_documents) // n_terms for n in np.diff(words.first).tolist()]
                times = times.astype(np.int64)
                impact = weight[term] * ((1_000_000_000 * times) // (1000 * times + 8 * np.array(length, np.int64)[text]))
                _add_scores(heaps, index, part.column("doc_id").to_numpy(), text, term, impact)
        rows = list(heaps.rows())
        for at in range(0, len(rows), 100_000):
            columns = list(zip(*rows[at : at + 100_000]))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["number", "doc_id", "score"])

    heaps = docs.select("doc_id", "text").mapInArrow(run, "number long, doc_id long, score long")
    return heaps.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(PARTS)))


def merge_heaps(heaps: DataFrame, k: int) -> DataFrame:
    """The best ``k`` rows of every number, with their rank; a part holds rows of some tasks only."""
    best = [F.desc("score"), F.asc("doc_id")]
    some = heaps.withColumn("rank", F.row_number().over(Window.partitionBy("number", "part").orderBy(*best)))
    some = some.filter(F.col("rank") <= k).drop("rank", "part")
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("number").orderBy(*best)))
    return ranked.filter(F.col("rank") <= k)


def search(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    k: int = K,
    max_postings: int = MAX_POSTINGS,
) -> DataFrame:
    """``(item, rank, doc_id, score)``: for each item the ``k`` documents with the highest scores.

    Terms are runs of ASCII letters and digits and of all characters beyond ASCII, with A-Z
    lower-cased. Equal scores go by ascending id; a document without any of an item's terms is not
    returned. Null and empty texts have no terms: such an item returns nothing, and such a document
    is not counted. Ids of documents are integers; rows without one count in the statistics and are
    never returned, and rows that repeat are documents of their own. Items without an id return
    nothing; repeated items count once, and several texts of one id are one item. Texts of any length
    are read whole. Empty tables give no rows. Other columns are not used, whatever their names.
    """
    spark = docs.sparkSession
    plain = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    terms = materialise(item_terms(items, item, item_text), "item-terms")
    kind = terms.schema["item"].dataType
    schema = T.StructType([T.StructField("number", T.LongType()), T.StructField("item", kind)])
    blocks = -(-terms.count() // max_postings)
    # Blocks are half full on average, so that none holds more than it may.
    block = F.pmod(F.xxhash64("item"), F.lit(2 * blocks if blocks > 1 else 1))
    parts = []
    for b in range(2 * blocks if blocks > 1 else 1):
        rows = [tuple(r) for r in terms.filter(block == b).select("item", "term", "times").collect()]
        names = sorted({r[0] for r in rows})
        number = {name: i for i, name in enumerate(names)}
        index = build_index([(number[name], bytes(term), n) for name, term, n in rows], len(names))
        found = collect_statistics(plain, index) if names else Statistics(0, 0, np.zeros(0, np.int64))
        heaps = materialise(score_block(plain if names else plain.limit(0), index, found, k), "heaps")
        known = spark.createDataFrame(list(enumerate(names)), schema)
        parts.append(merge_heaps(heaps, k).join(known, "number"))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result.select(F.col("item").alias(item), F.col("rank"), F.col("doc_id").alias(doc_id), F.col("score"))
