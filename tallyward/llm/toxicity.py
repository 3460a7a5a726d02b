"""Toxicity scores from positive and unlabelled texts.

Confirmed toxic texts are the positives; any other text is unlabelled, whatever its label says.
Features are that a word, or its first few letters, occurs once, twice or three times. Those that stand out among the
positives are found by document frequencies counted in Spark. A linear classifier over them is
trained with the non-negative risk estimator: the risk of calling a text clean is measured on the
unlabelled texts, corrected by the share of toxic ones among them, and kept from going negative.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyward.llm.text import _POWERS, LOWER, WORD_BYTES, add_columns, mix, pieces, split_words, utf8
from tallyward.session import materialise

PREFIXES = (4, 5, 6, 7)
MAX_POSITIVE, MAX_UNLABELLED = 6_000, 12_000  # texts learned from
MAX_FEATURES = 4_000
MIN_TEXTS, MIN_LIFT = 5, 3.0  # a feature must be in so many positives, and so much denser there
MIN_SURPRISE = 6.0  # standard deviations above what chance would put into the positives
PENALTY = 1e-4  # on squared weights
LEVELS = (1, 2, 3)  # occurrences that count
THRESHOLD = 0.7


class Model(NamedTuple):
    keys: np.ndarray  # sorted feature hashes
    weights: np.ndarray  # of all keys for the first level, then for the next
    bias: float


def text_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text number, feature hash) of every word and word beginning."""
    data, bounds = utf8(texts)
    data = LOWER[data]
    words = split_words(data, bounds, WORD_BYTES)
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(words.first))
    size, owners, keys = words.end - words.start, [owner], [words.key]
    for n in PREFIXES:
        long = np.flatnonzero(size > n)
        start, key = words.start[long], np.zeros(len(long), np.uint64)
        for i in range(n):
            key += (data[start + i].astype(np.uint64) + np.uint64(1)) * _POWERS[i]
        owners.append(owner[long])
        keys.append(mix(key + np.uint64(n << 32)))
    return np.concatenate(owners), np.concatenate(keys)


def _present(texts: pa.Array, known: np.ndarray, bitmap: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text number, feature) of what each text has: a place in ``known`` for each level reached."""
    owner, keys = text_features(texts)
    near = np.flatnonzero(bitmap[keys >> np.uint64(44)])
    at = np.minimum(np.searchsorted(known, keys[near]), len(known) - 1)
    hit = known[at] == keys[near]
    pairs, counts = np.unique(owner[near][hit] * len(known) + at[hit], return_counts=True)
    owners = [pairs[counts >= level] // len(known) for level in LEVELS]
    features = [pairs[counts >= level] % len(known) + i * len(known) for i, level in enumerate(LEVELS)]
    order = np.argsort(np.concatenate(owners), kind="stable")
    return np.concatenate(owners)[order], np.concatenate(features)[order]


def _bitmap(known: np.ndarray) -> np.ndarray:
    bitmap = np.zeros(1 << 20, bool)
    bitmap[known >> np.uint64(44)] = True
    return bitmap


def fold(doc_id: str) -> Column:
    """The third of all ids that a row is in; rows of fold 1 are held out."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3


def training_rows(docs: DataFrame, labels: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, float]:
    """``(positive, text)`` of a bounded sample by hash of the id, and the share of positives.

    Labels of held-out rows are not read. An id that is labelled both ways is positive.
    """
    known = labels.filter(fold(doc_id) != 1).groupBy(doc_id).agg(F.max("toxic").alias("toxic"))
    share = known.agg(F.avg(F.col("toxic").cast("double"))).first()[0] or 0.0
    order = F.xxhash64(F.col(doc_id))
    toxic = known.filter("toxic = 1").select(doc_id).orderBy(order, doc_id).limit(MAX_POSITIVE)
    others = docs.filter(fold(doc_id) != 1).select(doc_id).distinct()
    others = others.orderBy(order, doc_id).limit(MAX_UNLABELLED)
    chosen = toxic.withColumn("positive", F.lit(True)).union(others.withColumn("positive", F.lit(False)))
    chosen = chosen.withColumnRenamed(doc_id, "_id")  # at most MAX_POSITIVE + MAX_UNLABELLED rows
    texts = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("text"))
    return texts.join(F.broadcast(chosen), "_id").select("positive", "text"), float(share)


def choose_features(rows: DataFrame) -> np.ndarray:
    """Hashes of the features that stand out among the positives, sorted."""

    def count(batches):
        frequency: dict[bool, list] = {True: [], False: []}
        for batch in batches:
            for part in pieces(batch, "text"):
                positive = part.column("positive").to_numpy(zero_copy_only=False).astype(bool)
                owner, keys = text_features(part.column("text"))
                order = np.lexsort((keys, owner))
                owner, keys = owner[order], keys[order]
                new = np.ones(len(keys), bool)
                new[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
                owner, keys = owner[new], keys[new]
                for kind in (True, False):
                    frequency[kind].append(np.unique(keys[positive[owner] == kind], return_counts=True))
                    if len(frequency[kind]) > 8:
                        frequency[kind] = [_summed(frequency[kind])]
        for kind, found in frequency.items():
            if found:
                keys, n = _summed(found)
                for at in range(0, len(keys), 100_000):
                    some = slice(at, at + 100_000)
                    columns = [np.full(len(keys[some]), kind), keys[some].view(np.int64), n[some]]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["positive", "key", "n"])

    totals = {r.positive: r.n for r in rows.groupBy("positive").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_pos, n_all = totals.get(True, 0), totals.get(False, 0)
    if not n_pos or not n_all:
        return np.zeros(0, np.uint64)
    counted = rows.select("positive", "text").mapInArrow(count, "positive boolean, key long, n long")
    both = counted.groupBy("key").agg(
        F.sum(F.when(F.col("positive"), F.col("n")).otherwise(0)).alias("p"),
        F.sum(F.when(F.col("positive"), 0).otherwise(F.col("n"))).alias("u"),
    )
    share_p, share_u = F.col("p") / n_pos, (F.col("u") + 0.5) / n_all
    surprise = (share_p - share_u) * n_pos / F.sqrt(share_u * n_pos)
    best = (
        both.filter(F.col("p") >= MIN_TEXTS)
        .filter(share_p >= MIN_LIFT * share_u)
        .filter(surprise >= MIN_SURPRISE)
        .orderBy(surprise.desc(), "key")
        .limit(MAX_FEATURES)
    )
    return np.sort(np.array([r.key for r in best.select("key").collect()], np.int64).view(np.uint64))


def _summed(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, inverse = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
    counts = np.bincount(inverse, np.concatenate([n for _, n in found]), len(keys)).astype(np.int64)
    return keys, counts


def train(rows: DataFrame, share: float, rounds: int = 400) -> Model:
    """A classifier of the features that ``choose_features`` finds in ``(positive, text)`` rows."""
    keys = choose_features(rows)
    prior = min(max(share, 1e-4), 0.9)
    if not len(keys):
        return Model(keys, np.zeros(0), float(np.log(prior / (1 - prior))) if share else -50.0)

    def find(batches):
        bitmap = _bitmap(keys)
        for batch in batches:
            for part in pieces(batch, "text"):
                owner, at = _present(part.column("text"), keys, bitmap)
                ends = np.searchsorted(owner, np.arange(part.num_rows + 1))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(at, pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column("positive"), lists], ["positive", "found"])

    sparse = rows.select("positive", "text").mapInArrow(find, "positive boolean, found array<int>").collect()
    weights, bias = fit([r.found for r in sparse], np.array([r.positive for r in sparse], bool), len(keys) * len(LEVELS), prior, rounds)
    return Model(keys, weights, bias)


def fit(
    found: list[list[int]], positive: np.ndarray, n_features: int, prior: float, rounds: int = 400
) -> tuple[np.ndarray, float]:
    """Minimise the non-negative positive-unlabelled risk of a linear classifier with Adam.

    ``found`` lists the present features of each text. Where the corrected risk on the negative
    side falls below zero, the step climbs it instead, which keeps it from overfitting.
    """
    sizes = np.array([len(f) for f in found])
    row = np.repeat(np.arange(len(found)), sizes)
    column = np.concatenate([np.asarray(f, np.int64) for f in found] + [np.zeros(0, np.int64)])
    n_pos, n_all = max(1, int(positive.sum())), max(1, int((~positive).sum()))
    weights, bias = np.zeros(n_features), float(np.log(prior / (1 - prior)))
    first, second = np.zeros(n_features + 1), np.zeros(n_features + 1)
    for step in range(1, rounds + 1):
        margin = np.bincount(row, weights[column], len(found)) + bias
        chance = 1 / (1 + np.exp(-np.clip(margin, -50, 50)))
        loss = np.logaddexp(0, margin)  # of calling a text toxic that is clean
        negative = loss[~positive].sum() / n_all - prior * loss[positive].sum() / n_pos
        slope = np.where(positive, prior * (chance - 1) / n_pos, 0.0)
        correction = np.where(positive, -prior * chance / n_pos, chance / n_all)
        slope = slope + correction if negative >= 0 else -correction
        gradient = np.append(np.bincount(column, slope[row], n_features) + PENALTY * weights, slope.sum())
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        move = 0.1 * first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        weights, bias = weights - move[:-1], bias - move[-1]
    return weights, float(bias)


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` plus ``score``, 0 to 1, higher for texts more likely toxic.

    Null and empty texts score what a text without any known feature does. Existing columns
    ``score`` are replaced; repeated rows each get the same score.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        keys, weights, bias = shared.value
        bitmap = _bitmap(keys)

        def work(texts: pa.Array) -> list[pa.Array]:
            margin = np.full(len(texts), bias)
            if len(keys):
                owner, at = _present(texts, keys, bitmap)
                margin += np.bincount(owner, weights[at], len(texts))
            return [pa.array(1 / (1 + np.exp(-np.clip(margin, -50, 50))))]

        return work

    return add_columns(docs, make, [T.StructField("score", T.DoubleType())], text)


def learn(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Model:
    """A model from the labels of rows that are not held out. Without any positive, all texts
    score the share of positives; without labels, next to nothing."""
    rows, share = training_rows(docs, labels, doc_id, text)
    return train(materialise(rows, "toxicity-sample"), share)
