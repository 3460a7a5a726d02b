"""Language identification: multinomial naive Bayes over hashed character n-grams.

Runs of one to three characters, of lower-cased text in which all but letters are blanks, fall
into a fixed number of buckets. Counts per language and bucket are taken over all learnable texts
in Spark, a partial table per task. The log-probability matrix has a bounded size, is broadcast,
and scores all texts of a piece together in numpy.
"""

from __future__ import annotations

from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyward.llm.text import add_columns, mix, pieces

ORDERS = (1, 2, 3)
BUCKETS = 1 << 15
MAX_LANGUAGES = 256  # the matrix that is broadcast has at most 64 MB
SMOOTHING = 0.5
UNKNOWN = "und"


class Model(NamedTuple):
    languages: list[str]  # in alphabetical order
    prior: np.ndarray  # log share of texts
    table: np.ndarray  # log probability of a bucket, a row for each language


@lru_cache(1)
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def _ngrams(texts: list[str]) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """For each order (text number, bucket) of all n-grams; and how many letters each text has."""
    lowered = [f" {t.lower()} " for t in texts]
    ends = np.cumsum([len(t) for t in lowered])
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(texts)), np.diff(np.concatenate(([0], ends))))
    letter = _letters()[codes]
    codes = np.where(letter, codes, 32).astype(np.uint64)
    result = []
    for n in ORDERS:
        last = len(codes) - n + 1
        inside = ends[owner[:last]] >= np.arange(n, last + n)
        key, some = np.full(last, np.uint64(n)), np.zeros(last, bool)
        for i in range(n):
            key = key * np.uint64(0x100000001B3) + codes[i : i + last]
            some |= letter[i : i + last]
        keep = np.flatnonzero(inside & some)
        result.append((owner[keep], (mix(key[keep]) >> np.uint64(49)).astype(np.int64)))
    return result, np.bincount(owner, letter, len(texts))


def learn(rows: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """A model of all rows with a text and a language."""
    known = rows.select(F.col(text).alias("text"), F.col(lang).alias("lang")).filter(
        "text is not null and lang is not null"
    )

    def count(batches):
        totals: dict[str, np.ndarray] = {}
        documents: dict[str, int] = {}
        for batch in batches:
            for part in pieces(batch, "text"):
                names = np.array(part.column("lang").to_pylist(), object)
                different, number = np.unique(names.astype(str), return_inverse=True)
                grams, _ = _ngrams(part.column("text").to_pylist())
                for i, name in enumerate(different):
                    table = totals.setdefault(str(name), np.zeros(BUCKETS, np.int64))
                    documents[str(name)] = documents.get(str(name), 0) + int((number == i).sum())
                    for owner, bucket in grams:
                        table += np.bincount(bucket[number[owner] == i], minlength=BUCKETS)
                if len(totals) > MAX_LANGUAGES:
                    raise ValueError(f"more than {MAX_LANGUAGES} languages")
        for name, table in totals.items():
            used = np.flatnonzero(table)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([name] * (len(used) + 1), pa.string()),
                    pa.array(np.append(used, -1), pa.int32()),
                    pa.array(np.append(table[used], documents[name]), pa.int64()),
                ],
                ["lang", "bucket", "n"],
            )

    counted = known.mapInArrow(count, "lang string, bucket int, n long")
    summed = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    per_language = summed.groupBy("lang").agg(
        F.map_from_entries(F.collect_list(F.struct("bucket", "n"))).alias("counts")
    )
    found = per_language.orderBy("lang").limit(MAX_LANGUAGES + 1).collect()
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    table = np.full((len(found), BUCKETS), SMOOTHING)
    documents = np.ones(len(found))
    for i, row in enumerate(found):
        documents[i] = row.counts.pop(-1)
        table[i, list(row.counts)] += list(row.counts.values())
    table = np.log(table / table.sum(1, keepdims=True))
    return Model([r.lang for r in found], np.log(documents / max(1.0, documents.sum())), table)


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` plus ``lang_pred`` and ``score``, the probability that the model gives it.

    ``und`` with score 0 if a text is null or has no letter, or if no language was learned. Ties go
    to the first language in alphabetical order. Columns of these names are replaced; each of
    several equal rows gets the same result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        languages, prior, table = shared.value

        def work(texts: pa.Array) -> list[pa.Array]:
            n = len(texts)
            grams, letters = _ngrams([t or "" for t in texts.to_pylist()])
            if not languages:
                return [pa.array([UNKNOWN] * n), pa.array(np.zeros(n))]
            score = np.repeat(prior[:, None], n, 1)
            for i in range(len(languages)):
                for owner, bucket in grams:
                    score[i] += np.bincount(owner, table[i][bucket], n)
            best = score.argmax(0)
            chance = 1 / np.exp(score - score.max(0)).sum(0)
            names = [languages[b] if k else UNKNOWN for b, k in zip(best, letters)]
            return [pa.array(names, pa.string()), pa.array(np.where(letters > 0, chance, 0.0))]

        return work

    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    return add_columns(docs, make, fields, text)
