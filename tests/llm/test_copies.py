import random
from collections import defaultdict
from hashlib import sha256

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyward.llm import copies

SPACE = dict.fromkeys(map(ord, " \t\n\x0b\f\r"))


def filters_of(values, bits):
    return copies.build_filter(*copies.fold(np.array(values, np.uint64)), bits)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 255) | st.just(7), max_size=80), min_size=1, max_size=5), st.sampled_from([8, 11, 63, 64]))
def test_filters_merge_without_loss(parts, bits):
    scale = 1 << max(0, bits - 8)
    parts = [[v * scale + v % 3 for v in part] if bits > 8 else part for part in parts]
    values, counts = copies.merge_filters([filters_of(part, bits) for part in parts], bits)
    want = defaultdict(int)
    for v in sum(parts, []):
        want[v] += 1
    assert dict(zip(values.tolist(), counts.tolist())) == want and values.tolist() == sorted(want)


def test_counts_of_any_size_survive():
    values, counts = np.array([3, 200, 201], np.uint64), np.array([1 << 40, 2, 70_000])
    for bits in (8, 20, 64):
        back = copies.read_filter(copies.build_filter(values, counts, bits), bits)
        assert back[0].tolist() == values.tolist() and back[1].tolist() == counts.tolist()


def brute_force(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[(text or "").translate(SPACE)].append((-len(text or ""), i is None, i or 0, i))
    out = []
    for i, text in rows:
        bare = (text or "").translate(SPACE)
        keep = min(groups[bare])[3]
        out.append((i, keep, len(groups[bare]), i == keep, sha256(bare.encode()).hexdigest()))
    return sorted(out, key=repr)


ROWS = (
    [(i, f"alone {i} é") for i in range(40)]
    + [(100 + i, "one and\tthe same" + " " * (i % 3)) for i in range(300)]
    + [(500, "a b"), (501, "ab "), (502, "a b"), (503, ""), (504, None), (505, " \n"), (None, "ab    "), (506, "ab    ")]
    + [(600, "x" * 300_000), (601, "x" * 299_999 + " x")]
)


@pytest.mark.parametrize("bits", [64, 5])
def test_equals_brute_force(spark, bits):
    rows = random.Random(1).sample(ROWS, len(ROWS))
    docs = spark.createDataFrame([(*r, "k", 3) for r in rows], "doc_id long, text string, digest string, best int").repartition(7)
    got = copies.find_copies(docs, bits=bits, rows_per_block=16).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute_force(rows)


def test_repeated_fingerprints_and_their_counts(spark):
    rows = spark.createDataFrame([(v,) for v in [5, 5, -1, -1, -1, 9, 1 << 62, -(1 << 63)]], "f long").repartition(5)
    found = copies.repeated_fingerprints(rows, "f", 2).collect()
    assert sorted(map(tuple, found)) == [(-1, 3), (5, 2)]


@pytest.mark.parametrize("bits", [64, 5])
def test_rows_that_stay_keep_their_columns(spark, bits):
    schema = "doc_id long, text string, digest string, points_ int, points long, _id string, best array<int>, tie string, fingerprint long"
    rows = [(*r, str(r[0]), 1, 2, "q", [1, 2], None, 4) for r in ROWS] + [(506, "ab    ", "506", 1, 2, "q", [1, 2], None, 4)]
    docs = spark.createDataFrame(rows, schema).repartition(3)
    kept = copies.remove_copies(docs, bits=bits, rows_per_block=16)
    assert kept.columns == docs.columns
    got = kept.collect()
    want = {(r[0], r[1]) for r in brute_force([(r[0], r[1]) for r in ROWS]) if r[3]}
    assert sorted(r.doc_id for r in got) == sorted(i for i, _ in want) and all(r.digest == str(r.doc_id) and r.best == [1, 2] for r in got)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert copies.find_copies(docs).collect() == [] and copies.remove_copies(docs).collect() == []
    one = spark.createDataFrame([(None, None)], "doc_id long, text string")
    assert [tuple(r)[:4] for r in copies.find_copies(one).collect()] == [(None, None, 1, True)]
