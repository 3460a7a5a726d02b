import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tallyward.llm import search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def brute_force(docs, items, k=10):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    n_docs, length = sum(bool(c) for _, c in counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = set()
    for item, text in items:
        scores = []
        for i, c in counts:
            if not c or i is None:
                continue
            m = 25 + (75 * sum(c.values()) * n_docs) // length
            score = 0
            for t in terms(text):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scores.append((-score, i))
        out |= {(item, r, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k], 1)}
    return out


def run(spark, docs, items, **options):
    d = spark.createDataFrame([(*r, 1, "x") for r in docs], "doc_id long, text string, score int, item string").repartition(5)
    i = spark.createDataFrame([(*r, 2, "y") for r in items], "item_id long, text string, rank int, number string")
    return {tuple(r) for r in search.search(d, i, **options).select("item_id", "rank", "doc_id", "score").collect()}


WORDS = ["Tree", "tree", "stone", "water", "über", "水", "a1", "it", "the", "of", "rare-word", "end."]


@pytest.fixture(scope="module")
def tables():
    rnd = random.Random(3)
    docs = [(n, " ".join(rnd.choices(WORDS, range(1, 13), k=rnd.randint(0, 60)))) for n in range(300)]
    docs += [(1000 + n, "the stone of the tree") for n in range(200)]
    docs += [(2000, None), (2001, ""), (2002, "... --- !"), (None, "stone stone"), (2003, "water " * 60_000)]
    items = [(n, " ".join(rnd.choices(WORDS, k=rnd.randint(1, 9)))) for n in range(30)]
    return docs, items + [(50, None), (51, ""), (52, "nowhere"), (53, "stone stone stone tree")]


def test_equals_brute_force(spark, tables):
    assert run(spark, *tables) == brute_force(*tables)


def test_small_blocks_and_small_batches_change_nothing(spark, tables, monkeypatch):
    docs, items = tables
    assert run(spark, docs, items, max_postings=40, k=3) == brute_force(docs, items, 3)
    data, words = search.words_of(__import__("pyarrow").array([t for i, t in docs if i is not None]))
    index = search.build_index([(n, t.encode(), c) for n, (_, text) in enumerate(items) for t, c in Counter(terms(text)).items()], len(items))
    ids = np.array([i for i, _ in docs if i is not None])
    text, term, times = search.term_counts(index, data, words)
    results = []
    for limit in (1, 97, 1 << 22):
        monkeypatch.setattr(search, "UPDATES_AT_ONCE", limit)
        heaps = search.Heaps(len(items), 10)
        search._add_scores(heaps, index, ids, text, term, times.astype(np.int64) * 7)
        results.append(sorted(heaps.rows()))
    assert results[0] == results[1] == results[2] and len(results[0]) > 100


def test_heaps_keep_the_best_and_the_smaller_ids():
    rnd = random.Random(5)
    rows = [(rnd.randrange(3), rnd.randrange(1, 9), n) for n in range(500)]
    heaps = search.Heaps(3, 4)
    rnd.shuffle(rows)
    for at in range(0, 500, 50):
        heaps.add(*np.array(rows[at : at + 50]).T)
    want = {(i, d, s) for i in range(3) for j, s, d in sorted((r for r in rows if r[0] == i), key=lambda r: (-r[1], r[2]))[:4]}
    assert set(heaps.rows()) == want


def test_terms_with_the_hash_of_another_do_not_count():
    index = search.build_index([(0, b"stone", 1)], 1)
    data, words = search.words_of(__import__("pyarrow").array(["water stone"]))
    faked = words._replace(key=np.full(2, index.key[0]))
    assert [a.tolist() for a in search.term_counts(index, data, faked)] == [[0], [0], [1]]


def test_repeated_and_nameless_items(spark):
    docs = [(1, "stone"), (2, "water"), (2, "water"), (3, "tree")]
    items = [(7, "stone"), (7, "stone"), (8, "stone"), (8, "water"), (None, "tree")]
    want = brute_force(docs, [(7, "stone"), (8, "stone water")])
    assert run(spark, docs, items) == want and len(want) == 4


def test_empty_tables(spark):
    assert run(spark, [], [(1, "stone")]) == run(spark, [(1, "stone")], []) == run(spark, [], []) == set()
