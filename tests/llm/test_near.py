import random

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from tallyward.llm import near
from tallyward.llm.linking import components, link, shared_groups

WORDS = [f"word{i}" for i in range(400)]


def brute(rows, percent=85):
    sets = []
    for _, text in rows:
        w = (text or "").lower().split()
        sets.append({tuple(w)} if 0 < len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)})
    label = list(range(len(rows)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                label[find(i)] = find(j)
    groups = {}
    for i, (doc, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(doc)
    names = {g: min([d for d in ids if d is not None], default=None) for g, ids in groups.items()}
    return sorted(
        ((d, len(sets[i]), names[find(i)], d == names[find(i)]) for i, (d, _) in enumerate(rows)), key=repr
    )


@pytest.fixture
def rows():
    pick = random.Random(5)
    base = [[pick.choice(WORDS) for _ in range(pick.choice([3, 30, 80, 200]))] for _ in range(12)]
    rows = []
    for n in range(150):
        words = list(pick.choice(base))
        for _ in range(pick.choice([0, 0, 1, 2, 4])):
            words[pick.randrange(len(words))] = pick.choice(WORDS)
        rows.append((n, " ".join(words)))
    odd = [(200, None), (201, ""), (202, " \n"), (203, "One two"), (204, "one TWO"), (205, "x " * 3000), (206, "x " * 2990)]
    return rows + odd + [rows[7], (None, rows[3][1]), (None, "alone in the world of words")]


def test_components_equal_brute_force(spark, rows):
    docs = spark.createDataFrame([(d, t, "own") for d, t in rows], "doc_id long, text string, component_id string")
    got = [tuple(r) for r in near.near_duplicates(docs.repartition(5)).collect()]
    assert sorted(got, key=repr) == brute(rows)


def test_one_of_each_group_stays(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted((r.doc_id for r in near.deduplicate(docs).collect()), key=repr)
    want = sorted({r[0] for r in brute(rows) if r[3]}, key=repr)
    assert kept == want


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert near.near_duplicates(docs).count() == 0 and near.deduplicate(docs).count() == 0


def test_a_pair_within_the_errors_shares_a_key():
    pick = np.random.default_rng(3)
    for _ in range(200):
        one = pick.integers(0, 1 << near.BITS, near.SYMBOLS).astype(np.uint64)
        two = one.copy()
        for place in pick.choice(near.SYMBOLS, near.ERRORS, replace=False):
            two[place] ^= np.uint64(1 + pick.integers(0, 1000))
        assert set(near.index_keys(one[None])[0].tolist()) & set(near.index_keys(two[None])[0].tolist())


def test_signatures_estimate_similarity():
    left = " ".join(f"a{i}" for i in range(1000))
    right = " ".join(f"a{i}" for i in range(920))
    symbols = near.signatures(*near.shingle_sets(pa.array([left, right])))
    assert 0.75 < (symbols[0] == symbols[1]).mean() <= 1


def test_long_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 140)] + [(300, 200)]
    found = dict(components(spark.createDataFrame(chain, "a long, b long")).collect())
    assert set(found) == set(range(61)) | set(range(100, 140)) | {200, 300}
    assert all(c == (0 if n <= 60 else 100 if n < 200 else 200) for n, c in found.items())


def test_links_survive_a_bad_representative(spark):
    """Members that the first representative is not linked to still meet the others."""
    groups = [(1, n) for n in range(8)] + [(2, 7), (2, 9), (3, 9)]
    true = {(0, 1), (2, 3), (4, 5), (5, 6), (1, 2), (7, 9)}
    seen = []

    def verify(pairs):
        rows = [tuple(r) for r in pairs.collect()]
        seen.extend(rows)
        return spark.createDataFrame([r for r in rows if r in true] or [], "a long, b long")

    shared = shared_groups(spark.createDataFrame(groups * 2, "key long, node long"))
    labels = dict(link(shared, verify).collect())
    assert [labels.get(n) for n in range(10)] == [0, 0, 0, 0, 4, 4, 4, 7, None, 7]
    assert len(seen) == len(set(seen)) and all(a < b for a, b in seen)


def test_the_stage_links_from_four_fifths_on(spark):
    """Copies of 100 words with 2 or 3 others: similarity 0.81 (86 of 106) and 0.73 (81 of 111)."""
    pick, rows = random.Random(12), []
    for n in range(80):
        words = [pick.choice(WORDS) for _ in range(100)]
        rows.append((2 * n, " ".join(words)))
        for k, at in enumerate((20, 50, 80)[: 2 + n % 2]):
            words[at] = f"other{k}"
        rows.append((2 * n + 1, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted(r.doc_id for r in corpus_pipeline.remove_near_duplicates(spark, docs, "").collect())
    assert kept == sorted(r[0] for r in brute(rows, 80) if r[3]) and len(kept) == 120


def test_permitted_errors_follow_the_similarity():
    assert near.permitted(85) == (near.CHUNKS, 42)
    for percent in (75, 80, 85, 95):
        chunks, errors = near.permitted(percent)
        assert near.loss(4 * chunks, 2 * chunks - 1, percent) <= near.MAX_LOSS >= near.loss(near.CHECKS, errors, percent)
    for percent in (0, 50, 101):
        with pytest.raises(ValueError):
            near.permitted(percent)


def test_many_texts_around_one_passage(spark):
    """2,000 texts share a passage, copies of one of them differ more and more."""
    rng = random.Random(21)
    passage = [f"p{i}" for i in range(60)]
    texts = [passage + [f"w{rng.randrange(10**6)}" for _ in range(rng.randint(0, 60))] for _ in range(1200)]
    base = passage + [f"b{i}" for i in range(140)]
    for _ in range(800):
        copy = list(base)
        for at in rng.sample(range(len(base)), rng.randint(0, 9)):
            copy[at] = f"x{rng.randrange(10**6)}"
        texts.append(copy)
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near.near_duplicates(docs).collect()}
    sets = [{tuple(t[k : k + 5]) for k in range(len(t) - 4)} for t in texts]
    holders = {}
    for i, s in enumerate(sets):
        for shingle in s:
            holders.setdefault(shingle, []).append(i)
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, s in enumerate(sets):
        shared = {}
        for shingle in s:
            for j in holders[shingle]:
                if j < i:
                    shared[j] = shared.get(j, 0) + 1
        for j, n in shared.items():
            if 100 * n >= 85 * (len(s) + len(sets[j]) - n):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    assert got == {i: root(i) for i in range(len(texts))} and len(set(got.values())) > 1000


def test_a_column_of_a_helpers_name_stays(spark):
    text = " ".join(WORDS[:60])
    docs = spark.createDataFrame([(1, text, "a"), (2, text, "b"), (3, None, "c")], "doc_id long, text string, _row string")
    assert sorted(tuple(r) for r in near.deduplicate(docs).select("doc_id", "_row").collect()) == [(1, "a"), (3, "c")]


def test_other_texts_are_left_out_before_the_join(spark):
    docs = spark.createDataFrame([(n, "a") for n in range(5000)] + [(None, "b"), (7, "c")], "_id long, text string")
    wanted = spark.createDataFrame([(7,), (4000,), (None,)], "_wanted long")
    left = [(r["_id"], r.text) for r in near._maybe_in(docs, "_id", wanted, "_wanted").collect()]
    assert {(7, "a"), (7, "c"), (4000, "a"), (None, "b")} <= set(left) and len(left) < 50
