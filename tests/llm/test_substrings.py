import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyward.llm import substrings as ss

SPAN, GRAM = 12, 5


def brute(texts, span):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + span] for b in raw for i in range(len(b) - span + 1))
    rows = []
    for b in raw:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - span + 1):
            if seen[b[i : i + span]] > 1:
                gone[i : i + span] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        rows.append((len(b), int(gone.sum()), len(ss._stretches(gone)), kept))
    return rows


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab", min_size=SPAN, max_size=60), min_size=1, max_size=5))
def test_windows_of_runs(texts):
    runs = [t.encode() for t in texts]
    weights = [1 + i % 2 for i in range(len(runs))]
    seen = Counter()
    for r, w in zip(runs, weights):
        seen.update({})
        for i in range(len(r) - SPAN + 1):
            seen[r[i : i + SPAN]] += w
    want = [[seen[r[i : i + SPAN]] > 1 for i in range(len(r) - SPAN + 1)] for r in runs]
    assert [m.tolist() for m in ss.repeated_windows(runs, weights, SPAN)] == want


@settings(max_examples=200, deadline=None)
@given(st.binary(min_size=1, max_size=120).map(lambda b: bytes(x % 3 for x in b)))
def test_two_stage_order_is_the_suffix_array(data):
    array = np.frombuffer(data, np.uint8)
    order = ss.two_stage_order(array, np.ones(len(data), bool), len(data))
    assert order.tolist() == sorted(range(len(data)), key=lambda i: data[i:])
    shared = ss.common_prefixes(array, order, 16).tolist()
    for k in range(1, len(order)):
        a, b = data[order[k - 1] :], data[order[k] :]
        n = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert shared[k] == min(n, 16)


def test_every_window_is_in_one_run():
    pick = random.Random(1)
    texts = ["".join(pick.choice("abc") for _ in range(n)) for n in (0, 5, 12, 90, 300)] + ["a" * 80]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    bounds = np.cumsum([0, *map(len, texts)])
    owner, start, n, shift, *_ = ss.anchors(data, bounds, SPAN, GRAM)
    found = Counter((o, s + i) for o, s, k in zip(owner, start, n) for i in range(k))
    assert found == Counter((i, j) for i, t in enumerate(texts) for j in range(len(t) - SPAN + 1))
    assert (shift >= 0).all() and (shift <= SPAN - GRAM).all()


@pytest.fixture(scope="module")
def texts():
    pick = random.Random(2)
    word = lambda n: "".join(pick.choice("abcdé ") for _ in range(n))
    shared = [word(40) for _ in range(4)]
    rows = [word(pick.randrange(60)) + pick.choice(shared)[: pick.randrange(41)] + word(20) for _ in range(60)]
    return rows + [rows[0], rows[0], None, "", "short", "x" * 50, "yx" * 30, shared[0], shared[1] + shared[2]]


def rows_of(df):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in df.collect()}


@pytest.mark.parametrize("most", [ss.MAX_RUNS, 2])
def test_removal_equals_brute_force(spark, texts, most, monkeypatch):
    monkeypatch.setattr(ss, "SHORT_RUN", 3)
    docs = spark.createDataFrame([(i, t, "own") for i, t in enumerate(texts)], "doc_id long, text string, kept string")
    got = rows_of(ss.remove_repeats(docs.repartition(4), span=SPAN, gram=GRAM, max_runs=most))
    assert got == dict(enumerate(brute(texts, SPAN)))


def test_one_long_text_in_segments(spark, monkeypatch):
    monkeypatch.setattr(ss, "SEGMENT", 50)
    text = "".join(random.Random(4).choice("abcdefgh") for _ in range(400))
    cut = [text + "-" + text[30:90] + "+" + text[100:111], "q" + text[200:260]]
    for parts in list(ss._segments(np.frombuffer(cut[0].encode(), np.uint8), np.array([0, len(cut[0])]), SPAN)):
        assert len(parts[1]) <= 50 + SPAN - 1
    docs = spark.createDataFrame(list(enumerate(cut)), "doc_id long, text string")
    assert rows_of(ss.remove_repeats(docs, span=SPAN, gram=GRAM)) == dict(enumerate(brute(cut, SPAN)))


def test_empty_table(spark):
    assert ss.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_copies_of_one_text_and_any_other_columns(spark):
    """A thousand copies, and columns with the names of helpers."""
    texts = ["the same words again and again, all of them" for _ in range(1000)] + [None, "", "alone as a text can be", "x" * 3000]
    rows = [(i, t, "own", "own", "own") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string, _spans string, _key string")
    found = {r.doc_id: r for r in ss.remove_repeats(docs, span=SPAN, gram=GRAM).collect()}
    assert len(found) == len(rows) and {(r.key, r["_spans"], r["_key"]) for r in found.values()} == {("own",) * 3}
    for (i, *_), want in zip(rows, brute(texts, SPAN)):
        assert (found[i].n_bytes, found[i].n_removed, found[i].n_spans, found[i].kept) == want
