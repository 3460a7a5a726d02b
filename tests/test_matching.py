import random
from difflib import SequenceMatcher, get_close_matches

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyward.operators import matching
from tallyward.operators.matching import fuzzy_join, match_values

WORDS = "QUEDA CORTE FERIDA MAQUINA LESAO ESCADA TUBO FORNO MOTOR SERRA PRENSA RUA PISO ACIDO".split()


def phrases(rng, n, longest=6):
    return [" ".join(rng.choices(WORDS, k=rng.randint(1, longest))) for _ in range(n)]


def dirty(rng, text):
    kind = rng.randrange(5)
    if kind == 0:
        return text[: max(1, len(text) * 2 // 3)]
    if kind == 1:
        letters = list(text)
        rng.shuffle(letters)
        return "".join(letters)
    if kind == 2:
        return "".join(rng.choices("ABCXYZ ,-", k=rng.randint(1, 30)))
    if kind == 3:
        return text.replace("A", "", 1) + rng.choice(["", ".", " DE"])
    return text


def frames(spark, values, entries):
    return (
        spark.createDataFrame([(v,) for v in sorted(set(values))], "value string"),
        spark.createDataFrame([(e,) for e in sorted(set(entries))], "entry string"),
    )


def result(df):
    return {r.value: (r.entry, r.score) for r in df.collect()}


def expected(values, entries, cutoff):
    found = {}
    for value in set(values):
        hit = get_close_matches(value, sorted(set(entries)), n=1, cutoff=cutoff)
        if hit:
            found[value] = (hit[0], SequenceMatcher(None, hit[0], value).ratio())
    return found


@pytest.mark.parametrize("cutoff", [0.3, 0.6, 0.9, 1.0])
def test_ratio_equals_the_standard_matcher(spark, cutoff):
    rng = random.Random(7)
    entries = phrases(rng, 80)
    values = [dirty(rng, rng.choice(entries)) for _ in range(150)] + ["XYZ", "DESCONHECIDO"]
    assert result(match_values(*frames(spark, values, entries), cutoff=cutoff)) == expected(
        values, entries, cutoff
    )


TEXTS = st.lists(st.text("AB CÉ", min_size=1, max_size=12), min_size=1, max_size=8, unique=True)


def best_of(values, entries, cutoff, measure=matching.Ratio):
    index, found = matching.Index(sorted(entries)), {}
    for value in values:
        best = (cutoff, "")
        for one in (matching.first_round, matching.second_round):
            best, _ = one(index, measure(value), best)
        if best[1]:
            found[value] = best[::-1]
    return found


@settings(max_examples=300, deadline=None)
@given(values=TEXTS, entries=TEXTS, cutoff=st.sampled_from([0.1, 0.3, 0.5, 0.8, 1.0]))
def test_pruning_is_exact(values, entries, cutoff):
    assert best_of(values, entries, cutoff) == expected(values, entries, cutoff)


@settings(max_examples=300, deadline=None)
@given(values=TEXTS, entries=TEXTS, cutoff=st.sampled_from([0.1, 0.5, 0.8]))
def test_pruning_by_edits_is_exact(values, entries, cutoff):
    want = {}
    for v in values:
        score, e = max((1 - edit_distance(v, e) / max(len(v), len(e)), e) for e in entries)
        if score >= cutoff:
            want[v] = (e, score)
    assert best_of(values, entries, cutoff, matching.Levenshtein) == want


@settings(max_examples=300, deadline=None)
@given(a=st.text("abcdé日", max_size=90), b=st.text("abcdé日", max_size=90))
def test_edit_distance(a, b):
    assert matching._distance(a, b) == edit_distance(a, b)


@settings(max_examples=200, deadline=None)
@given(value=st.text("abc日", min_size=1, max_size=80), entries=st.lists(st.text("abc日x", min_size=1, max_size=30), min_size=1, max_size=6))
def test_common_subsequences_of_many_entries(value, entries):
    index = matching.Index(entries)
    got = matching._common_subsequences(value, index, np.arange(len(entries)))
    assert got.tolist() == [matching._common_subsequence(value, e) for e in entries]


def test_few_pairs_are_scored(spark):
    """20,000 values against 5,000 entries: a hundred million pairs, of which few are compared in full."""
    rng = random.Random(12)
    words = ["".join(rng.choices("ABCDEFGHILMNOPRSTU", k=rng.randint(4, 9))) for _ in range(3000)]
    entries = sorted({" ".join(rng.choices(words, k=rng.randint(2, 4))) for _ in range(5000)})
    values = set()
    while len(values) < 20_000:
        entry = rng.choice(entries)
        at = rng.randrange(len(entry))
        values.add(rng.choice([entry[:at] + entry[at + 1 :], entry[:at] + "X" + entry[at:], entry[: max(8, 2 * len(entry) // 3)]]))
    found = matching.search(*frames(spark, values, entries), 0.3, "ratio")
    n, scored = found.selectExpr("count(*)", "sum(scored)").first()
    assert n == len(values) and scored < 3 * n < n * len(entries) / 1000
    some = rng.sample(sorted(values), 15)
    got = {r.value: (r.entry, r.score) for r in found.filter(F.col("value").isin(some)).collect()}
    assert got == expected(some, entries, 0.3)


def test_long_values_and_ties(spark):
    rng = random.Random(8)
    entries = phrases(rng, 12, 60) + ["AB", "BA", "AC"]
    values = [dirty(rng, e) for e in entries] + [" ".join(phrases(rng, 40)), "A", "B", "CAB"]
    assert any(len(v) >= 200 for v in values)
    assert result(match_values(*frames(spark, values, entries))) == expected(values, entries, 0.3)


@pytest.mark.parametrize("scorer", ["ratio", "levenshtein"])
def test_many_blocks_give_the_same_result(spark, monkeypatch, scorer):
    rng = random.Random(9)
    entries = phrases(rng, 60)
    values = [dirty(rng, rng.choice(entries)) for _ in range(90)] + ["DESCONHECIDO"]
    want = result(match_values(*frames(spark, values, entries), scorer=scorer))
    monkeypatch.setattr(matching, "MAX_ENTRIES", 15)
    assert result(match_values(*frames(spark, values, entries), scorer=scorer)) == want
    if scorer == "ratio":
        assert want == expected(values, entries, 0.3)


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("cutoff", [0.3, 0.7])
def test_levenshtein_equals_brute_force(spark, monkeypatch, cutoff):
    monkeypatch.setattr(matching, "MAX_CHARACTERS", 300)
    rng = random.Random(10)
    entries = sorted(set(phrases(rng, 40)))
    values = sorted({dirty(rng, rng.choice(entries)) for _ in range(60)})
    best = {
        v: max((1 - edit_distance(v, e) / max(len(v), len(e)), e) for e in entries) for v in values
    }
    want = {v: e for v, (s, e) in best.items() if s >= cutoff}
    got = result(match_values(*frames(spark, values, entries), cutoff=cutoff, scorer="levenshtein"))
    assert {v: e for v, (e, _) in got.items()} == want


def test_join_keeps_unmatched_null_and_protected(spark):
    rows = spark.createDataFrame(
        [(1, "QUEDA DE ESCAD"), (2, "@@@"), (3, None), (4, "DESCONHECIDO"), (5, "Tubo"), (6, "TUBO")],
        "k int, t string",
    )
    words = spark.createDataFrame([("Queda de escada",), ("Acido",), ("tubo",), (None,)], "d string")
    out = fuzzy_join(rows, "t", words, "d", protected=["DESCONHECIDO"], score_column="s")
    got = {r.k: (r.t, r.s) for r in out.collect()}
    assert out.columns == ["k", "t", "s"]
    assert got[1][0] == "QUEDA DE ESCADA" and 0.9 < got[1][1] < 1
    assert got[2] == ("@@@", None) and got[3] == (None, None)
    assert got[4] == ("DESCONHECIDO", None) and got[6] == ("TUBO", 1.0)
    unprotected = fuzzy_join(rows, "t", words, "d").filter(F.col("k") == 4).first()
    assert unprotected.t == "ACIDO"


def test_empty_dictionary_changes_nothing(spark):
    rows = spark.createDataFrame([("A",), ("B",)], "t string")
    none = spark.createDataFrame([], "d string")
    assert sorted(r.t for r in fuzzy_join(rows, "t", none, "d").collect()) == ["A", "B"]


def test_plan_has_no_cross_join(spark):
    values, entries = frames(spark, ["AB", "AC"], ["ABC"])
    plan = match_values(values, entries)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "MapInArrow" in plan and "Join" not in plan


def test_join_beside_a_large_mapping(spark):
    rng = random.Random(11)
    entries = sorted(set(phrases(rng, 30)))
    texts = ["DESCONHECIDO"] * 200 + [dirty(rng, rng.choice(entries)) for _ in range(200)] + [None] * 50
    rows = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    words = spark.createDataFrame([(e,) for e in entries], "d string")
    plain = fuzzy_join(rows, "t", words, "d", protected=["DESCONHECIDO"], score_column="s")
    want = sorted((tuple(r) for r in plain.collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        spread = fuzzy_join(rows, "t", words, "d", protected=["DESCONHECIDO"], score_column="s")
        assert sorted((tuple(r) for r in spread.collect())) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
