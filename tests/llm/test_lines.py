import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from tallyward.llm import lines


LENGTHS = (20, 40, 60)  # one edit for twenty characters, so that short texts have several


def allowed(size, lengths):
    return sum(size >= least for least in lengths)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


PAIRS = st.tuples(st.text(alphabet="abé", max_size=14), st.text(alphabet="abé", max_size=14))


@settings(max_examples=5, deadline=None)
@given(st.lists(PAIRS, min_size=60, max_size=60))
def test_banded_distance(spark, pairs):
    pairs = [tuple(sorted(p, key=len)) for p in pairs]
    pairs += [(a, a[:3] + "x" + a[3:]) for a, _ in pairs]
    df = spark.createDataFrame(list(enumerate(pairs)), "i int, p struct<a:string,b:string>")
    for limit in (1, 2, 3):
        got = df.select("i", lines.edits_within(F.col("p.a"), F.col("p.b"), limit).alias("near")).collect()
        assert {r.i: r.near for r in got} == {i: distance(a, b) <= limit for i, (a, b) in enumerate(pairs)}


def test_close_lines_share_a_key(spark):
    pick, rows = random.Random(6), []
    for n in range(300):
        size, edits = pick.choice([40, 41, 59, 60, 61, 83]), pick.choice([1, 2, 3])
        one = [pick.choice("abcdefgh") for _ in range(size)]
        two = list(one)
        for _ in range(min(edits, allowed(size, LENGTHS))):
            at, kind = pick.randrange(len(two)), pick.randrange(3)
            two[at : at + (kind != 1)] = ["x"] if kind < 2 else []
        if allowed(min(len(one), len(two)), LENGTHS) >= min(edits, allowed(size, LENGTHS)):
            rows.append((n, "".join(one), "".join(two)))
    df = spark.createDataFrame(rows, "n int, a string, b string")
    assert shared_keys(df, lines.segment_keys(LENGTHS)) == shared_keys(df, lines.part_keys(LENGTHS)) == len(rows) > 200


def shared_keys(df, keys):
    """How many rows have texts ``a`` and ``b`` with a common key."""
    a, b = (df.select("n", *lines.measured(F.col(c))).select("n", keys.alias(c)) for c in "ab")
    return a.join(b, "n").filter(F.arrays_overlap("a", "b")).count()


def test_lines_one_edit_apart_share_a_part_key(spark):
    pick, rows = random.Random(7), []
    for n in range(300):
        one = [pick.choice("ab") for _ in range(pick.randrange(20, 45))]
        two = list(one)
        at, kind = pick.randrange(len(two)), pick.randrange(3)
        two[at : at + (kind != 1)] = ["x"] if kind < 2 else []
        if len(two) >= 20:  # shorter ones may have no edit
            rows.append((n, "".join(one), "".join(two)))
    df = spark.createDataFrame(rows, "n int, a string, b string")
    assert shared_keys(df, lines.part_keys((20,))) == len(rows) > 280


def test_many_lines_that_share_half(spark):
    half = "".join(random.Random(3).choice("abcdef") for _ in range(40))
    rows = [(n, half + hashlib.sha256(bytes([n])).hexdigest()[:40]) for n in range(120)]
    rows += [(200 + n, rows[n][1][:70] + "?" + rows[n][1][71:]) for n in range(0, 120, 10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, r.text, r.n_lines, [tuple(x) for x in r.removed or []]) for r in lines.dedup_lines(docs).collect()]
    assert sorted(got, key=repr) == brute(rows, lines.LENGTHS) and sum(len(g[3]) for g in got) == 12


def counts(line, lengths):
    return len(line) >= lengths[0] or bool(line.strip(" \t\n\v\f\r"))


def brute(rows, lengths):
    found = {}
    for doc, text in rows:
        for i, line in enumerate([] if text is None else text.split("\n")):
            if counts(line, lengths):
                found.setdefault(line, []).append((doc is None, doc if doc is not None else 0, i))
    label = {x: x for x in found}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    texts = list(found)
    for i, a in enumerate(texts):
        for b in texts[:i]:
            edits = allowed(min(len(a), len(b)), lengths)
            if abs(len(a) - len(b)) <= edits and distance(a, b) <= edits:
                label[find(a)] = find(b)
    first = {}
    for line, places in found.items():
        first[find(line)] = min([first.get(find(line), (True, 10**9, 0)), *places])
    result = []
    for doc, text in rows:
        all_lines = [] if text is None else text.split("\n")
        gone = []
        for i, line in enumerate(all_lines):
            place = (doc is None, doc if doc is not None else 0, i)
            if counts(line, lengths) and first[find(line)] != place:
                head = first[find(line)]
                gone.append((i, None if head[0] else head[1], head[2]))
        left = {g[0] for g in gone}
        kept = None if text is None else "\n".join(x for i, x in enumerate(all_lines) if i not in left)
        result.append((doc, kept, len(all_lines), gone))
    return sorted(result, key=repr)


@pytest.fixture(scope="module")
def rows():
    pick = random.Random(8)
    base = ["".join(pick.choice("abcdefg ") for _ in range(pick.choice([10, 20, 25, 44, 70]))) for _ in range(14)]
    rows = []
    for n in range(50):
        some = []
        for _ in range(pick.randrange(5)):
            line = list(pick.choice(base))
            for _ in range(pick.choice([0, 0, 1, 2, 3])):
                line[pick.randrange(len(line))] = pick.choice("xyz")
            some.append("".join(line))
        rows.append((n, "\n".join(some)))
    return rows + [(90, None), (91, ""), (92, "\n\n"), (None, base[3] + "\n" + "q" * 30), (93, "q" * 30), rows[3], rows[4]]


@pytest.mark.parametrize("lengths", [(20,), (20, 40), LENGTHS])
def test_lines_equal_brute_force(spark, rows, lengths):
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, removed int")
    got = [
        (r.doc_id, r.text, r.n_lines, [tuple(x) for x in r.removed or []])
        for r in lines.dedup_lines(docs.repartition(3), lengths=lengths).collect()
    ]
    assert all(r.n_removed == len(r.removed or []) for r in lines.dedup_lines(docs).collect())
    assert sorted(got, key=repr) == brute(rows, lengths)


def test_very_long_lines_and_empty_tables(spark):
    long = "".join(hashlib.sha256(bytes([i % 251, i // 251])).hexdigest() for i in range(600))
    docs = spark.createDataFrame([(1, long), (2, long[:500] + long[501:]), (3, long + "wxyz"), (4, "pq" + long + "r")], "doc_id long, text string")
    assert {r.doc_id: r.n_removed for r in lines.dedup_lines(docs).collect()} == {1: 0, 2: 1, 3: 0, 4: 1}
    assert lines.dedup_lines(docs.limit(0)).count() == 0


def test_short_lines_must_be_equal(spark):
    texts = ["all rights reserved\nfirst\n\n \t", "ALL rights reserved\n全部の権利\n\n", None, "全部の権利\nall rights reserved\n \t\nfirs"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.text for r in corpus_pipeline.remove_lines(spark, docs, "").collect()}
    assert got == {0: texts[0], 1: texts[1], 2: None, 3: " \t\nfirs"}


def test_a_column_of_a_helpers_name_stays(spark):
    line = "one line of text that is long enough"
    docs = spark.createDataFrame([(1, line, "a"), (2, f"{line}\nrest", "b"), (3, None, "c")], "doc_id long, text string, _row string")
    got = sorted((r.doc_id, r.text, r["_row"], r.n_removed) for r in lines.dedup_lines(docs).collect())
    assert got == [(1, line, "a", 0), (2, "rest", "b", 1), (3, None, "c", 0)]


def test_a_line_has_few_keys(spark):
    """With up to three edits: twelve keys at most, where exact lengths took 24 for 240 characters."""
    df = spark.createDataFrame([(n, "x" * n) for n in range(20, 300)], "n int, line string")
    sized = df.select(*lines.measured(F.col("line"))).select("size", F.size(lines.segment_keys(lines.LENGTHS)).alias("k"))
    found = {r["size"]: r.k for r in sized.collect()}
    assert max(found.values()) <= 12 and found[30] == 2 and found[70] == 4 and found[250] == 6


def test_only_lines_with_close_counts_meet(spark):
    """Copies of a line with another word each share segments and parts, but are not compared in pairs."""
    base = "".join(random.Random(5).choice("etaoins rhldu") for _ in range(300))
    rows = [(n, base[: 3 * n] + chr(97 + n % 5) * 9 + base[3 * n + 9 :]) for n in range(40, 70)]
    docs = spark.createDataFrame(rows, "n int, line string")
    keys = docs.select("n", *lines.measured(F.col("line"))).select("n", F.explode(lines._narrow_keys(lines.LENGTHS)).alias("k"))
    a, b = (keys.select(F.col("n").alias(c), "k.key", F.col("k.about").alias(f"about_{c}")) for c in "xy")
    met = a.join(b, "key").filter("x < y")
    close = met.filter(lines._near_counts(F.col("about_x"), F.col("about_y"))).select("x", "y").distinct().count()
    assert close < met.select("x", "y").distinct().count() / 2
