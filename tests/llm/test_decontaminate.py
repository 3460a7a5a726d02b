import pytest
from pyspark.sql import functions as F

from tallyward.llm import decontaminate as dc


def passage(start, n):
    return " ".join(f"w{i}" for i in range(start, start + n))


BENCH = [(10, passage(0, 20)), (2, "Short item here"), (7, None), (8, "!!"), (None, passage(500, 20)), (10, passage(0, 20)), (3, passage(0, 13))]
DOCS = [
    (1, "x, " + passage(0, 13).upper() + "! tail", "a"),
    (2, passage(0, 12) + " but no more", "a"),
    (3, "a SHORT item; here " + " ".join(["z"] * 100), "a"),
    (4, None, "a"), (5, "", "a"), (6, "... !!", None), (None, passage(2, 14), "a"),
    (1, "x, " + passage(0, 13).upper() + "! tail", "a"), (9, passage(500, 20), "a"),
]


@pytest.fixture
def tables(spark):
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    return spark.createDataFrame(DOCS, "doc_id long, text string, n_words string"), bench


def found(marked):
    return sorted(
        ((r.doc_id, r.n_words, r.n_hit, tuple(r.hit_items), r.contaminated) for r in marked.collect()), key=repr
    )


WANT = sorted(
    [(1, 15, 13, ("10", "3"), True)] * 2
    + [(2, 15, 0, (), False), (3, 104, 3, ("2",), False), (4, 0, 0, (), False), (5, 0, 0, (), False)]
    + [(6, 0, 0, (), False), (None, 14, 14, ("10",), True), (9, 20, 0, (), False)],
    key=repr,
)


def test_hits_of_every_window(tables):
    assert found(dc.find_contamination(*tables)) == WANT


def test_a_benchmark_in_blocks(tables):
    assert found(dc.find_contamination(*tables, max_windows=3)) == WANT


def test_removal(tables):
    marked = dc.find_contamination(*tables)
    assert sorted(r.doc_id for r in dc.remove_documents(marked).collect()) == [2, 3, 4, 5, 6, 9]
    clean = {r.doc_id: r.clean_text for r in dc.remove_spans(marked).collect()}
    assert clean[1] == "x, ! tail" and clean[3].startswith("a  z z") and clean[4] is None and clean[None] == ""


def test_nothing_to_find(spark, tables):
    docs, bench = tables
    assert {r.n_hit for r in dc.find_contamination(docs, bench.limit(0)).collect()} == {0}
    assert dc.find_contamination(docs.limit(0), bench).count() == 0


def test_other_columns_stay(tables):
    docs, bench = tables
    odd = docs.withColumns({n: F.lit("own") for n in ("_runs", "_items", "_Runs_", "windows", "hit_items")})
    for size in (dc.MAX_WINDOWS, 3):
        marked = dc.find_contamination(odd, bench, max_windows=size)
        assert found(marked) == WANT
        assert {(r["_runs"], r["_items"], r["_Runs_"], r["windows"]) for r in marked.collect()} == {("own",) * 4}
