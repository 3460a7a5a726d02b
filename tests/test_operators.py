import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyward.operators.attach import attach, hot_values
from tallyward.operators.dimensions import dense_keys, lookup, with_unknown
from tallyward.operators import attach as attaching
from tallyward.operators import paging
from tallyward.operators.paging import page
from tallyward.operators.quality import (
    count_violations,
    fk_flag,
    fk_split,
    missing_references,
    pk_violations,
    split_on_pk,
    tag,
    too_long,
)
from tallyward.plans import marts
from tallyward.plans.adhoc import rows_as_dicts, run_sql


def values(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_primary_key(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k int, v string")
    assert values(pk_violations(df, ["k"])) == [(1, 2), (None, 1)]
    split = split_on_pk(df, ["k"])
    assert values(split.valid) == [(2, "c")]
    assert values(split.violations) == [(1, "a"), (1, "b"), (None, "d")]


def test_foreign_key(spark):
    rows = spark.createDataFrame([(1, "a"), (9, "b"), (None, "c"), (1, "a")], "k int, v string")
    dim = spark.createDataFrame([(1,), (2,)], "id int")
    split = fk_split(rows, "k", dim, "id")
    assert values(split.valid) == [(1, "a"), (1, "a"), (None, "c")]
    assert values(split.violations) == [(9, "b")]
    flagged = fk_flag(rows, "k", dim, "id", "orphan")
    assert values(flagged.filter("orphan").drop("orphan")) == values(split.violations)
    assert flagged.count() == rows.count()


@pytest.fixture
def large_sides(spark):
    """Nothing is broadcast by size."""
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name in names:
        spark.conf.unset(name)


def skewed(spark):
    hot = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 11 == 0, 100_000)
    key = F.when(F.col("id") % 5 != 0, hot.otherwise(F.col("id") % 700))
    return spark.range(0, 9000, 1, 6).select(key.cast("int").alias("k"), "id")


def test_attach_beside_a_large_side(spark, large_sides):
    rows = skewed(spark)
    side = spark.range(600).selectExpr("cast(id as int) as key", "if(id % 2 = 0, null, 'n' || id) as name")
    got = attach(rows, "k", side, "key", {"label": "name", "found": "key"})
    assert got.columns == ["k", "id", "label", "found"]
    want = rows.join(side, rows.k == side.key, "left").select("k", "id", "name", "key")
    assert values(got) == values(want) and got.count() == 9000


def test_hot_rows_are_spread(spark, large_sides):
    rows = skewed(spark)
    assert {r.value for r in hot_values(rows, ["k", "id"]).collect()} == {"7"}
    side = spark.range(600).selectExpr("cast(id as int) as key")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = attach(rows, "k", side, "key", {"found": "key"})
        sizes = got.groupBy(F.spark_partition_id()).count()
        assert sizes.agg(F.max("count")).first()[0] < 9000 / 4 * 1.3
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_checks_beside_large_sides(spark, large_sides):
    rows, dim = skewed(spark), spark.range(600).selectExpr("cast(id as int) as key")
    split = fk_split(rows, "k", dim, "key")
    assert split.valid.count() + split.violations.count() == 9000
    assert split.violations.filter("k is null or k < 600").isEmpty()
    assert split.valid.filter("k >= 600").isEmpty()
    keyed = split_on_pk(rows, ["k"])
    assert keyed.valid.isEmpty() and keyed.violations.count() == 9000
    assert split_on_pk(rows, ["id", "k"]).violations.filter("k is not null").isEmpty()


def test_length_and_report(spark):
    df = spark.createDataFrame([("abcde",), ("abcd",), ("DESCONHECIDO",), (None,)], "c string")
    rules = {"long": too_long(F.col("c"), 4), "null": F.col("c").isNull()}
    assert values(count_violations(df, rules)) == [("long", 1), ("null", 1)]
    tagged = {r.c: r.violations for r in tag(df, rules).collect()}
    assert tagged == {"abcde": ["long"], "abcd": [], "DESCONHECIDO": [], None: ["null"]}


def test_unknown_member(spark):
    dim = spark.createDataFrame([(5, "x")], "k int, v string")
    assert values(with_unknown(dim, "k", "v")) == [(0, "DESCONHECIDO"), (5, "x")]
    assert with_unknown(dim, "k", "v").schema == dim.schema
    assert with_unknown(dim.limit(0), "k", "v").isEmpty()
    assert values(with_unknown(dim.limit(0), "k", "v", source=dim)) == [(0, "DESCONHECIDO")]


@pytest.mark.parametrize("partitions", [1, 7])
def test_dense_keys(spark, partitions):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).cast("int").alias("code"))
    keyed = dense_keys(df.repartition(partitions), ["code"])
    assert values(keyed) == sorted([(i + 1, i) for i in range(1000)], key=repr)
    assert dense_keys(df.limit(0), ["code"]).isEmpty()


def test_lookup_keeps_every_row(spark):
    rows = spark.createDataFrame([(1,), (1,), (3,), (None,)], "k int")
    dim = spark.createDataFrame([(1, "one"), (2, None)], "id int, name string")
    out = lookup(rows, "k", dim, "id", {"label": "name"})
    assert values(out) == [(1, "one"), (1, "one"), (3, "DESCONHECIDO"), (None, "DESCONHECIDO")]


def test_deep_page(spark):
    rows = spark.range(500).select((F.col("id") * 7 % 500).alias("k"), "id").repartition(6)
    deep = page(rows, ["k"], 5, 300)
    assert deep.columns == ["k", "id"] and [r.k for r in deep.collect()] == [300, 301, 302, 303, 304]
    assert page(rows, ["k"], 5, 600).isEmpty()


def test_page(spark):
    assert [r.id for r in page(spark.range(50).repartition(5), ["id"], 4, 10).collect()] == [10, 11, 12, 13]
    assert page(spark.range(5), ["id"], 4, 10).isEmpty()


def test_parameters_in_every_spelling(spark):
    for query, params in [
        ("select %s + 1 as a, %s as b, 7 %% 4 as c", (1, "x' or 1=1")),
        ("select %(n)s + 1 as a, %(t)s as b, 7 %% 4 as c", {"n": 1, "t": "x' or 1=1"}),
        ("select :n + 1 as a, :t as b, 3 as c", {"n": 1, "t": "x' or 1=1"}),
        ("select ? + 1 as a, ? as b, 3 as c", [1, "x' or 1=1"]),
    ]:
        assert list(rows_as_dicts(run_sql(spark, query, params))) == [{"a": 2, "b": "x' or 1=1", "c": 3}]
    assert run_sql(spark, "select 'a%s' as t").first().t == "a%s"
    day, codes = dt.date(2025, 1, 2), (1, 3, 5)
    for query, params in [
        ("select count(*) as n from range(10) where id in %s and %s > date'2025-01-01'", (codes, day)),
        ("select count(*) as n from range(10) where id in %(c)s and %(d)s is not null", {"c": codes, "d": day}),
    ]:
        assert run_sql(spark, query, params).first().n == 3
    assert run_sql(spark, "select %s is null as n", [None]).first().n is True
    with pytest.raises(ValueError, match="more parameter marks"):
        run_sql(spark, "select %s, %s", [1])


def test_age(spark):
    cases = [
        ("2000-06-15", "2020-06-14", 19), ("2000-06-15", "2020-06-15", 20), ("2030-01-01", "2020-01-01", None),
        (None, "2020-01-01", None), ("2000-02-29", "2001-03-01", 1), ("1999-12-31", "2000-01-01", 0),
    ]
    df = spark.createDataFrame([c[:2] for c in cases], "b string, d string")
    age = marts.age_in_years(F.col("b").cast("date"), F.col("d").cast("date"))
    assert [r.a for r in df.select(age.alias("a")).collect()] == [c[2] for c in cases]
    bands = df.select(marts.age_band(age, [18, 20], "?").alias("a")).collect()
    assert [r.a for r in bands] == ["18-19", "20+", "?", "?", "0-17", "0-17"]


def test_reports(spark):
    df = spark.createDataFrame(
        [("SP", "a", "SIM", dt.date(2025, 1, 5)), ("SP", "b", None, dt.date(2025, 1, 9)),
         ("SP", "b", "NAO", dt.date(2025, 2, 1)), ("RJ", "a", "SIM", None)],
        "uf string, agent string, died string, day date",
    )
    monthly = values(marts.monthly(df, F.col("day"), [F.col("uf")]))
    assert monthly == sorted(
        [(dt.date(2025, 1, 1), "SP", 2), (dt.date(2025, 2, 1), "SP", 1), (None, "RJ", 1)], key=repr
    )
    assert values(marts.rate(df, F.col("uf"), F.col("died"), ["SIM"])) == [("RJ", 1, 1, 1.0), ("SP", 3, 1, 1 / 3)]
    assert values(marts.top_k(df, "uf", "agent", 1)) == [("RJ", "a", 1, 1), ("SP", "b", 2, 1)]
    dim = spark.createDataFrame([("SP", "São Paulo"), ("MG", "Minas")], "uf string, name string")
    assert values(marts.by_dimension(df, "uf", dim, "uf", "name", "?")) == [("?", 1), ("São Paulo", 3)]


@pytest.mark.parametrize("at_once", [100_000, 40])
def test_pages_at_any_depth(spark, monkeypatch, at_once):
    monkeypatch.setattr(paging, "SKIPPED_AT_MOST", at_once)
    rows = [(None if i % 50 == 0 else i * 7 % 31, f"{i:04}", "wide") for i in range(900)]
    df = spark.createDataFrame(rows, "a int, `b.c` string, w string").repartition(6)
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    for limit, offset in ((10, 0), (25, 437), (30, 880), (5, 2000), (900, 0)):
        got = [tuple(r) for r in page(df, ["a", "b.c"], limit, offset).collect()]
        assert got == ordered[offset : offset + limit]


def test_a_page_writes_nothing_and_reads_keys_first(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(paging, "SKIPPED_AT_MOST", 100)
    spark.range(5000).selectExpr("(id * 37) % 5000 as k", "repeat('x', 50) as w").write.parquet(str(tmp_path / "t"))
    result = page(spark.read.parquet(str(tmp_path / "t")), ["k"], 20, 3000)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(k" in plan and "Exchange" not in plan.split("TakeOrdered")[0]
    assert [r.k for r in result.collect()] == list(range(3000, 3020))


def test_hot_values_equal_counts_and_single_values_are_not_grouped(spark, monkeypatch):
    rows = spark.range(1000).select(
        F.col("id").alias("single"),
        F.when(F.col("id") % 2 == 0, F.lit(7)).when(F.col("id") % 5 > 0, F.col("id")).alias("skewed"),
    )
    written = []
    monkeypatch.setattr(attaching, "materialise", lambda df, label: written.append(label) or df)
    assert attaching.hot_values(rows, ["single"]).collect() == [] and written == []
    hot = attaching.hot_values(rows, ["single", "skewed"]).collect()
    assert [tuple(r) for r in hot] == [("skewed", "7", 33)] and written == ["hot-values"]


def test_missing_references(spark):
    rows = spark.createDataFrame([(1,), (1,), (2,), (2,), (3,), (None,)], "place int")
    dim = spark.createDataFrame([(1,), (1,), (None,)], "code int")
    found = missing_references(rows, "place", dim, "code").collect()
    assert sorted(r[0] for r in found) == [2, 3]
