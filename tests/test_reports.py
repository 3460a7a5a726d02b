import pathlib

from pyspark.sql import functions as F

from tallyward.plans import marts, report_state
from tallyward.sources.tables import replace_partitions


def test_cube_tells_totals_from_missing_values(spark):
    rows = spark.createDataFrame([("a", "x"), ("a", None), (None, "x"), ("a", "x")], "agent string, state string")
    got = {(r.agent, r.state, r.level): r.n for r in marts.cube(rows, ["agent", "state"]).collect()}
    assert got == {
        ("a", "x", 0): 2, ("a", None, 0): 1, (None, "x", 0): 1, ("a", None, 1): 3, (None, None, 1): 1,
        (None, "x", 2): 3, (None, None, 2): 1, (None, None, 3): 4,
    }
    none = marts.cube(rows.limit(0), ["agent", "state"]).collect()
    assert [r for r in none if r.n] == []


def test_report_adds_up_loads_and_replaces_repeats(spark, tmp_path):
    path = str(tmp_path / "state")

    def load(number, *rows):
        df = spark.createDataFrame(rows, "g string, dead boolean")
        counts = report_state.partial_counts(df, {"g": F.col("g")}, {"dead": F.col("dead")})
        report_state.record(counts, path, number)
        return {r.g: (r.n, r.n_dead) for r in report_state.report(spark, path, counts.schema).collect()}

    assert load(1, ("a", True), ("a", None), (None, False)) == {"a": (2, 1), None: (1, 0)}
    first = {p: p.stat().st_mtime_ns for p in pathlib.Path(path).rglob("_load=1/*.parquet")}
    assert load(2, ("a", True), ("b", True)) == {"a": (3, 2), None: (1, 0), "b": (1, 1)}
    assert load(2, ("b", False)) == {"a": (2, 1), None: (1, 0), "b": (1, 0)}
    assert load(2) == {"a": (2, 1), None: (1, 0)}
    assert {p: p.stat().st_mtime_ns for p in pathlib.Path(path).rglob("_load=1/*.parquet")} == first


def test_report_does_not_read_facts(spark, tmp_path):
    path = str(tmp_path / "state")
    counts = report_state.partial_counts(spark.range(10).withColumn("g", F.col("id") % 2), {"g": F.col("g")})
    report_state.record(counts, path, 1)
    files = report_state.report(spark, path, counts.schema).inputFiles()
    assert files and all("_load=1" in f for f in files)


def test_files_of_other_years_stay(spark, tmp_path):
    path = str(tmp_path / "years")
    replace_partitions(spark.createDataFrame([(1, 2020), (2, 2021), (3, 2022)], "k int, year int"), path, ["year"])
    before = {p.name: p.parent.name for p in pathlib.Path(path).rglob("*.parquet")}
    replace_partitions(spark.createDataFrame([(9, 2021), (8, 2023)], "k int, year int"), path, ["year"])
    after = {p.name: p.parent.name for p in pathlib.Path(path).rglob("*.parquet")}
    assert {n for n, y in before.items() if y != "year=2021"} <= set(after)
    assert not {n for n, y in before.items() if y == "year=2021"} & set(after)
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [(1, 2020), (3, 2022), (8, 2023), (9, 2021)]
