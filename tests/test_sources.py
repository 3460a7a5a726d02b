import gzip

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyward.operators.shape import rename, subset, typed
from tallyward.session import materialise
from tallyward.sources.delimited import FAULT, ORIGINAL, SOURCE, scan
from tallyward.plans import staging
from tallyward.sources import headers
from tallyward.sources.headers import layouts, list_files, split_header, unique_names
from tallyward.sources.isolation import isolate

TABLE = T.StructType(
    [T.StructField("a", T.IntegerType()), T.StructField("a.1", T.StringType()), T.StructField("b", T.StringType())]
)


def write(folder, **files):
    for name, text in files.items():
        (folder / f"{name}.csv").write_bytes(text.encode("latin-1"))
    return f"{folder}/*.csv"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_repeated_names():
    assert split_header("a;a;b;Data;Data;c", ";") == ("a", "a.1", "b", "Data", "Data.1", "c")
    assert unique_names(["a", "a", "a", "a.1"]) == ["a", "a.2", "a.3", "a.1"]
    assert unique_names(["", "x", ""]) == ["Unnamed: 0", "x", "Unnamed: 2"]
    assert split_header('"x;y";z', ";") == ("x;y", "z")


def test_quotes_encoding_and_missing(spark, tmp_path):
    text = 'código,texto\r\n1,"a, ""b"""\r\n2,NA\r\n3,"NA"\r\n4,none\r\n5, \r\n6,\r\n\r\n7,é"x\r\n'
    read = scan(spark, write(tmp_path, one=text), ",")
    assert read.columns == ["código", "texto"]
    assert rows(read) == [
        ("1", 'a, "b"'), ("2", None), ("3", None), ("4", "none"), ("5", " "), ("6", None), ("7", 'é"x'),
    ]


def test_newline_in_quotes(spark, tmp_path):
    path = write(tmp_path, one='a,b\n1,"x\ny"\n')
    assert rows(scan(spark, path, ",", multi_line=True)) == [("1", "x\ny")]


def test_files_join_by_name(spark, tmp_path):
    path = write(tmp_path, one="a;a;b\n1;x;y\n", two="b;a;a\nY;2;X\n", three="a\n3\n", empty="")
    read = scan(spark, path, ";", expected=TABLE, lineage=True)
    assert read.columns == ["a", "a.1", "b", SOURCE, FAULT, ORIGINAL]
    assert rows(read.drop(SOURCE, ORIGINAL)) == [("1", "x", "y", None), ("2", "X", "Y", None), ("3", None, None, None)]
    assert {r[SOURCE].rsplit("/", 1)[1] for r in read.collect()} == {"one.csv", "two.csv", "three.csv"}


def test_nothing_there(spark, tmp_path):
    read = scan(spark, f"{tmp_path}/absent.csv", ";", expected=TABLE, lineage=True)
    assert read.columns == ["a", "a.1", "b", SOURCE, FAULT, ORIGINAL] and read.isEmpty()
    assert scan(spark, f"{tmp_path}/no/*.csv", ";", expected=TABLE).isEmpty()


def test_one_job_for_all_headers(spark, tmp_path):
    """As many jobs for many files as for two, and a pattern goes on where all agree."""
    counts = []
    for n in (2, 9):
        folder = tmp_path / str(n)
        folder.mkdir()
        path = write(folder, **{f"f{i}": f"a;b\n{i};x\n" for i in range(n)}, empty="")
        spark.sparkContext.setJobGroup(f"headers-{n}", "")
        files = list_files(spark, path)
        assert len(files) == n + 1
        assert layouts(spark, path, files, ";", "ISO-8859-1") == [(("a", "b"), path, False)]
        counts.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"headers-{n}")))
    assert counts[0] == counts[1]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_lines_are_not_sorted_for_their_headers(spark, tmp_path, monkeypatch):
    """The scan of all lines is a hash aggregate; headers are right in files of several blocks, packed or not."""
    plans, write_out = [], headers.materialise

    def watched(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write_out(df, label)

    monkeypatch.setattr(headers, "materialise", watched)
    long = "".join(f"{i};x\n" for i in range(200))
    path = write(tmp_path, a="\na;b\n" + long, b="b;a\n" + long, c="a;b\n", d='a;b\n1;"open\n', empty="", **{"e f": "a;b\n1;2\n"})
    with gzip.open(tmp_path / "g.csv.gz", "wt") as out:
        out.write("b;a\n" + long)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        files = list_files(spark, f"{path}*")
        found = layouts(spark, f"{path}*", files, ";", "ISO-8859-1")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len(plans) == 1 and "Sort" not in plans[0]
    got = [(names, [p.rsplit("/", 1)[1] for p in paths], quotes) for names, paths, quotes in found]
    assert sorted(got) == [
        (("a", "b"), ["a.csv", "c.csv", "e f.csv"], False), (("a", "b"), ["d.csv"], True), (("b", "a"), ["b.csv", "g.csv.gz"], False),
    ]


def test_clean_loads_are_not_searched(spark, tmp_path):
    """Without a faulty row nothing is marked or joined; with one, its file is left out."""
    load = staging.load_files(spark, write(tmp_path, one="a;b\n1;x\n", two="a;b\n2;y\n"), ";", {}, TABLE)
    plan = load.rows._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and load.rejected.isEmpty() and load.stats.count() == 2
    load = staging.load_files(spark, write(tmp_path, two="a;b\nq;y\n"), ";", {}, TABLE)
    assert rows(staging.table_rows(load).select("a")) == [(1,)] and load.rejected.count() == 1


def test_named_files_must_exist(spark, tmp_path):
    write(tmp_path, **{"cat[2025] {a}": "a\n1\n", "cat2": "a\n2\n"})
    named = [f"{tmp_path}/cat[2025] {{a}}.csv", f"{tmp_path}/cat2.csv"]
    assert rows(scan(spark, named, ";")) == [("1",), ("2",)]
    assert rows(scan(spark, f"{tmp_path}/*.csv", ";")) == [("1",), ("2",)]
    with pytest.raises(FileNotFoundError):
        scan(spark, [*named, f"{tmp_path}/gone.csv"], ";")


def test_surplus_cells_are_never_cut_silently(spark, tmp_path):
    with pytest.raises(Exception, match="too many cells"):
        scan(spark, write(tmp_path, one="a;b\n1;x\n1;x;LOST\n"), ";").collect()


def test_open_quotes_are_a_fault(spark, tmp_path):
    text = 'a;b\n1;"x\ny"\n2;z"\n'
    with pytest.raises(ValueError, match="not closed"):
        scan(spark, write(tmp_path, one=text), ";")
    faults = {r[FAULT] for r in scan(spark, f"{tmp_path}/*.csv", ";", lineage=True).collect()}
    assert faults == {"a quote is not closed in its line"}
    assert rows(scan(spark, f"{tmp_path}/*.csv", ";", multi_line=True)) == [("1", "x\ny"), ("2", 'z"')]


def test_rejects_keep_their_text(spark, tmp_path):
    path = write(
        tmp_path, good="a;b\n1.0;x\n2.5;\n", bad="a;b\n12x;y\n7;z\n", wide="a;b\n1;x;LOST\n", extra="a;q\n1;KEPT\n",
        header="a;b\n", empty="",
    )
    load = staging.load_files(spark, path, ";", {}, TABLE)
    assert rows(staging.table_rows(load).select("a", "b")) == [(1, "x"), (2, None)]
    kept = {r[SOURCE].rsplit("/", 1)[1]: r[ORIGINAL] for r in load.rejected.filter(f"{ORIGINAL} is not null").collect()}
    assert "12x" in kept["bad.csv"] and kept["wide.csv"] == "1;x;LOST" and "KEPT" in kept["extra.csv"]
    stats = {r[SOURCE].rsplit("/", 1)[1]: (r.n_read, r.n_loaded) for r in load.stats.collect()}
    assert stats == {
        "good.csv": (2, 2), "bad.csv": (2, 0), "wide.csv": (1, 0), "extra.csv": (1, 0), "header.csv": (0, 0), "empty.csv": (0, 0),
    }


def test_blank_in_file_name(spark, tmp_path):
    path = write(tmp_path, **{"jan 2025 ã": "a\n1\n"})
    assert rows(scan(spark, path, ";")) == [("1",)]


def test_a_faulty_file_is_left_out_whole(spark, tmp_path):
    path = write(
        tmp_path,
        good="a;b\n1;x\n2;y\n",
        short="a;a;b\n3\n4;x\n",
        wide="a;b\n5;x\n6;y;z\n",
        trailing="a;b\n7;x;\n",
        bad_int="a;b\n8;x\n9,5;y\n",
        extra="a;q\n10;z\n",
        quoted='a;b\n11;"x;y"\n12;"x;y";z\n',
        dots="a;a;q.1;q.2\n13;z;1;2\n",
    )
    read = scan(spark, path, ";", expected=TABLE, lineage=True)
    load = isolate(materialise(typed(read, TABLE, FAULT), "test"))
    assert sorted(r.a for r in load.rows.collect()) == [1, 2, 3, 4]
    assert load.rows.schema["a"].dataType == T.IntegerType()
    stats = {r[SOURCE].rsplit("/", 1)[1][:-4]: r for r in load.stats.collect()}
    assert (stats["good"].n_read, stats["good"].n_faulty, stats["good"].n_loaded) == (2, 0, 2)
    assert (stats["wide"].n_read, stats["wide"].n_faulty, stats["wide"].n_loaded) == (2, 1, 0)
    reasons = {name: row.reason for name, row in stats.items()}
    assert reasons == {
        "good": None, "short": None, "wide": "too many cells", "trailing": "too many cells",
        "dots": "unexpected column q.1, q.2", "bad_int": "a is not an integer", "extra": "unexpected column q", "quoted": "too many cells",
    }
    assert load.rows.count() + load.rejected.count() == read.count()


def test_unexpected_column_without_lineage(spark, tmp_path):
    with pytest.raises(ValueError, match="unexpected"):
        scan(spark, write(tmp_path, one="a;q\n1;2\n"), ";", expected=TABLE)


def test_split_in_files_changes_nothing(spark, tmp_path):
    lines = [f"{i};t{i % 7}" for i in range(200)]
    (tmp_path / "whole").mkdir(), (tmp_path / "split").mkdir()
    whole = write(tmp_path / "whole", all="a;b\n" + "\n".join(lines))
    split = write(
        tmp_path / "split", **{f"p{k}": "a;b\n" + "\n".join(lines[k::3]) + "\n" for k in range(3)}
    )
    assert rows(scan(spark, whole, ";")) == rows(scan(spark, split, ";"))


def test_rename_and_subset(spark):
    df = spark.createDataFrame([(1, 2)], ["x.1", "y"])
    assert rename(df, {"x.1": "x", "absent": "z"}).columns == ["x", "y"]
    assert subset(df, ["y", "absent", "x.1"]).columns == ["y", "x.1"]
