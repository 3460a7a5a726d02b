import uuid

import pytest
from pyspark.sql import functions as F

from tallyward.operators import known_keys
from tallyward.sources.keyed import KEYS, append_new_keys
from tallyward.streaming.repeats import drop_stream_repeats


def test_filter_has_no_false_negatives_and_few_false_positives(spark):
    keys = spark.range(0, 40_000, 2)
    buckets = known_keys.buckets_for(20_000)
    known = known_keys.merge_filters(
        known_keys.key_filter(keys.filter("id < 9000"), ["id"], buckets), known_keys.key_filter(keys.filter("id >= 9000"), ["id"], buckets)
    )
    assert known.count() <= buckets
    through = known_keys.maybe_known(spark.range(40_000), ["id"], known, buckets)
    ids = {int(r[0]) for r in through.select(F.get_json_object("key", "$.id")).collect()}
    assert set(range(0, 40_000, 2)) <= ids and len(ids) - 20_000 < 400


@pytest.mark.parametrize("buckets", [None, 1])
def test_split_does_not_depend_on_the_filter(spark, buckets):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (3, None), (4, "d"), (None, "e"), (5, "a")], "k int, t string")
    table = spark.createDataFrame([(4, "d"), (1, "x"), (5, "a"), (None, "e")], "k int, t string")
    known = known_keys.key_filter(table, ["k", "t"], buckets) if buckets else None
    valid, violations = known_keys.split_on_known_keys(rows, ["k", "t"], table, known, buckets)
    assert sorted(map(tuple, valid.collect())) == [(1, "a")] and valid.columns == ["k", "t"]
    assert sorted((r.k or 0, r.reason) for r in violations.collect()) == [
        (0, "missing key"), (2, "repeated key"), (2, "repeated key"), (3, "missing key"),
        (4, "the table has this key"), (5, "the table has this key"),
    ]


def test_key_holds_over_loads_while_the_filter_grows(spark, monkeypatch):
    monkeypatch.setattr("tallyward.sources.keyed.KEYS_PER_BUCKET", 4)
    monkeypatch.setattr(known_keys, "KEYS_PER_BUCKET", 4)
    name = f"default.t{uuid.uuid4().hex}"
    loads = [list(range(0, 6)), [5, 6, 7, 7], [], list(range(4, 60)), [7, 60]]
    rejected = [append_new_keys(spark.createDataFrame([(k,) for k in load], "k int"), name, ["k"]).violations for load in loads]
    assert [sorted(r.k for r in df.collect()) for df in rejected] == [[], [5, 7, 7], [], [4, 5, 6], [7]]
    assert sorted(r.k for r in spark.table(name).collect()) == list(range(61))
    assert spark.table(f"{name}_{KEYS}").first().buckets > 1
    for table in (name, f"{name}_{KEYS}"):
        spark.sql(f"DROP TABLE {table}")


def test_stream_remembers_keys_and_drops_late_rows(spark, tmp_path):
    schema = "k int, at timestamp"

    def run(*rows):
        df = spark.createDataFrame([(k, day) for k, day in rows], "k int, day string")
        df.select("k", F.to_timestamp("day").alias("at")).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        drop_stream_repeats(stream, ["k"], "at", "2 days", str(tmp_path / "out"), str(tmp_path / "progress"))
        return sorted(r.k for r in spark.read.parquet(str(tmp_path / "out")).collect())

    assert run((1, "2025-01-01"), (1, "2025-01-01"), (2, "2025-01-09"), (3, "2025-01-10"), (3, "2025-01-10")) == [1, 2, 3]
    # 3 is a repeat that the state remembers; 4 is behind the watermark of 8 January, new as it is.
    assert run((3, "2025-01-10"), (4, "2025-01-02"), (5, "2025-01-09")) == [1, 2, 3, 5]
    # By now 3 is forgotten: its time and two days are behind the watermark.
    assert run((6, "2025-03-01")) == [1, 2, 3, 5, 6]
    assert run((3, "2025-03-02")) == [1, 2, 3, 3, 5, 6]
