"""Tables whose key holds over all their loads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyward.operators.known_keys import KEYS_PER_BUCKET, buckets_for, key_filter, merge_filters, split_on_known_keys
from tallyward.operators.quality import Split
from tallyward.session import materialise
from tallyward.sources.tables import read_table, write_table

KEYS = "chaves"  # suffix of the table that has the filter of a table's keys


def append_new_keys(df: DataFrame, name: str, keys: list[str], columns: T.StructType | None = None) -> Split:
    """Append the rows whose key is whole, single in ``df`` and not in the table; the others come back.

    The filter of the table's keys is kept beside it and grows with each load. It is written before
    the rows: if a load stops in between, it has keys too many, which costs a look into the table.
    Rows of one load that share a key are all set aside. All loads of the table must come this way.
    """
    spark = df.sparkSession
    rows = materialise(df, "delivered")
    exists = spark.catalog.tableExists(name)
    table = read_table(spark, name, keys) if exists else rows.select(*keys).limit(0)
    total = (table.count() if exists else 0) + rows.count()
    state = f"{name}_{KEYS}"
    known, buckets = None, buckets_for(2 * total)
    if exists and spark.catalog.tableExists(state):
        kept = spark.table(state)
        own = kept.select("buckets").first()
        if own and total <= own.buckets * KEYS_PER_BUCKET:
            known, buckets = kept.select("bucket", "bits"), own.buckets
    if known is None:  # the first load, or a table that has outgrown its filter
        known = key_filter(table, keys, buckets)
    known = materialise(known, "known-keys")
    split = split_on_known_keys(rows, keys, table, known, buckets)
    valid = materialise(split.valid, "new-rows")
    violations = materialise(split.violations, "known-rows")
    merged = materialise(merge_filters(known, key_filter(valid, keys, buckets)), "known-keys")
    write_table(merged.select(F.lit(buckets).alias("buckets"), "bucket", "bits"), state, mode="overwrite")
    write_table(valid, name, columns=columns)
    return Split(valid, violations)
