"""Keys that hold for a table and not only for one load: a Bloom filter, then an exact join.

The filter is a table itself: one row of 32,768 bits for each bucket. A key belongs to one bucket and
sets a few bits in it, so probing is one join on the bucket, filters of several loads merge by *or*,
and neither the filter nor the probe reads the rows that are already there. Only keys that the filter
lets through are looked for in the table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.operators.attach import attach
from tallyward.operators.quality import Split, pk_violations
from tallyward.session import materialise

BUCKET_BITS = 1 << 15  # what one row of Spark's bitmaps holds
KEYS_PER_BUCKET = 2048  # 16 bits for a key: about 1 in 400 unknown keys gets through
PROBES = 4


def buckets_for(keys: int) -> int:
    """How many buckets a filter of so many keys should have."""
    return max(1, -(-keys // KEYS_PER_BUCKET))


def _text(keys: list[str]) -> Column:
    """The key as one text; null if any part is missing."""
    missing = reduce(lambda a, b: a | b, [F.col(f"`{k}`").isNull() for k in keys])
    return F.when(~missing, F.to_json(F.struct(*[F.col(f"`{k}`") for k in keys])))


def _bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets))


def _bit(key: Column, probe: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(probe)), F.lit(BUCKET_BITS))


def key_filter(rows: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    """``(bucket, bits)`` of the keys in ``rows``; folded before the shuffle."""
    key = rows.select(_text(keys).alias("key")).filter("key is not null")
    bits = F.explode(F.array(*[_bit(F.col("key"), i) for i in range(PROBES)]))
    set_bits = key.select(_bucket(F.col("key"), buckets).alias("bucket"), bits.alias("bit"))
    return set_bits.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))


def merge_filters(*filters: DataFrame) -> DataFrame:
    """One filter of the keys of several, which have the same number of buckets."""
    return reduce(DataFrame.unionByName, filters).groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def maybe_known(rows: DataFrame, keys: list[str], known: DataFrame, buckets: int) -> DataFrame:
    """The distinct ``key`` texts of ``rows`` that the filter lets through."""

    def is_set(probe: int) -> Column:
        bit = _bit(F.col("key"), probe)
        byte = F.conv(F.hex(F.substring("bits", (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        return F.getbit(byte, (bit % 8).cast("int")) == 1

    own = rows.select(_text(keys).alias("key")).filter("key is not null").distinct()
    probed = own.withColumn("bucket", _bucket(F.col("key"), buckets)).join(known, "bucket")
    return probed.filter(reduce(lambda a, b: a & b, [is_set(i) for i in range(PROBES)])).select("key")


def split_on_known_keys(
    rows: DataFrame, keys: list[str], table: DataFrame, known: DataFrame | None = None, buckets: int | None = None
) -> Split:
    """Rows whose key is new to ``table`` and single among ``rows``; all others, with their ``reason``.

    ``known`` is the table's filter of ``buckets`` buckets, kept from load to load; without it one is
    made from the table's keys. The result does not depend on it, only what is read: the table's keys
    are compared with the few that the filter lets through. A key with a missing part is no key. Rows
    are read several times and should be written.
    """
    if known is None:
        buckets = buckets_for(table.count())
        known = key_filter(table, keys, buckets)
    suspects = materialise(maybe_known(rows, keys, known, buckets), "suspect-keys")
    # Suspects are a written table of known size: a small one is sent to the table's scan.
    held = table.select(_text(keys).alias("key")).join(suspects, "key", "left_semi").distinct()
    held = held.withColumn("reason", F.lit("the table has this key"))
    repeated = pk_violations(rows, keys).select(_text(keys).alias("key"), F.lit("repeated key").alias("reason"))
    bad = held.unionByName(repeated.filter("key is not null")).groupBy("key").agg(F.max("reason").alias("reason"))
    bad = materialise(bad, "bad-keys")
    marked = attach(rows.withColumn("_known_key", _text(keys)), "_known_key", bad, "key", {"_reason": "reason"})
    reason = F.when(F.col("_known_key").isNull(), "missing key").otherwise(F.col("_reason"))
    marked = marked.withColumn("reason", reason).drop("_known_key", "_reason")
    return Split(marked.filter("reason is null").drop("reason"), marked.filter("reason is not null"))
