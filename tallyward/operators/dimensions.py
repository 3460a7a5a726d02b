"""Dimension tables: unknown member, surrogate keys, label lookup."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyward.fixed_values import UNKNOWN, UNKNOWN_CODE
from tallyward.operators.attach import attach
from tallyward.session import materialise


def with_unknown(
    dim: DataFrame,
    code: str,
    label: str,
    source: DataFrame | None = None,
    unknown_code: int = UNKNOWN_CODE,
) -> DataFrame:
    """``dim`` plus the unknown member; nothing is added when the source has no rows.

    The extra row is made from one source row, so emptiness needs no separate job.
    """
    kinds = {f.name: f.dataType for f in dim.schema}
    member = (dim if source is None else source).limit(1).select(
        F.lit(unknown_code).cast(kinds[code]).alias(code),
        F.lit(UNKNOWN).cast(kinds[label]).alias(label),
    )
    return dim.unionByName(member, allowMissingColumns=True)


def dense_keys(
    df: DataFrame, order: list[str], name: str = "id", kind: str = "int"
) -> DataFrame:
    """Number rows 1..n in the order of a unique key, without one task seeing all rows.

    Rows are cut into sorted ranges of the key: one shuffle.
    """
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    return number_rows(ranged, name).withColumn(name, F.col(name).cast(kind))


def number_rows(df: DataFrame, name: str = "id", after: int = 0) -> DataFrame:
    """Rows numbered ``after + 1``, ``after + 2``... in the order of their partitions.

    They are written with the number of their partition and their place in it, which the sizes of
    the partitions before it then shift.
    """
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) + 1
    placed = materialise(
        df.select("*", F.spark_partition_id().alias("_range"), place.alias("_place")), "ranges"
    )
    sizes = placed.groupBy("_range").agg(F.max("_place").alias("_size"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(
        "_range", (F.coalesce(F.sum("_size").over(before), F.lit(0)) + after).alias("_shift")
    )
    # A row for each partition, whatever the size of the data.
    return placed.join(F.broadcast(shifts), "_range").select(
        (F.col("_place") + F.col("_shift")).alias(name), *df.columns
    )


def lookup(
    rows: DataFrame,
    column: str,
    dim: DataFrame,
    key: str,
    labels: Mapping[str, str],
    unknown: str = UNKNOWN,
) -> DataFrame:
    """Attach ``{new name: text column}`` of a dimension; without a member, the unknown word."""
    found = attach(rows, column, dim, key, labels)
    return found.withColumns({a: F.coalesce(F.col(a), F.lit(unknown)) for a in labels})
