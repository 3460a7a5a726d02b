"""Reports kept up to date load by load, without reading the facts of earlier loads.

Every load leaves its own partial counts, a row for each group that it has. Counts add up, so a
report is the sum over the loads. A load that is repeated replaces its counts.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyward.sources.tables import replace_partitions

_LOAD = "_load"


def partial_counts(rows: DataFrame, by: Mapping[str, Column], flags: Mapping[str, Column] | None = None) -> DataFrame:
    """Rows per group as ``n``, and of these how many have each flag, as ``n_...``; a null flag is none."""
    hits = [F.count_if(F.coalesce(flag, F.lit(False))).alias(f"n_{name}") for name, flag in (flags or {}).items()]
    return rows.groupBy(*[c.alias(name) for name, c in by.items()]).agg(F.count(F.lit(1)).alias("n"), *hits)


def record(counts: DataFrame, path: str, load: int) -> None:
    """Keep the partial counts of one load; a repeated load replaces its own and no others."""
    spark = counts.sparkSession
    # A repeat without rows names no partition, so what the load left before goes first.
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{_LOAD}={load}")
    if counts.isEmpty():
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    replace_partitions(counts.withColumn(_LOAD, F.lit(load).cast("long")), path, [_LOAD])


def report(spark: SparkSession, path: str, columns: T.StructType) -> DataFrame:
    """The counts of all loads added up by all other columns; ``columns`` are those of the partial counts."""
    state = spark.read.schema(columns).parquet(path)
    counts = [c for c in columns.names if c == "n" or c.startswith("n_")]
    groups = [c for c in columns.names if c not in counts]
    return state.groupBy(*groups).agg(*[F.sum(c).alias(c) for c in counts])
