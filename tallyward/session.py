"""Where intermediate tables go, and how a plan is cut there."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def work_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; on a local master without it, one in the warehouse."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work"


def work_folder(spark: SparkSession) -> str:
    """The folder of this application below the work root."""
    return f"{work_root(spark)}/tallyward/{spark.sparkContext.applicationId}"


_given_out: list[str] = []


def work_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the work root."""
    _given_out.append(f"{work_folder(spark)}/{label}-{uuid.uuid4().hex}")
    return _given_out[-1]


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def work_only_here(spark: SparkSession) -> Iterator[None]:
    """Delete, in the end, what the work folder gets inside the block."""
    before = len(_given_out)
    try:
        yield
    finally:
        for path in _given_out[before:]:
            _delete(spark, path)
        del _given_out[before:]


_SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_go(spark: SparkSession) -> Iterator[None]:
    """Delete the shuffle files of each job inside the block as it ends, not whenever the driver's memory
    is collected: else those of all steps so far lie on the disks beside each other."""
    before = spark.conf.get(_SHUFFLES_GO, "false")
    spark.conf.set(_SHUFFLES_GO, "true")
    try:
        yield
    finally:
        spark.conf.set(_SHUFFLES_GO, before)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back.

    Later plans start from files: nothing is recomputed when an executor is lost, and the
    planner sees the real size, so it broadcasts the result only when it is small.
    """
    spark = df.sparkSession
    path = work_path(spark, label)
    with shuffles_go(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the tables that ``materialise`` wrote and ``df`` reads; no later job may read them."""
    spark = df.sparkSession
    own = f"/{re.sub(r'^[a-z0-9]+:/*', '', work_folder(spark)).lstrip('/')}/"
    for folder in sorted({file.rsplit("/", 1)[0] for file in df.inputFiles()}):
        if own in folder:
            _delete(spark, folder)


def use_all_cores(scan: DataFrame) -> DataFrame:
    """Spread the rows of a table scan that has fewer input splits than there are cores.

    Only for work that is heavy per row. A large table has many splits and passes unchanged.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def clear_work(spark: SparkSession) -> None:
    """Delete what this application wrote, once no DataFrame needs it any more."""
    _delete(spark, work_folder(spark))
