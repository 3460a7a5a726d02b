"""A faulty source is set aside as a whole; the others load."""

from __future__ import annotations

from typing import NamedTuple
from urllib.parse import quote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.operators.attach import attach
from tallyward.session import materialise
from tallyward.sources.delimited import FAULT, SOURCE


class Load(NamedTuple):
    rows: DataFrame  # rows of sources without any fault
    rejected: DataFrame  # all rows of the other sources
    stats: DataFrame  # per source: rows read, faulty rows, rows loaded, one reason


def load_stats(rows: DataFrame, source: str = SOURCE, fault: str = FAULT) -> DataFrame:
    """Counts per source. Map-side partial sums, so one huge source is no hot spot."""
    n_bad = F.count(F.col(fault))
    return rows.groupBy(source).agg(
        F.count(F.lit(1)).alias("n_read"),
        n_bad.alias("n_faulty"),
        F.when(n_bad == 0, F.count(F.lit(1))).otherwise(F.lit(0)).alias("n_loaded"),
        F.min(fault).alias("reason"),
    )


def with_all_files(stats: DataFrame, files: list[str], source: str = SOURCE) -> DataFrame:
    """``stats`` plus a line of zeros for each of the files that has no row."""
    spark = stats.sparkSession
    same = F.regexp_replace(F.url_decode("_file"), "^file:/+", "file:/") == F.regexp_replace(
        F.url_decode(source), "^file:/+", "file:/"
    )
    listed = spark.createDataFrame([(quote(f),) for f in files], "_file string")
    joined = listed.join(stats, same, "left")
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("n_read", "n_faulty", "n_loaded")]
    return joined.select(F.coalesce(source, "_file").alias(source), *counts, "reason")


def isolate(
    rows: DataFrame,
    source: str = SOURCE,
    fault: str = FAULT,
    files: list[str] | None = None,
    clean: bool = False,
) -> Load:
    """Split by source. ``rows`` should already be written, since it is read three times.

    The list of faulty sources is written too: one row per file, so the planner knows its
    size and broadcasts it when small. The rows then never shuffle on the source. If the write
    counted no faulty row (``clean``), rows are not marked at all.
    """
    stats = load_stats(rows, source, fault)
    stats = materialise(stats if files is None else with_all_files(stats, files, source), "load-stats")
    if clean:
        return Load(rows, rows.filter(F.lit(False)), stats)
    faulty = stats.filter("n_faulty > 0").select(source, F.lit(True).alias("_faulty"))
    marked = attach(rows, source, faulty, source, {"_faulty": "_faulty"})
    return Load(
        rows=marked.filter("_faulty is null").drop("_faulty"),
        rejected=marked.filter("_faulty").drop("_faulty"),
        stats=stats,
    )
