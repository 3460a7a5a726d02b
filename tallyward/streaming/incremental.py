"""Incremental loads with Structured Streaming: every new file once."""

from __future__ import annotations

from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tallyward import fixed_values as fx
from tallyward.plans import core, staging
from tallyward.session import discard, work_only_here
from tallyward.sources.tables import TABLES, conform, with_defaults

# Layout of the built-in file listing source; the content column is never read here.
_LISTING = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)


def clean_stream(
    rows: DataFrame, clean: Callable[[DataFrame], DataFrame], target: str, checkpoint: str
) -> None:
    """Append ``clean(rows)`` of everything that is new; ``clean`` must be stateless."""
    (
        clean(rows)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def load_new_files(
    spark: SparkSession,
    folder: str,
    checkpoint: str,
    load: Callable[[list[str], int], None],
    files_per_batch: int = 1000,
    names: str = "*.csv",
) -> None:
    """Call ``load(paths, batch)`` for the files that arrived since the last run.

    ``names`` are those of the files; Spark's readers unpack ``*.csv.gz``, a file in one task.

    The stream carries file names only; ``load`` scans the files as a batch job, so headers
    go by name and faulty files are set aside just as in a full load. Spark's checkpoint
    remembers the files. A batch may be repeated after a failure, with the same number.
    """

    def one_batch(listing: DataFrame, batch: int) -> None:
        paths = [unquote(row.path) for row in listing.toLocalIterator()]
        if paths:
            load(sorted(paths), batch)

    (
        spark.readStream.format("binaryFile")
        .schema(_LISTING)
        .option("pathGlobFilter", names)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(folder)
        .select("path")
        .writeStream.foreachBatch(one_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def incremental_incidents(
    spark: SparkSession,
    folder: str,
    target: str,
    checkpoint: str,
    municipality_dim: DataFrame,
    agent_dim: DataFrame,
    nature_dim: DataFrame,
    files_per_batch: int = 1000,
    names: str = "*.csv",
) -> None:
    """New incident files through stage and core into ``target``.

    Each batch overwrites its own sub-folder, so a repeated batch leaves no copies:
    ``fact/batch=N``, ``violations/batch=N``, ``rejected/batch=N`` and ``stats/batch=N``. Each written
    step is deleted when the next one stands, so that at most two of them are there at a time.
    """
    columns = TABLES[f"{fx.CORE}.acidente_trabalho"]

    def load(paths: list[str], batch: int) -> None:
        def put(name: str, df: DataFrame) -> None:
            df.write.mode("overwrite").parquet(f"{target}/{name}/batch={batch}")

        with work_only_here(spark):
            staged = staging.incidents(spark, paths)
            put("rejected", staged.rejected)
            put("stats", staged.stats)
            tagged = core.incidents(
                staging.table_rows(staged), municipality_dim, agent_dim, nature_dim
            )
            discard(staged.rows)  # the cleaned rows are written
            checked = core.split_tagged(tagged)
            discard(tagged)
            put("violations", checked.violations)
            # Ids of a batch follow its number, so a repeated batch has the same ones.
            fact = conform(with_defaults(checked.valid, columns, batch << 40), columns)
            discard(checked.valid)  # they are written with their places
            put("fact", fact)

    load_new_files(spark, folder, checkpoint, load, files_per_batch, names)
