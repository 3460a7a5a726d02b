"""Repeats dropped from a stream, with a state that does not grow without end."""

from __future__ import annotations

from pyspark.sql import DataFrame


def drop_stream_repeats(
    rows: DataFrame, keys: list[str], time: str, delay: str, target: str, checkpoint: str
) -> None:
    """Append to ``target`` everything that is new, one row of each key.

    ``time`` is an event time. A key is remembered until the watermark, the latest event time less
    ``delay``, has left its own time and ``delay`` behind; the checkpoint keeps that memory from run to
    run. So a repeat is dropped if it comes within ``delay`` of the first row. Rows behind the
    watermark are too late and dropped as well, whether they are repeats or not. Rows with a null
    time are never late.
    """
    (
        rows.withWatermark(time, delay)
        .dropDuplicatesWithinWatermark(keys)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
