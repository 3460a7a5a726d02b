"""A page of rows in a visible order."""

from __future__ import annotations

from bisect import bisect_left

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

RANGES = 16  # each of which takes a comparison for every key
SAMPLE = 40 * RANGES  # keys, about, that the borders of the ranges are taken from
SKIPPED_AT_MOST = 100_000  # rows before the page that a task may hold besides the page


def _key(df: DataFrame, order: list[str], values: Row | None = None) -> Column:
    kinds = {f.name: f.dataType for f in df.schema}
    return F.struct(*[(F.col(f"`{c}`") if values is None else F.lit(values[c]).cast(kinds[c])).alias(f"k{i}") for i, c in enumerate(order)])


def _between(df: DataFrame, order: list[str], low: Row | None, high: Row | None) -> DataFrame:
    """Rows from ``low`` on and before ``high``. The first column's bounds also reach the scan."""
    first = order[0]
    if low is not None:
        if low[first] is not None:
            df = df.filter(F.col(f"`{first}`") >= F.lit(low[first]))
        df = df.filter(_key(df, order) >= _key(df, order, low))
    if high is not None:
        if low is not None and low[first] is not None:
            df = df.filter(F.col(f"`{first}`") <= F.lit(high[first]))
        df = df.filter(_key(df, order) < _key(df, order, high))
    return df


def page(df: DataFrame, order: list[str], limit: int, offset: int = 0) -> DataFrame:
    """Rows ``offset + 1 .. offset + limit`` in the order of a unique key, nulls first.

    A task holds the page and the rows before it, as far as these are few. Before a deep page whole
    ranges are left out first, for which only the key's columns are read: a sample gives the borders,
    the rows before each are counted, and the ranges that the page meets are cut again while too many
    rows come before it. Nothing is written. Equal keys have no border between them.
    """
    keys = df.select(*[F.col(f"`{c}`") for c in order])
    low = high = None
    total, skip = 0, offset
    while skip > SKIPPED_AT_MOST:
        total = total or keys.count()
        if skip >= total:  # behind the last row
            return df.limit(0)
        inside = _between(keys, order, low, high)
        # The seed is fixed, so the borders do not change from call to call.
        sample = inside.sample(min(1.0, SAMPLE / total), seed=7).collect()
        found = sorted(set(sample), key=lambda r: [(v is not None, v) for v in r])
        borders = found[:: max(1, len(found) // RANGES)][1:]
        if not borders:
            break
        key = _key(df, order)
        below = inside.agg(*[F.count_if(key < _key(df, order, b)).alias(f"n{i}") for i, b in enumerate(borders)]).first()
        ends = [*below, total]
        first = min(bisect_left(ends, skip + 1), len(borders))
        last = min(bisect_left(ends, skip + limit), len(borders))
        before = ends[first - 1] if first else 0
        if ends[last] - before >= total:
            break
        low = borders[first - 1] if first else low
        high = borders[last] if last < len(borders) else high
        total, skip = ends[last] - before, skip - before
    return _between(df, order, low, high).orderBy(*[F.col(f"`{c}`") for c in order]).offset(skip).limit(limit)
