"""Left join of rows to a side by key, whatever the skew of the rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.operators.shape import col
from tallyward.session import materialise

# A value is hot when it has more rows than a shuffle partition's share. Its rows are dealt out
# in so many parts for each share, which level out over the partitions.
_PARTS = 16
_BUCKETS = 1 << 16  # of hashed values, counted first


def _partitions(rows: DataFrame) -> int:
    return int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def fits_broadcast(side: DataFrame) -> bool:
    """Whether the planner, by the sizes that it knows, sends the side whole to every task."""
    limit = side.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(side._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) <= limit


def hot_values(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, value, parts)`` of the values above a partition's share of the rows; written.

    A first pass over the columns counts buckets of hashed values, a fixed number, so its shuffle does not
    grow with the rows. Values are counted themselves in buckets above a share only, if there are any: a
    column has fewer of those than shuffle partitions, and of such values, however large the rows are.
    """
    cells = F.array(
        *[F.struct(F.lit(c).alias("column"), col(c).cast("string").alias("value")) for c in columns]
    )
    places = {c: i for i, c in enumerate(columns)}
    bucket = F.pmod(F.xxhash64("value"), F.lit(_BUCKETS))
    # Numbers alone: the first pass runs over every cell.
    hashed = [
        F.struct(F.lit(i).alias("place"), F.when(col(c).isNotNull(), F.pmod(F.xxhash64(col(c).cast("string")), F.lit(_BUCKETS))).alias("bucket"))
        for c, i in places.items()
    ]
    buckets = rows.select(F.inline(F.array(*hashed))).groupBy("place", "bucket").agg(F.count(F.lit(1)).alias("n"))
    totals = buckets.groupBy("place").agg(F.sum("n").alias("total"))  # a row for each column
    full = (
        buckets.join(F.broadcast(totals), "place")
        .filter(F.col("bucket").isNotNull() & (F.col("n") > F.col("total") / _partitions(rows)))
        .collect()
    )
    if not full:
        return rows.sparkSession.createDataFrame([], "column string, value string, parts int")
    names = list(columns)
    searched = F.lit(False)
    for column in sorted({names[r.place] for r in full}):
        mine = [r.bucket for r in full if names[r.place] == column]
        searched = searched | ((F.col("column") == column) & bucket.isin(*mine))
    total = F.create_map(*[F.lit(x) for r in {(r.place, r.total) for r in full} for x in (names[r[0]], r[1])])
    counts = rows.select(F.inline(cells)).filter(F.col("value").isNotNull() & searched)
    counts = counts.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    share = total[F.col("column")] / _partitions(rows)
    hot = counts.filter(F.col("n") > share).select(
        "column", "value", F.ceil(_PARTS * F.col("n") / share).cast("int").alias("parts")
    )
    return materialise(hot, "hot-values")


def attach(
    rows: DataFrame,
    column: str,
    side: DataFrame,
    key: str,
    columns: Mapping[str, str],
    hot: DataFrame | None = None,
) -> DataFrame:
    """``rows`` plus ``{new name: side column}``, NULL where ``side`` has no such key.

    A side that the planner broadcasts is joined as it is. Beside a larger one rows of hot values, and
    rows without a key, are dealt out in parts; the side's rows of those values are repeated once for
    each part. A key that the side has several times gives a row for each. Names must not clash.
    Beside a large side ``rows`` is read once to find hot values and once for the join, so it should
    be written if it is dear; ``hot`` has them if they were found for several columns.
    """
    side = side.select(col(key).alias("_key"), *[col(c).alias(a) for a, c in columns.items()])
    if fits_broadcast(side):  # no row of a hot value moves
        return rows.join(side, col(column) == F.col("_key"), "left").drop("_key")
    hot = hot_values(rows, [column]) if hot is None else hot
    # At most as many rows as there are shuffle partitions.
    hot = F.broadcast(hot.filter(F.col("column") == column).select("value", "parts"))
    number = F.monotonically_increasing_id()
    nowhere = _PARTS * _partitions(rows)
    part = F.when(col(column).isNull(), F.pmod(number, F.lit(nowhere))).otherwise(
        F.pmod(number, F.coalesce(F.col("parts"), F.lit(1)))
    )
    marked = rows.join(hot, col(column).cast("string") == F.col("value"), "left")
    marked = marked.withColumn("_part", part).drop("value", "parts")
    parts = F.sequence(F.lit(0).cast("long"), F.coalesce(F.col("parts"), F.lit(1)).cast("long") - 1)
    dealt = (
        side.join(hot, F.col("_key").cast("string") == F.col("value"), "left")
        .withColumn("_side_part", F.explode(parts))
        .drop("value", "parts")
    )
    same = (col(column) == F.col("_key")) & (F.col("_part") == F.col("_side_part"))
    return marked.join(dealt, same, "left").drop("_key", "_part", "_side_part")
