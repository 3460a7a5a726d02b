"""Renames and projections that tolerate absent columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyward.functions.numbers import loaded_int


def col(name: str) -> Column:
    """A column by its plain name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename what is there; other columns pass, absent ones are ignored."""
    return df.withColumnsRenamed(dict(names))


def subset(df: DataFrame, wanted: Iterable[str]) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    present = set(df.columns)
    return df.select([col(c) for c in wanted if c in present])


def typed(df: DataFrame, table: T.StructType, fault: str | None = None) -> DataFrame:
    """String columns cast to the types of ``table``; texts that are no number become NULL.

    With ``fault`` that column names the first such column of a row, unless it has a reason already.
    Each cell is parsed once.
    """
    numbers = [f.name for f in table if f.dataType == T.IntegerType() and f.name in df.columns]
    parsed = df.withColumns({f"_{c}_parsed": loaded_int(col(c)) for c in numbers})
    columns = [(col(f"_{c}_parsed") if c in numbers else col(c)).alias(c) for c in df.columns]
    if fault:
        wrong = [
            F.when(col(c).isNotNull() & col(f"_{c}_parsed").isNull(), F.lit(f"{c} is not an integer"))
            for c in numbers
        ]
        reason = F.coalesce(col(fault) if fault in df.columns else F.lit(None).cast("string"), *wrong)
        columns = [c for c, name in zip(columns, df.columns) if name != fault] + [reason.alias(fault)]
    return parsed.select(columns)
