"""Key, reference, length and type rules; offending rows are set aside, not lost."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.fixed_values import UNKNOWN
from tallyward.operators.attach import attach
from tallyward.session import materialise


class Split(NamedTuple):
    valid: DataFrame
    violations: DataFrame


def _split(flagged: DataFrame, flag: str) -> Split:
    return Split(flagged.filter(~F.col(flag)).drop(flag), flagged.filter(flag).drop(flag))


def too_long(c: Column, limit: int, exempt: Iterable[str] = (UNKNOWN,)) -> Column:
    """True for texts over the limit. The unknown word is allowed in any column."""
    return F.coalesce((F.length(c) > limit) & ~c.isin(*exempt), F.lit(False))


def pk_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that are NULL or occur more than once, with their row counts."""
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(missing | (F.col("n") > 1))


def pk_flag(df: DataFrame, keys: list[str], flag: str) -> DataFrame:
    """Mark all rows whose key is NULL or repeated."""
    as_text = F.to_json(F.struct(*keys))
    bad = pk_violations(df, keys).select(as_text.alias("_pk"), F.lit(True).alias("_bad"))
    marked = attach(df.withColumn("_pk", as_text), "_pk", bad, "_pk", {"_bad": "_bad"})
    return marked.withColumn(flag, F.col("_bad").isNotNull()).drop("_pk", "_bad")


def split_on_pk(df: DataFrame, keys: list[str]) -> Split:
    """Rows with a good key, and all rows of the bad keys."""
    return _split(pk_flag(df, keys, "_repeated"), "_repeated")


def fk_flag(df: DataFrame, column: str, dim: DataFrame, key: str, flag: str) -> DataFrame:
    """Mark rows whose reference is missing from ``dim``; a NULL refers to nothing and is fine.

    One pass over the rows, whose number does not change: keys of ``dim`` count once.
    """
    keys = dim.select(key).distinct().withColumn("_found", F.lit(True))
    found = attach(df, column, keys, key, {"_found": "_found"})
    return found.withColumn(flag, F.col(column).isNotNull() & F.col("_found").isNull()).drop("_found")


def missing_references(df: DataFrame, column: str, dim: DataFrame, key: str) -> DataFrame:
    """The written distinct values of a column that are missing from ``dim``.

    Values fold before they shuffle. ``df`` is read once for this, so it should be written if it is dear;
    the result is small where few references are wrong, and its size is known.
    """
    values = df.select(F.col(column).alias("_value")).filter("_value is not null").distinct()
    missing = values.join(dim.select(F.col(key).alias("_key")), F.col("_value") == F.col("_key"), "left_anti")
    return materialise(missing, "missing-references")


def fk_split(df: DataFrame, column: str, dim: DataFrame, key: str) -> Split:
    """Rows whose reference exists (or is NULL), and the orphans."""
    return _split(fk_flag(df, column, dim, key, "_orphan"), "_orphan")


def tag(df: DataFrame, rules: Mapping[str, Column], column: str = "violations") -> DataFrame:
    """Add the names of the rules a row breaks (an empty array for a good row)."""
    broken = [F.when(rule, F.lit(name)) for name, rule in rules.items()]
    return df.withColumn(column, F.array_compact(F.array(*broken)))


def count_violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """``(rule, n)`` for row rules, all counted in one pass over the rows."""
    counts = df.agg(*[F.count_if(rule).alias(name) for name, rule in rules.items()])
    pairs = [F.struct(F.lit(n).alias("rule"), F.col(f"`{n}`").alias("n")) for n in rules]
    return counts.select(F.inline(F.array(*pairs)))


def report(*parts: DataFrame) -> DataFrame:
    """One ``(rule, n)`` table out of several."""
    return reduce(DataFrame.unionByName, parts)


def count_rows(rule: str, df: DataFrame) -> DataFrame:
    """``(rule, n)`` for violations found by grouping or joining."""
    return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(rule).alias("rule"), "n")
