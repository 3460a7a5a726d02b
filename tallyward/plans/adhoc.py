"""Parameterised SQL over the catalog."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession

_MARK = re.compile(r"%\((\w+)\)s|%s|%%")


def _named(query: str, params: Mapping[str, Any]) -> tuple[str, dict[str, Any]]:
    """``%(name)s`` marks as ``:name``; a tuple becomes a list in brackets, for IN."""
    args = dict(params)

    def mark(found: re.Match) -> str:
        name = found[1]
        if name is None:
            return "%" if found[0] == "%%" else found[0]
        if not isinstance(params[name], tuple):
            return f":{name}"
        items = {f"{name}_{i}": item for i, item in enumerate(params[name])}
        args.update(items)
        args.pop(name, None)
        return "(" + ", ".join(f":{item}" for item in items) + ")"

    return _MARK.sub(mark, query), args


def _positional(query: str, params: Sequence[Any]) -> tuple[str, list[Any]]:
    """``%s`` marks as ``?``; a tuple becomes a list in brackets, for IN."""
    left, args = list(params), []

    def mark(found: re.Match) -> str:
        if found[0] != "%s":
            return "%" if found[0] == "%%" else found[0]
        if not left:
            raise ValueError("more parameter marks than values")
        value = left.pop(0)
        many = isinstance(value, tuple)
        args.extend(value if many else [value])
        return "(" + ", ".join("?" * len(value)) + ")" if many else "?"

    text = _MARK.sub(mark, query)
    return text, args + left


def run_sql(
    spark: SparkSession, query: str, params: Sequence[Any] | Mapping[str, Any] | None = None
) -> DataFrame:
    """The rows of a query; values are bound, never pasted into the text.

    Marks may be ``%s`` and ``%(name)s`` (then ``%%`` is a per cent sign), or Spark's own
    ``?`` and ``:name``.
    """
    if not params:
        return spark.sql(query)
    bind = _named if isinstance(params, Mapping) else _positional
    text, args = bind(query, params)
    return spark.sql(text, args=args)


def rows_as_dicts(df: DataFrame) -> Iterator[dict[str, Any]]:
    """Rows as dicts, fetched one partition at a time."""
    for row in df.toLocalIterator():
        yield row.asDict()
