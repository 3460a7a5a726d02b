"""Delimited text files as DataFrames of strings, columns by name."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyward.functions.text import missing_to_null
from tallyward.operators.shape import col, rename
from tallyward.sources.headers import layouts, list_files

SOURCE = "arquivo_origem"  # the file a row came from
FAULT = "motivo_rejeicao"  # why a row cannot be loaded, NULL if it can
ORIGINAL = "texto_original"  # all cells of a row with a fault as they were read, else NULL

_BAD_LINE = "_bad_line"
_END = "\x02"


def _strings(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _no_rows(spark: SparkSession, names: list[str]) -> DataFrame:
    """An empty relation that the optimizer drops from a union."""
    nothing = F.lit(None).cast("string")
    return spark.range(1).limit(0).select(*[nothing.alias(n) for n in names])


def _too_wide(line: Column, width: int, sep: str) -> Column:
    """True if a line the reader flagged has more cells than the header (fewer is fine).

    An end mark is put behind the last cell; on a short line it lands within the width.
    """
    names = [f"c{i}" for i in range(width)]
    cells = F.from_csv(
        F.concat(line, F.lit(sep + _END)),
        ", ".join(f"{n} string" for n in names),
        {"sep": sep, "escape": '"'},
    )
    ends_within = F.array_contains(F.array(*[cells[n] for n in names]), _END)
    return line.isNotNull() & ~F.coalesce(ends_within, F.lit(False))


def _scan_layout(spark, layout, sep, encoding, multi_line, lineage):
    names, paths, open_quotes = layout
    # Positional names first: header names may hold dots.
    positions = [f"c{i}" for i in range(len(names))]
    # The width of a line is only seen when all of it is parsed.
    raw = spark.read.option("columnPruning", False).csv(
        paths,
        schema=_strings([*positions, _BAD_LINE]),
        sep=sep,
        header=True,
        encoding=encoding,
        escape='"',
        multiLine=multi_line,
        columnNameOfCorruptRecord=_BAD_LINE,
    )
    wide = _too_wide(F.col(_BAD_LINE), len(names), sep)
    cells = [missing_to_null(F.col(p)) for p in positions]
    if not lineage:
        problem = F.concat(F.lit("too many cells: "), F.col(_BAD_LINE))
        cells[0] = F.when(wide, F.raise_error(problem)).otherwise(cells[0])
        return raw.select(*[c.alias(n) for c, n in zip(cells, names)])
    unclosed = F.lit("a quote is not closed in its line" if open_quotes else None).cast("string")
    fault = F.when(wide, F.lit("too many cells")).otherwise(unclosed)
    return raw.select(
        *[c.alias(n) for c, n in zip(cells, names)],
        F.col("_metadata.file_path").alias(SOURCE),
        fault.alias(FAULT),
        F.when(wide, F.col(_BAD_LINE)).alias(ORIGINAL),
    )


def original(columns: Sequence[str]) -> Column:
    """The cells of a row as JSON text, for rows that are set aside."""
    return F.to_json(F.struct(*[col(c) for c in columns]))


def scan(
    spark: SparkSession,
    pattern: str | Sequence[str],
    sep: str = ";",
    *,
    renames: Mapping[str, str] | None = None,
    expected: T.StructType | None = None,
    encoding: str = "ISO-8859-1",
    multi_line: bool = False,
    lineage: bool = False,
) -> DataFrame:
    """All files behind ``pattern`` appended by column name; every column is a string.

    Nothing there gives no rows (with the ``expected`` columns); a list names files that must
    exist. With ``lineage`` each row names its file, what is wrong with it (too many cells, a file
    whose header has columns outside ``expected``, or one with a quote that is not closed in its
    line, unless ``multi_line``), and then its original text. Without it, such files are an error.
    """
    files = list_files(spark, pattern)
    parts = []
    for layout in layouts(spark, pattern, files, sep, encoding, multi_line):
        if layout.open_quotes and not lineage:
            raise ValueError(f"a quote is not closed in its line: {layout.paths}")
        part = _scan_layout(spark, layout, sep, encoding, multi_line, lineage)
        part = rename(part, renames or {})
        if expected is not None:
            known = {*expected.names, SOURCE, FAULT, ORIGINAL}
            surplus = [c for c in part.columns if c not in known]
            if surplus and lineage:
                reason = "unexpected column " + ", ".join(surplus)
                cells = [c for c in part.columns if c not in (SOURCE, FAULT, ORIGINAL)]
                part = part.withColumns({FAULT: F.lit(reason), ORIGINAL: F.coalesce(ORIGINAL, original(cells))})
                part = part.drop(*surplus)
            elif surplus:
                raise ValueError(f"unexpected columns in {layout.paths}: {surplus}")
        parts.append(part)
    if expected is not None or not parts:
        names = expected.names if expected is not None else []
        parts.insert(0, _no_rows(spark, [*names, *([SOURCE, FAULT, ORIGINAL] if lineage else [])]))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
