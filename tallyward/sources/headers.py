"""Header lines: one per file, read before the data so that columns go by name."""

from __future__ import annotations

import csv
import re
from collections import defaultdict
from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.session import discard, materialise

_NO_SEPARATOR = "\x01"  # makes the reader hand back whole lines
_HASHES = ("_hash", "_other_hash")  # of a line


class Layout(NamedTuple):
    names: tuple[str, ...]
    paths: str | list[str]  # as Spark's readers take them
    open_quotes: bool  # a line of these files ends inside quotes


def unique_names(names: list[str]) -> list[str]:
    """Repeated names get ``.1``, ``.2``...; a suffix that the header itself uses is skipped."""
    taken, count, result = set(names), defaultdict(int), []
    for position, name in enumerate(names):
        name = name or f"Unnamed: {position}"
        unique = name
        while count[name] and unique in taken:
            unique = f"{name}.{count[name]}"
            if unique in taken:
                count[name] += 1
        count[name] += 1
        taken.add(unique)
        result.append(unique)
    return result


def split_header(line: str, sep: str) -> tuple[str, ...]:
    return tuple(unique_names(next(csv.reader([line], delimiter=sep))))


def literal(path: str) -> str:
    """A file's path as a pattern that matches only this file."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def list_files(spark: SparkSession, source: str | Sequence[str]) -> list[str]:
    """Paths of the files behind a path or pattern; none if nothing is there.

    A list names files as they are, not patterns. One that is not there is an error, since the
    rows that it should have given would be lost without a word.
    """
    wanted = source if isinstance(source, str) else [literal(path) for path in source]
    if not wanted:
        return []
    try:
        found = spark.read.text(wanted).inputFiles()
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        if isinstance(source, str):
            return []
        raise FileNotFoundError(str(error)) from error
    return sorted(unquote(path) for path in found)


def _ends_in_quotes(line: Column, sep: str) -> Column:
    """True if a cell of the line opens a quote that the line does not close."""
    sep = re.escape(sep)
    # Most lines have no quote at all, which is seen at once.
    odd = line.contains('"') & ((F.length(line) - F.length(F.translate(line, '"', ""))) % 2 == 1)
    rest = F.regexp_replace(line, f'(^|{sep})"(?:[^"]|"")*"(?={sep}|$)', "$1")
    return odd & rest.rlike(f'(^|{sep})"')


def _lines(spark: SparkSession, files: list[str], encoding: str) -> DataFrame:
    """Whole lines, with two hashes that together have 128 bits."""
    lines = spark.read.csv(
        [literal(path) for path in files],
        schema="line string", sep=_NO_SEPARATOR, quote="", encoding=encoding,
    )
    return lines.withColumns({name: F.xxhash64(F.lit(seed), F.col("line")) for seed, name in enumerate(_HASHES)})


def layouts(
    spark: SparkSession,
    source: str | Sequence[str],
    files: list[str],
    sep: str,
    encoding: str,
    multi_line: bool = False,
) -> list[Layout]:
    """Files grouped by their column names, found in one scan of all of them.

    Files without any line are in no group. If all agree, the group is ``source`` itself, and no file
    names are gathered. The scan keeps numbers only: with texts Spark would sort every line. The text of a
    header is then read from one of the files that begin with it.
    """
    if not files:
        return []
    at_start = F.when(F.col("_metadata.file_block_start") == 0, F.monotonically_increasing_id())
    open_quotes = F.lit(False) if multi_line else _ends_in_quotes(F.col("line"), sep)
    found = materialise(
        _lines(spark, files, encoding)
        .select(*_HASHES, F.col("_metadata.file_path").alias("file"), at_start.alias("at"), open_quotes.alias("open"))
        .groupBy("file")
        .agg(*[F.min_by(h, "at").alias(h) for h in _HASHES], F.max("open").alias("open")),
        "headers",
    )
    kinds = {}
    for *hashes, quotes, file in found.groupBy(*_HASHES, "open").agg(F.min("file")).collect():
        same = reduce(lambda a, b: a & b, [F.col(h) == value for h, value in zip(_HASHES, hashes)])
        header = _lines(spark, [unquote(file)], encoding).filter(same).first().line
        kinds[(*hashes, quotes)] = (split_header(header, sep), quotes)
    if len(set(kinds.values())) == 1 and isinstance(source, str):
        discard(found)
        names, quotes = next(iter(kinds.values()))
        return [Layout(names, source, quotes)]
    groups: dict[tuple, list[str]] = defaultdict(list)
    for row in found.toLocalIterator():
        groups[kinds[(*(row[h] for h in _HASHES), row.open)]].append(unquote(row.file))
    discard(found)
    return [Layout(names, [literal(p) for p in sorted(paths)], quotes) for (names, quotes), paths in sorted(groups.items())]
