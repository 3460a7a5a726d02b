"""Text cleaning as native column expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyward.fixed_values import MISSING_TOKENS, UNKNOWN, UNKNOWN_CODE, UNKNOWN_TOKENS, WHITE_SPACE


def strip(c: Column) -> Column:
    """Drop white space of every kind from both ends."""
    return F.trim(c, F.lit(WHITE_SPACE))


def upper_text(c: Column) -> Column:
    """Trimmed upper-case text."""
    return F.upper(strip(c.cast("string")))


def known_text(text: Column) -> Column:
    """The unknown word in place of empty, missing and unclassified upper-case texts."""
    return F.when(text.isNull() | text.isin(*UNKNOWN_TOKENS), F.lit(UNKNOWN)).otherwise(text)


def clean_text(c: Column) -> Column:
    """Trimmed upper-case text; empty, missing and unclassified become the unknown word."""
    return known_text(upper_text(c))


def missing_to_null(c: Column, tokens: Iterable[str] = MISSING_TOKENS) -> Column:
    """NULL for cells that hold one of the missing-value tokens, exactly as written."""
    return F.when(~c.isin(*tokens), c)


def leading_code(c: Column) -> Column:
    """The text before the first dash; the whole text if there is none."""
    return strip(F.substring_index(c, "-", 1))


def default_code(c: Column, code: int = UNKNOWN_CODE) -> Column:
    """The code of the unknown member in place of the unknown word."""
    return F.when(c == UNKNOWN, F.lit(str(code))).otherwise(c)
