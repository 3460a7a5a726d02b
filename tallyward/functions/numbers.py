"""Integer codes from text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyward.fixed_values import BLANK_NUMERIC_TOKENS, WHITE_SPACE
from tallyward.functions.text import clean_text, default_code, leading_code, strip

_NUMBER = f"^[{WHITE_SPACE}]*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)(?:[eE][+-]?[0-9]+)?[{WHITE_SPACE}]*$"
_INTEGER = f"^[{WHITE_SPACE}]*[+-]?[0-9]+[{WHITE_SPACE}]*$"


def blank_to_null(c: Column) -> Column:
    """NULL for the texts that stand for "no number"."""
    return F.when(~c.isin(*BLANK_NUMERIC_TOKENS), c)


def strict_int(c: Column) -> Column:
    """The integer a text spells, NULL when it spells none (no decimals, no overflow).

    The pattern test comes first, since a failed cast costs an exception per row.
    """
    text = c.cast("string")
    return F.when(text.rlike(_INTEGER), strip(text).try_cast("int"))


def loaded_int(c: Column) -> Column:
    """The integer that a table column takes from a numeric text: decimals are rounded, halves to
    the even neighbour. NULL for other texts and for numbers that do not fit."""
    number = F.when(c.rlike(_NUMBER), F.rint(strip(c).try_cast("double")))
    return F.when(number.between(-(2**31), 2**31 - 1), number.cast("int"))


def not_an_int(c: Column) -> Column:
    """True where a value is present but is not an integer."""
    return c.isNotNull() & strict_int(c).isNull()


def municipality_code(c: Column) -> Column:
    """Integer code out of a raw ``code-name`` text; the unknown member's code if not known."""
    return strict_int(default_code(leading_code(clean_text(c))))


def drop_check_digit(code: Column) -> Column:
    """The code without its last digit; NULL when nothing is left."""
    return F.when(F.abs(code) > 9, F.call_function("div", code, F.lit(10)).cast("int"))


def no_check_digit_to_drop(code: Column) -> Column:
    """True where removing the last character cannot give a code: NULL or a bare sign."""
    return code.isNull() | code.between(-9, -1)
