"""Tolerant, row-wise date parsing."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyward.fixed_values import DATE_FORMATS
from tallyward.functions.text import strip


def _shape(fmt: str) -> str:
    """A pattern for texts that a date format can read, e.g. ``d/M/yyyy``."""
    fields = {"d": "[0-9]{1,2}", "M": "[0-9]{1,2}"}
    parts = re.findall(r"([a-zA-Z])(\1*)|(.)", fmt)
    return "^" + "".join(
        re.escape(other) if other else fields.get(letter + more, f"[0-9]{{{1 + len(more)}}}")
        for letter, more, other in parts
    ) + "$"


def parse_date(c: Column, formats: Iterable[str] = DATE_FORMATS) -> Column:
    """The first format that reads the trimmed text; NULL when none does."""
    return trimmed_date(strip(c), formats)


def trimmed_date(text: Column, formats: Iterable[str] = DATE_FORMATS) -> Column:
    """The same of a text without white space at its ends.

    The shape test comes first, since a failed parse costs an exception per row.
    """
    return F.coalesce(
        *[F.when(text.rlike(_shape(f)), F.try_to_date(text, f)) for f in formats]
    )
