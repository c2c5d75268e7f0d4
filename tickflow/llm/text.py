"""Column expressions on text that several operators share."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The six ASCII separators between words: space, tab, line feed, VT, FF, CR.
SEPARATORS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]"


def or_empty(text: str | Column) -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words(text: Column) -> Column:
    """The runs of characters that are no separator, in order."""
    spaced = F.translate(text, SEPARATORS, " " * len(SEPARATORS))
    return F.filter(F.split(spaced, " "), lambda w: w != "")


def without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
