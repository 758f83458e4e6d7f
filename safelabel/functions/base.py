"""Small helpers shared by the Column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# A letter, digit or underscore in any script (combining marks excluded).
WORD_CHARS = r"\p{L}\p{N}_"
WORD = f"[{WORD_CHARS}]"
# White space in any script.
SPACE_CHARS = r"\t-\r\x1c-\x20\x85\p{Z}"
SPACE = f"[{SPACE_CHARS}]"


def as_col(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def total(values: Column) -> Column:
    """Sum of an array of doubles, left to right."""
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def strip(col: Column | str) -> Column:
    """Remove white space of any script from both ends."""
    return F.regexp_replace(as_col(col), f"^{SPACE}+|{SPACE}+$", "")
