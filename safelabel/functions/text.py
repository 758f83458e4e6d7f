"""Rules on single texts and on nested dialogue columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from safelabel.functions.base import SPACE, WORD, as_col, strip


# --- fixed values: letters that match another letter only when case is ignored ------------
_FOLDED = {"ı": "i", "ſ": "s", "ς": "σ"}


def fold_text(col: Column | str) -> Column:
    """Lower-case, with the letters that match another one only when case is ignored
    (dotted and dotless i, long s, final sigma) mapped to that letter.

    ``replace`` skips through a text that has none of them; ``translate`` would look up
    every single character.
    """
    text = F.lower(F.replace(as_col(col), F.lit("İ"), F.lit("i")))
    for letter, plain in _FOLDED.items():
        text = F.replace(text, F.lit(letter), F.lit(plain))
    return text


def fold_literal(term: str) -> str:
    """The same folding for a term on the driver."""
    return term.replace("İ", "i").lower().translate(str.maketrans(_FOLDED))


def word_tokens(folded: Column) -> Column:
    """Maximal runs of letters, digits and underscores."""
    return F.regexp_extract_all(folded, F.lit(f"{WORD}+"), F.lit(0))


def _nested(col: Column | str, position: int) -> Column:
    return F.get(F.get(as_col(col), F.lit(0)), F.lit(position))


def first_prompt(col: Column | str) -> Column:
    """``col[0][0]``; null when any level is missing or too short."""
    return _nested(col, 0)


def first_response(col: Column | str) -> Column:
    """``col[0][1]``; null when any level is missing or too short."""
    return _nested(col, 1)


def clean_text(col: Column | str) -> Column:
    """Commas become spaces and double quotes become single quotes."""
    return F.translate(as_col(col), ',"', " '")


def coerce_text(col: Column | str, null_text: str = "") -> Column:
    """Text of a value; a missing one becomes ``null_text``."""
    return F.coalesce(as_col(col).cast("string"), F.lit(null_text))


def not_blank(col: Column | str) -> Column:
    """True when the text holds anything but white space."""
    return F.coalesce(strip(col) != "", F.lit(False))


def not_empty(col: Column | str) -> Column:
    """True when the text is present and has at least one character."""
    return F.coalesce(as_col(col) != "", F.lit(False))


def _space_tokens(col: Column | str) -> Column:
    return F.filter(F.split(as_col(col), f"{SPACE}+"), lambda t: t != "")


def token_count(col: Column | str) -> Column:
    """Number of white-space separated tokens."""
    return F.coalesce(F.size(_space_tokens(col)), F.lit(0))


def truncate_tokens(col: Column | str, limit: int) -> Column:
    """The first ``limit`` white-space separated tokens, joined by one space."""
    return F.array_join(F.slice(_space_tokens(col), 1, limit), " ")
