"""Substring tests against per-language term lists.

A list becomes one literal pattern (terms share their common starts), so a text is
read once however long the list is.  Matching is case-sensitive and takes terms as
they are: inner and trailing spaces count, and nothing is normalised.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from safelabel.functions.base import as_col, let
from safelabel.functions.patterns import any_of
from safelabel.session import collect_config

MAX_TERMS = 50_000


class Lexicon:
    """Terms per language."""

    def __init__(self, rows):
        self.terms: dict[str, list[str]] = defaultdict(list)
        for language, term in rows:
            self.terms[language].append(term)

    @classmethod
    def from_table(cls, df: DataFrame) -> "Lexicon":
        """From a table with the columns language and term."""
        return cls(collect_config(df.select("language", "term"), MAX_TERMS, "the lexicon"))

    def flag(self, text: Column | str, language: Column | str) -> Column:
        """1 when the text holds a term of its own language, else 0."""
        text, language = as_col(text), as_col(language)
        result = F.lit(False)
        for code, terms in sorted(self.terms.items()):
            result = F.when(language == code, text.rlike(any_of(terms))).otherwise(result)
        return F.coalesce(result, F.lit(False)).cast("int")

    def any_term(self, text: Column | str) -> Column:
        """True when the text holds a term of any language."""
        pattern = any_of(t for terms in self.terms.values() for t in terms)
        return F.coalesce(as_col(text).rlike(pattern), F.lit(False))


GRAM = 4


def grams(text: Column | str, *sizes: int) -> Column:
    """All runs of so many neighbouring code points of a text, size by size, in order."""
    def runs(letters: Column, size: int) -> Column:
        starts = F.when(F.size(letters) >= size, F.sequence(F.lit(0), F.size(letters) - size)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.concat(*[F.get(letters, i + k) for k in range(size)]))

    cut = lambda letters: F.concat(*[runs(letters, size) for size in sizes])
    return let(F.regexp_extract_all(as_col(text), F.lit("(?s)."), F.lit(0)), cut)
