"""Keyword counts per category.

Every pattern counts on its own, so overlapping patterns count twice.  Texts are cut
into words once; a word whose first letters start no pattern is dropped by a hash
lookup, and only the few words left are compared with the patterns that share their
first letters.  Phrases are counted with a pattern, on texts that hold their first
word only.  All of this is one Column expression: no shuffle, no explode, no UDF.
"""

from __future__ import annotations

import json
import re
from collections import defaultdict
from dataclasses import asdict, dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from safelabel.catalog import CATEGORIES
from safelabel.functions.base import as_col, let
from safelabel.functions.patterns import classify, leading_word, quote, to_java
from safelabel.functions.text import fold_literal, fold_text, word_tokens
from safelabel.session import collect_config

MAX_PATTERNS = 20_000
_KEY_LENGTH = 3
_PATTERN_ARRAY = "array<struct<number:int,position:int,head:string,is_open:boolean,regex:string>>"


@dataclass(frozen=True)
class Pattern:
    number: int  # tells equal patterns apart
    position: int  # zero-based position of the category
    head: str | None  # folded letters a matching word starts with
    is_open: bool  # the word may go on after the head
    regex: str | None  # set for phrases


def _literal(value, kind: str) -> Column:
    """A nested constant in one piece, folded by the optimizer."""
    return F.from_json(F.lit(json.dumps(value, default=asdict, ensure_ascii=False)), kind)


class Taxonomy:
    """Categories with their stems, words and phrases."""

    def __init__(self, rows, categories: list[str] = CATEGORIES):
        self.categories = list(categories)
        self.rows = [tuple(row) for row in rows]
        order = {name: i for i, name in enumerate(self.categories)}
        self.patterns = []
        for number, (category, kind, term) in enumerate(self.rows):
            if category not in order:
                raise ValueError(f"unknown category {category!r}")
            if kind not in ("stem", "word", "phrase"):
                raise ValueError(f"unknown kind {kind!r}")
            if kind != "phrase" and not re.fullmatch(r"\w+", term):  # several words, or a hyphen
                term = rf"\b{quote(term)}" + (r"\w*" if kind == "stem" else r"\b")
                kind = "phrase"
            if kind == "phrase":
                self.patterns.append(Pattern(number, order[category], *leading_word(term), to_java(term)))
            else:
                self.patterns.append(Pattern(number, order[category], fold_literal(term), kind == "stem", None))

    @classmethod
    def from_table(cls, df: DataFrame, categories: list[str] = CATEGORIES) -> "Taxonomy":
        """From a table with the columns category, kind and term."""
        rows = collect_config(df.select("category", "kind", "term"), MAX_PATTERNS, "the taxonomy")
        return cls(rows, categories)

    @classmethod
    def from_patterns(cls, patterns: dict[str, list[str]]) -> "Taxonomy":
        """From Python-style patterns per category."""
        return cls([(c, *classify(p)) for c, ps in patterns.items() for p in ps], list(patterns))

    def _index(self) -> dict[int, dict[str, list[Pattern]]]:
        """Patterns by the first letters of the words they match.

        The letters are three, or the whole word when it is shorter and cannot go on;
        only short open heads need keys of another length.
        """
        index: dict[int, dict[str, list[Pattern]]] = defaultdict(lambda: defaultdict(list))
        for p in self.patterns:
            if p.head:
                length = len(p.head) if p.is_open and len(p.head) < _KEY_LENGTH else _KEY_LENGTH
                index[length][p.head[:_KEY_LENGTH]].append(p)
        return index

    def counts(self, text: Column | str) -> Column:
        """``array<bigint>``: matches per category; zeros for null or empty text."""
        zeros = F.array(*[F.lit(0).cast("bigint") for _ in self.categories])
        index = self._index()
        always = [p for p in self.patterns if not p.head]

        def starts_pattern(word: Column) -> Column:
            tests = [F.substring(word, 1, n).isin(sorted(keys)) for n, keys in sorted(index.items())]
            return reduce(lambda a, b: a | b, tests)

        def patterns_of(word: Column) -> Column:
            groups = []
            for n, keys in sorted(index.items()):
                candidates = F.try_element_at(_literal(keys, f"map<string,{_PATTERN_ARRAY}>"), F.substring(word, 1, n))
                found = F.filter(candidates, lambda p: F.startswith(word, p["head"]) & (p["is_open"] | (word == p["head"])))
                groups.append(F.coalesce(found, F.array().cast(_PATTERN_ARRAY)))
            return groups[0] if len(groups) == 1 else F.concat(*groups)

        def tally(folded: Column) -> Column:
            def add_up(matched: Column) -> Column:
                words = F.filter(matched, lambda p: p["regex"].isNull())
                phrases = F.array_distinct(F.filter(matched, lambda p: p["regex"].isNotNull()))
                if always:
                    phrases = F.concat(phrases, _literal(always, _PATTERN_ARRAY))
                hits = F.concat(
                    F.transform(words, lambda p: F.struct(p["position"].alias("at"), F.lit(1).alias("n"))),
                    F.transform(phrases, lambda p: F.struct(
                        p["position"].alias("at"), F.regexp_count(folded, p["regex"]).alias("n"))),
                )
                return F.aggregate(hits, zeros, lambda acc, hit: F.transform(
                    acc, lambda x, i: x + F.when(i == hit["at"], hit["n"]).otherwise(0).cast("bigint")))

            if index:
                hits = F.filter(word_tokens(folded), starts_pattern)
                matched = F.flatten(F.transform(hits, patterns_of))
            else:
                matched = F.array().cast(_PATTERN_ARRAY)
            return let(matched, add_up)

        return F.coalesce(let(fold_text(as_col(text)), tally), zeros)
