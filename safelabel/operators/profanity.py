"""Profanity flags and the lexicon as a table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from safelabel.functions.lexicon import GRAM, MAX_TERMS, Lexicon, grams
from safelabel.functions.trie import TermTrie
from safelabel.session import broadcast_if, pin_if_small, small_side, stage_table

SAFETY_COLUMNS = ["safety_categories", "safety_distribution"]


def flag_profanity(df: DataFrame, lexicon: Lexicon, text: str = "text", language: str = "language", out: str = "profanity") -> DataFrame:
    """1 when the text holds a term of the lexicon of its language."""
    return df.withColumn(out, lexicon.flag(text, language))


def drop_safety_columns(df: DataFrame) -> DataFrame:
    return df.drop(*SAFETY_COLUMNS)


def profanity_rows(df: DataFrame, lexicon: Lexicon) -> DataFrame:
    """The binary table: flagged rows without their category columns.

    A row lacking a category column, the language, or (in a language with a lexicon)
    the text is dropped.
    """
    ok = F.col("language").isNotNull() & (F.col("text").isNotNull() | ~F.col("language").isin(sorted(lexicon.terms)))
    for column in SAFETY_COLUMNS:
        ok = ok & F.col(column).isNotNull()
    return drop_safety_columns(flag_profanity(df.filter(ok), lexicon))


def term_postings(terms: DataFrame) -> DataFrame:
    """One ``gram`` for each distinct term (language, term).

    A term of ``GRAM`` letters or more posts the one of its grams that fewest terms hold, so common
    grams hardly have postings; a shorter term posts itself, the empty term an empty gram.
    """
    long = terms.filter(F.char_length("term") >= GRAM)
    own = long.select("language", "term", F.explode(F.array_distinct(grams("term", GRAM))).alias("gram"))
    common = own.groupBy("language", "gram").agg(F.count("*").alias("holders"))
    rarest = own.join(small_side(common), ["language", "gram"]).groupBy("language", "term").agg(
        F.min(F.struct("holders", "gram")).alias("post"))
    short = terms.filter(F.char_length("term") < GRAM).select("language", "term", F.col("term").alias("gram"))
    return rarest.select("language", "term", "post.gram").union(short)


def _without(terms: DataFrame, postings: DataFrame, size: int) -> DataFrame:
    """Terms that hold no other term that posts a gram of this size."""
    held = F.array_distinct(grams("term", size)) if size else F.array(F.lit(""))
    lookups = terms.filter(F.char_length("term") >= size).select("language", F.col("term").alias("whole"), F.explode(held).alias("gram"))
    redundant = (lookups.join(small_side(postings), ["language", "gram"]).filter((F.col("term") != F.col("whole")) & F.contains("whole", "term"))
                 .select("language", F.col("whole").alias("term")).distinct())
    return terms.join(redundant, ["language", "term"], "left_anti")


def minimise_lexicon(lexicon: DataFrame) -> DataFrame:
    """Terms that decide the flag: no duplicates, none that holds a shorter term.

    A term that holds another also holds a minimal one, so terms of 0, 1, 2, ... letters strike out
    the terms that hold them, size by size, before larger grams are cut. What is left looks up its
    grams of ``GRAM`` letters among the postings of the others left, and only terms that post one of
    them are searched for in it. Work grows with the letters of the lexicon.
    """
    terms = stage_table(lexicon.select("language", "term").filter("term is not null").distinct(), "terms")
    for size in range(GRAM):
        short = terms.filter(F.char_length("term") == size).select("language", F.col("term").alias("gram"), "term")
        if not short.isEmpty():
            terms = stage_table(_without(terms, short, size), "terms")
    long = terms.filter(F.char_length("term") >= GRAM)
    return _without(terms, stage_table(term_postings(long), "postings"), GRAM)


def with_lexicon_terms(df: DataFrame, lexicon: DataFrame, language: str = "language", out: str = "terms") -> DataFrame:
    """Attach the terms of the row's language; null where the language has none."""
    lexicon, small = pin_if_small(lexicon.select("language", "term"), MAX_TERMS)
    lists = lexicon.groupBy(F.col("language").alias(language)).agg(F.array_sort(F.collect_set("term")).alias(out))
    return df.join(broadcast_if(small, lists), language, "left")


HIT = "array<struct<term: string, place: int>>"
# A block of texts has about so many bytes, and so many pairs of a text and a term of its language at most.
BLOCK_BYTES, BLOCK_PAIRS = 1 << 18, 1 << 21


def _finder(terms: list[tuple]):
    """Arrays of texts and languages to arrays of hits, for the terms (language, term)."""
    def find(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        by_language = {}
        for code, term in terms:
            by_language.setdefault(code, []).append(term)
        words = pa.array([t for own in by_language.values() for t in own], pa.string())
        tries, first = {}, 0
        for code, own in by_language.items():
            tries[code] = (TermTrie(own), first)
            first += len(own)
        texts_at_once = max(1, BLOCK_PAIRS // max((t.size for t, _ in tries.values()), default=1))

        def hits(texts, languages):
            rows = {}
            for i, code in enumerate(languages):
                if code in tries and texts[i] is not None:
                    rows.setdefault(code, []).append(i)
            parts = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int32))]
            for code, own in rows.items():
                trie, shift = tries[code]
                text, term, place = trie.first_places([texts[i] for i in own])
                parts.append((np.array(own)[text], term + shift, place))
            row, term, place = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(row, kind="stable")
            ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(texts)))]).astype(np.int32)
            found = pa.StructArray.from_arrays([words.take(pa.array(term[order])), pa.array(place[order], pa.int32())], ["term", "place"])
            return pa.ListArray.from_arrays(pa.array(ends), found)

        for texts, languages in batches:
            held, codes, size = [], [], 0
            for text, code in zip(texts, languages):
                held.append(text.as_buffer().to_pybytes() if text.is_valid else None)
                codes.append(code.as_py())
                size += len(held[-1] or b"")
                if size >= BLOCK_BYTES or len(held) >= texts_at_once:
                    yield hits(held, codes)
                    held, codes, size = [], [], 0
            if held:
                yield hits(held, codes)

    return find


def term_hits(df: DataFrame, lexicon: DataFrame, text: str = "text", language: str = "language", place: str | None = None,
              gather: str | None = None) -> DataFrame:
    """One row per text and term of its language found in it: the columns of ``df``, ``term`` and, if named, its first place from 0.

    With ``gather``, one row per text with hits: the columns of ``df`` and, under that name, the array
    of its hits (``term``, ``place``). No pair comes twice. Null texts and empty terms have no hits.

    Each text is read once, where it lies, by a ``TermTrie`` of its language; nothing is shuffled.
    A lexicon beyond the limit for broadcasts is joined by grams: a text is cut into its distinct
    grams, they look up the terms that post them, and a term is searched for only in texts that hold
    the gram it posts.
    """
    terms = stage_table(lexicon.select("language", "term").filter("length(term) > 0 and language is not null").distinct(), "terms")
    pinned, small = pin_if_small(terms)
    rows = df.filter(F.col(text).isNotNull())
    if small:
        find = F.arrow_udf(_finder([tuple(r) for r in pinned.collect()]), HIT).asNondeterministic()
        found = rows.withColumn("_hits", find(F.col(text), F.col(language)))
        if gather:
            return found.filter(F.size("_hits") > 0).withColumnRenamed("_hits", gather)
        hits = found.withColumn("_hit", F.explode("_hits")).withColumns({"term": F.col("_hit.term"), "_place": F.col("_hit.place")})
    else:
        held = F.array_distinct(grams(text, *range(1, GRAM + 1)))
        pieces = rows.withColumn("_row", F.monotonically_increasing_id()).withColumn("_piece", F.explode(held))
        posted = term_postings(terms).select(F.col("language").alias("_language"), F.col("gram").alias("_gram"), "term")
        hits = (pieces.join(posted, (F.col(language) == F.col("_language")) & (F.col("_piece") == F.col("_gram")))
                .filter((F.col("term") == F.col("_gram")) | F.contains(text, "term"))
                .withColumn("_place", F.instr(F.col(text), F.col("term")) - 1))
        if gather:
            own = F.any_value(F.struct(*df.columns)).alias("_own")
            return hits.groupBy("_row").agg(own, F.collect_list(F.struct("term", F.col("_place").alias("place"))).alias(gather)).select("_own.*", gather)
    return hits.select(*df.columns, "term", *([F.col("_place").alias(place)] if place else []))
