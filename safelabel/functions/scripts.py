"""Language tags from the script of a text, and from stop words for Latin script."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from safelabel.catalog import EXAMPLE_STOP_WORDS
from safelabel.functions.base import as_col, let
from safelabel.functions.text import fold_text, word_tokens

# --- fixed values: code points of the script of each language ---------------------------
SCRIPT_RANGES = {
    "bn": r"\x{0980}-\x{09FF}",
    "or": r"\x{0B00}-\x{0B7F}",
    "kn": r"\x{0C80}-\x{0CFF}",
    "ml": r"\x{0D00}-\x{0D7F}",
}


def _best(votes: Column) -> Column:
    """Name of the first entry with the most votes; null when nobody voted."""
    return let(votes, lambda vs: let(F.array_max(F.transform(vs, lambda v: v["n"])), lambda top: F.when(
        top > 0, F.get(F.filter(vs, lambda v: v["n"] == top), F.lit(0))["name"])))


def tag_language(text: Column | str, stop_words: dict[str, list[str]] | None = None) -> Column:
    """Language code of the text, ``unknown`` when nothing tells.

    The script with the most letters decides; texts in none of the scripts are voted
    on by stop words.
    """
    stop_words = EXAMPLE_STOP_WORDS if stop_words is None else stop_words
    # Most texts hold little beyond Latin letters, which one plain range takes out.
    beyond_latin = F.regexp_replace(as_col(text), r"[\x00-\x{097F}]+", "")
    kept = F.regexp_replace(beyond_latin, f"[^{''.join(SCRIPT_RANGES.values())}]+", "")
    by_script = let(kept, lambda t: F.when(t != "", _best(F.array(*[
        F.struct(F.lit(code).alias("name"), F.regexp_count(t, F.lit(f"[{letters}]")).alias("n"))
        for code, letters in SCRIPT_RANGES.items()]))))

    every_word = sorted({w for words in stop_words.values() for w in words})
    voters = F.filter(word_tokens(fold_text(text)), lambda t: t.isin(every_word))
    by_words = let(voters, lambda ts: _best(F.array(*[
        F.struct(F.lit(code).alias("name"), F.size(F.filter(ts, lambda t: t.isin(words))).alias("n"))
        for code, words in sorted(stop_words.items())])))
    return F.coalesce(by_script, by_words, F.lit("unknown"))
