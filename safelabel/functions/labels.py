"""Rules on gold and predicted labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from safelabel.catalog import BINARY_LABELS, SAFE, SAFE_WORDS, UNKNOWN, UNSAFE, UNSAFE_WORDS
from safelabel.functions.base import as_col, strip

PREDICTION_POLICIES = ("full", "default_safe", "safe_first")


def safe_label(col: Column | str) -> Column:
    """UNSAFE when the value truncates to 1, else SAFE (also when it is no number)."""
    text = strip(as_col(col).cast("string"))
    value = F.when(F.lower(text) == "true", F.lit(1.0)).otherwise(text.try_cast("double"))
    return F.when((value >= 1) & (value < 2), F.lit(UNSAFE)).otherwise(F.lit(SAFE))


def _shout(col: Column | str) -> Column:
    return F.upper(strip(col))


def normalise_gold(col: Column | str) -> Column:
    """SAFE or UNSAFE in any case and padding, else UNKNOWN."""
    text = _shout(col)
    return F.when(text.isin(BINARY_LABELS), text).otherwise(F.lit(UNKNOWN))


def normalise_pred(col: Column | str, policy: str = "full") -> Column:
    """Label from the raw words of a scorer.

    ``full``: UNSAFE before SAFE, then single words, else UNKNOWN.
    ``default_safe``: UNSAFE when mentioned, else SAFE.
    ``safe_first``: looks for SAFE first, so an UNSAFE answer turns SAFE and other
    text passes through; offered for parity only.
    """
    text = _shout(col)
    if policy == "full":
        return (F.when(text.contains(UNSAFE), F.lit(UNSAFE)).when(text.contains(SAFE), F.lit(SAFE))
                .when(text.isin(UNSAFE_WORDS), F.lit(UNSAFE)).when(text.isin(SAFE_WORDS), F.lit(SAFE))
                .otherwise(F.lit(UNKNOWN)))
    if policy == "default_safe":
        return F.when(text.contains(UNSAFE), F.lit(UNSAFE)).otherwise(F.lit(SAFE))
    if policy == "safe_first":
        return F.when(text.contains(SAFE), F.lit(SAFE)).otherwise(text)
    raise ValueError(f"policy must be one of {PREDICTION_POLICIES}")


def is_correct(gold: Column | str = "gold", pred: Column | str = "pred") -> Column:
    return as_col(gold) == as_col(pred)
