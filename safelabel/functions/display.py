"""Report values: bands, percentages, clamping and display names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from safelabel.catalog import ACCURACY_CUT, F1_CUTS, IMBALANCE_CUTS, KL_CUTS
from safelabel.functions.base import as_col


def f1_band(col: Column | str) -> Column:
    low, high = F1_CUTS
    value = as_col(col)
    return F.when(value < low, "low").when(value > high, "high").otherwise("medium")


def accuracy_band(col: Column | str) -> Column:
    return F.when(as_col(col) < ACCURACY_CUT, "low").otherwise("ok")


def kl_band(col: Column | str) -> Column:
    high, severe = KL_CUTS
    value = as_col(col)
    return F.when(value > severe, "severe").when(value > high, "high").otherwise("ok")


def imbalance_band(percent: Column | str) -> Column:
    """Verdict on the share of one category, given in percent."""
    likely, confirmed = IMBALANCE_CUTS
    value = as_col(percent)
    return F.when(value > confirmed, "confirmed").when(value > likely, "likely").otherwise("denied")


def pct(col: Column | str, decimals: int = 2) -> Column:
    return F.round(as_col(col) * 100, decimals)


def clamp(col: Column | str, low: float = 0.0, high: float = 1.0) -> Column:
    return F.greatest(F.least(as_col(col), F.lit(high)), F.lit(low))


def display_name(code: Column | str, names: dict[str, str]) -> Column:
    """Name of a code; an unknown code stands for itself."""
    code = as_col(code)
    table = F.create_map(*[F.lit(x) for item in names.items() for x in item])
    return F.coalesce(F.try_element_at(table, code), code)
