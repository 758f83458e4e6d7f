"""Labelled rows -> profanity flag -> quota sample -> train and test."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from safelabel.catalog import HARM_COLUMN, TRAIN_SHARE
from safelabel.functions.labels import safe_label
from safelabel.functions.lexicon import Lexicon
from safelabel.functions.text import coerce_text
from safelabel.operators.profanity import profanity_rows
from safelabel.operators.sampling import id_columns, quota_sample, ratio_split
from safelabel.operators.scanning import require_keys
from safelabel.session import stage_table


def binary_table(labelled: DataFrame, lexicon: Lexicon) -> DataFrame:
    """Rows with a profanity flag and without category columns.  No shuffle."""
    return profanity_rows(labelled, lexicon)


def sampled_pairs(rows: DataFrame, quotas: DataFrame, seed: int = 42, ratio: float = TRAIN_SHARE, id_col: str | list[str] = "id",
                  harm: str = HARM_COLUMN, on_short: str = "error", stage: bool = True) -> DataFrame:
    """Text, label and split of a quota sample by source and language.

    Sampling reads its input several times, so the rows are written once first;
    ``stage=False`` skips that when they are a plain table already.
    """
    good, _ = require_keys(rows, ["source", "language"])
    good = stage_table(good, "binary-rows") if stage else good
    picked = quota_sample(good, quotas, ["source", "language"], seed, id_col, on_short=on_short)
    pairs = picked.select(*id_columns(id_col), coerce_text("text").alias("text"), safe_label(F.col(f"`{harm}`")).alias("label"))
    return ratio_split(pairs, ratio, seed, id_col)
