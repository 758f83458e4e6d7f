"""Raw dialogues -> weak labels -> balanced training table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from safelabel.catalog import DIALOGUE_COLUMNS, ROWS_PER_CATEGORY
from safelabel.functions.taxonomy import Taxonomy
from safelabel.functions.vectors import format_distribution, map_to_vector, parse_distribution, winner
from safelabel.operators.labelling import VECTOR, keep_labelled, propagate_labels, with_dialogue_vector
from safelabel.operators.sampling import balance, id_columns, shuffle
from safelabel.operators.scanning import keep_computed
from safelabel.session import stage_table


def label_dialogues(dialogues: DataFrame, taxonomy: Taxonomy, english: str = "eng_Latn",
                    language_columns: dict[str, str] = DIALOGUE_COLUMNS, source: str | None = None,
                    harm: str = "harmful") -> DataFrame:
    """Labelled rows of all translations.  One narrow stage, no shuffle.

    ``harm`` names the column of the harm flag; ``catalog.HARM_COLUMN`` is its key in
    JSON-lines files.
    """
    labelled = keep_labelled(with_dialogue_vector(dialogues, taxonomy, english))
    return propagate_labels(labelled.drop(english), language_columns, source=source, harm=harm).drop(VECTOR)


def with_winner(labelled: DataFrame, distribution: str = "safety_distribution", out: str = "category") -> DataFrame:
    """Winning category of a distribution string; rows that do not parse are dropped."""
    rows = labelled.withColumn(out, winner(parse_distribution(distribution)))
    return keep_computed(rows, out, F.col(out).isNotNull())


def with_distribution_text(labelled: DataFrame, distribution: str = "safety_distribution") -> DataFrame:
    """The distribution map as the string that training and balancing read."""
    return labelled.withColumn(distribution, format_distribution(map_to_vector(distribution)))


def balanced_training_table(labelled: DataFrame, n: int = ROWS_PER_CATEGORY, seed: int = 42, id_col: str | list[str] = "id",
                            ordered: bool = True, stage: bool = True) -> DataFrame:
    """``n`` rows per winning category, in random order.

    Balancing reads its input several times, so the labelled rows are written once
    first; ``stage=False`` skips that when they are a plain table already.
    """
    rows = with_winner(labelled)
    rows = balance(stage_table(rows, "labelled") if stage else rows, "category", n, seed, id_col)
    return shuffle(rows, seed, *id_columns(id_col), "draw") if ordered else rows
