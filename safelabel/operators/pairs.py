"""Prompts, training pairs, and pairing gold with predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from safelabel.functions.base import as_col


def fill_template(template: str, text: Column | str, slot: str = "{text}") -> Column:
    """The template with its one named slot replaced by the text; other braces stay, a null text is empty."""
    if template.count(slot) != 1:
        raise ValueError(f"the template must hold {slot} once")
    head, _, tail = template.partition(slot)
    return F.concat(F.lit(head), F.coalesce(as_col(text), F.lit("")), F.lit(tail))


def render_prompt(df: DataFrame, template: str, text: str = "text", out: str = "prompt", slot: str = "{text}") -> DataFrame:
    return df.withColumn(out, fill_template(template, text, slot))


def sft_pairs(df: DataFrame, input_col: str, output_col: str, template: str, id_col: str | None = None) -> DataFrame:
    """Prompt and completion of each training row."""
    return df.select(*([id_col] if id_col else []), fill_template(template, input_col).alias("prompt"),
                     F.col(output_col).alias("completion"))


def pair_predictions(gold: DataFrame, predictions: DataFrame, id_col: str = "id", keep_unmatched: bool = False) -> DataFrame:
    """Gold rows with their predictions, matched by id.

    ``keep_unmatched`` also keeps gold rows without a prediction, which is null then.
    """
    return gold.join(predictions, id_col, "left" if keep_unmatched else "inner")


def pairing_summary(gold: DataFrame, predictions: DataFrame, id_col: str = "id") -> DataFrame:
    """One row: ids on both sides, on one side only, and ids that a side repeats.

    Ids are counted per side before they meet, so an id that fills a table is one row.
    """
    sides = gold.select(id_col, F.lit(1).alias("_g"), F.lit(0).alias("_p")).unionByName(
        predictions.select(id_col, F.lit(0).alias("_g"), F.lit(1).alias("_p")))
    ids = sides.filter(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.sum("_g").alias("_g"), F.sum("_p").alias("_p"))
    g, p = F.col("_g"), F.col("_p")
    return ids.agg(
        F.count_if((g > 0) & (p > 0)).alias("matched"), F.count_if((g > 0) & (p == 0)).alias("gold_only"),
        F.count_if((g == 0) & (p > 0)).alias("pred_only"), F.count_if(g > 1).alias("repeated_gold"),
        F.count_if(p > 1).alias("repeated_pred"))
