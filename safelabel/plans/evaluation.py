"""Raw predictions -> labels -> metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from safelabel.catalog import CATEGORIES
from safelabel.functions.labels import is_correct, normalise_gold, normalise_pred
from safelabel.functions.scripts import tag_language
from safelabel.functions.vectors import winner
from safelabel.operators.confusion import classification_report, confusion, confusion_counts, prf, run_metrics
from safelabel.operators.ranking import distribution_metrics, distribution_sums, score_rows
from safelabel.session import stage_table


def normalised(predictions: DataFrame, policy: str = "full", gold: str = "gold", raw: str = "pred_raw") -> DataFrame:
    """Predictions with clean labels and a flag for the right ones."""
    rows = predictions.withColumn("gold", normalise_gold(gold)).withColumn("pred", normalise_pred(raw, policy))
    return rows.withColumn("correct", is_correct())


def evaluate_binary(predictions: DataFrame, policy: str = "full", by: list[str] | None = None) -> dict[str, DataFrame]:
    """All binary reports of a prediction table, each a small table.

    The predictions are read once; the counts of label pairs are written, and all
    reports are made from them.
    """
    counts = stage_table(confusion_counts(normalised(predictions, policy), by=by), "confusion")
    return {"metrics": run_metrics(counts, by=by, counted=True), "classes": prf(counts, by=by, counted=True),
            "confusion": confusion(counts, by=by, counted=True), "report": classification_report(counts, by=by, counted=True)}


def tagged(predictions: DataFrame, text: str = "text", out: str = "language") -> DataFrame:
    """Predictions with the language told from their text."""
    return predictions.withColumn(out, tag_language(text))


def evaluate_distributions(predictions: DataFrame, language: str = "language") -> dict[str, DataFrame]:
    """All reports of predicted distributions, overall and per language.

    The predictions are read once: one aggregate per language and pair of winners is
    written, a few hundred rows a language, and every report adds up its rows.
    """
    scored = score_rows(predictions).withColumns({
        "gold": F.when(F.col("parsed"), winner("truth_vector")), "pred": F.when(F.col("parsed"), winner("pred_vector"))})
    sums = stage_table(distribution_sums(scored, [language, "gold", "pred"]), "distribution-sums")
    counts = confusion_counts(sums.filter("parsed > 0").select(language, "gold", "pred", F.col("parsed").alias("n")),
                              CATEGORIES, [language], counted=True)
    return {"metrics": distribution_metrics(sums, language, overall=True, counted=True),
            "report": classification_report(counts, CATEGORIES, CATEGORIES, counted=True),
            "confusion": confusion(counts, CATEGORIES, counted=True),
            "report_by_language": classification_report(counts, "present", CATEGORIES, [language], counted=True)}
