"""Classification metrics from gold and predicted labels.

All of them start from counts per (gold, predicted) pair: one pass with map-side
combine, whose result has as many rows as there are pairs of labels.  Everything
after it works on that small table.  ``by`` computes the metrics per group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from safelabel.catalog import BINARY_LABELS


def _ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom``, or 0 where undefined."""
    return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))


def _class_metrics() -> list[Column]:
    tp, predicted, support = F.col("tp"), F.col("predicted"), F.col("support")
    return [_ratio(tp, predicted).alias("precision"), _ratio(tp, support).alias("recall"),
            _ratio(2 * tp, predicted + support).alias("f1")]


def confusion_counts(df: DataFrame, valid_gold: list[str] | None = BINARY_LABELS, by: list[str] | None = None,
                     gold: str = "gold", pred: str = "pred", counted: bool = False) -> DataFrame:
    """Rows per pair of gold and predicted label, for rows with a valid gold label.

    An unknown prediction stays in: it is a wrong answer, not a missing row.  With
    ``counted`` the input holds such counts already, possibly of finer groups.
    """
    rows = df if valid_gold is None else df.filter(F.col(gold).isin(valid_gold))
    size = F.col("n") if counted else F.lit(1)
    rows = rows.select(*(by or []), F.col(gold).alias("gold"), F.col(pred).alias("pred"), size.alias("n"))
    total = F.sum("n") if counted else F.count(F.lit(1))
    return rows.groupBy(*(by or []), "gold", "pred").agg(total.alias("n"))


def class_stats(counts: DataFrame, by: list[str] | None = None, labels: list[str] | None = None) -> DataFrame:
    """Per label: true positives, support (gold) and predicted, zero-filled for ``labels``.

    ``known`` is the support among rows whose prediction is one of the ``labels``.
    """
    def entry(label: Column, tp: Column, support: Column, known: Column, predicted: Column) -> Column:
        parts = {"tp": tp, "support": support, "known": known, "predicted": predicted}
        return F.struct(label.alias("label"), *[c.cast("bigint").alias(name) for name, c in parts.items()])

    zero, n = F.lit(0), F.col("n")
    known = n if labels is None else F.when(F.col("pred").isin(labels), n).otherwise(zero)
    entries = [
        entry(F.col("gold"), F.when(F.col("gold") == F.col("pred"), n).otherwise(zero), n, known, zero),
        entry(F.col("pred"), zero, zero, zero, n),
        *[entry(F.lit(label), zero, zero, zero, zero) for label in labels or []],
    ]
    return (counts.select(*(by or []), F.inline(F.array(*entries))).groupBy(*(by or []), "label")
            .agg(*[F.sum(c).alias(c) for c in ("tp", "support", "known", "predicted")]))


def prf(df: DataFrame, labels: list[str] = BINARY_LABELS, valid_gold: list[str] | None = BINARY_LABELS,
        by: list[str] | None = None, counted: bool = False) -> DataFrame:
    """Precision, recall, F1 and support of each label; 0 where undefined."""
    stats = class_stats(confusion_counts(df, valid_gold, by, counted=counted), by, labels)
    return stats.filter(F.col("label").isin(labels)).select(*(by or []), "label", *_class_metrics(), "support")


def run_metrics(df: DataFrame, labels: list[str] = BINARY_LABELS, valid_gold: list[str] | None = BINARY_LABELS,
                by: list[str] | None = None, counted: bool = False) -> DataFrame:
    """All single-number metrics of a run (or of each group) from one pass.

    Valid rows, accuracy, balanced accuracy (mean recall of the classes in gold),
    Cohen's kappa over all labels of gold and prediction, the Matthews correlation of
    the rows whose labels are both in ``labels``, and the F1 of each of the ``labels``.
    """
    stats = class_stats(confusion_counts(df, valid_gold, by, counted=counted), by, labels)
    listed = F.col("label").isin(labels)
    product = lambda a, b: F.sum(F.when(listed, F.col(a).cast("double") * F.col(b)))
    f1 = _ratio(2 * F.col("tp"), F.col("predicted") + F.col("support"))
    sums = stats.groupBy(*(by or [])).agg(
        F.sum("support").alias("valid"), F.sum("tp").alias("_right"),
        F.avg(F.try_divide("tp", "support")).alias("balanced_accuracy"),
        F.sum(F.col("support").cast("double") * F.col("predicted")).alias("_chance"),
        F.sum(F.when(listed, F.col("known"))).cast("double").alias("_n"),
        F.sum(F.when(listed, F.col("tp"))).cast("double").alias("_c"),
        product("known", "predicted").alias("_kp"), product("known", "known").alias("_kk"), product("predicted", "predicted").alias("_pp"),
        *[F.max(F.when(F.col("label") == label, f1)).alias(f"f1_{label.lower()}") for label in labels])
    accuracy_ = F.try_divide("_right", "valid")
    expected = F.col("_chance") / (F.col("valid").cast("double") * F.col("valid"))
    n2 = F.col("_n") * F.col("_n")
    spread = F.sqrt((n2 - F.col("_pp")) * (n2 - F.col("_kk")))
    return sums.filter("valid > 0").select(
        *(by or []), "valid", accuracy_.alias("accuracy"), "balanced_accuracy",
        F.try_divide(accuracy_ - expected, 1 - expected).alias("kappa"),
        _ratio(F.col("_c") * F.col("_n") - F.col("_kp"), spread).alias("mcc"),
        *[f"f1_{label.lower()}" for label in labels])


def agreement(df: DataFrame, valid_gold: list[str] | None = BINARY_LABELS, by: list[str] | None = None, counted: bool = False) -> DataFrame:
    """Valid rows, accuracy, balanced accuracy and Cohen's kappa."""
    return run_metrics(df, valid_gold=valid_gold, by=by, counted=counted).select(
        *(by or []), "valid", "accuracy", "balanced_accuracy", "kappa")


def accuracy(df: DataFrame, valid_gold: list[str] | None = BINARY_LABELS, by: list[str] | None = None) -> DataFrame:
    return run_metrics(df, valid_gold=valid_gold, by=by).select(*(by or []), "valid", "accuracy")


def balanced_accuracy(df: DataFrame, valid_gold: list[str] | None = BINARY_LABELS, by: list[str] | None = None) -> DataFrame:
    return run_metrics(df, valid_gold=valid_gold, by=by).select(*(by or []), "balanced_accuracy")


def cohen_kappa(df: DataFrame, valid_gold: list[str] | None = BINARY_LABELS, by: list[str] | None = None) -> DataFrame:
    return run_metrics(df, valid_gold=valid_gold, by=by).select(*(by or []), "kappa")


def mcc(df: DataFrame, labels: list[str] = BINARY_LABELS, by: list[str] | None = None, counted: bool = False) -> DataFrame:
    return run_metrics(df, labels, labels, by, counted).select(*(by or []), "mcc")


def confusion(df: DataFrame, labels: list[str] = BINARY_LABELS, by: list[str] | None = None, counted: bool = False) -> DataFrame:
    """Confusion matrix in long form, every pair of ``labels`` present."""
    counts = confusion_counts(df, labels, by, counted=counted)
    names = F.array(*[F.lit(label) for label in labels])
    pairs = F.flatten(F.transform(names, lambda g: F.transform(
        names, lambda p: F.struct(g.alias("gold"), p.alias("pred"), F.lit(0).cast("bigint").alias("n")))))
    cells = counts.select(*(by or []), F.inline(F.concat(F.array(F.struct("gold", "pred", "n")), pairs)))
    return (cells.filter(F.col("pred").isin(labels)).groupBy(*(by or []), "gold", "pred")
            .agg(F.sum("n").alias("n")))


def confusion_matrix(df: DataFrame, labels: list[str] = BINARY_LABELS, by: list[str] | None = None, counted: bool = False) -> DataFrame:
    """Confusion matrix with one row per gold label and one column per prediction."""
    return confusion(df, labels, by, counted).groupBy(*(by or []), "gold").pivot("pred", labels).agg(F.first("n"))


def classification_report(df: DataFrame, labels: list[str] | str = BINARY_LABELS,
                          valid_gold: list[str] | None = BINARY_LABELS, by: list[str] | None = None,
                          counted: bool = False) -> DataFrame:
    """Per-label metrics and their averages.

    With ``labels="present"`` the labels that occur in gold or prediction are used.
    The overall row is ``accuracy`` when the labels cover everything that occurs, and
    ``micro avg`` when they do not (for instance when UNKNOWN was predicted).
    """
    by = by or []
    fixed = None if labels == "present" else labels
    stats = class_stats(confusion_counts(df, valid_gold, by, counted=counted), by, fixed)
    listed = F.lit(True) if fixed is None else F.col("label").isin(fixed)
    stats = stats.withColumn("_listed", listed).withColumn("_left_out", F.max((~listed).cast("int")).over(Window.partitionBy(*by)))
    rows = stats.filter("_listed").select(*by, "label", *_class_metrics(), "support", "tp", "predicted", "_left_out")
    weighted = lambda c: _ratio(F.sum(F.col(c) * F.col("support")), F.sum("support"))
    sums = rows.groupBy(*by).agg(
        F.array_sort(F.collect_list(F.struct("label", "precision", "recall", "f1", "support"))).alias("_classes"),
        F.max("_left_out").alias("_left_out"), F.sum("support").alias("_n"), F.sum("tp").alias("_tp"), F.sum("predicted").alias("_p"),
        *[F.avg(c).alias(f"_macro_{c}") for c in ("precision", "recall", "f1")],
        *[weighted(c).alias(f"_weighted_{c}") for c in ("precision", "recall", "f1")])

    def line(label: Column, precision: Column, recall: Column, f1: Column) -> Column:
        return F.struct(label.alias("label"), precision.alias("precision"), recall.alias("recall"),
                        f1.alias("f1"), F.col("_n").alias("support"))

    averages = F.array(
        line(F.when(F.col("_left_out") == 1, "micro avg").otherwise("accuracy"),
             _ratio(F.col("_tp"), F.col("_p")), _ratio(F.col("_tp"), F.col("_n")), _ratio(2 * F.col("_tp"), F.col("_p") + F.col("_n"))),
        *[line(F.lit(f"{name} avg"), *[F.col(f"_{name}_{c}") for c in ("precision", "recall", "f1")]) for name in ("macro", "weighted")])
    return sums.select(*by, F.inline(F.concat("_classes", averages)))


def active_classes(report: DataFrame) -> DataFrame:
    """Classes with support, the largest first."""
    return report.filter("support > 0").orderBy(F.desc("support"), "label")


def misclassified(df: DataFrame, gold: str = "gold", pred: str = "pred") -> DataFrame:
    return df.filter(F.col(gold) != F.col(pred))
