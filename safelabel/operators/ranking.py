"""Metrics of predicted distributions against true ones.

Row metrics are Column expressions; they are summed per group, and totals over all
groups are sums of the few group rows rather than a second pass over the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from safelabel.functions.text import not_empty
from safelabel.functions.vectors import (
    average_precision, exact_match, jaccard, kl_divergence, parse_distribution, topk_recall, winner,
)
from safelabel.operators.scanning import keep_computed

ROW_METRICS = ["kl", "ap", "top1_recall", "top3_recall", "jaccard", "exact_match", "top1_correct"]


def score_rows(df: DataFrame, truth: str = "truth", pred: str = "pred_raw", text: str = "text") -> DataFrame:
    """Parse both distributions and add the metrics of each row.

    Metrics are null where either side does not parse, and those that need a positive
    category also where the truth has none.
    """
    usable = not_empty(text) & not_empty(truth)
    parsed = df.withColumn("truth_vector", F.when(usable, parse_distribution(truth))) \
        .withColumn("pred_vector", F.when(usable, parse_distribution(pred)))
    both = F.col("truth_vector").isNotNull() & F.col("pred_vector").isNotNull()
    args = ("truth_vector", "pred_vector")
    return parsed.withColumns({
        "usable": usable,
        "parsed": both,
        "truth_error": usable & F.col("truth_vector").isNull(),
        "format_error": F.col("truth_vector").isNotNull() & F.col("pred_vector").isNull(),
        "kl": F.when(both, kl_divergence(*args)),
        "ap": F.when(both, average_precision(*args)),
        "top1_recall": F.when(both, topk_recall(*args, 1)),
        "top3_recall": F.when(both, topk_recall(*args, 3)),
        "jaccard": F.when(both, jaccard(*args)),
        "exact_match": F.when(both, exact_match(*args)),
        "top1_correct": F.when(both, (winner("truth_vector") == winner("pred_vector")).cast("double")),
    })


def distribution_sums(scored: DataFrame, keys: list[str], means: list[str] | None = None) -> DataFrame:
    """Per group the counts, and the sum and number of each row metric and column of ``means``.

    Coarser groups follow from these rows by addition.
    """
    counts = {"rows": F.lit(True), "samples": F.col("usable"), "parsed": F.col("parsed"),
              "format_errors": F.col("format_error"), "truth_errors": F.col("truth_error")}
    measured = [*ROW_METRICS, *(means or [])]
    return scored.groupBy(*keys).agg(
        *[F.count_if(c).alias(name) for name, c in counts.items()],
        *[F.sum(m).alias(f"_{m}") for m in measured], *[F.count(m).alias(f"_n_{m}") for m in measured])


def distribution_metrics(scored: DataFrame, by: str | None = None, overall: bool = False,
                         means: list[str] | None = None, counted: bool = False) -> DataFrame:
    """Means of the row metrics with the counts behind them.

    ``rows`` counts everything, ``samples`` the rows with text and truth.  The overall
    ``success_rate`` is parsed rows over all rows; per group the rows whose *truth* is
    unreadable are not failures of the model, so ``group_success_rate`` is the samples
    without format errors over the samples.  With ``overall`` a row for all groups is
    added, whose group is null.  ``means`` names further columns to average.  With
    ``counted`` the input holds ``distribution_sums`` already, possibly of finer groups.
    """
    groups, counts = [by] if by else [], ["rows", "samples", "parsed", "format_errors", "truth_errors"]
    sums = scored if counted else distribution_sums(scored, groups, means)
    added = [F.sum(c).alias(c) for c in sums.columns if c in counts or c.startswith("_")]
    if by and overall:
        sums = sums.rollup(by).agg(*added, F.grouping_id().alias("_level"))
        sums = sums.withColumn("is_overall", F.col("_level") == 1)
    elif counted:
        sums = sums.groupBy(*groups).agg(*added)
    names = {"kl": "mean_kl", "ap": "map", "top1_recall": "top1_recall", "top3_recall": "top3_recall",
             "jaccard": "jaccard", "exact_match": "exact_match", "top1_correct": "top1_accuracy"}
    return sums.select(
        *groups, *(["is_overall"] if by and overall else []), *counts,
        F.try_divide("parsed", "rows").alias("success_rate"),
        F.try_divide(F.col("samples") - F.col("format_errors"), F.col("samples")).alias("group_success_rate"),
        *[F.try_divide(f"_{m}", f"_n_{m}").alias(name) for m, name in names.items()],
        *[F.try_divide(f"_{m}", f"_n_{m}").alias(f"mean_{m}") for m in means or []])


def compare_distribution_runs(scored: DataFrame, run: str = "run", latency: str | None = None) -> DataFrame:
    """One row per run: divergence, precision, recalls, overlap, exact match, failures, mean latency; one pass."""
    return distribution_metrics(scored, run, means=[latency] if latency else None)


def success_rate(scored: DataFrame) -> DataFrame:
    """Share of rows with a readable prediction, and the unreadable ones."""
    return distribution_metrics(scored).select("rows", "samples", "parsed", "format_errors", "truth_errors", "success_rate")


def winners(scored: DataFrame) -> DataFrame:
    """Top-1 labels of the parsed rows as ``gold`` and ``pred``, for the classification report."""
    top = F.struct(winner("truth_vector").alias("gold"), winner("pred_vector").alias("pred"))
    rows = keep_computed(scored.withColumn("_top", F.when(F.col("parsed"), top)), "_top", F.col("_top").isNotNull())
    return rows.withColumns({"gold": F.col("_top.gold"), "pred": F.col("_top.pred")}).drop("_top")


def best_by(df: DataFrame, group: str, metric: str, largest: bool = True) -> DataFrame:
    """The group with the largest (or smallest) metric; of equals the first by name."""
    value = F.col(metric) if largest else -F.col(metric)
    known = df.filter(F.col(metric).isNotNull())
    top = known.agg(F.min(F.struct((-value).alias("_v"), F.col(group).alias("g"), F.col(metric).alias("m"))).alias("_top"))
    return top.select(F.col("_top.g").alias(group), F.col("_top.m").alias(metric))


def best_of(df: DataFrame, group: str, metrics: dict[str, bool]) -> DataFrame:
    """``best_by`` for several metrics (True: the largest wins) as rows (metric, group, value), in one pass."""
    def top(metric: str, largest: bool) -> Column:
        value = -F.col(metric) if largest else F.col(metric)
        entry = F.struct(value.alias("_v"), F.col(group).alias("g"), F.col(metric).cast("double").alias("m"))
        return F.min(F.when(F.col(metric).isNotNull(), entry)).alias(f"_{metric}")

    tops = df.agg(*[top(metric, largest) for metric, largest in metrics.items()])
    return tops.select(F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(f"_{m}.g").alias(group), F.col(f"_{m}.m").alias("value")) for m in metrics])))


def mean_group_size(df: DataFrame, size: str = "samples") -> DataFrame:
    return df.agg(F.avg(size).alias("mean_size"))
