"""Dataset reports: sizes, histograms, shares and cross tables.

Each report is one aggregate with map-side combine; shares, totals and ranks are
computed on its few result rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from safelabel.catalog import CATEGORIES, CATEGORY_NAMES, LANGUAGE_NAMES, WIDTH
from safelabel.functions.display import display_name, imbalance_band
from safelabel.functions.vectors import winner
from safelabel.operators.confusion import run_metrics
from safelabel.session import small_side

def _share(count: str = "n") -> Column:
    """Share of the total; for aggregates of a few rows, as the window is not partitioned."""
    return F.try_divide(F.col(count), F.sum(count).over(Window.partitionBy()))


def label_dimensions(df: DataFrame, category: str | None = "category", language: str | None = "language") -> DataFrame:
    """Add the display names of category and language codes."""
    if category:
        df = df.withColumn(f"{category}_name", display_name(category, CATEGORY_NAMES))
    if language:
        df = df.withColumn(f"{language}_name", display_name(language, LANGUAGE_NAMES))
    return df


def join_dimension(df: DataFrame, dimension: DataFrame, code: str) -> DataFrame:
    """Add ``name`` from a table of (code, name); an unknown code stands for itself."""
    names = dimension.select(F.col("code").alias(code), F.col("name").alias("_name"))
    joined = df.join(small_side(names), code, "left")
    return joined.withColumn("name", F.coalesce("_name", code)).drop("_name")


def bucket_sizes(df: DataFrame, keys: list[str] = ["source", "language"]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def _position(categories: list[str]) -> Column:
    """Place of the category in the list; names that are not in it come last, by name."""
    at = F.array_position(F.array(*[F.lit(c) for c in categories]), F.col("category"))
    return F.when(at > 0, at).otherwise(len(categories) + 1)


def category_histogram(df: DataFrame, vec: str, full: bool = False, by: str | None = None) -> DataFrame:
    """Rows per winning category with their share; ``full`` lists all categories."""
    groups = [by] if by else []
    counts = df.select(*groups, winner(vec).alias("category")).groupBy(*groups, "category").agg(F.count(F.lit(1)).alias("n"))
    if full:
        zeros = F.array(*[F.struct(F.lit(c).alias("category"), F.lit(0).cast("bigint").alias("n")) for c in CATEGORIES])
        empty = df.sparkSession.range(1).select(F.inline(zeros))
        counts = counts.unionByName(empty).groupBy("category").agg(F.sum("n").alias("n"))
    share = F.try_divide(F.col("n"), F.sum("n").over(Window.partitionBy(*groups)))
    return counts.withColumn("share", share).orderBy(*groups, F.desc("n"), _position(CATEGORIES))


def imbalance_verdict(histogram: DataFrame, category: str) -> DataFrame:
    """Share of one category, in percent, and the verdict on it."""
    percent = F.coalesce(F.try_divide(
        100 * F.sum(F.when(F.col("category") == category, F.col("n")).otherwise(0)), F.sum("n")), F.lit(0.0))
    return histogram.agg(percent.alias("percent")).select(F.lit(category).alias("category"), "percent", imbalance_band("percent").alias("verdict"))


def _cross_table(df: DataFrame, language: str, flags: dict[str, Column]) -> DataFrame:
    """Counts and percentages of flags per language, with a row for all languages."""
    counts = df.groupBy(language).agg(*[F.count_if(c).alias(name) for name, c in flags.items()], F.count(F.lit(1)).alias("total"))
    sums = counts.rollup(language).agg(*[F.sum(c).alias(c) for c in [*flags, "total"]], F.grouping_id().alias("_level"))
    return sums.select(
        F.when(F.col("_level") == 1, "(all)").otherwise(F.col(language)).alias(language), *flags, "total",
        *[F.round(F.try_divide(100 * F.col(c), F.col("total")), 2).alias(f"{c}_pct") for c in flags])


def label_by_language(df: DataFrame, label: str = "harmful", language: str = "language") -> DataFrame:
    """Safe and harmful rows per language and in all."""
    bad = F.col(label).cast("string") == "1"
    return _cross_table(df, language, {"safe": ~bad, "harmful": bad})


def profanity_by_language(df: DataFrame, flag: str = "profanity", language: str = "language") -> DataFrame:
    """Profane and other rows per language and in all."""
    bad = F.col(flag) == 1
    return _cross_table(df, language, {"non_profane": ~bad, "profane": bad})


def category_share(df: DataFrame, categories: str = "safety_categories") -> DataFrame:
    """Assignments per category; shares are of all assignments, not of rows."""
    names = F.filter(F.split(categories, " "), lambda c: c != "")
    return (df.select(F.explode(names).alias("category")).groupBy("category").agg(F.count(F.lit(1)).alias("n"))
            .withColumn("share", _share()))


def top_n_other(histogram: DataFrame, n: int = 6, other: str = "Others", categories: list[str] = CATEGORIES) -> DataFrame:
    """The ``n`` largest categories, the rest summed up."""
    order = Window.partitionBy().orderBy(F.desc("n"), _position(categories), "category")
    ranked = histogram.withColumn("_rank", F.row_number().over(order))
    return (ranked.groupBy(F.when(F.col("_rank") <= n, F.col("category")).otherwise(other).alias("category"))
            .agg(F.sum("n").alias("n")).withColumn("share", _share()))


def corr_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """Correlation of every pair of columns in long form, from one pass."""
    pairs = [(a, b) for a in cols for b in cols]
    row = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}|{b}") for a, b in pairs])
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"{a}|{b}").alias("corr")) for a, b in pairs])))


def text_stats(df: DataFrame, text: str = "text") -> DataFrame:
    """Shortest and longest text, in characters."""
    return df.agg(F.min(F.char_length(text)).alias("min_chars"), F.max(F.char_length(text)).alias("max_chars"))


def language_distribution(df: DataFrame, language: str = "language") -> DataFrame:
    return df.groupBy(language).agg(F.count(F.lit(1)).alias("n")).withColumn("share", _share())


def overview(df: DataFrame, vec: str, language: str = "language", width: int = WIDTH) -> DataFrame:
    """Rows, languages and categories in use.

    Categories are one flag for each position of the vector and languages are groups, so
    nothing is de-duplicated in a shuffle.
    """
    per_language = df.groupBy(language).agg(
        F.count(F.lit(1)).alias("n"), *[F.bool_or(F.get(F.col(vec), F.lit(i)) > 0).alias(f"_{i}") for i in range(width)])
    used = sum((F.coalesce(F.bool_or(f"_{i}"), F.lit(False)).cast("bigint") for i in range(width)), F.lit(0).cast("bigint"))
    return per_language.agg(F.sum("n").alias("rows"), F.count(language).alias("languages"), used.alias("categories"))


def compare_runs(df: DataFrame, run: str = "run", latency: str | None = None) -> DataFrame:
    """One row per run: agreement, correlation, F1 of both labels, mean latency."""
    table = run_metrics(df, by=[run])
    return table.join(mean_latency(df, [run], latency), run) if latency else table


def mean_latency(df: DataFrame, by: list[str] | None = None, latency: str = "latency_sec") -> DataFrame:
    return df.groupBy(*(by or [])).agg(F.avg(latency).alias("mean_latency_sec"))
