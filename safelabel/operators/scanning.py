"""Row checks at the edge of a job: rejects, guards and first rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from safelabel.functions.text import not_blank, not_empty
from safelabel.functions.vectors import parse_distribution

REJECTED = "_rejected"


def keep_computed(df: DataFrame, column: str, condition: Column) -> DataFrame:
    """Rows that meet a condition on one costly computed column.

    Written as a generator, not as a filter: a filter would be pushed below the
    projection that computes the column, and it would be computed twice.
    """
    kept = F.explode(F.when(condition, F.array(F.col(column)))).alias(column)
    return df.select(*[c for c in df.columns if c != column], kept).select(*df.columns)


def _all_present(cols: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])


def require_keys(df: DataFrame, cols: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with all keys present, and the rest.  An empty string is present."""
    ok = _all_present(cols)
    return df.filter(ok), df.filter(~ok)


def with_rejects(df: DataFrame, is_bad: Column) -> DataFrame:
    """Mark malformed rows instead of dropping them."""
    return df.withColumn(REJECTED, F.coalesce(is_bad, F.lit(True)))


def reject_summary(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Processed, valid and malformed rows, in one aggregate."""
    return df.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("processed"),
        F.count_if(~F.col(REJECTED)).alias("valid"),
        F.count_if(REJECTED).alias("malformed"),
    )


def scan_summary(df: DataFrame, distribution: str = "safety_distribution", by: list[str] | None = None) -> DataFrame:
    """``reject_summary`` of rows whose distribution does not parse."""
    return reject_summary(with_rejects(df, parse_distribution(distribution).isNull()), by)


def first_n(df: DataFrame, n: int, order_col: str = "id") -> DataFrame:
    """The first ``n`` rows in the order of ``order_col``."""
    return df.orderBy(order_col).limit(n)


def preview(df: DataFrame, n: int = 4, order_col: str = "id") -> DataFrame:
    """A handful of rows for display."""
    return df.orderBy(order_col).limit(n)


def require_text(df: DataFrame, text: str = "text", *others: str) -> DataFrame:
    """Drop rows whose text is blank or whose other columns are empty."""
    return df.filter(reduce(lambda a, b: a & b, [not_blank(text), *[not_empty(c) for c in others]]))
