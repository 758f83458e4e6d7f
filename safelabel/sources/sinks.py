"""Result files."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_jsonl(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON lines: column order kept, nulls written, letters of all scripts as they are."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_predictions(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV with a header; quotes inside a value are doubled and outer spaces kept."""
    (df.write.mode(mode).option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def write_split(df: DataFrame, path: str, split: str = "split", mode: str = "errorifexists") -> None:
    """Train and test rows below ``split=train`` and ``split=test``, from one job."""
    df.write.mode(mode).partitionBy(split).option("ignoreNullFields", "false").json(path)
