"""Columnar and delimited tables exported from a dataset hub."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from safelabel.sources.jsonl import read_jsonl

FORMATS = ("parquet", "orc", "json", "csv")


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | str | None = None) -> DataFrame:
    """A table in one of the ``FORMATS``; json and csv need a schema."""
    if fmt not in FORMATS:
        raise ValueError(f"fmt must be one of {FORMATS}")
    if fmt in ("parquet", "orc"):
        return spark.read.format(fmt).load(path)
    if schema is None:
        raise ValueError(f"{fmt} needs a schema, so that no pass is spent on guessing one")
    if fmt == "json":
        return read_jsonl(spark, path, schema)
    return spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"').csv(path)


def read_parquet_with_id(spark: SparkSession, path: str, id_col: str = "id") -> DataFrame:
    """A Parquet table without ids, each row named by its file and position.

    Stable across runs on the same files, and needs no shuffle even when many rows
    are copies of each other.
    """
    place = F.concat_ws("#", F.col("_metadata.file_path"), F.col("_metadata.row_index"))
    return spark.read.parquet(path).select("*", place.alias(id_col))
