"""JSON-lines scans that tolerate or reject bad lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from safelabel.functions.base import strip

CORRUPT = "_corrupt_record"
MODES = ("drop", "keep", "fail")


def parse_json_lines(lines: DataFrame, schema: T.StructType | str, mode: str = "drop", line: str = "value") -> DataFrame:
    """Columns of a schema from lines of JSON objects; works on streams too.

    Blank lines are skipped.  A line that is no object of the schema is dropped
    (``drop``), kept with nulls and its text in ``_corrupt_record`` (``keep``), or
    fails the job (``fail``).
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    text = strip(line)
    options = {"mode": "FAILFAST"} if mode == "fail" else {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = F.from_json(text, schema if mode == "fail" else full, options)
    if mode == "fail":
        parsed = F.when(F.startswith(text, F.lit("{")), parsed).otherwise(
            F.raise_error(F.concat(F.lit("no JSON object: "), F.col(line))))
    rows = lines.filter(text != "").select(F.col(line).alias("_line"), parsed.alias("_row"))
    if mode == "fail":
        return rows.select("_row.*")
    bad = F.col("_row").isNull() | F.col(f"_row.{CORRUPT}").isNotNull() | ~F.startswith(strip("_line"), F.lit("{"))
    if mode == "drop":
        # A generator, as a filter would be pushed down and parse every line twice.
        return rows.select(F.explode(F.when(~bad, F.array("_row"))).alias("_row")).select("_row.*").drop(CORRUPT)
    fields = [F.when(~F.col("_bad"), F.col(f"_row.`{f.name}`")).alias(f.name) for f in schema.fields]
    return rows.withColumn("_bad", bad).select(*fields, F.when(F.col("_bad"), F.col("_line")).alias(CORRUPT))


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str, mode: str = "drop") -> DataFrame:
    """Scan JSON-lines files with a fixed schema; see ``parse_json_lines``."""
    return parse_json_lines(spark.read.text(path), schema, mode)
