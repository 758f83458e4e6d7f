"""Inputs of the registered queries, derived by Spark from the given tables.

Predictions, dialogues and malformed rows do not exist in the tables, so they are
derived from row ids with md5: the hex digits of a row decide which variant it shows.
``oracles.py`` states the same rules in SQL.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from safelabel.catalog import CATEGORIES, EXAMPLE_LEXICON, EXAMPLE_TAXONOMY, SAFE, UNSAFE, WIDTH
from safelabel.functions.base import let
from safelabel.functions.lexicon import Lexicon
from safelabel.functions.taxonomy import Taxonomy
from safelabel.functions.vectors import category_list, format_distribution, harm_flag, vector_to_map
from safelabel.operators.labelling import keep_labelled, with_category_vector
from safelabel.session import stage_table

TAXONOMY = Taxonomy(EXAMPLE_TAXONOMY)
LEXICON = Lexicon(EXAMPLE_LEXICON)
SEED = 7


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def documents(spark: SparkSession, sf: str) -> DataFrame:
    """doc_id, text, language, source."""
    return table(spark, sf, "documents").select("doc_id", "text", F.col("lang").alias("language"), "source")


def lexicon_table(spark: SparkSession) -> DataFrame:
    columns = [list(c) for c in zip(*EXAMPLE_LEXICON)]
    return spark.createDataFrame(pa.table(columns, names=["language", "term"]))


def digit(salt: str, at: int = 1, id_col: str = "doc_id") -> Column:
    """A hex digit of a row."""
    return F.substring(F.md5(F.concat_ws("|", F.lit(salt), F.col(id_col).cast("string"))), at, 1)


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with their weak vector in ``v``."""
    return with_category_vector(documents(spark, sf), TAXONOMY, out="v")


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with a label, in the shape of the main table."""
    rows = keep_labelled(vectors(spark, sf), "v")
    return rows.withColumns({
        "harmful": harm_flag("v"), "safety_categories": category_list("v"), "safety_distribution": format_distribution("v")})


def labelled_table(spark: SparkSession, sf: str) -> DataFrame:
    """The same, written once, for operators that read their input several times."""
    return stage_table(labelled(spark, sf), "labelled")


def dialogues(spark: SparkSession, sf: str) -> DataFrame:
    """First prompt and response of each conversation, with mock translations.

    Some translations are missing, and some have too few levels.
    """
    turns = table(spark, sf, "conversations")
    first = lambda role: F.min_by(F.when(F.col("role") == role, F.col("text")), F.when(F.col("role") == role, F.col("turn")))
    pairs = turns.groupBy("conv_id").agg(first("user").alias("p"), first("assistant").alias("r"))
    nested = lambda tag: F.array(F.array(F.concat(F.lit(tag), F.col("p")), F.concat(F.lit(tag), F.col("r"))))
    none = F.lit(None).cast("array<array<string>>")
    return pairs.select(
        "conv_id",
        F.array(F.array("p", "r")).alias("eng_Latn"),
        F.when(digit("bn", 1, "conv_id") < "4", none).otherwise(nested("bn: ")).alias("ben_Beng"),
        F.when(digit("kn", 1, "conv_id") < "4", F.array().cast("array<array<string>>")).otherwise(nested('kn, "')).alias("kan_Kadn"),
        F.when(digit("ml", 1, "conv_id") < "4", F.array(F.array().cast("array<string>"))).otherwise(nested("ml ")).alias("mal_Mlym"),
        nested("or ").alias("ory_Orya"))


def binary_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with a harm label."""
    toxic = table(spark, sf, "labels").select("doc_id", F.col("toxic").cast("string").alias("harmful"))
    return documents(spark, sf).join(toxic, "doc_id")


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Gold from the labels, raw predictions from the lexicon, both with odd variants."""
    d, g = digit("pred"), digit("gold")
    raw = (F.when(d == "0", "maybe").when(d == "1", " unsafe. ").when(d == "2", "1").when(d == "3", "HARMFUL")
           .when(d == "4", F.lit(None)).when(LEXICON.any_term("text"), UNSAFE).otherwise(SAFE))
    gold = F.when(g == "0", "n/a").when(F.col("harmful") == "1", F.when(g == "1", " Unsafe\n").otherwise(UNSAFE)).otherwise(SAFE)
    return binary_rows(spark, sf).withColumns({
        "gold": gold, "pred_raw": raw, "run": F.when(digit("run") < "8", "run_a").otherwise("run_b")})


def distribution_text(salt: str) -> Column:
    """``{S1: 0.2, S2: 0, ...}`` with values from the hex digits of a row, or a variant of it."""
    hashed = F.md5(F.concat_ws("|", F.lit(salt), F.col("doc_id").cast("string")))
    values = F.filter(F.split(F.translate(hashed, "0123456789abcdef", "0000000000123456"), ""), lambda d: d != "")
    numbers = F.transform(F.slice(values, 1, WIDTH), lambda d: F.when(d == "0", F.lit("0")).otherwise(F.concat(F.lit("0."), d)))
    kind = digit("kind " + salt)

    def variant(ns: Column) -> Column:
        items = F.transform(ns, lambda n, i: F.concat(F.lit("S"), (i + 1).cast("string"), F.lit(": "), n))
        full = F.array_join(items, ", ")
        return (F.when(kind == "0", F.array_join(F.slice(items, 1, WIDTH - 1), ", "))
                .when(kind == "1", F.concat(full, F.lit(".5.")))
                .when(kind == "2", F.concat(F.lit('{"'), F.replace(F.replace(full, F.lit(": "), F.lit('": ')), F.lit(", "), F.lit(', "')), F.lit("}")))
                .when(kind == "3", F.concat(F.lit("{"), full, F.lit("e-05}")))
                .when(kind == "4", F.array_join(ns, " "))
                .when(kind == "5", F.lit(None).cast("string"))
                .when(kind == "6", F.regexp_replace(full, r"0\.\d", "0"))
                .otherwise(F.concat(F.lit("{"), full, F.lit("}"))))

    return let(numbers, variant)


def distributions(spark: SparkSession, sf: str) -> DataFrame:
    """True and predicted distribution of each document as text."""
    return documents(spark, sf).withColumns({"truth": distribution_text("truth"), "pred_raw": distribution_text("guess")})


def micro(vec: str | Column) -> Column:
    """A vector as text, in whole millionths."""
    vec = F.col(vec) if isinstance(vec, str) else vec
    return F.array_join(F.transform(vec, lambda x: F.round(x * 1_000_000).cast("bigint")), ",")


def map_text(m: str | Column) -> Column:
    """A category map as text: entries in category order, values in whole millionths."""
    m = F.col(m) if isinstance(m, str) else m
    entries = F.array(*[
        F.when(F.try_element_at(m, F.lit(c)).isNotNull(), F.concat(
            F.lit(f"{c}="), F.round(F.try_element_at(m, F.lit(c)) * 1_000_000).cast("bigint").cast("string")))
        for c in CATEGORIES])
    return F.when(m.isNotNull(), F.array_join(entries, ","))


def ints(arr: Column) -> Column:
    return F.array_join(F.transform(arr, lambda x: x.cast("string")), ",")


def six(*cols: str) -> dict[str, Column]:
    """Doubles rounded to six places, as sums may differ in their last bits."""
    return {c: F.round(F.col(c).cast("double"), 6) for c in cols}


def category_map(vec: str = "v") -> Column:
    return vector_to_map(vec)
