"""Weak labels from keyword counts, and their spread to translations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from safelabel.functions.taxonomy import Taxonomy
from safelabel.functions.text import clean_text, first_prompt, first_response
from safelabel.functions.vectors import category_list, harm_flag, shares, total, vector_to_map
from safelabel.operators.scanning import keep_computed

VECTOR = "category_vector"


def with_category_counts(df: DataFrame, taxonomy: Taxonomy, text: str = "text", out: str = "category_counts") -> DataFrame:
    return df.withColumn(out, taxonomy.counts(text))


def with_category_vector(df: DataFrame, taxonomy: Taxonomy, text: str = "text", out: str = VECTOR) -> DataFrame:
    """Share of each category among all keyword matches; zeros when nothing matches."""
    return df.withColumn(out, shares(taxonomy.counts(text)))


def with_dialogue_vector(df: DataFrame, taxonomy: Taxonomy, dialogue: str, out: str = VECTOR) -> DataFrame:
    """Vector of the first response of a nested dialogue column."""
    return df.withColumn(out, shares(taxonomy.counts(first_response(dialogue))))


def keep_labelled(df: DataFrame, vec: str = VECTOR) -> DataFrame:
    """Drop rows whose vector is all zero; the texts are scanned only once."""
    return keep_computed(df, vec, total(F.col(vec)) > 0)


def label_coverage(df: DataFrame, vec: str = VECTOR) -> DataFrame:
    """Rows seen and rows without any label."""
    return df.agg(F.count(F.lit(1)).alias("total_rows"), F.count_if(total(F.col(vec)) == 0).alias("unlabelled_rows"))


def propagate_labels(df: DataFrame, language_columns: dict[str, str], vec: str = VECTOR, source: str | None = None,
                     harm: str = "harmful") -> DataFrame:
    """One row per translation, carrying the label of the English response.

    The text is the prompt of the translation; a translation that is missing or too
    short is skipped on its own.  Unknown columns raise.  Where there is an ``id``, ``row_id``
    names the row: id and language.
    """
    missing = [c for c in language_columns.values() if c not in df.columns]
    if missing:
        raise ValueError(f"no such translation columns: {missing}")
    texts = F.array(*[
        F.struct(F.lit(code).alias("language"), clean_text(first_prompt(column)).alias("text"))
        for code, column in language_columns.items()])
    present = F.filter(texts, lambda t: t["text"].isNotNull())
    owned = set(language_columns.values()) | {"language", "text"}
    keep = [c for c in df.columns if c not in owned]
    rows = df.select(*keep, F.inline(present))
    rows = rows.withColumn("source", F.lit(source)) if source else rows
    # Translations of one dialogue share its id; samplers need one that names a row.
    rows = rows.withColumn("row_id", F.concat_ws("-", F.col("id").cast("string"), "language")) if "id" in rows.columns else rows
    return (rows.withColumn(harm, harm_flag(vec))
            .withColumn("safety_categories", category_list(vec))
            .withColumn("safety_distribution", vector_to_map(vec)))
