"""Language tags by profiles of character trigrams, fitted on labelled rows.

A profile has a weight for each trigram and language: how much likelier a text of the
language holds it than a text of another one, as a logarithm in thousandths.  Weights are
whole numbers, so sums do not depend on the order of rows.  Each trigram of a text counts
once.  Fitting is one aggregate by trigram; tagging joins the trigrams of a text with the
profile and adds up in the task that holds the text, so one narrow row a text is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from safelabel.functions.lexicon import grams
from safelabel.session import small_side

GRAM_SIZE = 3


def _held(text: Column | str) -> Column:
    return F.explode(F.array_distinct(grams(F.lower(F.col(text) if isinstance(text, str) else text), GRAM_SIZE))).alias("gram")


def fit_language_profiles(df: DataFrame, languages: list[str], text: str = "text", language: str = "language", least: int = 5) -> DataFrame:
    """(gram, one weight column a language) from labelled rows; trigrams of fewer than ``least`` texts are left out.

    Rows without a text or of another language are not used.
    """
    rows = df.filter(F.col(text).isNotNull() & F.col(language).isin(languages)).select(F.col(language).alias("_language"), text)
    sums = lambda counted: [F.count_if(F.col("_language") == code).alias(code) for code in counted]
    totals = rows.agg(*sums(languages)).first().asDict()
    n = sum(totals.values())
    counts = rows.select("_language", _held(text)).groupBy("gram").agg(F.count("*").alias("_n"), *sums(languages)).filter(F.col("_n") >= least)

    def weight(code: str) -> Column:
        inside = (F.col(code) + 1) / F.lit(float(totals[code] + 2))
        outside = (F.col("_n") - F.col(code) + 1) / F.lit(float(n - totals[code] + 2))
        return F.round(1000 * (F.log(inside) - F.log(outside))).cast("long").alias(code)

    return counts.select("gram", *[weight(code) for code in languages])


def tag_by_profile(df: DataFrame, profiles: DataFrame, id_col: str, text: str = "text", margin: int = 50) -> DataFrame:
    """(id, tag, lead, known): the likeliest language of each text.

    ``known`` counts the text's trigrams that the profile has, ``lead`` is the weight by which the
    best language is ahead.  The tag is ``unknown`` if that is less than ``margin`` thousandths a
    known trigram, or none is known.  Equal weights go to the language named first.  Ids must be unique.
    """
    languages = [c for c in profiles.columns if c != "gram"]
    found = df.select(id_col, _held(text)).join(small_side(profiles), "gram")
    sums = found.groupBy(id_col).agg(F.count("*").alias("known"), *[F.sum(code).alias(code) for code in languages])
    ranked = F.sort_array(F.array(*[F.struct(F.col(code).alias("w"), F.lit(-k).alias("k"), F.lit(code).alias("name")) for k, code in enumerate(languages)]), False)
    told = sums.withColumn("_best", ranked).select(id_col, "known", F.col("_best")[0]["name"].alias("_tag"), (F.col("_best")[0]["w"] - F.get("_best", F.lit(1))["w"]).alias("lead"))
    tag = F.when(F.col("lead") >= F.lit(margin) * F.col("known"), F.col("_tag")).otherwise("unknown").alias("tag")
    return (df.select(id_col).join(told, id_col, "left")
            .select(id_col, F.coalesce(tag, F.lit("unknown")).alias("tag"), F.coalesce("lead", F.lit(0)).cast("long").alias("lead"), F.coalesce("known", F.lit(0)).cast("long").alias("known")))
