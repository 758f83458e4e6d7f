"""A training corpus from raw documents in five stages; part of the subpackage ``llm``.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. All but
the last return the columns of ``documents``; ``run`` writes each result as Parquet to the
shared folder and reads it back for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from safelabel.llm import decontamination, jaccard_join, packing, quality, suffix_dedup
from safelabel.llm.queries import _tokenizer_path
from safelabel.llm.store import table, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return jaccard_join.keep_one(docs)


#: Passages of over 50 words of some five letters count as repeats.
REPEAT_BYTES = 50 * 6


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte strings of ``REPEAT_BYTES`` or more that start anywhere else are cut out; the rows stay."""
    return suffix_dedup.remove_repeats(docs, REPEAT_BYTES)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of 1024."""
    return packing.packed_sequences(docs, _tokenizer_path())


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("benchmark decontamination", benchmark_leaks),
    ("best-fit packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


#: Tokenizing and suffix indexes are beyond SQL; the tests hold ``run`` against a brute-force version.
ORACLE_SQL = None
