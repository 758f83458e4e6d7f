"""Streaming moderation and restartable scoring.

Both are stateless, so every operator is the batch one.  Offsets and finished files
live in the checkpoint folder: after a crash the next run goes on where the last
complete batch ended, without losing or repeating rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from safelabel.catalog import SAFE, UNSAFE
from safelabel.functions.lexicon import Lexicon
from safelabel.functions.taxonomy import Taxonomy
from safelabel.functions.vectors import shares
from safelabel.operators.scoring import Factory, moderate, score_batches
from safelabel.session import stage_table
from safelabel.sources.jsonl import CORRUPT, parse_json_lines
from pyspark.sql import functions as F


def stream_jsonl(spark: SparkSession, path: str, schema: T.StructType | str, files_per_batch: int = 1000) -> DataFrame:
    """JSON-lines files as a stream; bad lines are dropped."""
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(path)
    return parse_json_lines(lines, schema)


def moderated(df: DataFrame, lexicon: Lexicon, taxonomy: Taxonomy, text: str = "text") -> DataFrame:
    """Two-stage moderation with the lexicon as first and the taxonomy as second head."""
    return moderate(
        df, lambda t: F.when(lexicon.any_term(t), UNSAFE).otherwise(SAFE), lambda t: shares(taxonomy.counts(t)), text)


def append_available(df: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Process what has arrived, append it as Parquet, and stop."""
    return (df.writeStream.format("parquet").outputMode("append").option("path", out)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def moderate_stream(spark: SparkSession, path: str, schema: T.StructType | str, out: str, checkpoint: str,
                    lexicon: Lexicon, taxonomy: Taxonomy, text: str = "text") -> StreamingQuery:
    """Moderate JSON lines as they arrive."""
    return append_available(moderated(stream_jsonl(spark, path, schema), lexicon, taxonomy, text), out, checkpoint)


def score_to_sink(spark: SparkSession, path: str, schema: T.StructType | str, out: str, checkpoint: str,
                  make_model: Factory, prompt: str = "prompt", batch_size: int = 8, files_per_batch: int = 50,
                  error: str | None = None, retries: int = 0) -> StreamingQuery:
    """Score JSON lines so that finished batches survive a crash of the job.

    With ``error``, a prompt that fails is a row with its error there, and cannot hold up its batch for ever.
    """
    scored = score_batches(stream_jsonl(spark, path, schema, files_per_batch), make_model, batch_size, prompt, error=error, retries=retries)
    return append_available(scored, out, checkpoint)


def split_stream(spark: SparkSession, path: str, schema: T.StructType | str, out: str, checkpoint: str,
                 transform: Callable[[DataFrame], DataFrame], files_per_batch: int = 1000) -> StreamingQuery:
    """Transform JSON lines as they arrive, and keep the rejected ones and the counts.

    Below ``out``: ``rows`` (the transformed good lines), ``rejects`` (``_corrupt_record``) and
    ``counts`` (processed, valid, malformed), each in a folder per batch, ``batch_id=N``.  A batch
    that runs again after a crash writes the same folders anew, so each line is there once.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        lines = stage_table(parse_json_lines(batch, schema, "keep"), "split-lines")
        bad = F.col(CORRUPT).isNotNull()
        counts = lines.agg(F.count("*").alias("processed"), F.count_if(~bad).alias("valid"), F.count_if(bad).alias("malformed"))
        for name, rows in (("rows", transform(lines.filter(~bad).drop(CORRUPT))), ("rejects", lines.filter(bad).select(CORRUPT)), ("counts", counts)):
            rows.write.mode("overwrite").parquet(f"{out}/{name}/batch_id={batch_id}")

    lines = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(path)
    return lines.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
