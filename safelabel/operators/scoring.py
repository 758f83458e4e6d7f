"""Batched scoring with a pluggable model, two-stage moderation, a trainable head."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from safelabel.catalog import SAFE, UNSAFE
from safelabel.functions.base import WORD, as_col
from safelabel.functions.vectors import moderation_response

# A model is made once per task by calling the factory; it maps a list of prompts to
# a list of answers of the same length.
Factory = Callable[[], Callable[[list], list]]


def answers_or_errors(model: Callable[[list], list], prompts: list, retries: int = 0) -> tuple[list, list]:
    """Answers of a model and errors, one of the two for each prompt.

    A batch that fails is halved until the failing prompt stands alone; that one is tried
    ``retries`` times more.  A batch of k failing prompts among n costs at most 2 k log2(n) calls
    beyond the first.
    """
    try:
        answers = list(model(prompts))
        if len(answers) != len(prompts):
            raise ValueError(f"{len(answers)} answers to {len(prompts)} prompts")
        return answers, [None] * len(prompts)
    except Exception as error:  # whatever the model raises belongs to its prompts
        if len(prompts) > 1:
            half = len(prompts) // 2
            left, right = (answers_or_errors(model, part, retries) for part in (prompts[:half], prompts[half:]))
            return left[0] + right[0], left[1] + right[1]
        return answers_or_errors(model, prompts, retries - 1) if retries > 0 else ([None], [f"{type(error).__name__}: {error}"])


# Rows that leave a Python worker at a time.
ROWS_OUT = 512


def prompt_batches(prompts: pa.Array, batch_size: int) -> Iterator[list]:
    """Prompts for one call each; only these are Python objects at a time."""
    for start in range(0, len(prompts), batch_size):
        yield prompts.slice(start, batch_size).to_pylist()


def answer_column(answers: list) -> pa.Array:
    """Answers as strings, also where a model gives numbers."""
    try:
        return pa.array(answers, pa.string(), from_pandas=True)
    except (pa.ArrowInvalid, pa.ArrowTypeError):
        return pa.array(answers, from_pandas=True).cast(pa.string())


def with_columns(frame: pa.RecordBatch, columns: dict[str, pa.Array]) -> Iterator[pa.RecordBatch]:
    """The rows with further columns, few at a time, without a copy of the rest."""
    whole = pa.RecordBatch.from_arrays([*frame.columns, *columns.values()], [*frame.schema.names, *columns])
    for start in range(0, whole.num_rows, ROWS_OUT):
        yield whole.slice(start, ROWS_OUT)


def score_batches(df: DataFrame, make_model: Factory, batch_size: int = 8, prompt: str = "prompt",
                  out: str = "pred_raw", latency: str | None = None, error: str | None = None, retries: int = 0) -> DataFrame:
    """Add the answer of a model to every row, and the seconds per row if asked.

    Rows stream through the Python workers in Arrow batches and stay in Arrow; of a batch only the
    prompts of one call are Python objects, and no partition is held in memory as a whole. Without
    ``error``, a prompt that fails fails the job; with it, its row has no answer and its error in
    the column of that name, and all other rows are scored.
    """
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.StringType())])
    if latency:
        schema = schema.add(latency, T.DoubleType())
    if error:
        schema = schema.add(error, T.StringType())
    isolated = answers_or_errors

    def run(frames):
        import time

        model = make_model()
        for frame in frames:
            answers, seconds, errors = [], [], []
            for batch in prompt_batches(frame.column(prompt), batch_size):
                began = time.perf_counter()
                if error:
                    got, failed = isolated(model, batch, retries)
                    errors.extend(failed)
                else:
                    got = model(batch)
                answers.extend(got)
                seconds.extend([(time.perf_counter() - began) / len(batch)] * len(batch))
            columns = {out: answer_column(answers)}
            if latency:
                columns[latency] = pa.array(seconds, pa.float64())
            if error:
                columns[error] = pa.array(errors, pa.string())
            yield from with_columns(frame, columns)

    return df.mapInArrow(run, schema)


def moderate(df: DataFrame, binary: Callable[[Column], Column], category: Callable[[Column], Column],
             text: str = "text", out: str = "response") -> DataFrame:
    """Two-stage moderation with Column rules as heads.

    ``binary`` gives SAFE or UNSAFE, ``category`` a vector; the second is evaluated on
    UNSAFE rows only.
    """
    rows = df.withColumn("_result", binary(F.col(text)))
    vec = F.when(F.col("_result") != SAFE, category(F.col(text)))
    return rows.withColumn("_vector", vec).withColumn(out, moderation_response("_result", "_vector")).drop("_result", "_vector")


def moderate_with_models(df: DataFrame, make_binary: Factory, make_category: Factory, batch_size: int = 8,
                         prompt: str = "prompt") -> DataFrame:
    """Raw answers of both heads in one pass; the second model sees UNSAFE rows only."""
    schema = T.StructType([*df.schema.fields, T.StructField("binary_raw", T.StringType()), T.StructField("category_raw", T.StringType())])
    unsafe = UNSAFE

    def run(frames):
        def in_batches(model, prompts):
            return [a for batch in prompt_batches(prompts, batch_size) for a in model(batch)]

        binary, category = make_binary(), make_category()
        for frame in frames:
            prompts = frame.column(prompt)
            first = in_batches(binary, prompts)
            flagged = [i for i, answer in enumerate(first) if answer is not None and unsafe in answer.upper()]
            second = [None] * len(prompts)
            for start in range(0, len(flagged), batch_size):
                some = flagged[start : start + batch_size]
                for i, answer in zip(some, category(prompts.take(pa.array(some)).to_pylist())):
                    second[i] = answer
            yield from with_columns(frame, {"binary_raw": answer_column(first), "category_raw": answer_column(second)})

    return df.mapInArrow(run, schema)


def fit_binary_head(train: DataFrame, text: str = "text", label: str = "label", kind: str = "linear_svc",
                    features: int = 1 << 18, max_iter: int = 20) -> PipelineModel:
    """Linear SAFE/UNSAFE classifier on hashed, IDF-weighted words."""
    classifiers = {"linear_svc": LinearSVC, "logistic": LogisticRegression}
    if kind not in classifiers:
        raise ValueError(f"kind must be one of {sorted(classifiers)}")
    stages = [
        RegexTokenizer(inputCol=text, outputCol="_words", pattern=f"{WORD}+", gaps=False),
        HashingTF(inputCol="_words", outputCol="_tf", numFeatures=features),
        IDF(inputCol="_tf", outputCol="_features"),
        classifiers[kind](featuresCol="_features", labelCol="_y", predictionCol="_prediction",
                          rawPredictionCol="_raw", maxIter=max_iter),
    ]
    rows = train.select(as_col(text), (F.col(label) == UNSAFE).cast("double").alias("_y"))
    return Pipeline(stages=stages).fit(rows)


def predict_binary_head(model: PipelineModel, df: DataFrame, out: str = "pred") -> DataFrame:
    """Add the label predicted by ``fit_binary_head``."""
    scored = model.transform(df)
    return scored.withColumn(out, F.when(F.col("_prediction") == 1.0, UNSAFE).otherwise(SAFE)).select(*df.columns, out)
