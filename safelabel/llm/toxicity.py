"""Toxicity by a classifier chain.

Categories are predicted one after another. The model of a category is linear: a logistic
regression with an L1 penalty over the words of a text and the first bytes of its words, as
far as they go with a class by more than ``SIGMAS`` standard deviations, and the
probabilities of all categories before it. For training these probabilities are out of fold:
each comes from a model that has not seen the row. For prediction they come from the models
fitted on all rows.

The chain is fitted on at most ``TRAIN_ROWS`` labelled rows, those with the smallest hash of
their id: a documented, fixed bound, so one task holds them. All documents are scored, each
whole text in one narrow pass; a model is a few hundred weights and is sent to the tasks.

Null and empty texts have no features. Labels that are null are left out for their category.
A category without both classes among the training rows gets a constant probability, 0 if it
has no rows. Repeated rows are scored each; null ids stay null. Extra columns are ignored.
Empty tables give an empty result, or constant probabilities if there are no labels.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from safelabel.llm.hashing import encoded
from safelabel.llm.store import named, unnamed, written

TRAIN_ROWS = 12_000
DIMENSIONS = 1 << 20
FOLDS = 3
PENALTY = 5e-5
STEPS = 300
LEAST_ROWS = 3
SIGMAS = 3
MODEL = "category string, bias double, chained array<double>, places array<int>, weights array<double>"
_NOT_WORD = bytes(c if chr(c).isalnum() or c >= 128 else 32 for c in range(256))


def features(text: str | bytes | None) -> np.ndarray:
    """Places of the distinct words and word beginnings of a text; A-Z count as a-z."""
    words = set(encoded(text).translate(_NOT_WORD).lower().split())
    heads = {w[:5] + b"*" for w in words if len(w) > 5}
    places = np.fromiter((zlib.crc32(w) for w in words | heads), np.int64, len(words) + len(heads))
    return np.unique(places & (DIMENSIONS - 1))


def _probability(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Linear:
    """Logistic regression with an L1 penalty on sparse 0/1 features, and free dense ones."""

    def __init__(self, rows: list[np.ndarray], dense: np.ndarray, y: np.ndarray):
        self.bias, self.chained = 0.0, np.zeros(dense.shape[1])
        self.places, self.weights = np.zeros(0, np.int64), np.zeros(0)
        if not len(y) or y.min() == y.max():
            self.bias = float(np.where(len(y) and y.max() > 0, 30.0, -30.0))
            return
        at = np.concatenate(rows)
        kinds, inverse, often = np.unique(at, return_inverse=True, return_counts=True)
        known = (often >= LEAST_ROWS) & (often <= len(y) // 2)
        # Features that go with neither class more than chance explains are left out first.
        share = y.mean()
        excess = np.bincount(inverse, np.repeat(y - share, [len(r) for r in rows]), len(kinds))
        known &= np.abs(excess) > SIGMAS * np.sqrt(often * share * (1 - share))
        kept = known[inverse]
        column = (np.cumsum(known) - 1)[inverse[kept]]
        owner = np.repeat(np.arange(len(y)), [len(r) for r in rows])[kept]
        kinds = kinds[known]
        w, free = np.zeros(len(kinds)), np.zeros(dense.shape[1] + 1)
        inputs = np.column_stack([dense, np.ones(len(y))])
        ahead, ahead_free, t = w, free, 1.0
        rate = 0.5
        for _ in range(STEPS):
            z = np.bincount(owner, ahead[column], len(y)) + inputs @ ahead_free
            error = _probability(z) - y
            # Features are scaled by how often they occur, so that rare ones move as fast.
            slope = np.bincount(column, error[owner], len(kinds)) / len(y)
            step = rate / np.sqrt(often[known] / len(y))
            moved = ahead - step * slope
            new = np.sign(moved) * np.maximum(np.abs(moved) - step * PENALTY, 0)
            new_free = ahead_free - rate * (inputs.T @ error) / len(y)
            # Steps that point back restart the momentum.
            back = ((ahead - new) * (new - w)).sum() > 0
            t_new = 1.0 if back else (1 + np.sqrt(1 + 4 * t * t)) / 2
            pull = 0.0 if back else (t - 1) / t_new
            ahead, ahead_free = new + pull * (new - w), new_free + pull * (new_free - free)
            w, free, t = new, new_free, t_new
        self.places, self.weights = kinds[w != 0], w[w != 0]
        self.chained, self.bias = free[:-1], float(free[-1])

    @classmethod
    def of(cls, bias: float, chained: Sequence[float], places: Sequence[int], weights: Sequence[float]) -> Linear:
        made = cls.__new__(cls)
        made.bias, made.chained = bias, np.array(chained, float)
        made.places, made.weights = np.array(places, np.int64), np.array(weights, float)
        return made

    def predict(self, rows: list[np.ndarray], dense: np.ndarray) -> np.ndarray:
        z = np.full(len(rows), self.bias)
        if len(self.chained):
            z += dense @ self.chained
        if len(self.places) and len(rows):
            at = np.concatenate(rows)
            owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
            place = np.minimum(np.searchsorted(self.places, at), len(self.places) - 1)
            hit = self.places[place] == at
            z += np.bincount(owner[hit], self.weights[place[hit]], len(rows))
        return _probability(z)


def fit_chain(sample: pd.DataFrame, categories: Sequence[str]) -> list[Linear]:
    """Models of the categories in order; ``sample`` has doc_id, text and a 0/1 column for each."""
    sample = sample.sort_values("doc_id", ignore_index=True)
    rows = [features(t) for t in sample["text"]]
    fold = np.arange(len(sample)) % FOLDS
    chain, earlier = [], np.zeros((len(sample), 0))
    for category in categories:
        y = sample[category].to_numpy(float, na_value=np.nan)
        known = np.flatnonzero(~np.isnan(y))
        pick = lambda at: [rows[i] for i in at]
        unseen = np.zeros(len(sample))
        for k in range(FOLDS):
            train, rest = known[fold[known] != k], np.flatnonzero(fold == k)
            unseen[rest] = Linear(pick(train), earlier[train], y[train]).predict(pick(rest), earlier[rest])
        chain.append(Linear(pick(known), earlier[known], y[known]))
        earlier = np.column_stack([earlier, unseen])
    return chain


def predict_chain(chain: list[Linear], texts: Sequence[str | None]) -> np.ndarray:
    """Probabilities, one column for each category."""
    rows = [features(t) for t in texts]
    out = np.zeros((len(rows), 0))
    for model in chain:
        out = np.column_stack([out, model.predict(rows, out)])
    return out


def _column(category: str) -> str:
    return "p_" + re.sub(r"\W", "_", category)


def fitted(documents: DataFrame, labels: DataFrame, categories: Sequence[str], rows: int = TRAIN_ROWS) -> DataFrame:
    """A table of models, one row for each category."""
    wanted = [F.col(c).cast("double").alias(c) for c in categories]
    one = labels.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("label_id"), *wanted)
    chosen = one.groupBy("label_id").agg(*[F.max(c).alias(c) for c in categories]).orderBy(F.xxhash64("label_id"), "label_id").limit(rows)
    sample = documents.join(F.broadcast(chosen), F.col("doc_id").cast("long") == F.col("label_id")).select(F.col("label_id").alias("doc_id"), "text", *categories)
    sample = sample.dropDuplicates(["doc_id"])

    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        chain = fit_chain(frame, categories)
        return pd.DataFrame(
            [(c, m.bias, m.chained.tolist(), m.places.tolist(), m.weights.tolist()) for c, m in zip(categories, chain, strict=True)],
            columns=["category", "bias", "chained", "places", "weights"])

    return written(sample.groupBy().applyInPandas(fit, MODEL))  # bounded by ``rows``


def _score(frames: Iterator[pd.DataFrame], chain: list[Linear], names: list[str]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for a in range(0, len(frame), 500):
            part = frame.iloc[a : a + 500]
            out = pd.DataFrame(predict_chain(chain, part["text"].tolist()), columns=names)
            out.insert(0, "doc_id", part["doc_id"].to_numpy())
            yield out


def score(documents: DataFrame, labels: DataFrame, categories: Sequence[str] = ("quality", "toxic"), rows: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, p_<category>..., <last category>) of every document; the last category is true from 0.5 on."""
    models = {r["category"]: r for r in fitted(documents, labels, categories, rows).collect()}
    chain = []
    for k, c in enumerate(categories):
        m = models.get(c)
        chain.append(Linear.of(m["bias"], m["chained"], m["places"], m["weights"]) if m else Linear.of(-30.0, [0.0] * k, [], []))
    sent = documents.sparkSession.sparkContext.broadcast(chain)
    names = [_column(c) for c in categories]
    spec = ", ".join(["doc_id long", *[f"{n} double" for n in names]])
    scored = documents.select(named("doc_id"), "text").mapInPandas(lambda frames: _score(frames, sent.value, names), spec)
    return unnamed(scored, "doc_id").withColumn(categories[-1], F.col(names[-1]) >= 0.5)

