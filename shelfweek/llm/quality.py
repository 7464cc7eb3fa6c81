"""Quality classifier: naive Bayes support vectors on n-grams of bytes, and on n-grams of
words that are all the same.

Which n-grams a text holds is an indicator vector; each indicator is scaled by the log-count
ratio of its n-gram between the classes, the vector is brought to length one, and a linear
hinge-loss model is fitted to it by dual coordinate descent. Margins become probabilities by
a logistic curve fitted on margins of rows the model had not seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .arrow_text import raw, text_slices
from .scratch import sent

#: n-grams are hashed to so many buckets.
BUCKETS = 1 << 16
ORDERS = (1, 2, 3)
#: One word so many times in a row is an n-gram, whatever the word; they have the first buckets.
REPEATS = (2, 3, 4, 6, 8, 16)
#: Labelled rows a model is fitted on, at most, of each class; those with the smallest hash
#: of their id. Everything else covers all rows.
PER_CLASS = 2000
#: Different texts under one labelled id, at most; those with the smallest hash.
PER_ID = 4
#: Bytes of a text looked at together.
STRETCH = 1 << 20


def ngrams(text: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """The buckets of all n-grams in the bytes of a text, each once, in rising order.
    ``seen`` is a cleared array of BUCKETS flags, and is cleared again."""
    words = text.tobytes().split()
    same = np.fromiter(map(eq, words, islice(words, 1, None)), bool, max(len(words) - 1, 0))
    if same.any():
        edges = np.flatnonzero(np.diff(np.concatenate([[0], same.view(np.int8), [0]])))
        longest = int((edges[1::2] - edges[::2]).max()) + 1
        seen[[k for k, n in enumerate(REPEATS) if n <= longest]] = True
    for at in range(0, len(text), STRETCH):
        part = text[at : at + STRETCH + max(ORDERS) - 1].astype(np.uint32)
        for n in ORDERS:
            if len(part) < n:
                continue
            code = np.full(len(part) - n + 1, n, np.uint32)
            for k in range(n):
                code = code * np.uint32(0x01000193) ^ part[k : len(part) - n + 1 + k]
            code *= np.uint32(0x9E3779B1)
            seen[code >> np.uint32(16)] = True
    found = np.flatnonzero(seen)
    seen[found] = False
    return found


def log_count_ratios(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Per bucket the log of its smoothed share among class 1 over that among class 0."""
    shares = []
    for label in (1, 0):
        own = [r for r, y in zip(rows, labels) if y == label]
        count = 1 + np.bincount(np.concatenate(own or [np.zeros(0, np.int64)]), minlength=BUCKETS)
        shares.append(count / count.sum())
    return np.log(shares[0] / shares[1])


def dual_descent(rows, values, labels, cost, rounds: int = 12) -> tuple[np.ndarray, float]:
    """Weights and bias of the hinge-loss model, by coordinate descent on its dual: row i has
    a multiplier from 0 to cost[i], moved to its best value while the others stay."""
    rng = np.random.default_rng(0)
    sign = np.where(labels == 1, 1.0, -1.0)
    weights, bias, alpha = np.zeros(BUCKETS), 0.0, np.zeros(len(rows))
    norm = np.array([v @ v + 1 for v in values])
    for _ in range(rounds):
        for i in rng.permutation(len(rows)):
            gradient = sign[i] * (weights[rows[i]] @ values[i] + bias) - 1
            moved = min(max(alpha[i] - gradient / norm[i], 0.0), cost[i])
            step = (moved - alpha[i]) * sign[i]
            if step:
                weights[rows[i]] += step * values[i]
                bias += step
                alpha[i] = moved
    return weights, bias


def logistic_curve(margins, labels, weight, rounds: int = 50) -> tuple[float, float]:
    """Slope and intercept of the weighted logistic fit, by Newton steps; lightly damped, so
    that separated classes have an answer too."""
    x = np.stack([margins, np.ones(len(margins))], 1)
    beta = np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (weight * (labels - p)) - 1e-3 * weight.sum() * beta * [1, 0]
        curve = (x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x
        step = np.linalg.solve(curve + 1e-3 * weight.sum() * np.diag([1, 1e-6]), gradient)
        beta += step
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(beta[1])


@dataclass
class Model:
    weights: np.ndarray  #: by bucket, the ratio included
    ratios: np.ndarray
    bias: float
    slope: float
    intercept: float

    def margin(self, found: np.ndarray) -> float:
        if not len(found):
            return self.bias
        own = self.ratios[found]
        return float(self.weights[found] @ own) / max(float(np.sqrt(own @ own)), 1e-12) + self.bias

    def score(self, found: np.ndarray) -> float:
        at = self.slope * self.margin(found) + self.intercept
        return float(1 / (1 + np.exp(-np.clip(at, -30, 30))))


def _fit_linear(rows, labels) -> Model:
    ratios = log_count_ratios(rows, labels)
    values = [ratios[r] / max(np.sqrt((ratios[r] ** 2).sum()), 1e-12) for r in rows]
    share = np.array([(labels == 0).mean(), (labels == 1).mean()])
    cost = 4.0 / (2 * np.maximum(share[labels], 1e-9))
    weights, bias = dual_descent(rows, values, labels, cost)
    return Model(weights, ratios, bias, 1.0, 0.0)


def fit(rows: list[np.ndarray], labels: np.ndarray, totals: tuple[int, int]) -> Model:
    """A model from n-gram rows and 0/1 labels; ``totals``: rows of class 0 and 1 that the
    sample stands for. Without two rows of either class the score is the classes' share."""
    sampled = np.bincount(labels, minlength=2)
    if sampled.min() < 2:
        prior = np.log((totals[1] + 1) / (totals[0] + 1))
        return Model(np.zeros(BUCKETS), np.zeros(BUCKETS), 0.0, 0.0, float(prior))
    part = np.empty(len(rows), int)
    for label in (0, 1):
        part[labels == label] = np.arange((labels == label).sum()) % 2
    margins = np.empty(len(rows))
    for k in (0, 1):
        half = _fit_linear([r for r, p in zip(rows, part) if p != k], labels[part != k])
        margins[part == k] = [half.margin(r) for r, p in zip(rows, part) if p == k]
    weight = (np.array(totals) / sampled)[labels]
    model = _fit_linear(rows, labels)
    model.slope, model.intercept = logistic_curve(margins, labels, weight)
    return model


def _training_ids(labels: DataFrame, id_col: str, label_col: str, held_out) -> tuple[DataFrame, tuple]:
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y"))
    known = known.where(F.col("_id").isNotNull() & F.col("_y").isin(0, 1) & ~held_out(F.col("_id")))
    known = known.groupBy("_id").agg(F.min("_y").alias("_y"))
    counts = {r._y: r.n for r in known.groupBy("_y").agg(F.count("*").alias("n")).collect()}
    part = [
        known.where(F.col("_y") == y).orderBy(F.xxhash64("_id"), "_id").limit(PER_CLASS) for y in (0, 1)
    ]
    return part[0].union(part[1]), (counts.get(0, 0), counts.get(1, 0))


def in_held_out_fold(id_column):
    """Whether crc32 of the id as text leaves no remainder by 5; false for a null id."""
    return F.coalesce(F.crc32(id_column.cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", label_col="quality") -> Model:
    """Fit on labelled rows outside the held-out fold, at most PER_CLASS ids of each class and
    PER_ID different texts of each id.
    Contradicting labels of an id count as its lowest; null and other labels not at all."""
    chosen, totals = _training_ids(labels, id_col, label_col, in_held_out_fold)
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    # at most 2 * PER_CLASS ids
    rows = rows.join(F.broadcast(chosen), "_id").select("_id", "_y", "_text")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(BUCKETS, bool)
        for batch in batches:
            for part, texts in text_slices(batch, 2):
                offsets, data = raw(texts)
                data = np.frombuffer(data, np.uint8)
                found = [
                    ngrams(data[a:b], seen).astype("<u2").tobytes()
                    for a, b in zip(offsets[:-1], offsets[1:])
                ]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(pa.string()), part.column(1), pa.array(found, pa.binary())],
                    ["_id", "_y", "grams"],
                )

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [r for batch in batches for r in batch.to_pylist()]
        # copies of a document under one id are one row
        own = sorted({(r["_id"], r["grams"], r["_y"]) for r in own})
        grams = [np.frombuffer(g, "<u2").astype(np.int64) for _, g, _ in own]
        model = fit(grams, np.array([y for _, _, y in own], int), totals)
        out = np.concatenate(
            [model.weights, model.ratios, [model.bias, model.slope, model.intercept]]
        ).astype("<f8")
        yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()])], ["model"])

    grams = rows.mapInArrow(read, "_id string, _y int, grams binary").distinct()
    place = F.row_number().over(Window.partitionBy("_id").orderBy(F.xxhash64("grams"), "grams"))
    grams = grams.withColumn("_place", place).where(F.col("_place") <= PER_ID).drop("_place")
    # the bounded sample meets in one task; one row comes back
    fitted = grams.repartition(1).mapInArrow(learn, "model binary").collect()
    numbers = np.frombuffer(fitted[0].model, "<f8") if fitted else None
    if numbers is None:
        return fit([], np.zeros(0, int), totals)
    return Model(
        numbers[:BUCKETS], numbers[BUCKETS : 2 * BUCKETS], *map(float, numbers[2 * BUCKETS :])
    )


def _scorer(spark, model: Model):
    """A pandas function from texts to scores; nulls count as empty."""
    get = sent(spark, model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        seen, own = np.zeros(BUCKETS, bool), get()
        for batch in batches:
            yield pd.Series(
                [
                    own.score(ngrams(np.frombuffer((t or "").encode("utf-8", "replace"), np.uint8), seen))
                    for t in batch
                ],
                dtype="float64",
            )

    return score


def kept(docs: DataFrame, model: Model, threshold: float = 0.3, text_col="text") -> DataFrame:
    """The rows of ``docs`` scored ``threshold`` or more, all their columns as they are."""
    return docs.where(_scorer(docs.sparkSession, model)(F.col(text_col).cast("string")) >= threshold)


def scores(
    docs: DataFrame, model: Model, threshold: float = 0.3, id_col="doc_id", text_col="text"
) -> DataFrame:
    """(id_col, held_out, score, predicted) per row, from the whole text and nothing else.

    Null text counts as empty, and an empty text has the score of no n-grams at all. Rows
    with equal ids stay rows of their own. An empty table gives an empty result.
    """
    score = _scorer(docs.sparkSession, model)(F.col("_text"))
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    found = rows.select("_id", score.alias("score"))
    return found.select(
        F.col("_id").alias(id_col),
        in_held_out_fold(F.col("_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
