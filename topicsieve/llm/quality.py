"""Quality classifier: a factorisation machine over hashed words and text statistics.

A text is a sparse vector: hashed words with damped counts, and standardised statistics
of its structure and size. The score adds the weights of the features and the inner
products of the low-rank factors of all pairs of them; by the sum-of-squares identity
all pairs cost as much as one pass over the features::

    sum_{i<j} <v_i, v_j> x_i x_j = 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)

The model is fitted on at most ``TRAIN_ROWS`` labelled rows, the same ones on every
run; every text is scored, in whole.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicsieve.llm.frames import slices, text_or_empty

#: Documented bound of the labelled rows that the model is fitted on.
TRAIN_ROWS = 6_000
WORD_FEATURES = 1 << 12
FACTORS = 8
EPOCHS = 12
BATCH = 64
RATE = 0.02
DECAY = 1e-4
#: Words of a text whose hashes are held at a time, a bound on a worker's memory.
CACHED_WORDS = 200_000
STATISTICS = (
    "chars", "words", "word_length", "different_words", "most_frequent", "upper", "digits",
    "marks", "ends", "bars", "spaces", "lines", "repeated_lines", "beyond_ascii",
)
_buckets: dict[bytes, int] = {}


def word_bucket(word: bytes) -> int:
    found = _buckets.get(word)
    if found is None:
        if len(_buckets) >= CACHED_WORDS:
            _buckets.clear()
        found = _buckets[word] = zlib.crc32(word) % WORD_FEATURES
    return found


def text_features(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word buckets, their values (of unit length), and the statistics of a text."""
    raw = text.encode()
    words = raw.lower().split()
    found = np.fromiter(map(word_bucket, words), np.int64, len(words))
    counts = np.bincount(found, minlength=WORD_FEATURES)
    buckets = np.flatnonzero(counts)
    values = np.log1p(counts[buckets])
    if len(values):
        values /= np.sqrt((values**2).sum())

    of_byte = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    size, n = max(1, len(raw)), max(1, len(words))
    letters = of_byte[65:91].sum() + of_byte[97:123].sum()
    digits = of_byte[48:58].sum()
    spaces = of_byte[9:14].sum() + of_byte[32]
    ascii_bytes = of_byte[:128].sum()
    lines = text.split("\n")
    statistics = np.array(
        [
            np.log1p(len(text)),
            np.log1p(len(words)),
            (len(raw) - spaces) / n,
            # longer texts repeat more words; this ratio hardly depends on the length
            np.log1p(len(set(words))) / np.log1p(n),
            counts.max() / n,
            of_byte[65:91].sum() / size,
            digits / size,
            (ascii_bytes - letters - digits - spaces) / size,
            of_byte[46] / n,
            of_byte[124] / n,
            spaces / size,
            np.log1p(len(lines)) / np.log1p(n),
            1 - len(set(lines)) / len(lines),
            (len(raw) - ascii_bytes) / size,
        ]
    )
    return buckets, values, statistics


@dataclass
class FactorisationMachine:
    """Weights and factors; the statistics come after the hashed words."""

    bias: float
    weights: np.ndarray
    factors: np.ndarray
    centre: np.ndarray
    scale: np.ndarray

    def inputs(self, features: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        buckets, values, statistics = features
        dense = np.clip((statistics - self.centre) / self.scale, -4, 4)
        places = WORD_FEATURES + np.arange(len(dense))
        return np.concatenate([buckets, places]), np.concatenate([values, dense])

    def score(self, features: tuple[np.ndarray, np.ndarray, np.ndarray]) -> float:
        """Probability of good quality."""
        places, x = self.inputs(features)
        sums = x @ self.factors[places]
        squares = (x**2) @ (self.factors[places] ** 2)
        margin = self.bias + x @ self.weights[places] + 0.5 * (sums**2 - squares).sum()
        return float(1 / (1 + np.exp(-np.clip(margin, -30, 30))))


def fit(rows: list[tuple[tuple[np.ndarray, np.ndarray, np.ndarray], int]]) -> FactorisationMachine:
    """Fit by Adam on the logistic loss; without both labels the score is constant."""
    rng = np.random.default_rng(7)
    n_inputs = WORD_FEATURES + len(STATISTICS)
    labels = np.array([y for _, y in rows], float)
    statistics = np.array([f[2] for f, _ in rows]).reshape(-1, len(STATISTICS))
    good = (labels.sum() + 1) / (len(labels) + 2)
    model = FactorisationMachine(
        float(np.log(good / (1 - good))),
        np.zeros(n_inputs),
        np.zeros((n_inputs, FACTORS)),
        statistics.mean(0) if len(rows) else np.zeros(len(STATISTICS)),
        np.maximum(statistics.std(0), 1e-6) if len(rows) else np.ones(len(STATISTICS)),
    )
    if len(set(labels)) < 2:
        return model
    model.factors = rng.normal(0, 0.05, (n_inputs, FACTORS))
    inputs = [model.inputs(f) for f, _ in rows]
    shapes = (1, n_inputs, n_inputs * FACTORS)
    theta = np.concatenate([[model.bias], model.weights, model.factors.ravel()])
    cuts = np.cumsum(shapes)[:2]
    first, second, step = np.zeros_like(theta), np.zeros_like(theta), 0
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        for chosen in np.array_split(rng.permutation(len(rows)), max(1, len(rows) // BATCH)):
            bias, weights, factors = np.split(theta, cuts)
            factors = factors.reshape(n_inputs, FACTORS)
            places = np.concatenate([inputs[i][0] for i in chosen])
            x = np.concatenate([inputs[i][1] for i in chosen])
            row = np.repeat(np.arange(len(chosen)), [len(inputs[i][0]) for i in chosen])
            starts = np.flatnonzero(np.diff(row, prepend=-1))
            v = factors[places] * x[:, None]
            sums = np.add.reduceat(v, starts)
            squares = np.add.reduceat(v**2, starts)
            margin = bias[0] + np.add.reduceat(weights[places] * x, starts) + 0.5 * (sums**2 - squares).sum(1)
            slope = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[chosen]) / len(chosen)
            by_input = slope[row] * x
            toward = by_input[:, None] * (sums[row] - v)
            gradient = DECAY * theta
            gradient[0] = slope.sum()
            gradient[1 : cuts[1]] += np.bincount(places, by_input, n_inputs)
            for f in range(FACTORS):
                gradient[cuts[1] + f :: FACTORS] += np.bincount(places, toward[:, f], n_inputs)
            step += 1
            first = 0.9 * first + 0.1 * gradient
            second = 0.999 * second + 0.001 * gradient**2
            theta = theta - rate * (first / (1 - 0.9**step)) / (
                np.sqrt(second / (1 - 0.999**step)) + 1e-8
            )
    bias, model.weights, factors = np.split(theta, cuts)
    model.bias, model.factors = float(bias[0]), factors.reshape(n_inputs, FACTORS)
    return model


def remainder(doc_id: Column) -> Column:
    """crc32 of the identifier's digits, modulo 3; null without an identifier."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3


def train(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> FactorisationMachine:
    """A model of ``labels.quality`` (0 or 1), from rows that are not held out.

    Takes the ``most`` labelled rows whose identifiers' hashes are the smallest. Rows
    without an identifier or label are passed over; a document with several labels
    counts with each.
    """
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
    chosen = (
        usable.where(remainder(F.col("doc_id")) != 1)
        .select("doc_id", F.col("quality").cast("int").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "quality")
        .limit(most)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            features = [text_features(x.as_py()) for x in batch["text"]]
            yield pa.RecordBatch.from_pydict(
                {
                    "quality": batch["quality"],
                    "buckets": pa.array([f[0].tolist() for f in features], pa.list_(pa.int32())),
                    "values": pa.array([f[1].tolist() for f in features], pa.list_(pa.float32())),
                    "statistics": pa.array([f[2].tolist() for f in features], pa.list_(pa.float64())),
                }
            )

    # at most ``most`` rows are broadcast, and as many come back
    texts = docs.select("doc_id", text_or_empty().alias("text"))
    found = (
        texts.join(F.broadcast(chosen), "doc_id")
        .select("doc_id", "quality", "text")
        .mapInArrow(
            run, "quality int, buckets array<int>, values array<float>, statistics array<double>"
        )
        .orderBy("statistics", "buckets", "quality")
        .limit(most)
        .toArrow()
    )
    rows = [
        ((np.array(b, int), np.array(v, float), np.array(s, float)), y)
        for y, b, v, s in zip(*(c.to_pylist() for c in found.columns), strict=True)
    ]
    return fit(rows)


def scored_by(model: FactorisationMachine, text: Column) -> Column:
    """The model's score of a text, 0 to 1; null and empty texts are scored as empty."""

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        # one text at a time as a string, however many there are in the batch
        return pa.array([model.score(text_features(t.as_py())) for t in texts], pa.float64())

    return score(F.coalesce(text, F.lit("")))


def score_documents(docs: DataFrame, model: FactorisationMachine) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row.

    Rows without an identifier count as not held out. Other columns are not looked at.
    """
    scored = docs.select("doc_id", scored_by(model, F.col("text")).alias("score"))
    return scored.select(
        "doc_id",
        F.coalesce(remainder(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
