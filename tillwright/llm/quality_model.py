"""Quality classifier: a factorization machine over hashed words and structure (operator 4).

A document is a sparse vector of hashed words and a few structure statistics. The score has a weight per
feature and, for each pair of features, the product of their low-rank factors. The sum over all pairs
needs one pass: it is half of (sum of factors)^2 - sum of squares, per rank. The model is fitted on a
bounded sample of labelled documents and scores every whole text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.llm.common import text_or_empty

HASHED = 1 << 15
RANK = 6
EPOCHS = 12
BATCH = 32
RATE = 0.05
PENALTY = 1e-4
SEED = 11
# The model is fitted on at most so many labelled documents, those with the smallest hashed ids.
SAMPLE_ROWS = 4_000

# Structure statistics; each is 0 to 1 and has a feature of its own behind the hashed words.
STRUCTURE = (
    "bias_free_length", "tiny", "symbols", "capitals", "digits", "punctuation", "shouting", "bars",
    "distinct_words", "repeated_lines", "mean_word", "line_length", "stops",
)
N_FEATURES = HASHED + len(STRUCTURE)
_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SYMBOLS = b"#*$%&|<>@^~_=+{}[]\\/"


class _WordIds(dict):
    def __missing__(self, word: bytes) -> int:
        number = zlib.crc32(word) % HASHED
        if len(self) < 300_000:
            self[word] = number
        return number


def features(text: str, word_ids: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values. Hashed words have length 1 together, whatever the text's length."""
    raw = text.encode()
    words = raw.lower().split()
    n, size = max(1, len(words)), max(1, len(raw))
    ids, counts = np.unique(
        np.fromiter(map(word_ids.__getitem__, words), np.int64, len(words)), return_counts=True
    )
    lines = [line for line in text.split("\n") if line.strip()]
    without = lambda chars: size - len(raw.translate(None, chars)) if raw else 0
    structure = np.array(
        [
            min(1.0, np.log1p(len(words)) / 12),
            float(len(words) < 50),
            min(1.0, 5 * without(_SYMBOLS) / size),
            min(1.0, 2 * without(_UPPER) / size),
            min(1.0, 5 * without(b"0123456789") / size),
            min(1.0, 5 * without(b".,;:!?") / size),
            min(1.0, 5 * raw.count(b"!!") / n),
            min(1.0, 3 * raw.count(b" | ") / n),
            len(set(words)) / n,
            1 - len(set(lines)) / len(lines) if lines else 0.0,
            min(1.0, size / n / 20),
            min(1.0, np.log1p(size / max(1, len(lines))) / 10),
            min(1.0, 2 * sum(len(w) <= 3 for w in words) / n),
        ]
    )
    values = counts / max(1e-9, float(np.sqrt((counts * counts).sum()))) if len(ids) else np.zeros(0)
    return np.concatenate([ids, np.arange(HASHED, N_FEATURES)]), np.concatenate([values, structure])


@dataclass(frozen=True)
class Model:
    """Bias, weight per feature, and factors per feature."""

    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def score(self, ids: np.ndarray, values: np.ndarray) -> float:
        """Probability of good quality, in time linear in the features."""
        scaled = self.factors[ids] * values[:, None]
        pairs = 0.5 * float((scaled.sum(0) ** 2 - (scaled**2).sum(0)).sum())
        raw = self.bias + float(self.weights[ids] @ values) + pairs
        return float(1 / (1 + np.exp(-np.clip(raw, -30, 30))))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, seed: int = SEED) -> Model:
    """Logistic loss, AdaGrad steps over small batches. Without rows: every score is one half."""
    rng = np.random.default_rng(seed)
    weights = np.zeros(N_FEATURES)
    factors = rng.normal(0, 0.01, (N_FEATURES, RANK))
    bias = 0.0
    if not rows:
        return Model(bias, weights, np.zeros_like(factors))
    squared_w, squared_f, squared_b = np.full(N_FEATURES, 1e-6), np.full((N_FEATURES, RANK), 1e-6), 1e-6
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for start in range(0, len(rows), BATCH):
            batch = order[start : start + BATCH]
            sizes = np.array([len(rows[i][0]) for i in batch])
            ids = np.concatenate([rows[i][0] for i in batch])
            values = np.concatenate([rows[i][1] for i in batch])
            first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            owner = np.repeat(np.arange(len(batch)), sizes)
            scaled = factors[ids] * values[:, None]
            sums = np.add.reduceat(scaled, first)
            pairs = 0.5 * (sums**2 - np.add.reduceat(scaled**2, first)).sum(1)
            raw = bias + np.add.reduceat(weights[ids] * values, first) + pairs
            slope = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[batch]) / len(batch)
            each = slope[owner] * values
            # One row per feature of the batch: the step uses the summed slope.
            seen, where = np.unique(ids, return_inverse=True)
            slope_w = np.bincount(where, each, len(seen)) + PENALTY * weights[seen]
            by_factor = each[:, None] * (sums[owner] - scaled)
            slope_f = np.stack([np.bincount(where, by_factor[:, f], len(seen)) for f in range(RANK)], 1)
            slope_f += PENALTY * factors[seen]
            squared_w[seen] += slope_w**2
            squared_f[seen] += slope_f**2
            weights[seen] -= RATE * slope_w / np.sqrt(squared_w[seen])
            factors[seen] -= RATE * slope_f / np.sqrt(squared_f[seen])
            squared_b += slope.sum() ** 2
            bias -= RATE * slope.sum() / squared_b**0.5
    return Model(float(bias), weights, factors)


def held_out(doc_id: Column) -> Column:
    """Documents that no model may learn from; a null id is held out too."""
    remainder = F.crc32(doc_id.cast("string").cast("binary")) % 3
    return F.coalesce(remainder == 1, F.lit(True))


def training_rows(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, text and quality of the labelled sample, never of a held-out row: ``sample_rows`` rows at most.

    Of an id with several labels the smallest counts, and of one with several texts one of them, by a hash.
    """
    known = labels.filter(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").alias("_id")).agg(F.min("quality").alias("quality"))
    sample = known.orderBy(F.xxhash64("_id"), "_id").limit(sample_rows)
    # The limit bounds what is broadcast.
    texts = docs.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(sample), F.col("doc_id") == F.col("_id"))
    one = F.max(F.struct(F.xxhash64("text"), "text", "quality")).alias("_one")
    return texts.groupBy("doc_id").agg(one).select("doc_id", "_one.text", "_one.quality")


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, seed: int = SEED) -> Model:
    """Fit on the labelled sample; only the sample's features reach the driver, 6 bytes a different hashed word."""

    def extract(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        word_ids = _WordIds()
        for frame in frames:
            rows = [features(text, word_ids) for text in frame["text"]]
            yield pd.DataFrame(
                {
                    "doc_id": frame["doc_id"],
                    "ids": [ids.astype("<u2").tobytes() for ids, _ in rows],
                    "vals": [values.astype("<f4").tobytes() for _, values in rows],
                    "quality": frame["quality"],
                }
            )

    found = training_rows(docs, labels, sample_rows).mapInPandas(
        extract, "doc_id long, ids binary, vals binary, quality int"
    ).toPandas()
    found = found.sort_values(["doc_id", "ids", "vals", "quality"], kind="stable")  # the same in each run
    rows = [
        (np.frombuffer(i, "<u2").astype(np.int64), np.frombuffer(v, "<f4").astype(np.float64))
        for i, v in zip(found["ids"], found["vals"], strict=True)
    ]
    return fit(rows, found["quality"].to_numpy(np.float64), seed)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of ``docs``.

    Null and empty texts are scored by their structure alone. Repeated rows and null ids get a row each;
    other columns are not looked at.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        word_ids, fitted = _WordIds(), shared.value
        for texts in batches:
            yield pd.Series([fitted.score(*features(text, word_ids)) for text in texts], dtype="float64")

    scored = docs.select("doc_id", scores(text_or_empty()).alias("score"))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
