"""A kernel quality classifier: random Fourier features of document statistics, ridge, isotonic calibration.

The features approximate a Gaussian kernel.  Every task sums its own part of the
normal equations; the sums, of a size set by the number of features alone, are
added up and solved on the driver.  Calibration pools a histogram of scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.llm.common import label_remainder, stored, table
from wordloom.llm.doc_stats import COUNTS, doc_counts

FEATURES = 200
SEED = 11
RIDGE = 1e-3
#: Scores are pooled into so many equal steps before calibration.
STEPS = 2000
THRESHOLD = 0.7

INPUTS = (
    *(("share", a, b) for a, b in (
        ("word_chars", "n_words"),
        ("n_symbols", "n_words"),
        ("n_dup_lines", "n_lines"),
        ("n_repeat_words", "n_words"),
        ("n_upper", "word_chars"),
        ("n_digits", "word_chars"),
        ("n_exclaim", "n_words"),
        ("n_stops", "n_words"),
        ("n_distinct", "n_words"),
        ("n_same", "n_words"),
        ("n_words", "n_lines"),
    )),
    ("size", "n_words", ""),
    ("size", "longest_word", ""),
)


def inputs(batch: pa.RecordBatch) -> np.ndarray:
    """Shares and sizes of one batch of counts, the skewed ones as logarithms."""
    c = {n: batch.column(n).to_numpy(zero_copy_only=False).astype(float) for n in COUNTS}
    cols = [np.log1p(c[a]) if kind == "size" else np.log1p(10 * c[a] / np.maximum(c[b], 1)) for kind, a, b in INPUTS]
    return np.stack(cols, 1)


@dataclass
class Model:
    """Standardisation, random directions, ridge weights and the calibration curve."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.hstack([np.ones((len(z), 1)), np.sqrt(2 / len(self.phases)) * np.cos(z @ self.directions + self.phases)])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.features(x) @ self.weights, 0, 1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(x), self.knots, self.levels)


def summed(rows: DataFrame, make, size: int) -> np.ndarray:
    """The sum over all rows of a vector of ``size`` numbers, added inside tasks, then between them.

    ``make`` turns one batch into its vector.  Partial sums meet by position in
    a shuffle with map-side addition; the driver gets ``size`` numbers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += make(batch)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["i", "v"])

    found = rows.mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros(size)
    out[found.column("i").to_numpy()] = found.column("v").to_numpy()
    return out


def isotonic(n: np.ndarray, positive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over a histogram of scores: knots and rising levels.

    Each pool gets a pseudo-observation of either class, so that no level is
    quite 0 or 1; between pools the curve is a straight line.
    """
    centre = (np.arange(len(n)) + 0.5) / len(n)
    pools: list[list[float]] = []
    for i in np.flatnonzero(n):
        pools.append([n[i], positive[i], centre[i], centre[i]])
        while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
            b = pools.pop()
            pools[-1] = [pools[-1][0] + b[0], pools[-1][1] + b[1], pools[-1][2], b[3]]
    knots, levels = [], []
    for count, good, low, high in pools:
        knots += [low, high]
        levels += [(good + 0.5) / (count + 1)] * 2
    return (np.array(knots), np.maximum.accumulate(levels)) if pools else (np.array([0.0, 1.0]), np.array([0.5, 0.5]))


def fit(known: DataFrame, *, features: int = FEATURES, seed: int = SEED) -> Model:
    """Fit on rows of counts with ``__label`` 0 or 1; ``__pool`` true marks the rows kept for calibration."""
    d, rng = len(INPUTS), np.random.default_rng(seed)

    def moments(batch: pa.RecordBatch) -> np.ndarray:
        x = inputs(batch)
        return np.concatenate([[len(x)], x.sum(0), (x**2).sum(0)])

    fitting, pool = known.where("not __pool"), known.where("__pool")
    m = summed(fitting, moments, 1 + 2 * d)
    n = max(m[0], 1.0)
    mean = m[1 : 1 + d] / n
    scale = np.sqrt(np.maximum(m[1 + d :] / n - mean**2, 1e-6))
    width = np.sqrt(d)
    model = Model(mean, scale, rng.normal(size=(d, features)) / width, rng.uniform(0, 2 * np.pi, features), np.zeros(features + 1), np.zeros(1), np.zeros(1))
    k = features + 1

    def equations(batch: pa.RecordBatch) -> np.ndarray:
        z, y = model.features(inputs(batch)), batch.column("__label").to_numpy(zero_copy_only=False).astype(float)
        return np.concatenate([(z.T @ z)[np.triu_indices(k)], z.T @ y])

    s = summed(fitting, equations, k * (k + 1) // 2 + k)
    gram = np.zeros((k, k))
    gram[np.triu_indices(k)] = s[: -k]
    gram = gram + np.triu(gram, 1).T
    model.weights = np.linalg.solve(gram + RIDGE * n * np.eye(k) / k + 1e-9 * np.eye(k), s[-k:])

    def histogram(batch: pa.RecordBatch) -> np.ndarray:
        at = np.minimum((model.raw(inputs(batch)) * STEPS).astype(int), STEPS - 1)
        y = batch.column("__label").to_numpy(zero_copy_only=False).astype(float)
        return np.concatenate([np.bincount(at, minlength=STEPS), np.bincount(at, y, minlength=STEPS)])

    h = summed(pool, histogram, 2 * STEPS)
    model.knots, model.levels = isotonic(h[:STEPS], h[STEPS:])
    return model


def scored(stats: DataFrame, model: Model) -> DataFrame:
    """``doc_id`` and the calibrated score of each row of counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.score(inputs(batch)))], names=["doc_id", "score"])

    return stats.select("doc_id", *COUNTS).mapInArrow(run, "doc_id long, score double")


def quality_scores(docs: DataFrame, labels: DataFrame, learn_from: Column, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Score each whole text between 0 and 1.

    ``labels`` has doc_id and ``quality``; ``learn_from`` picks the label rows to
    learn from, a quarter of which calibrate.  Null labels teach nothing; null
    and empty texts are scored by their zero counts; repeated rows are scored
    alike; without labels every score is 0.5.
    """
    stats = stored(doc_counts(docs, key=key, text=text))
    known = labels.where(learn_from & F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).select(
        "doc_id",
        F.col("quality").cast("int").alias("__label"),
        (F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0).alias("__pool"),
    )
    rows = stored(stats.join(known, "doc_id").select(*COUNTS, "__label", "__pool"))
    return scored(stats, fit(rows))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; labels of remainder 2 modulo 4 are held out."""
    held = lambda c: label_remainder(c, 4) == 2
    scores = quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held(F.col("doc_id")))
    return scores.select(
        "doc_id", held(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
