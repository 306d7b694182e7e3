"""Toxicity: a factorization machine over hashed terms.

A text is the set of its lower-cased words and numbers, hashed. Its score is the logistic of a bias,
a weight for each term, and the inner product of the factor vectors of every pair of terms, so a
pair such as an insult and a group's name can count for more than both alone. Trained by AdaGrad on
at most SAMPLE_ROWS labelled rows outside the held-out fold; terms of fewer than LEAST_DOCS of
them have no weight, all others have one and factors. Linear weights pay an L1 penalty and factors
an L2 penalty, higher ones for terms that neither tell labels apart alone nor are frequent, so
ordinary vocabulary stays near zero and long texts do not drift. Such shrinkage makes scores timid:
a line in the log odds, fitted on a share of the sample that a second machine has not seen, undoes it.
"""

from __future__ import annotations

import pickle
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm.common import fold, rows, saved

DIMENSIONS = 1 << 18
FACTORS = 4
#: Labelled rows the model is fitted on: those of the least hash.
SAMPLE_ROWS = 12_000
#: Rows a term must be in: so many, and such a share of the sample.
LEAST_DOCS, LEAST_SHARE = 5, 0.001
#: Share of the sample that makes a term frequent.
FREQUENT = 0.02
#: One row in so many is left for calibration, if it holds so many rows of either label.
CALIBRATE, LEAST_LABELS = 5, 10
EPOCHS = 5
BATCH = 32
RATE, FACTOR_RATE = 0.2, 0.02
#: Penalties per row a term is in: to find terms that tell labels apart, for these and frequent ones,
#: and for all others.
SELECT_L1, L1, L2 = 0.3, 0.05, 0.02
OTHER_L1, OTHER_L2 = 1.0, 0.3
#: Spread of factors at the start.
START, OTHER_START = 0.01, 0.001
THRESHOLD = 0.3
_TERM = re.compile(r"[^\W_]+")


def terms(text: str | None) -> np.ndarray:
    """Sorted hashed terms of the text, each once."""
    found = set(_TERM.findall((text or "").lower()))
    hashed = np.fromiter((zlib.crc32(t.encode()) for t in found), np.int64, len(found))
    return np.unique(hashed % DIMENSIONS)


def logistic(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass
class Machine:
    bias: float
    at: np.ndarray  # terms that have weights, ascending
    linear: np.ndarray
    factors: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def log_odds(self, found: np.ndarray) -> float:
        """Before calibration."""
        if not len(self.at):
            return self.bias
        place = np.minimum(np.searchsorted(self.at, found), len(self.at) - 1)
        place = place[self.at[place] == found]
        v = self.factors[place]
        pairs = 0.5 * float((v.sum(0) ** 2 - (v**2).sum(0)).sum())
        return float(self.bias + self.linear[place].sum() + pairs)

    def score(self, found: np.ndarray) -> float:
        return float(logistic(self.slope * self.log_odds(found) + self.shift))


def _epochs(docs, truth, machine: Machine, n: int, l1: np.ndarray, l2: np.ndarray | None, seed: int):
    """AdaGrad passes with a penalty for each term; without ``l2`` factors stay as they are."""
    rng = np.random.default_rng(seed)
    w, v = machine.linear, machine.factors
    bias_sum, w_sum, v_sum = 1e-8, np.full(len(w), 1e-8), np.full(v.shape, 1e-8)
    for _ in range(n):
        order = rng.permutation(len(docs))
        for start in range(0, len(order), BATCH):
            part = order[start : start + BATCH]
            flat = np.concatenate([docs[i] for i in part])
            row = np.repeat(np.arange(len(part)), [len(docs[i]) for i in part])
            some, of = np.unique(flat, return_inverse=True)
            x = np.zeros((len(part), len(some)))
            x[row, of] = 1.0
            ws, vs = w[some], v[some]
            total = x @ vs
            z = machine.bias + x @ ws + 0.5 * (total**2 - x @ vs**2).sum(1)
            error = logistic(z) - truth[part]
            g = x.T @ error
            bias_sum += error.sum() ** 2
            machine.bias -= RATE * error.sum() / np.sqrt(bias_sum)
            w_sum[some] += g**2
            step = RATE / np.sqrt(w_sum[some])
            moved = ws - step * g
            w[some] = np.sign(moved) * np.maximum(np.abs(moved) - step * l1[some] * x.sum(0), 0)
            if l2 is not None:
                gv = x.T @ (error[:, None] * total) - g[:, None] * vs + l2[some, None] * vs
                v_sum[some] += gv**2
                v[some] = vs - FACTOR_RATE * gv / np.sqrt(v_sum[some])


def _fitted(sample: list[tuple[np.ndarray, int]]) -> Machine:
    """A first pass with a strong penalty and no factors finds the terms that tell labels apart
    alone; the second trains all weights and factors, these terms' and frequent ones' most freely."""
    counts = np.bincount(np.concatenate([np.zeros(0, np.int64), *(x for x, _ in sample)]), minlength=DIMENSIONS)
    at = np.flatnonzero(counts >= max(LEAST_DOCS, LEAST_SHARE * len(sample)))
    place = np.full(DIMENSIONS, -1)
    place[at] = np.arange(len(at))
    docs = [place[x][place[x] >= 0] for x, _ in sample]
    truth = np.array([y for _, y in sample], float)
    share = (truth.sum() + 0.5) / (len(truth) + 1)
    bias = float(np.log(share / (1 - share)))
    machine = Machine(bias, at, np.zeros(len(at)), np.zeros((len(at), FACTORS)))
    _epochs(docs, truth, machine, EPOCHS, np.full(len(at), SELECT_L1), None, 3)
    free = (machine.linear != 0) | (counts[at] >= FREQUENT * len(sample))
    start = np.where(free, START, OTHER_START)
    machine.factors = np.random.default_rng(4).normal(0, 1, (len(at), FACTORS)) * start[:, None]
    _epochs(docs, truth, machine, EPOCHS, np.where(free, L1, OTHER_L1), np.where(free, L2, OTHER_L2), 5)
    return machine


def calibration(odds: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the log odds by regularised logistic regression; a falling line is refused."""
    slope, shift = 1.0, 0.0
    for _ in range(50):
        p = logistic(slope * odds + shift)
        w = p * (1 - p)
        slant = np.array([((p - labels) * odds).sum() + 1e-3 * (slope - 1), (p - labels).sum() + 1e-3 * shift])
        bend = np.array([[(w * odds**2).sum(), (w * odds).sum()], [(w * odds).sum(), w.sum()]]) + 1e-3 * np.eye(2)
        slope, shift = np.array([slope, shift]) - np.clip(np.linalg.solve(bend, slant), -2, 2)
    return (float(slope), float(shift)) if slope > 0 else (1.0, 0.0)


def fit(sample: list[tuple[np.ndarray, int]]) -> Machine:
    """sample: (terms, label), in an order that has nothing to do with labels. Without rows every
    score is one half; of one label, near its end."""
    if not len(sample):
        return Machine(0.0, np.zeros(0, np.int64), np.zeros(0), np.zeros((0, FACTORS)))
    machine = _fitted(sample)
    unseen = sample[: len(sample) // CALIBRATE]
    labels = np.array([y for _, y in unseen], float)
    if min(labels.sum(), len(labels) - labels.sum()) >= LEAST_LABELS:
        part = _fitted(sample[len(unseen) :])
        odds = np.array([part.log_odds(x) for x, _ in unseen])
        machine.slope, machine.shift = calibration(odds, labels)
    return machine


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> Machine:
    marked = labels.filter(
        (fold("doc_id", 4) != 2) & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()
    ).select("doc_id", F.col("toxic").cast("int").alias("toxic"), F.xxhash64(F.lit(3), "doc_id").alias("rank"))
    # SAMPLE_ROWS rows at most, so broadcasting them is safe
    few = saved(spark, marked.distinct().orderBy("rank", "toxic").limit(SAMPLE_ROWS), "marked")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rank, toxic, text in rows(batches, "rank", "toxic", "text"):
            yield pa.RecordBatch.from_arrays(
                [pa.array([rank]), pa.array([toxic], pa.int32()), pa.array([terms(text).astype("<i4").tobytes()])],
                names=["rank", "toxic", "terms"],
            )

    found = docs.select("doc_id", "text").join(F.broadcast(few), "doc_id")
    found = found.select("rank", "toxic", "text").mapInArrow(features, "rank long, toxic int, terms binary")
    # of ids that repeat, no more rows than the bound
    sample = saved(spark, found.orderBy("rank", "toxic").limit(SAMPLE_ROWS), "toxic-sample")

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = sorted(rows(batches, "rank", "toxic", "terms"))
        machine = fit([(np.frombuffer(t, "<i4").astype(np.int64), y) for _, y, t in held])
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(machine)], pa.binary())], names=["model"])

    row = sample.repartition(1).mapInArrow(fitted, "model binary").first()
    return pickle.loads(row["model"]) if row else fit([])


def score_documents(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row.

    Learns from ``labels.toxic`` (0 or 1) of the rows whose crc32(doc_id as text) modulo 4 is not 2.
    NULL, empty and wordless texts get the score of no terms. Labels without a document and
    documents without a label do no harm. Repeated rows count each time. No rows give no rows.
    """
    machine = spark.sparkContext.broadcast(train(spark, docs, labels))

    @F.pandas_udf("double")
    def score(texts):
        import pandas as pd

        return pd.Series([machine.value.score(terms(text)) for text in texts], dtype="float64")

    return docs.select(
        "doc_id", (fold("doc_id", 4) == 2).alias("held_out"), score(F.col("text")).alias("score")
    ).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
