"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Inverse document frequencies are counted over all labelled documents outside the held-out fold. The
weights are trained by follow-the-regularised-leader with elastic-net penalties on at most
SAMPLE_ROWS of those documents, and a temperature is then fitted on documents that were left out of
the training. Whole texts are read everywhere. The model has DIMENSIONS weights a language.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm.common import fold, rows, saved

#: Hashed 1- to 3-grams of characters.
DIMENSIONS = 1 << 15
#: Labelled documents the weights and the temperature are fitted on: those of the least hash.
SAMPLE_ROWS = 8_000
#: Share of the sample that only the temperature sees.
CALIBRATION = 5
EPOCHS = 2
BATCH = 16
#: Learning rate, its smoothing, and the elastic-net penalties of the leader.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.05
#: Characters of a text worked on at a time.
CHUNK = 1 << 20
UNKNOWN = "und"


def grams(text: str) -> np.ndarray:
    """Counts of the text's hashed character 1- to 3-grams, lower-cased, a space at either end."""
    counts = np.zeros(DIMENSIONS, np.int64)
    code = np.frombuffer((" " + text.lower() + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    for at in range(0, len(code), CHUNK):
        x = code[max(0, at - 2) : at + CHUNK].astype(np.uint64)
        fresh = min(2, at)
        one = x * np.uint64(0x9E3779B1)
        two = one[1:] ^ (x[:-1] * np.uint64(0x85EBCA77C2B2AE63))
        three = two[1:] ^ (x[:-2] * np.uint64(0x27D4EB2F165667C5))
        for n, h in enumerate((one, two, three)):
            h = h[max(0, fresh - n) :] + np.uint64(n)
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            counts += np.bincount((h >> np.uint64(49)).astype(np.int64), minlength=DIMENSIONS)
    return counts


def tf_idf(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    counts = grams(text)
    at = np.flatnonzero(counts)
    value = np.log1p(counts[at]) * idf[at]
    return at, value / max(float(np.sqrt(value @ value)), 1e-12)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # DIMENSIONS x languages
    bias: np.ndarray
    temperature: float = 1.0

    def logits(self, text: str) -> np.ndarray:
        at, value = tf_idf(text, self.idf)
        return value @ self.weights[at] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.languages or not any(map(str.isalpha, text or "")):
            return UNKNOWN, 0.0
        p = softmax(self.logits(text) / self.temperature)
        return self.languages[int(p.argmax())], float(p.max())


class Leader:
    """FTRL-proximal, a state for each weight."""

    def __init__(self, shape: tuple[int, ...]):
        self.z, self.n = np.zeros(shape), np.zeros(shape)

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) <= L1, 0.0, w)

    def step(self, at, gradient: np.ndarray, w: np.ndarray) -> None:
        n = self.n[at] + gradient**2
        self.z[at] += gradient - (np.sqrt(n) - np.sqrt(self.n[at])) / ALPHA * w
        self.n[at] = n


def fit(sample: list[tuple[np.ndarray, np.ndarray, str]], idf: np.ndarray) -> Model:
    """sample: (positions, values, language), in an order the data do not decide."""
    languages = sorted({language for _, _, language in sample})
    if not languages:
        return Model([], idf, np.zeros((DIMENSIONS, 0)), np.zeros(0))
    number = {language: i for i, language in enumerate(languages)}
    train = [x for i, x in enumerate(sample) if i % CALIBRATION] or sample
    check = [x for i, x in enumerate(sample) if not i % CALIBRATION]
    leader, bias = Leader((DIMENSIONS, len(languages))), Leader((len(languages),))
    for epoch in range(EPOCHS):
        order = np.random.default_rng([4, epoch]).permutation(len(train))
        for start in range(0, len(order), BATCH):
            part = [train[i] for i in order[start : start + BATCH]]
            at = np.unique(np.concatenate([x[0] for x in part]))
            x = np.zeros((len(part), len(at)))
            for row, (positions, values, _) in enumerate(part):
                x[row, np.searchsorted(at, positions)] = values
            w, b = leader.weights(at), bias.weights()
            error = softmax(x @ w + b)
            error[np.arange(len(part)), [number[y] for _, _, y in part]] -= 1
            leader.step(at, x.T @ error, w)
            bias.step(slice(None), error.sum(0), b)
    model = Model(languages, idf, leader.weights(), bias.weights())
    logits = np.array([v @ model.weights[p] + model.bias for p, v, _ in check])
    truth = np.array([number[y] for _, _, y in check])

    def loss(t: float) -> float:
        return -np.log(softmax(logits / t)[np.arange(len(truth)), truth] + 1e-12).mean()

    model.temperature = float(min(np.geomspace(0.1, 10, 81), key=loss))
    return model


def train(spark: SparkSession, docs: DataFrame) -> Model:
    labelled = docs.filter(
        (fold("doc_id", 5) != 0) & F.col("lang").isNotNull() & F.col("text").isNotNull()
    ).select("doc_id", "text", F.col("lang").cast("string").alias("lang"))

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n = np.zeros(DIMENSIONS, np.int64), 0
        for (text,) in rows(batches, "text"):
            seen += grams(text) > 0
            n += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(-1, DIMENSIONS)), pa.array(np.concatenate(([n], seen)))], names=["gram", "n"]
        )

    counted = labelled.select("text").mapInArrow(frequencies, "gram long, n long")
    found = counted.groupBy("gram").agg(F.sum("n").alias("n")).collect()  # DIMENSIONS + 1 rows
    df = np.zeros(DIMENSIONS + 1)
    for row in found:
        df[row["gram"] + 1] = row["n"]
    idf = np.log((1 + df[0]) / (1 + df[1:])) + 1

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rank, text, lang in rows(batches, "rank", "text", "lang"):
            at, value = tf_idf(text, idf)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([rank]),
                    pa.array([at.astype("<u2").tobytes()], pa.binary()),
                    pa.array([value.astype("<f4").tobytes()], pa.binary()),
                    pa.array([lang]),
                ],
                names=["rank", "at", "value", "lang"],
            )

    rank = F.xxhash64(F.lit(4), "doc_id")
    # the threshold on the hash keeps at most SAMPLE_ROWS ids, and then their texts are read
    ids = labelled.select(rank.alias("rank")).orderBy("rank").limit(SAMPLE_ROWS)
    top = ids.agg(F.max("rank")).first()[0]
    sample = []
    if top is not None:
        few = labelled.withColumn("rank", rank).filter(F.col("rank") <= top)
        few = few.mapInArrow(features, "rank long, at binary, value binary, lang string")
        # of ids that repeat, no more rows than the bound
        packed = saved(spark, few.orderBy("rank", "lang").limit(SAMPLE_ROWS), "language-sample")

        def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = [
                (np.frombuffer(a, "<u2").astype(np.int64), np.frombuffer(v, "<f4").astype(float), y)
                for _, a, v, y in sorted(rows(batches, "rank", "at", "value", "lang"))
            ]
            m = fit(held, idf)
            m.weights = m.weights.astype(np.float32)
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(m)], pa.binary())], names=["model"])

        row = packed.repartition(1).mapInArrow(fitted, "model binary").first()
        return pickle.loads(row["model"])
    return fit(sample, idf)


#: The column predictions are added as; documents keep any other names.
PREDICTED = "_predicted_language"


def predictions(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The documents with PREDICTED: lang_pred and score."""
    model = spark.sparkContext.broadcast(train(spark, docs.select("doc_id", "text", "lang")))

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts):
        import pandas as pd

        return pd.DataFrame([model.value.predict(t) for t in texts], columns=["lang_pred", "score"])

    return docs.withColumn(PREDICTED, predict(F.col("text")))


def identify(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row.

    Learns from text and lang of the documents whose crc32(doc_id as text) modulo 5 is not 0. NULL
    texts and texts without a letter are ``und`` with score 0, and so is every text if nothing is
    labelled. Repeated rows count each time. No rows give no rows.
    """
    return predictions(spark, docs.select("doc_id", "text", "lang")).select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), f"{PREDICTED}.lang_pred", f"{PREDICTED}.score"
    )


def known_language(spark: SparkSession, docs: DataFrame, least_score: float = 0.3) -> DataFrame:
    """The documents whose language is known: not ``und`` and at least ``least_score``."""
    found = predictions(spark, docs).filter(
        (F.col(f"{PREDICTED}.lang_pred") != UNKNOWN) & (F.col(f"{PREDICTED}.score") >= least_score)
    )
    return found.drop(PREDICTED)
