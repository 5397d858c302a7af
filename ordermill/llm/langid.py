"""Language identification: sparse multinomial logistic regression on character n-grams.

Texts are lower-cased; runs of characters that are no letters become one blank. N-grams of one to
three characters are hashed to 2**16 features, weighted by (1 + log tf) * idf and scaled to length
1. Weights are learned by follow-the-regularised-leader (FTRL-Proximal) with L1 and L2 penalties, so
most are exactly 0. A temperature fitted on examples that were not learned from calibrates the
probabilities.

The document frequencies are counted over all labelled documents. The classifier is fitted on a
bounded sample: of each language the ``PER_LANGUAGE`` distinct labelled texts with the smallest hash,
``SAMPLE_ROWS`` in all, each reduced to the features of its whole text before it leaves its task; of a
text with more than ``MOST_FEATURES`` of them the most frequent ones (of equally frequent ones the first).
Predictions read the text and nothing else, and texts of any length are read whole.

Defined results: a NULL text, and one without a letter, is ``und`` with score 1; if nothing is
labelled, every text is ``und`` with score 0. Ties go to the language first in code point order.
A text that is there many times is learned from once per language, and takes one place of the sample.
Other columns are not read.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import Scratch
from .words import MIX_1, MIX_2, mix

cloudpickle.register_pickle_by_value(sys.modules[__name__])

UNDETERMINED = "und"
BITS = 16                # features: 2**BITS
SIZES = (1, 2, 3)        # characters of an n-gram
PIECE = 1 << 18          # characters looked at at a time
FEW = 2_000              # n-grams that are sorted rather than tallied in a table
PER_LANGUAGE = 1_500     # labelled documents per language that are learned from
SAMPLE_ROWS = 12_000     # and in all
MOST_FEATURES = 4_096    # of a text that is learned from: 8 bytes each come to the driver
EPOCHS = 3
ALPHA, BETA = 0.5, 1.0   # learning rate of FTRL
L1, L2 = 0.01, 0.001     # elastic net
CALIBRATION = 5          # every fifth example fits the temperature
OTHER = re.compile(r"[\W\d_]+")


class Features:
    """Hashed n-gram counts of a text, without keeping more than a piece of its n-grams."""

    def counts(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Sorted features and how often each occurs."""
        total: np.ndarray | None = None
        chars = f" {OTHER.sub(' ', text.lower()).strip()} "
        for at in range(0, len(chars), PIECE):
            piece = chars[at:at + PIECE + max(SIZES) - 1]
            found = np.concatenate(list(self._hashed(piece, len(piece) <= PIECE)))
            if len(found) < FEW and len(chars) <= PIECE:
                return np.unique(found, return_counts=True)
            more = np.bincount(found, minlength=1 << BITS)
            total = more if total is None else total + more
        feature = np.flatnonzero(total)
        return feature, total[feature]

    @staticmethod
    def _hashed(piece: str, last: bool) -> Iterator[np.ndarray]:
        """N-grams that start in the piece; those that run on into the next one are in both."""
        code = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        starts = len(code) if last else PIECE
        gram = np.zeros(len(code), np.uint64)
        for size in range(1, max(SIZES) + 1):
            n = len(code) - size + 1
            if n <= 0:
                return
            gram = gram[:n] * MIX_1 + code[size - 1:size - 1 + n]
            if size in SIZES:
                hashed = mix(gram[:starts] + np.full(1, size, np.uint64) * MIX_2)
                yield (hashed >> np.uint64(64 - BITS)).astype(np.int64)


def most_frequent(feature: np.ndarray, count: np.ndarray,
                  most: int = MOST_FEATURES) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent features in their order, of equally frequent ones the first."""
    kept = np.sort(np.argsort(-count, kind="stable")[:most])
    return feature[kept], count[kept]


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray          # by feature
    weights: np.ndarray      # feature, language
    bias: np.ndarray         # by language
    temperature: float = 1.0

    def vector(self, feature: np.ndarray, count: np.ndarray) -> np.ndarray:
        return tf_idf(self.idf[feature], count)

    def probabilities(self, feature: np.ndarray, count: np.ndarray) -> np.ndarray:
        scores = self.vector(feature, count) @ self.weights[feature] + self.bias
        return softmax(scores / self.temperature)


def tf_idf(idf: np.ndarray, count: np.ndarray) -> np.ndarray:
    value = (1 + np.log(count)) * idf
    return value / max(float(np.linalg.norm(value)), 1e-12)


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max())
    return e / e.sum()


def train(examples: list[tuple[np.ndarray, np.ndarray, int]], idf: np.ndarray,
          languages: list[str]) -> Model:
    """FTRL-Proximal with one learning rate per weight; ``examples``: features, counts, class."""
    classes = len(languages)
    z = np.zeros((len(idf) + 1, classes))
    n = np.zeros_like(z)  # the last row is the bias, which has no penalty

    def weights(rows: np.ndarray) -> np.ndarray:
        zr, rate = z[rows], (BETA + np.sqrt(n[rows])) / ALPHA
        l1 = np.where(rows == len(idf), 0.0, L1)[:, None]
        return np.where(np.abs(zr) <= l1, 0.0, -(zr - np.sign(zr) * l1) / (rate + L2))

    kept_out = [e for i, e in enumerate(examples) if i % CALIBRATION == CALIBRATION - 1]
    learned = [e for i, e in enumerate(examples) if i % CALIBRATION != CALIBRATION - 1] or examples
    order = np.random.default_rng(3)
    for _ in range(EPOCHS):
        for i in order.permutation(len(learned)):
            feature, count, label = learned[i]
            rows = np.append(feature, len(idf))
            value = np.append(tf_idf(idf[feature], count), 1.0)
            w = weights(rows)
            error = softmax(value @ w)
            error[label] -= 1
            gradient = value[:, None] * error
            squared = gradient ** 2
            z[rows] += gradient - (np.sqrt(n[rows] + squared) - np.sqrt(n[rows])) / ALPHA * w
            n[rows] += squared
    final = weights(np.arange(len(idf) + 1))
    model = Model(languages, idf, final[:-1], final[-1])
    model.temperature = _temperature(model, kept_out or examples)
    return model


def _temperature(model: Model, examples: list) -> float:
    """The temperature of least log loss, by golden section over its logarithm."""
    scores = np.array([model.vector(f, c) @ model.weights[f] + model.bias for f, c, _ in examples])
    labels = np.array([label for _, _, label in examples])

    def loss(log_t: float) -> float:
        s = scores / np.exp(log_t)
        s = s - s.max(axis=1, keepdims=True)
        return float((np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(s)), labels]).mean())
    low, high, golden = -3.0, 3.0, (5 ** 0.5 - 1) / 2
    for _ in range(40):
        a, b = high - golden * (high - low), low + golden * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


# --- over tables -----------------------------------------------------------------------

def _document_frequency(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per feature and task; feature -1 counts the documents."""
    features, total, documents = Features(), np.zeros(1 << BITS, np.int64), 0
    for batch in batches:
        for text in batch.column(0):
            text = text.as_py()
            if has_letter(text):
                total[features.counts(text)[0]] += 1
                documents += 1
    found = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(found, -1)), pa.array(np.append(total[found], documents))],
        names=["feature", "n"])


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    features = Features()
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = text.as_py()
            if has_letter(text):
                feature, count = most_frequent(*features.counts(text))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang]), pa.array([feature.astype(np.int32)], pa.list_(pa.int32())),
                     pa.array([count.astype(np.int32)], pa.list_(pa.int32()))],
                    names=["lang", "feature", "n"])


def fit(labelled: DataFrame, doc_id: str = "doc_id", text: str = "text",
        lang: str = "lang") -> Model | None:
    """A model from rows whose language is not NULL; None if there is no usable one."""
    rows = labelled.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"),
                           F.col(lang).alias("lang")).where("lang is not null and text is not null")
    counted = (rows.select("text").mapInArrow(_document_frequency, "feature long, n long")
               .groupBy("feature").agg(F.sum("n").alias("n")).toArrow())
    feature, n = np.asarray(counted["feature"]), np.asarray(counted["n"])
    documents = int(n[feature == -1].sum())
    if not documents:
        return None
    frequency = np.zeros(1 << BITS)
    frequency[feature[feature >= 0]] = n[feature >= 0]
    idf = np.log((1 + documents) / (1 + frequency)) + 1

    # The sample: hashes of texts are made distinct, combined before the shuffle, and ranked. Hashes
    # that cannot be among the smallest are left out before, so a language's ranking is as small.
    place = F.shiftrightunsigned(F.xxhash64(F.lit(3), "text"), 11)
    placed = rows.withColumn("place", place)
    texts = Scratch(labelled.sparkSession, "language").table(
        placed.select("lang", "place").distinct(), "texts")
    sizes = {r["lang"]: r["count"] for r in texts.groupBy("lang").count().collect()}
    bound = F.element_at(F.create_map(*[F.lit(v) for lang, n in sorted(sizes.items()) for v in (
        lang, int(min(1.0, 2 * PER_LANGUAGE / n) * (1 << 53)))]), F.col("lang"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("place"))
    wanted = (texts.where(F.col("place") < bound).withColumn("rank", rank)
              .where(F.col("rank") <= PER_LANGUAGE).orderBy("rank", "lang").limit(SAMPLE_ROWS)
              .collect())
    sample = labelled.sparkSession.createDataFrame(
        sorted((r["place"], r["lang"]) for r in wanted), "place long, lang string")
    # At most SAMPLE_ROWS hashes: a bounded broadcast. Each task sends on one copy of a text.
    texts = (placed.join(F.broadcast(sample), ["place", "lang"], "left_semi")
             .groupBy("place", "lang").agg(F.min("text").alias("text")).select("lang", "text"))
    found = texts.mapInArrow(_examples, "lang string, feature array<int>, n array<int>").toArrow()
    languages = sorted(set(found["lang"].to_pylist()))
    if not languages:
        return None
    code = {name: i for i, name in enumerate(languages)}
    examples = sorted(((np.asarray(f.values), np.asarray(c.values), code[name.as_py()])
                       for name, f, c in zip(found["lang"], found["feature"], found["n"])),
                      key=lambda e: (len(e[0]), e[0].tobytes(), e[1].tobytes(), e[2]))
    examples = [examples[i] for i in np.random.default_rng(2).permutation(len(examples))]
    return train(examples, idf, languages)


def _predictions(model: Model | None):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            names, scores = [], []
            for text in batch.column(batch.num_columns - 1):
                text = text.as_py()
                if not has_letter(text):
                    names.append(UNDETERMINED)
                    scores.append(1.0)
                elif model is None:
                    names.append(UNDETERMINED)
                    scores.append(0.0)
                else:
                    p = model.probabilities(*features.counts(text))
                    names.append(model.languages[int(np.argmax(p))])
                    scores.append(float(p.max()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=[*batch.schema.names[:-1], "lang_pred", "score"])
    return predict


def predict(documents: DataFrame, model: Model | None, doc_id: str = "doc_id",
            text: str = "text") -> DataFrame:
    """doc_id, lang_pred and score; the model, some megabytes, travels with the job."""
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(_predictions(model), f"doc_id {kind}, lang_pred string, score double")
