"""Toxic passages: maximum-scoring segments over token log-odds.

1. A word, told by its 64-bit hash, is counted once per document. Its score is the log-odds of
   toxic against other documents with an informative Dirichlet prior, which has the shape of the
   word's share of the whole corpus (among the words learned from) and the weight of all that is
   counted. Scores that are not significant count as 0. Every word costs ``GAP``, so the expected
   score of plain text is negative. How significant a score must be is one of ``LEVELS``: that of
   the least log loss on the labelled documents that were not counted (step 3).
2. One scan finds all maximal scoring segments of a document (Ruzzo and Tompa), in time linear in
   its words.
3. In plain text the number of segments of score S or more is about K * n * exp(-lambda * S) for n
   words. lambda follows from the scores of words in other documents, K from the segments of others
   that were not counted.
   So a segment has an expected number E of such segments by chance; those with E below
   ``SIGNIFICANT`` are passages. Their -log E, the best and the sum, go through a logistic
   curve that is fitted on documents that were not counted in step 1.

Counts for the prior are taken over all documents. Labels are learned from a bounded sample: the
``PER_CLASS`` labelled documents of either class with the smallest hash, with their whole texts;
the curve's weights restore the classes' proportions. Words are counted and tested in Spark: only the
significant ones come to the driver, 32 bytes each, and of the documents of the curve their evidence
only, however long they are. A text of any length is read whole; a task holds one such text and
its words. A score depends on the text alone.

Defined results: a NULL, empty or wordless text has no passage and gets the score of such texts. If a
class has no labelled document, every score is 0. Of several rows with one id one is learned from, that
with the smallest text hash, and of equal texts one; several labels of one id count as toxic if one
is. Other columns are not read.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import Scratch
from .words import ALPHANUMERIC, WordHasher

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PRIOR = 1.0          # weight of the prior, as a share of what is counted
LEVELS = (3.0, 2.5, 2.0, 1.5)  # significance (z) from which on a word's log-odds may count
GAP = 0.25           # cost of every word
MOST_SCORE = 8.0
PER_CLASS = 20_000   # labelled documents of each class that are learned from
CURVE = 4            # a fourth of them, by hash, is left for the curve
SIGNIFICANT = 0.05   # expected segments by chance below which a segment is a passage
MOST_EVIDENCE = 100.0

COUNTED = 1 << 20    # counts that a task gathers before it combines them
PREFIX = 16          # leading bits of a hash by which most words are told not to be significant

FOUND = "words long, starts array<int>, ends array<int>, scores array<double>, level int"


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score), in order.

    Only places with a positive score are visited; what lies between two of them is one number
    by prefix sums. A candidate keeps the sum before it (low) and up to its end (high). A new
    candidate looks back for the last one with a smaller low; if that has a smaller high as well,
    everything from there on becomes one candidate, which looks back again. ``back`` holds
    the place found by a candidate, so no place is looked at twice.
    """
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    stack: list[tuple[float, float, int, int, int]] = []  # low, high, start, end, back
    for at in np.flatnonzero(scores > 0).tolist():
        low, high, start, end = float(sums[at]), float(sums[at + 1]), at, at + 1
        place = len(stack) - 1
        while True:
            while place >= 0 and stack[place][0] >= low:
                place = stack[place][4]
            if place < 0 or stack[place][1] >= high:
                break
            low, start = stack[place][0], stack[place][2]
            back = stack[place][4]
            del stack[place:]
            place = back
        stack.append((low, high, start, end, place))
    return [(start, end, high - low) for low, high, start, end, _ in stack]


@dataclass
class Model:
    words: np.ndarray                  # hashes of the significant words, sorted
    scores: np.ndarray                 # of these, without the cost of a word
    rate: float = 1.0                  # lambda
    scale: float = 1.0                 # K
    curve: np.ndarray = field(default_factory=lambda: np.zeros(3))

    def __post_init__(self):
        self.known = np.zeros(1 << PREFIX, bool)
        self.known[self.words >> np.uint64(64 - PREFIX)] = True

    def score(self, hashes: np.ndarray) -> np.ndarray:
        """The scores of words, less their cost."""
        out = np.full(len(hashes), -GAP)
        if len(self.words):
            at = np.flatnonzero(self.known[hashes >> np.uint64(64 - PREFIX)])
            place = np.minimum(np.searchsorted(self.words, hashes[at]), len(self.words) - 1)
            out[at] += np.where(self.words[place] == hashes[at], self.scores[place], 0.0)
        return out

    def evidence(self, words: int, found: list[float]) -> tuple[float, float, list[float]]:
        """The best and the sum of -log E over passages, and E of each segment."""
        expected = [min(self.scale * max(words, 1) * float(np.exp(-self.rate * s)), 1e9)
                    for s in found]
        strong = [min(-np.log(max(e, 1e-300)), MOST_EVIDENCE) for e in expected if e < SIGNIFICANT]
        return max(strong, default=0.0), min(sum(strong), 10 * MOST_EVIDENCE), expected

    def probability(self, words: int, found: list[float]) -> float:
        best, total, _ = self.evidence(words, found)
        x = float(self.curve @ np.array([1.0, best, np.log1p(total)]))
        return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def decay(scores: np.ndarray, frequency: np.ndarray) -> float:
    """The positive lambda at which the mean of exp(lambda * score) is 1."""
    values, where = np.unique(np.round(scores, 2), return_inverse=True)
    share = np.bincount(where, weights=frequency)
    share = share / share.sum()
    low, high = 1e-6, 20.0
    if (share * np.exp(np.minimum(high * values, 600))).sum() <= 1:
        return 1.0  # no positive score at all
    for _ in range(100):
        middle = (low + high) / 2
        if (share * np.exp(np.minimum(middle * values, 600))).sum() > 1:
            high = middle
        else:
            low = middle
    return max(low, 0.05)


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted logistic regression by Newton's method with a light penalty."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - y)) + 0.01 * w
        curvature = (x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + 0.01 * np.eye(len(w))
        step = np.linalg.solve(curvature, gradient)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w


NOTHING = Model(np.empty(0, np.uint64), np.empty(0))


# --- over tables -----------------------------------------------------------------------

def _combined(parts: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(classes, words, counts) of parts, with one place per class and word."""
    kind, word, n = (np.concatenate(column) for column in zip(*parts))
    order = np.lexsort((word, kind))
    kind, word, n = kind[order], word[order], n[order]
    first = np.flatnonzero(np.concatenate(
        [[True], (kind[1:] != kind[:-1]) | (word[1:] != word[:-1])]))
    return kind[first], word[first], np.add.reduceat(n, first)


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(class, word, n) of rows (class, text): texts that have the word.

    A word counts once per text: its repeats are no evidence of their own. Counts are combined in the
    task, and leave it early if there are too many.
    """
    def batch_of(counts: tuple) -> pa.RecordBatch:
        kind, word, n = counts
        return pa.RecordBatch.from_arrays(
            [pa.array(kind, pa.int32()), pa.array(word.view(np.int64)), pa.array(n, pa.int64())],
            names=["class", "word", "n"])

    hasher, parts, held = WordHasher(ALPHANUMERIC), [], 0
    for batch in batches:
        classes = batch.column(0).to_numpy(zero_copy_only=False)
        for words in hasher.slices(batch.column(1)):
            if not len(words.hashes):
                continue
            values, which = np.unique(words.hashes, return_inverse=True)
            each = np.unique(words.owner() * len(values) + which)
            kind = classes[words.first + each // len(values)].astype(np.int32)
            part = _combined([(kind, values[each % len(values)], np.ones(len(each), np.int64))])
            parts.append(part)
            held += len(part[0])
            if held > COUNTED:
                parts = [_combined(parts)]
                held = len(parts[0][0])
                if held > COUNTED // 2:
                    yield batch_of(parts[0])
                    parts, held = [], 0
    if parts:
        yield batch_of(_combined(parts))


def _counts(rows: DataFrame) -> DataFrame:
    return rows.mapInArrow(_word_counts, "class int, word long, n long")


def word_odds(counted: DataFrame, documents: DataFrame, scratch: Scratch) -> DataFrame | None:
    """word, toxic, other, odds and z of all words of ``counted`` (class, text).

    ``toxic`` and ``other`` are the texts of either class that have the word. None if a
    class has no word.
    """
    def of(kind: int) -> Column:
        return F.sum(F.when(F.col("class") == kind, F.col("n")).otherwise(0))
    seen = scratch.table(_counts(counted).groupBy("word").agg(
        of(1).alias("toxic"), of(0).alias("other")), "seen")
    corpus = (_counts(documents.select(F.lit(0).alias("class"), "text"))
              .join(seen.select("word"), "word").groupBy("word").agg(F.sum("n").alias("corpus")))
    words = scratch.table(
        seen.join(corpus, "word", "left").select(
            "word", "toxic", "other",
            (F.coalesce("corpus", F.lit(0)) + F.col("toxic") + F.col("other")).alias("all")), "words")
    n1, n0, total = words.agg(F.sum("toxic"), F.sum("other"), F.sum("all")).first()
    if not n1 or not n0:
        return None
    strength = PRIOR * (n1 + n0)
    prior = F.lit(strength) * F.col("all") / F.lit(total)
    a, b = F.col("a"), F.col("b")
    # strength is above the prior of a word, unless it is the only one
    odds = F.log(a / F.greatest(n1 + strength - a, F.lit(1e-9))) - F.log(
        b / F.greatest(n0 + strength - b, F.lit(1e-9)))
    return (words.select("word", "toxic", "other", (F.col("toxic") + prior).alias("a"),
                         (F.col("other") + prior).alias("b"))
            .withColumn("odds", odds).withColumn("z", F.col("odds") / F.sqrt(1 / a + 1 / b)))


def _models(odds: DataFrame) -> list[Model]:
    """A model without K and curve for each of ``LEVELS``."""
    plain = odds.agg(F.sum("other")).first()[0]
    found = (odds.where(F.abs("z") >= min(LEVELS)).select("word", "other", "odds", "z").toArrow())
    word, other, score, z = (np.asarray(found[c]) for c in ("word", "other", "odds", "z"))
    order = np.argsort(word.view(np.uint64))
    word, other, z = word.view(np.uint64)[order], other[order], z[order]
    score = np.clip(score[order], -MOST_SCORE, MOST_SCORE)
    models = []
    for level in LEVELS:
        good = np.abs(z) >= level
        rest = plain - other[good].sum()
        rate = decay(np.append(score[good], 0.0) - GAP, np.append(other[good], rest) + 0.01)
        models.append(Model(word[good], score[good], rate))
    return models


def _segments(models: list[Model]):
    """Adds FOUND to rows whose last column is the text, which goes; one row for each model."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(ALPHANUMERIC)
        for batch in batches:
            n = batch.num_rows
            n_words, found = np.zeros(n, np.int64), [[[] for _ in range(n)] for _ in models]
            for words in hasher.slices(batch.column(batch.num_columns - 1)):
                n_words[words.first:words.first + words.texts()] = np.diff(words.bounds)
                for level, model in enumerate(models):
                    scores = model.score(words.hashes)
                    owner = np.searchsorted(words.bounds, np.flatnonzero(scores > 0), "right") - 1
                    for t in np.unique(owner).tolist():
                        found[level][words.first + t] = segments(
                            scores[words.bounds[t]:words.bounds[t + 1]])
            for level, lists in enumerate(found):
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:-1], pa.array(n_words),
                     pa.array([[s[0] for s in f] for f in lists], pa.list_(pa.int32())),
                     pa.array([[s[1] for s in f] for f in lists], pa.list_(pa.int32())),
                     pa.array([[s[2] for s in f] for f in lists], pa.list_(pa.float64())),
                     pa.array(np.full(n, level, np.int32))],
                    names=[*batch.schema.names[:-1], "words", "starts", "ends", "scores", "level"])
    return find


def _evidence(models: list[Model]):
    """(class, level, best, total) of rows (class, level, words, scores)."""
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [models[level].evidence(words, scores)[:2] for level, words, scores in zip(
                *(batch.column(c).to_pylist() for c in (1, 2, 3)))]
            best, total = (pa.array([f[i] for f in found], pa.float64()) for i in (0, 1))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), best, total],
                                             names=["class", "level", "best", "total"])
    return weigh


def _sample(documents: DataFrame, labels: DataFrame, scratch: Scratch) -> tuple[DataFrame, dict]:
    """(class, part, text) of the labelled documents to learn from, and the size of each class.

    The labels are ranked without any text; the ids chosen, at most 2 * PER_CLASS, are broadcast.
    """
    one = (labels.where("doc_id is not null and toxic is not null").groupBy("doc_id")
           .agg(F.max(F.col("toxic").cast("int")).alias("class")).where("class in (0, 1)"))
    one = scratch.table(one, "labels")
    sizes = {r["class"]: r["count"] for r in one.groupBy("class").count().collect()}
    # Hashes that cannot be among the smallest are left out before, so sorting is as small.
    placed = one.withColumn("place", F.shiftrightunsigned(F.xxhash64(F.lit(6), "doc_id"), 11))
    chosen = placed.limit(0)
    for kind, n in sorted(sizes.items()):
        bound = int(min(1.0, 2 * PER_CLASS / n) * (1 << 53))
        chosen = chosen.unionByName(placed.where((F.col("class") == kind) & (F.col("place") < bound))
                                    .orderBy("place", "doc_id").limit(PER_CLASS))
    chosen = chosen.select("doc_id", "class", (F.col("place") % CURVE == 0).alias("for_curve"))
    texts = (documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
             .join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "class", "for_curve")
             .agg(F.min_by("text", F.xxhash64("text")).alias("text"))
             .dropDuplicates(["class", "text"]))
    return scratch.table(texts.select("class", "for_curve", "text"), "sample"), sizes


def fit(documents: DataFrame, labels: DataFrame) -> Model | None:
    """``labels``: doc_id and toxic (0 or 1) to learn from; ``documents``: the whole corpus."""
    scratch = Scratch(documents.sparkSession, "toxicity")
    sample, sizes = _sample(documents, labels, scratch)
    odds = word_odds(sample.where("not for_curve").select("class", "text"), documents, scratch)
    if odds is None:
        return None
    models = _models(odds)
    fresh = sample.where("for_curve")
    found = scratch.table(
        (sample if fresh.isEmpty() else fresh).select("class", "text").mapInArrow(
            _segments(models), f"class int, {FOUND}").drop("starts", "ends"), "segments")

    # K from segments of plain documents: as many as are expected of a moderate score or more.
    bounds = F.array(*[F.lit(2.0 / m.rate) for m in models])
    strong = F.size(F.filter("scores", lambda s: s >= bounds[F.col("level")]))
    for r in found.where("class = 0").groupBy("level").agg(
            F.sum("words").alias("words"), F.sum(strong).alias("strong")).collect():
        # exp(-rate * bound) is exp(-2)
        models[r["level"]].scale = (r["strong"] + 0.5) / (max(r["words"], 1) * np.exp(-2.0))

    curve = (found.select("class", "level", "words", "scores")
             .mapInArrow(_evidence(models), "class int, level int, best double, total double")
             .groupBy("level", "class", "best", "total").agg(F.count(F.lit(1)).alias("n"))
             .orderBy("level", "class", "best", "total").toPandas())
    losses = []
    for level, model in enumerate(models):
        rows = curve[curve.level == level]
        label, n = rows["class"].to_numpy(float), rows.n.to_numpy(float)
        have = np.bincount(rows["class"], weights=n, minlength=2)
        weight = n * np.array([sizes[c] / have[c] for c in rows["class"]])
        weight *= n.sum() / weight.sum()
        x = np.stack([np.ones(len(rows)), rows.best, np.log1p(rows.total)], axis=1)
        model.curve = logistic(x, label, weight)
        margin = np.clip(x @ model.curve, -30, 30)
        losses.append((weight * (np.logaddexp(0, margin) - label * margin)).sum())
    return models[int(np.argmin(losses))]  # the strictest of equals


def score(documents: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, score, and the significant passages by word position, with score and E."""
    rows = documents.select("doc_id", "text")
    kind = dict(rows.dtypes)["doc_id"]
    passage = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()),
                         ("expected", pa.float64())])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _segments([model or NOTHING])(batches):
            probabilities, passages = [], []
            for row in zip(*(c.to_pylist() for c in batch.columns[1:5])):
                words, starts, ends, scores = row
                if model is None:
                    probabilities.append(0.0)
                    passages.append([])
                    continue
                probabilities.append(model.probability(words, scores))
                expected = model.evidence(words, scores)[2]
                passages.append([dict(zip(("start", "end", "score", "expected"), p))
                                 for p in zip(starts, ends, scores, expected)
                                 if p[3] < SIGNIFICANT])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(probabilities, pa.float64()),
                 pa.array(passages, pa.list_(passage))], names=["doc_id", "score", "passages"])
    return rows.mapInArrow(judge, f"doc_id {kind}, score double, passages array<struct<start:int,"
                                  "end:int,score:double,expected:double>>")
