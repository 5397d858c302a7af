"""Toxicity against a plain program: counts, log-odds, models, levels and scores."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ordermill.llm import queries, toxicity
from ordermill.llm.words import ALPHANUMERIC, WordHasher
from ordermill.scratch import Scratch

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lower)


def hash_of(word):
    [words] = WordHasher(ALPHANUMERIC).slices(pa.array([word]))
    return int(words.hashes[0])


def plain_odds(counted, texts):
    """word -> (toxic, other, odds, z); ``counted``: (class, text)."""
    n = {0: Counter(), 1: Counter()}
    for kind, text in counted:
        n[kind].update(set(words_of(text)))
    seen = set(n[0]) | set(n[1])
    corpus = Counter(w for text in texts for w in set(words_of(text)) & seen)
    every = {w: corpus[w] + n[0][w] + n[1][w] for w in seen}
    n1, n0, total = sum(n[1].values()), sum(n[0].values()), sum(every.values())
    strength = toxicity.PRIOR * (n1 + n0)
    out = {}
    for w in seen:
        a, b = (n[k][w] + strength * every[w] / total for k in (1, 0))
        odds = math.log(a / (n1 + strength - a)) - math.log(b / (n0 + strength - b))
        out[w] = n[1][w], n[0][w], odds, odds / math.sqrt(1 / a + 1 / b)
    return out


def corpus(seed, n=400):
    """Texts, some of them long or odd, of which a fourth hold a passage of bad words."""
    r = random.Random(seed)
    usual, bad = [f"w{i}" for i in range(300)], [f"bad{i}" for i in range(12)]
    rows = []
    for i in range(n):
        text = r.choices(usual, k=r.randint(1, 60))
        toxic = int(r.random() < 0.25)
        if toxic:
            at = r.randint(0, len(text))
            text[at:at] = r.choices(bad, k=r.randint(2, 6))
        rows.append((i, " ".join(text).title() if i % 7 == 0 else " ".join(text), toxic))
    rows += [(n, None, 0), (n + 1, "", 0), (n + 2, "- , .", 1), (n + 3, "w1 " * 400_000, 0)]
    return rows


@pytest.fixture(scope="module")
def tables(spark):
    rows = corpus(3)
    documents = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, t) for i, _, t in rows], "doc_id long, toxic int")
    return rows, documents, labels


def test_odds_of_every_word(spark, tables):
    rows, documents, _ = tables
    counted = [(t, text) for _, text, t in rows if text is not None]
    table = spark.createDataFrame(counted, "class int, text string")
    found = {r["word"] % 2 ** 64: tuple(r)[1:] for r in toxicity.word_odds(
        table, documents, Scratch(spark, "test")).select(
            "word", "toxic", "other", "odds", "z").collect()}
    plain = {hash_of(w): v for w, v in plain_odds(counted, [r[1] for r in rows]).items()}
    assert found.keys() == plain.keys()
    for word, (toxic, other, odds, z) in plain.items():
        assert found[word][:2] == (toxic, other)
        assert found[word][2:] == pytest.approx((odds, z), rel=1e-9, abs=1e-9)


def test_counts_that_leave_a_task_early(spark, tables, monkeypatch):
    rows, documents, _ = tables
    table = documents.select(F.lit(0).alias("class"), "text")
    whole = toxicity._counts(table).groupBy("word").agg(F.sum("n").alias("n")).collect()
    monkeypatch.setattr(toxicity, "COUNTED", 40)
    parts = toxicity._counts(table).groupBy("word").agg(F.sum("n").alias("n")).collect()
    assert sorted(whole) == sorted(parts)


def plain_segments(scores):
    """All maximal segments: the best one, and those of what is left and right of it."""
    best = max(((sum(scores[i:j]), -(j - i), i, j) for i in range(len(scores))
                for j in range(i + 1, len(scores) + 1)), default=(0, 0, 0, 0))
    total, _, i, j = best
    if total <= 1e-12:
        return []
    return [*plain_segments(scores[:i]), total, *plain_segments(scores[j:])]


def test_every_score(spark, tables):
    """The operator, with a learned model, against the same steps in plain Python."""
    rows, documents, labels = tables
    got = {r["doc_id"]: r["score"] for r in toxicity.score(
        documents, toxicity.fit(documents, labels)).collect()}

    # NULL and the empty text are one text, of which one row is learned from
    place = {r[0]: r[1] for r in labels.select("doc_id", F.shiftrightunsigned(
        F.xxhash64(F.lit(6), "doc_id"), 11)).collect()}
    sample = {}
    for i, text, toxic in rows:
        if text:
            sample[toxic, text] = place[i] % toxicity.CURVE == 0
    counted = [k for k, for_curve in sample.items() if not for_curve]
    fresh = [k for k, for_curve in sample.items() if for_curve]
    sizes = Counter(t for _, _, t in rows)
    table = plain_odds(counted, [r[1] for r in rows])
    texts = [k for k in fresh if len(k[1]) < 10_000]
    assert len(texts) > 50 and {t for t, _ in texts} == {0, 1}

    def scores_of(level, text):
        return [(max(-toxicity.MOST_SCORE, min(toxicity.MOST_SCORE, table[w][2]))
                 if w in table and abs(table[w][3]) >= level else 0.0) - toxicity.GAP
                for w in words_of(text)]

    def segments_of(level, text):
        scores = scores_of(level, text)
        return plain_segments(scores) if any(s > 0 for s in scores) else []

    best = None
    for level in toxicity.LEVELS:
        odds = np.array([max(-toxicity.MOST_SCORE, min(toxicity.MOST_SCORE, o))
                         if abs(z) >= level else 0.0 for _, _, o, z in table.values()])
        model = toxicity.Model(np.empty(0, np.uint64), np.empty(0), toxicity.decay(
            odds - toxicity.GAP, np.array([v[1] for v in table.values()]) + 1e-9))
        found = [(t, len(words_of(x)), segments_of(level, x)) for t, x in fresh]
        plain = [f for f in found if f[0] == 0]
        many = sum(s >= 2 / model.rate for f in plain for s in f[2]) + 0.5
        model.scale = many / (max(sum(f[1] for f in plain), 1) * math.exp(-2))
        evidence = [model.evidence(n, s)[:2] for _, n, s in found]
        x = np.array([[1, b, math.log1p(total)] for b, total in evidence])
        y = np.array([f[0] for f in found], float)
        weight = np.array([sizes[int(t)] / (y == t).sum() for t in y])
        weight /= weight.mean()
        model.curve = toxicity.logistic(x, y, weight)
        margin = x @ model.curve
        loss = (weight * (np.logaddexp(0, margin) - y * margin)).sum()
        if best is None or loss < best[0] - 1e-9:
            best = loss, level, model
    _, level, model = best
    for i, text, _ in rows:
        expected = model.probability(len(words_of(text)), segments_of(level, text))
        assert got[i] == pytest.approx(expected, abs=0.02), i


def test_a_class_without_words(spark):
    documents = spark.createDataFrame([(1, "a b"), (2, "- ,"), (3, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (2, 1), (3, 1)], "doc_id long, toxic int")
    assert toxicity.fit(documents, labels) is None


def test_only_significant_words_come_to_the_driver(spark):
    folder = "/root/testdata/sf0.01"
    documents, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(documents, labels.where(queries._crc(5) != 0))
    assert 0 < len(model.words) < 1_000 and (np.diff(model.words.astype(float)) > 0).all()
    assert toxicity.Model(np.empty(0, np.uint64), np.empty(0)).score(
        np.array([1, 2], np.uint64)).tolist() == [-toxicity.GAP] * 2
