"""N-gram counts of texts that are looked at in pieces, the sample, and the fit."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ordermill.llm import langid
from ordermill.llm.words import MIX_1, MIX_2, mix


def feature_of(gram):
    hashed = 0
    for character in gram:
        hashed = (hashed * int(MIX_1) + ord(character)) % (1 << 64)
    hashed = (hashed + len(gram) * int(MIX_2)) % (1 << 64)
    return int(mix(np.array([hashed], np.uint64))[0]) >> (64 - langid.BITS)


def plain_counts(chars):
    features = Counter()
    for size in langid.SIZES:
        grams = Counter(chars[i:i + size] for i in range(len(chars) - size + 1))
        for gram, n in grams.items():
            features[feature_of(gram)] += n
    return sorted(features.items())


@pytest.mark.parametrize("pieces", [1, 2])
@pytest.mark.parametrize("more", [-1, 0, 1, 2, 500, 5_000])
def test_the_last_piece_is_not_all(pieces, more):
    length = pieces * langid.PIECE + more
    words = "the quick brown fox jumps over a lazy dog und der hund bellt "
    text = (words * (length // len(words) + 1))[:length - 3] + "z"  # blanks go on both ends
    feature, count = langid.Features().counts(text)
    assert list(zip(feature.tolist(), count.tolist())) == plain_counts(f" {text} ")
    assert len(f" {text} ") == length


def test_a_text_with_many_copies(spark):
    """One German document 5,000 times among the learned rows leaves the others' places alone."""
    documents = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select(
        "doc_id", "text", "lang")
    learned = documents.where("crc32(string(doc_id)) % 4 != 2")
    copied = learned.where("lang = 'de' and length(text) between 100 and 2000").orderBy("doc_id").limit(1)
    copies = copied.select("text", "lang", F.explode(F.sequence(F.lit(1), F.lit(5_000))).alias("id")).select(
        (F.col("id") + 10_000_000).alias("doc_id"), "text", "lang")
    model = langid.fit(learned.unionByName(copies))
    held = documents.where("crc32(string(doc_id)) % 4 = 2 and lang = 'de'")
    found = langid.predict(held, model).groupBy("lang_pred").count().collect()
    right = sum(r["count"] for r in found if r["lang_pred"] == "de")
    assert right >= 0.99 * held.count() > 100


def plain_ftrl(examples, idf, classes, epochs, seed):
    """One weight at a time, as in the paper."""
    z, n = defaultdict(float), defaultdict(float)

    def weight(i, k):
        l1 = 0.0 if i < 0 else langid.L1
        if abs(z[i, k]) <= l1:
            return 0.0
        return -(z[i, k] - math.copysign(l1, z[i, k])) / (
            (langid.BETA + math.sqrt(n[i, k])) / langid.ALPHA + langid.L2)
    learned = [e for i, e in enumerate(examples) if i % langid.CALIBRATION != langid.CALIBRATION - 1]
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for at in order.permutation(len(learned)):
            feature, count, label = learned[at]
            value = [(1 + math.log(c)) * idf[f] for f, c in zip(feature, count)]
            norm = math.sqrt(sum(v * v for v in value))
            x = [(int(f), v / norm) for f, v in zip(feature, value)] + [(-1, 1.0)]
            score = [sum(v * weight(f, k) for f, v in x) for k in range(classes)]
            e = [math.exp(s - max(score)) for s in score]
            for k in range(classes):
                error = e[k] / sum(e) - (k == label)
                for f, v in x:
                    g, w = v * error, weight(f, k)
                    z[f, k] += g - (math.sqrt(n[f, k] + g * g) - math.sqrt(n[f, k])) / langid.ALPHA * w
                    n[f, k] += g * g
    return weight


def test_train_is_ftrl():
    random = np.random.default_rng(8)
    examples = []
    for i in range(40):
        feature = np.sort(random.choice(60, 12, replace=False))
        examples.append((feature, random.integers(1, 5, 12), int(feature[:6].sum() % 3)))
    idf = random.uniform(1, 3, 60)
    model = langid.train(examples, idf, ["a", "b", "c"])
    weight = plain_ftrl(examples, idf, 3, langid.EPOCHS, 3)
    for k in range(3):
        assert math.isclose(model.bias[k], weight(-1, k), rel_tol=1e-9, abs_tol=1e-12)
        for f in range(60):
            assert math.isclose(model.weights[f, k], weight(f, k), rel_tol=1e-9, abs_tol=1e-12)
    assert (model.weights == 0).any()


def test_a_long_text_is_thinned_by_frequency():
    feature, count = np.arange(10) * 3, np.array([1, 5, 2, 5, 1, 9, 1, 1, 2, 2])
    kept = langid.most_frequent(feature, count, 5)
    assert kept[0].tolist() == [3, 6, 9, 15, 24] and kept[1].tolist() == [5, 2, 5, 9, 2]
