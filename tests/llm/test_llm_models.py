"""Language, toxicity and token counts: held-out accuracy, brute force, and a public tokenizer."""

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

from ordermill.llm import queries, tokencount, toxicity

FOLDER = "/root/testdata/sf0.01"


def test_language_of_held_out_documents(spark):
    found = queries.op3_language(spark, FOLDER).toPandas()
    truth = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang").toPandas()
    both = found.merge(truth, on="doc_id")
    assert len(both) == 1000 and both.score.between(0, 1).all()
    assert (both.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in both.doc_id]).all()
    held = both[both.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.95


def test_toxicity_of_held_out_documents(spark):
    found = queries.op6_toxicity(spark, "/root/testdata/sf0.1").toPandas()
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").toPandas()
    both = found.merge(labels, on="doc_id")
    held = both[both.held_out]
    assert ((held.score >= 0.5) == held.predicted).all()
    assert held[held.toxic == 0].predicted.mean() < 0.03
    assert held[held.toxic == 1].predicted.mean() > 0.6


def brute_segments(scores):
    """Take the best segment (longest of ties is not defined, so scores have no ties), recur."""
    best = max(((sum(scores[i:j]), -(j - i), i, j) for i in range(len(scores))
                for j in range(i + 1, len(scores) + 1)), default=(0, 0, 0, 0))
    total, _, i, j = best
    if total <= 0:
        return []
    left, right = brute_segments(scores[:i]), brute_segments(scores[j:])
    return left + [(i, j)] + [(a + j, b + j) for a, b in right]


@pytest.mark.parametrize("seed", range(40))
def test_all_maximal_segments(seed):
    r = np.random.default_rng(seed)
    scores = r.normal(-0.2, 1, r.integers(0, 40))
    got = toxicity.segments(scores)
    assert [(a, b) for a, b, _ in got] == brute_segments(scores.tolist())
    assert all(abs(s - scores[a:b].sum()) < 1e-9 for a, b, s in got)


def test_decay_solves_its_equation():
    scores, share = np.array([5.0, -0.25, -1.0]), np.array([0.001, 0.8, 0.199])
    rate = toxicity.decay(scores, share)
    assert abs((share * np.exp(rate * scores)).sum() - 1) < 1e-3 and rate > 0.1


@pytest.fixture(scope="module")
def vocabulary():
    return tokencount.load_vocabulary(f"{queries.TOKENIZERS}/piece_bpe_32k.model")


def public_counts(vocabulary, texts):
    unknown = next(i for i, (p, _) in enumerate(vocabulary.pieces) if p == "<unk>")
    tokenizer = Tokenizer(models.Unigram(list(vocabulary.pieces), unknown,
                                         vocabulary.bytes_fall_back))
    tokenizer.pre_tokenizer = pre_tokenizers.Metaspace(prepend_scheme="always")
    return [len(tokenizer.encode(t, add_special_tokens=False)) if t else 0 for t in texts]


ODD = ["", " ", "  ", "a", " a", "a ", "a  b", "▁", "▁a b▁", "\n\n", "漢字かな", "\U0001f600\U0001f601 x",
       "<s> <0x0A>", "<unk>", "é" * 300, "a" * 500, "\x00\x01", "tab\tnew\nline", "ﬁ ﷺ"]


def test_tokens_like_a_public_unigram_tokenizer(spark, vocabulary):
    counted = tokencount.count_tokens(spark.read.parquet(f"{FOLDER}/documents.parquet"), vocabulary)
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").join(counted, "doc_id").collect()
    assert [r["n_tokens"] for r in rows] == public_counts(vocabulary, [r["text"] for r in rows])
    counter = tokencount.Counter(vocabulary)
    assert [counter.tokens(t) for t in ODD] == public_counts(vocabulary, ODD)


@pytest.mark.parametrize("falls_back", [True, False])
def test_ties_and_unknown_characters(falls_back):
    """Equal scores everywhere, and characters outside of the vocabulary."""
    byte_pieces = [(f"<0x{b:02X}>", -9.0) for b in range(256)] if falls_back else []
    pieces = [("<unk>", -9.0), ("▁", -1.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("ba", -2.0),
              ("aab", -3.0), ("▁a", -2.0), ("bb", -1.5), ("abc", -3.0)] + byte_pieces
    vocabulary = tokencount.Vocabulary(tuple(pieces), falls_back)
    r = random.Random(4)
    texts = ["".join(r.choices("ab cé", k=r.randint(0, 12))) for _ in range(500)]
    counter = tokencount.Counter(vocabulary)
    assert [counter.tokens(t) for t in texts] == public_counts(vocabulary, texts)
