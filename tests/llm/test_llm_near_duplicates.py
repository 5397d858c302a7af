"""Near-duplicate groups against brute force."""

import random

import numpy as np
import pytest

from ordermill.llm import neardup
from ordermill.llm.words import SPACED, WordHasher


def sets(texts, size):
    out = []
    for text in texts:
        w = (text or "").lower().split()
        out.append({tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size
                   else ({tuple(w)} if w else set()))
    return out


def brute_force(texts, size, similar=80):
    s, root = sets(texts, size), list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(s)):
        for j in range(i):
            if s[i] and s[j] and 100 * len(s[i] & s[j]) >= similar * len(s[i] | s[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [(i, len(s[i]), find(i), find(i) == i) for i in range(len(s))]


def corpus(seed, groups, most, words=(5, 120)):
    """Groups of copies with more and more edits: chains, cliques and loners."""
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3_000)]
    texts = []
    for _ in range(groups):
        base = r.choices(vocabulary, k=r.randint(*words))
        for _ in range(r.randint(1, most)):
            copy = list(base)
            for _ in range(r.randint(0, max(1, len(copy) // 9))):
                copy[r.randrange(len(copy))] = r.choice(vocabulary)
            texts.append(" ".join(copy))
            if r.random() < 0.2:
                base = copy  # a chain of edits
    texts += ["", "one", "one", "One", "two words", "two words", "a b c", "a b c d"]
    r.shuffle(texts)
    return texts


@pytest.mark.parametrize("seed, size", [(1, 2), (2, 5)])
def test_same_groups_as_brute_force(spark, seed, size):
    texts = corpus(seed, 60, 12)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted(tuple(r) for r in neardup.near_duplicates(docs, words=size).collect())
    assert got == brute_force(texts, size)


def test_large_group_and_blocks(spark, monkeypatch):
    """A group larger than a block, with members that only few others are linked to."""
    r = random.Random(5)
    vocabulary = [f"w{i}" for i in range(5_000)]
    base = r.choices(vocabulary, k=80)
    texts = []
    for _ in range(300):
        copy = list(base)
        for _ in range(r.randint(3, 14)):
            copy[r.randrange(80)] = r.choice(vocabulary)
        texts.append(" ".join(copy))
    monkeypatch.setattr(neardup, "BLOCK", 64)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted(tuple(x) for x in neardup.near_duplicates(docs, words=2).collect())
    assert got == brute_force(texts, 2)


def test_one_document_of_each_group_stays(spark):
    texts = corpus(7, 30, 8)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted(r["doc_id"] for r in neardup.one_of_each_group(docs).collect())
    assert got == [i for i, _, _, kept in brute_force(texts, 5) if kept]


def test_estimate_is_close():
    """Sketch similarity, corrected, against the sets' Jaccard similarity."""
    r, order, estimate = np.random.default_rng(1), neardup.probes(), neardup.Estimate()
    for n, share in [(40, 0.8), (400, 0.5), (5_000, 0.9), (20_000, 0.1)]:
        errors = []
        for _ in range(20):
            union = r.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2)
            common = int(n * share)
            half = common + (n - common) // 2
            a, b = np.unique(union[:half]), np.unique(np.concatenate([union[:common], union[half:]]))
            same = (neardup.registers(a, order) == neardup.registers(b, order)).mean()
            got = estimate.corrected(np.array([same]), np.array([len(a)]), np.array([len(b)]))[0]
            errors.append(got - common / n)
        assert abs(np.mean(errors)) < 0.03


def test_unrelated_sets_have_no_similarity():
    r, order, estimate = np.random.default_rng(2), neardup.probes(), neardup.Estimate()
    equal = []
    for _ in range(400):
        a, b = (np.unique(r.integers(0, 1 << 63, 3_000, dtype=np.uint64) * np.uint64(2))
                for _ in range(2))
        equal.append((neardup.registers(a, order) == neardup.registers(b, order)).mean())
    assert abs(np.mean(equal) - estimate.accident(3_000, 3_000)) < 3e-4


def test_words_are_split_and_lowered_like_the_pattern():
    import pyarrow as pa
    texts = ["A b c", "", None, "Ärger ärgeR", "a\x0bb\x1cc\x85d", "x" * 50, "  lead trail  ",
             "nul\x00in word", "many words " * 30]
    expected = [2, 0, 0, 2, 2, 1, 2, 2, 60]
    for size in (1 << 20, 7, 20):
        found = {}
        for words in WordHasher(SPACED, size).slices(pa.array(texts)):
            for t in range(words.texts()):
                found[words.first + t] = words.hashes[words.bounds[t]:words.bounds[t + 1]]
        assert [len(found[i]) for i in range(len(texts))] == expected
        assert found[0][0] == WordHasher(SPACED).slices(pa.array(["a"])).__next__().hashes[0]
        assert found[3][0] != found[3][1]  # only A-Z is lowered


@pytest.mark.parametrize("sizes, columns", [((5, 300), 4096), ((5, 300), 7), ((400, 1500), 512)])
def test_blocks_of_fine_sketches_against_sets(monkeypatch, sizes, columns):
    """Small sets exactly; of large ones no link is given up, and few others pass."""
    import pyarrow as pa
    monkeypatch.setattr(neardup, "COLUMNS", columns)
    r = np.random.default_rng(sum(sizes) + columns)
    values = []
    for _ in range(6):
        base = r.integers(0, 1 << 63, r.integers(*sizes), dtype=np.uint64) * np.uint64(2)
        for _ in range(10):
            new = base.copy()
            where = r.random(len(base)) < r.uniform(0, 0.25)
            new[where] = r.integers(0, 1 << 63, where.sum(), dtype=np.uint64)
            values.append(np.unique(new))

    def side(part):
        sketches = [(v[:neardup.FINE] >> np.uint64(32)).astype(np.uint32).tobytes() for v in part]
        return neardup.Fine(pa.array(sketches, pa.binary()), np.array([len(v) for v in part]))
    got = side(values).may_link(side(values[::-1]), 80)
    for i, a in enumerate(values):
        for j, b in enumerate(values[::-1]):
            common = len(np.intersect1d(a, b))
            similarity = common / (len(a) + len(b) - common)
            if max(len(a), len(b)) <= neardup.FINE:
                assert got[i, j] == (similarity >= 0.8)
            elif similarity >= 0.8:
                assert got[i, j]
            elif similarity < 0.6:
                assert not got[i, j]


def test_blocks_without_a_common_hash():
    import pyarrow as pa
    a, b = (neardup.Fine(pa.array([np.array(x, np.uint32).tobytes()]), np.array([2]))
            for x in ([1, 2], [3, 4]))
    assert a.common(b).tolist() == [[0]] and not a.may_link(b, 80).any()


def test_many_similar_texts_without_links(spark, monkeypatch):
    """Members of a bucket at a similarity of about 0.69, and some links among them."""
    r = random.Random(9)
    vocabulary = [f"w{i}" for i in range(50_000)]
    base = r.choices(vocabulary, k=120)
    texts = []
    for _ in range(250):
        copy = list(base)
        for _ in range(12):
            copy[r.randrange(120)] = r.choice(vocabulary)
        texts.append(" ".join(copy))
        if r.random() < 0.1:
            copy[r.randrange(120)] = r.choice(vocabulary)
            texts.append(" ".join(copy))
    monkeypatch.setattr(neardup, "BLOCK", 100)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted(tuple(x) for x in neardup.near_duplicates(docs, words=2).collect())
    assert got == brute_force(texts, 2)
