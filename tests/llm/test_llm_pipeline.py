"""The pipeline, stage by stage, against a plain program over the same documents."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from ordermill.llm import mixing, quality

FOLDER = "/root/testdata/sf0.01"
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text)


def clean(docs):
    def normalised(line):
        return " ".join(SPACED.findall(re.sub("[0-9]+", "0", line.lower())))

    def fails(w):
        windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
        often = Counter(windows)
        hit = {i + k for i, x in enumerate(windows) if often[x] > 1 for k in range(5)}
        return len(w) < 10 or 100 * len(hit) > 20 * len(w)
    texts = {(s, t) for _, t, s in docs}
    contexts = defaultdict(list)
    for s, t in texts:
        lines = sorted({normalised(x) for x in t.split("\n") if SPACED.search(x)},
                       key=lambda x: hashlib.md5(x.encode()).hexdigest())
        for x in lines:
            contexts[s, x].append(next((y for y in lines if y != x), None))
    bad = {k for k, c in contexts.items() if len(set(c)) > quality.HOST_CONTEXTS
           and len(set(c)) >= len(c) * quality.CONTEXT_SHARE}
    out = []
    for i, t, s in docs:
        w = SPACED.findall(t)
        gone = [x for x in t.split("\n") if SPACED.search(x) and (s, normalised(x)) in bad]
        left = len(w) - sum(len(SPACED.findall(x)) for x in gone)
        if not fails(w) and left >= 10 and left >= 0.3 * len(w):
            kept = [x for x in t.split("\n") if not SPACED.search(x) or (s, normalised(x)) not in bad]
            out.append((i, "\n".join(kept) if gone else t, s))
    return out


def one_of_each(docs):
    sets, holders, root = {}, defaultdict(list), {}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, t, _ in sorted(docs):
        w = SPACED.findall(lowered(t))
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))}
        root[i] = i
        for j, n in Counter(j for x in sets[i] for j in holders[x]).items():
            if 100 * n >= 80 * (len(sets[i]) + len(sets[j]) - n):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
        for x in sets[i]:
            holders[x].append(i)
    return [d for d in docs if find(d[0]) == d[0]]


def uncontaminated(docs, items):
    grams = set()
    for t in items:
        w = PLAIN.findall(lowered(t))
        size = min(10, len(w))
        grams |= {tuple(w[k:k + size]) for k in range(len(w) - size + 1) if size}
    sizes = {len(g) for g in grams}

    def hit(t):
        w = PLAIN.findall(lowered(t))
        return any(tuple(w[k:k + n]) in grams for n in sizes for k in range(len(w) - n + 1))
    return [d for d in docs if not hit(d[1])]


def copies(docs, labels):
    size = {d: len(SPACED.findall(d[1])) for d in docs}
    total, target = Counter(), {}
    for d in docs:
        total[d[2]] += size[d]
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(sorted(total))}
    bounded = set()
    while True:
        level = ((1.5 * sum(total.values()) - sum(2 * total[s] for s in bounded))
                 / sum(w for s, w in weight.items() if s not in bounded))
        above = {s for s in total if s not in bounded and weight[s] * level > 2 * total[s]}
        if not above:
            break
        bounded |= above
    out = {}
    for s in total:
        target = min(weight[s] * level, 2.0 * total[s])
        epochs = math.floor(target / total[s])
        budget, done, taking = target - epochs * total[s], 0, True

        def key(d):
            name = f"{mixing.SEED}|{d[0]}|{hashlib.md5(d[1].encode()).hexdigest()}"
            u = (int(hashlib.md5(name.encode()).hexdigest()[:13], 16) + 0.5) / 2 ** 52
            q = labels.get(d[0])
            return -math.log(u) / (1.0 if q is None else 2.0 if q == 1 else 0.5)
        for d in sorted((d for d in docs if d[2] == s), key=key):
            end = done + size[d]
            taking = taking and budget > 0 and (end <= budget or end - budget < budget - done)
            out[d[0]] = epochs + taking
            taking, done = taking and end <= budget, end
    return out


@pytest.fixture(scope="module")
def results(spark):
    docs, out = spark.read.parquet(f"{FOLDER}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER).cache()
        out.append(docs)
    return out


def test_same_rows_as_a_plain_program(spark, results):
    read = spark.read.parquet(f"{FOLDER}/documents.parquet")
    expected = [(r["doc_id"], r["text"], r["source"]) for r in read.collect()]
    items = [r["text"] for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    labels = {r["doc_id"]: r["quality"]
              for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    steps = [clean, one_of_each, lambda d: uncontaminated(d, items)]
    for step, table in zip(steps, results):
        before, expected = len(expected), step(expected)
        got = [(r["doc_id"], r["text"], r["source"]) for r in table.collect()]
        assert sorted(got) == sorted(expected) and len(expected) < before
        assert table.columns == read.columns
        assert all(r["n_chars"] == len(r["text"]) for r in table.collect())
    often = copies(expected, labels)
    got = Counter(r["doc_id"] for r in results[3].collect())
    assert got == Counter({i: n for i, n in often.items() if n})
    shards = [(r["shard"], r["slot"], r["doc_id"]) for r in results[4].collect()]
    assert Counter(i for _, _, i in shards) == got
    sizes = Counter(s for s, _, _ in shards)
    assert len(sizes) == 40 and max(sizes.values()) - min(sizes.values()) <= 1
    assert {(s, t) for s, t, _ in shards} == {(s, t) for s in sizes for t in range(sizes[s])}


def test_run_applies_all_stages(spark, results):
    found = corpus_pipeline.run(spark, FOLDER)
    assert sorted(map(repr, found.collect())) == sorted(map(repr, results[-1].collect()))
