"""The trie against a plain program, for sketches that prove much and nothing."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from ordermill.llm import prefixtrie, queries
from ordermill.llm.totals import with_totals
from ordermill.scratch import Scratch

SAMPLE = "/root/testdata/sf0.01"
SCHEMA = ("conv_id long, turn long, role string, text string, depth string, d1 string, place string, "
          "part string, length string")
SMALL = prefixtrie.BLOCK


def plain(rows):
    convs = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            convs[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    whole, members, children = {}, defaultdict(list), defaultdict(set)
    for c in convs.values():
        c.sort()
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        first = convs.get(c - c % 5, [])
        whole[c] = tuple(t[2:] for t in first[:h] + turns[h:])
        for d in range(len(whole[c]) + 1):
            members[whole[c][:d]].append(c)
            if d:
                children[whole[c][:d - 1]].add(whole[c][:d])
    below, out = {}, []
    for node in sorted(members, key=len, reverse=True):
        leaves = sum(below[k][0] for k in children[node]) or 1
        saved = sum(below[k][1] for k in children[node]) + (
            (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0)
        below[node] = leaves, saved
        ends = ",".join(map(str, sorted(c for c in members[node] if whole[c] == node)))
        out.append((min(members[node]), len(node), min(members[node[:-1]]) if node else None,
                    len(members[node]), len(children[node]), leaves, saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def table(spark, rows):
    return spark.createDataFrame([(*r, *"abcde") for r in rows], SCHEMA)


def nodes(trie):
    return sorted((tuple(r) for r in trie.collect()), key=repr)


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SAMPLE}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    got = nodes(queries.op13_prefix_trie(spark, SAMPLE))
    assert got == plain(rows) and len(got) > 200


@pytest.mark.parametrize("width", [SMALL, 1 << 22])
def test_shared_beginnings(spark, width):
    """Chains, copies and branches; a narrow sketch leaves many prefixes open."""
    pick = random.Random(7)
    rows, begins = [], [[(pick.choice("ua"), f"{i} {j} é") for j in range(12)] for i in range(6)]
    for conv_id in range(3_000):
        begin = pick.choice(begins)
        turns = begin[:pick.randrange(13)] + [
            ("u", f"own {conv_id} {j}") for j in range(pick.choice([0, 0, 1, 20]))]
        rows += [(conv_id, i, *t) for i, t in enumerate(turns)]
    pick.shuffle(rows)
    assert nodes(prefixtrie.trie(table(spark, rows), width)) == plain(rows)


def test_a_long_conversation_and_many_copies(spark):
    rows = [(7, i, "u", f"t{i % 3}") for i in range(4_000)]
    rows += [(12, i, "u", f"t{i % 3}") for i in range(3_000)]
    rows += [(5 * i, 0, "u", "hello") for i in range(100, 2_100)]  # copies
    assert nodes(prefixtrie.trie(table(spark, rows), SMALL)) == plain(rows)


def test_odd_rows(spark):
    long = "é" * 500_000
    rows = [(None, 0, "u", "x"), (1, None, "u", "b"), (1, None, "u", "a"), (1, 3, None, None),
            (1, 3, None, None), (1, -5, "", ""), (2, 0, "u", long), (2, 0, "u", long), (3, 0, "ab", "c"),
            (4, 0, "a", "bc"), (0, 0, "u", "a"), (-7, 0, "u", "a"), (2**62, 1, "u", "😀"), (6, 0, None, "")]
    rows = [r for r in rows if r[0] != -7]  # the plain program's remainder of negative ids differs
    assert [r[1:2] + r[3:] for r in nodes(prefixtrie.trie(table(spark, rows)))] == [
        r[1:2] + r[3:] for r in plain([(c, t, r, x) for c, t, r, x in rows])]
    assert prefixtrie.trie(table(spark, [])).count() == 0
    assert prefixtrie.trie(table(spark, [(None, 0, "u", "x")])).count() == 0
    alone = prefixtrie.trie(table(spark, [(-7, 0, "u", "a")])).collect()
    assert {r["conv_id"] for r in alone} == {-7}


def test_the_sketch_never_proves_a_shared_prefix(spark):
    random = np.random.default_rng(3)
    numbers = random.integers(0, 1 << 20, size=(4, 60_000))
    numbers[:, 30_000:40_000] = numbers[:, :10_000]  # there twice
    prefixes = spark.createDataFrame(
        [tuple(map(int, r)) for r in numbers.T], "depth long, d1 long, d2 long, d3 long")
    packed = prefixtrie.sketch(prefixes.repartition(7), 1 << 20)
    found = prefixtrie.estimate(packed, list(numbers))
    assert (found[:10_000] == 2).all() and (found[30_000:40_000] == 2).all()
    assert (found[10_000:30_000] == 1).mean() > 0.95 and not (found == 0).any()


def test_running_totals_of_a_hot_group(spark):
    rows = [("hot", i % 977, i) for i in range(20_000)] + [(f"g{i}", i, 1) for i in range(500)]
    rows += [(None, 5, 2), (None, 5, 2), (None, 4, 1)]
    from pyspark.sql import functions as F
    found = with_totals(
        spark.createDataFrame(rows, "g string, o long, v long").repartition(13), Scratch(spark, "test"),
        "rows", ["g"], [F.col("o"), F.col("v")], {"total": F.col("v"), "n": F.lit(1)}).collect()
    total, at, want = defaultdict(int), defaultdict(int), []
    for g, o, v in sorted(rows, key=lambda r: (r[0] or "", r[1], r[2])):
        total[g] += v
        at[g] += 1
        want.append((g, o, v, total[g], at[g]))
    assert sorted(map(tuple, found), key=repr) == sorted(want, key=repr)
