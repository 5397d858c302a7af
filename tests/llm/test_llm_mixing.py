"""The mix on repeated rows: nearness to the targets, and each copy decided by itself."""

from collections import Counter

from pyspark.sql import functions as F

from ordermill.llm import mixing

SCHEMA = "doc_id long, text string, source string, n_chars long, copy string, key string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "c", "k") for r in rows], SCHEMA)


def near(found):
    """Each source's taken words are within a document of the target."""
    sources = {}
    for r in found:
        got = sources.setdefault(r["source"], [0, r["target"], 0])
        got[0] += r["taken"]
        got[2] = max(got[2], r["size"])
        assert r["taken"] % max(r["size"], 1) == 0 and r["taken"] <= 2 * r["size"]
    for source, (taken, target, longest) in sources.items():
        assert abs(taken - target) <= longest, (source, taken, target)
    return sources


def test_a_row_with_very_many_copies(spark):
    small = [(i, "w " * (1 + i % 300), "a", i) for i in range(2_000)]
    other = [(5_000 + i, "w " * 500, "b", i) for i in range(8_000)]
    hot = table(spark, [(4_000, "long " * 5_000, "a", 0)])
    copies = hot.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(10_000)))).drop("n")
    documents = table(spark, small + other).unionByName(copies)
    found = mixing.shares(documents).collect()
    assert len(found) == 20_000
    near(found)
    taken = Counter(r["taken"] // r["size"] for r in found if r["doc_id"] == 4_000)
    assert len(taken) == 2  # some copies once more than others
    again = mixing.shares(documents.repartition(7)).collect()
    assert Counter(map(tuple, found)) == Counter(map(tuple, again))


def test_copies_that_differ_in_other_columns_are_mixed(spark):
    rows = [(1, "x y z", "a", n) for n in range(300)] + [(1, "x y z", "a", 7)] * 200
    rows += [(i, "x y z " * (i % 5), "b", 0) for i in range(2, 300)] + [(None, None, None, None)] * 3
    documents = table(spark, rows)
    found = mixing.shares(documents).collect()
    near(found)
    mixed = mixing.mixed(documents)
    assert mixed.columns == documents.columns
    got = Counter(map(tuple, mixed.collect()))
    assert sum(got.values()) == sum(r["copies"] for r in found)
    have = Counter(map(tuple, documents.collect()))
    assert all(n <= 2 * have[row] for row, n in got.items())
    assert Counter(map(tuple, mixing.mixed(documents.repartition(3)).collect())) == got


def test_blocks_of_copies(spark):
    counted = spark.createDataFrame(
        [(1, "m", "a", 1), (2, "m", "a", mixing.BLOCK), (3, "m", None, mixing.BLOCK + 1),
         (None, "m", "a", 3 * mixing.BLOCK - 1)], "doc_id long, text_md5 string, source string, copies long")
    found = mixing.numbered_copies(counted).collect()
    numbers = {}
    for r in found:
        numbers.setdefault(r["doc_id"], []).append(r["copy"])
    for r in counted.collect():
        assert sorted(numbers[r["doc_id"]]) == list(range(r["copies"]))
