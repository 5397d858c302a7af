"""Shards: the law, the order, and the same result for another layout of the input."""

import zlib

import numpy as np
import pytest

from ordermill.llm import queries, sharding


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


@pytest.mark.parametrize("bucket_bytes", [1 << 26, 100_000])
def test_counts_differ_by_one_at_most(spark, documents, bucket_bytes):
    found = sharding.sharded(documents, shards=7, bucket_bytes=bucket_bytes).collect()
    slots = {}
    for r in found:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert sorted(slots) == list(range(7))
    assert sorted(map(len, slots.values())) == [142] * 1 + [143] * 6
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sorted(r["row"]["doc_id"] for r in found) == list(range(1000))


def test_reruns_agree(spark, documents):
    def placed(docs):
        rows = sharding.shuffled(docs, shards=5, bucket_bytes=200_000)
        return sorted((r["row"]["doc_id"], r["shard"], r["slot"]) for r in rows.collect())
    first = placed(documents)
    assert first == placed(documents.repartition(13)) == placed(documents.coalesce(1))
    order = [d for _, _, d in sorted((s, t, d) for d, s, t in first)]
    assert abs(np.corrcoef(order, range(1000))[0, 1]) < 0.15


def laws(found, shards):
    """Gapless slots, and counts at most one apart."""
    slots = {}
    for r in found:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots.get(s, ())) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1


def test_equal_rows_are_scattered(spark):
    """A third of all rows is one row; no bucket gets more than a small part of it."""
    rows = [(i, "x" * (i % 90), "s") for i in range(6_000)] + [(None, "hot " * 20, None)] * 3_000
    rows += [(7_000, "hot " * 20, str(i)) for i in range(500)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, `my source` string")
    found = sharding.sharded(documents, shards=7, bucket_bytes=20_000).collect()
    laws(found, 7)
    assert sorted(map(tuple, (r["row"] for r in found)), key=repr) == sorted(rows, key=repr)
    order = sorted((r["shard"], r["slot"], r["row"]["doc_id"] is None) for r in found)
    hot = np.flatnonzero([h for *_, h in order])
    assert np.abs(np.histogram(hot, bins=10, range=(0, len(rows)))[0] - 300).max() < 120
    again = sharding.sharded(documents.repartition(3), shards=7, bucket_bytes=20_000).collect()
    assert sorted((r["shard"], r["slot"], *r["row"][:2]) for r in found if r["row"]["doc_id"] is not None) == (
        sorted((r["shard"], r["slot"], *r["row"][:2]) for r in again if r["row"]["doc_id"] is not None))


def test_several_buckets_in_a_task(spark, documents):
    """The same shards, whether each bucket has a task of its own or not."""
    def placed(**options):
        rows = sharding.shuffled(documents, shards=5, bucket_bytes=50_000, **options).collect()
        return sorted((r["row"]["doc_id"], r["shard"], r["slot"]) for r in rows)
    assert placed() == placed(most_partitions=3)


def test_query(spark):
    """Every column of the query against a plain program, the order by its laws."""
    folder = "/root/testdata/sf0.01"
    found = queries.op8_shards(spark, folder).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert sorted(r["doc_id"] for r in found) == sorted(texts)
    for r in found:
        data = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(data) + 16, zlib.crc32(data))
        assert r["law"] == "rows" and r["grown_shard"] is None
    laws(found, 40)


def test_files_are_in_slot_order(spark, documents, tmp_path):
    sharding.write_shards(documents, str(tmp_path / "out"), shards=3)
    for shard in range(3):
        for file in (tmp_path / "out" / f"shard={shard}").glob("*.parquet"):
            slots = [r["slot"] for r in spark.read.parquet(str(file)).collect()]
            assert slots == sorted(slots)


def test_every_order_is_as_likely():
    counts = {}
    for seed in range(6_000):
        key = tuple(sharding.fisher_yates(3, seed, 1))
        counts[key] = counts.get(key, 0) + 1
    assert len(counts) == 6 and all(850 < n < 1150 for n in counts.values())


@pytest.mark.parametrize("rows, shards", [(0, 3), (1, 3), (10, 3), (40, 40), (1001, 40)])
def test_cut(rows, shards):
    shard, slot = sharding.cut(np.arange(rows), rows, shards)
    sizes = np.bincount(shard, minlength=shards)
    assert len(sizes) == shards and sizes.max() - sizes.min() <= 1
    assert [tuple(x) for x in zip(shard, slot)] == [(s, i) for s in range(shards)
                                                    for i in range(sizes[s])]
