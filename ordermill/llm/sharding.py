"""Shuffle a corpus into shards by a two-pass external shuffle.

First pass: every record goes to one of as many buckets as are needed for a bucket to fit into
memory, by a seeded hash of its id and text. Second pass: a task takes one bucket, puts it into
Fisher-Yates order with a generator seeded by the bucket, and writes it. Buckets behind
one another are a uniform order of the whole corpus, which is cut into shards of equal numbers of
rows (law ``rows``: counts differ by one at most).

Rows are put in hash order before the shuffle, so a repeated task gives the same order of ids and texts.
Where buckets start is a running sum over a written table; it reaches a bucket's task as a row, and nothing
that grows with the buckets passes through the driver. Copies of a row that would fill
much of a bucket are numbered and scattered by number as well.

Defined results: a NULL text counts as no bytes; a text longer than a bucket is a bucket's size by
itself. A NULL id is hashed like any other. Rows that are equal in id and text, and few, are in one
bucket; which of them takes which slot is not defined where they differ in other columns. An empty table
gives no shards. All columns are carried in ``row``, so none clashes with ``shard`` and ``slot``.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..scratch import Scratch
from .totals import with_totals

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHARDS = 40
BUCKET_BYTES = 24 * 1024 * 1024  # text that one task holds in memory, three times over
RECORD_BYTES = 16                # counted for each record besides its text
SEED = 8
KEY = ["hash_1", "hash_2"]       # of id and text: the bucket, and the place in it
ROWS_OUT = 2000                  # rows of a batch that leaves a task
HOT = 8                          # copies of a row that fill this part of a bucket are dealt out
MOST_PARTITIONS = 20_000         # of a shuffle; with more buckets a task takes several


def fisher_yates(n: int, seed: int, bucket: int) -> np.ndarray:
    """A uniform order of ``n`` rows: each place from the last on swaps with one not behind it."""
    draws = np.random.default_rng([seed, bucket]).random(n).tolist()
    order = list(range(n))
    for i in range(n - 1, 0, -1):
        j = int(draws[i] * (i + 1))
        order[i], order[j] = order[j], order[i]
    return np.array(order, np.int64)


def cut(position: np.ndarray, rows: int, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Shard and slot of positions; the first ``rows % shards`` shards have one row more."""
    least, more = divmod(rows, shards)
    longer = more * (least + 1)
    shard = np.where(position < longer, position // (least + 1),
                     more + (position - longer) // max(least, 1))
    start = np.where(shard < more, shard * (least + 1), longer + (shard - more) * least)
    return shard, position - start


def _shuffled(rows: int, shards: int, seed: int):
    """Buckets behind one another: rows of (row, bucket, place, start) become (row, shard, slot).

    Each bucket begins with a row that holds nothing but its start among all rows.
    """
    def shuffled_bucket(number: int, batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket = pa.Table.from_batches(batches)
        heads = bucket.column("start").is_valid()
        start = bucket.column("start").drop_null()[0].as_py()
        bucket = bucket.filter(pc.invert(heads))
        records = bucket.column("row").combine_chunks()
        place = bucket.column("place").to_numpy()
        by_hash = np.argsort(place, kind="stable")
        order = by_hash[fisher_yates(len(by_hash), seed, number)]
        for at in range(0, len(order), ROWS_OUT):
            part = order[at:at + ROWS_OUT]
            shard, slot = cut(start + np.arange(at, at + len(part)), rows, shards)
            yield pa.RecordBatch.from_arrays(
                [records.take(pa.array(part)), pa.array(shard.astype(np.int32)),
                 pa.array(slot.astype(np.int64))], names=["row", "shard", "slot"])

    def shuffle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = -1, []
        for batch in batches:
            buckets = batch.column("bucket").to_numpy()
            ends = [*(np.flatnonzero(np.diff(buckets)) + 1).tolist(), len(buckets)]
            at = 0
            for end in ends if len(buckets) else []:
                if held and buckets[at] != number:
                    yield from shuffled_bucket(number, held)
                    held = []
                number = int(buckets[at])
                held.append(batch.slice(at, end - at))
                at = end
        if held:
            yield from shuffled_bucket(number, held)
    return shuffle


def shuffled(documents: DataFrame, shards: int = SHARDS, bucket_bytes: int = BUCKET_BYTES,
             seed: int = SEED, most_partitions: int = MOST_PARTITIONS) -> DataFrame:
    """``row`` (all columns of the input), ``shard`` and ``slot``."""
    scratch = Scratch(documents.sparkSession, "buckets")
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + RECORD_BYTES
    row = F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row")
    hashes = [F.xxhash64(F.lit(seed + salt), "doc_id", "text").alias(name)
              for salt, name in enumerate(KEY)]
    keyed = documents.select(row, *hashes)
    narrow = scratch.table(documents.select(size.alias("bytes"), *hashes), "narrow")
    total = narrow.agg(F.sum("bytes").alias("bytes")).first()["bytes"] or 0
    buckets = max(1, -(-total // bucket_bytes))
    often = narrow.groupBy(*KEY).agg(F.count(F.lit(1)).alias("copies"), F.sum("bytes").alias("bytes"))
    often = scratch.table(often.where((F.col("copies") > 1) & (F.col("bytes") > bucket_bytes / HOT))
                          .select(*KEY), "often")
    placed = _placed(keyed, often, buckets, scratch)

    # Where each bucket starts: running sums, which go to the bucket's task as one more row.
    counts = placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    ends = with_totals(counts.withColumn("all", F.lit(0)), scratch, "counts", ["all"],
                       [F.col("bucket")], {"end": F.col("n")})
    ends = scratch.table(ends.select("bucket", "n", "end"), "ends")
    rows = ends.agg(F.max("end").alias("rows")).first()["rows"] or 0
    kind, none = placed.schema["row"].dataType, F.lit(None).cast("long")
    heads = ends.select(F.lit(None).cast(kind).alias("row"), "bucket", none.alias("place"),
                        (F.col("end") - F.col("n")).alias("start"))
    stacked = placed.select("row", "bucket", "place", none.alias("start")).unionAll(heads)
    if buckets <= most_partitions:
        dealt = stacked.repartitionById(buckets, F.col("bucket").cast("int"))
    else:  # several buckets to a task, one after the other
        group = F.floor(F.col("bucket") * most_partitions / buckets).cast("int")
        dealt = stacked.repartitionById(most_partitions, group).sortWithinPartitions("bucket")
    out = T.StructType().add("row", kind).add("shard", T.IntegerType()).add("slot", T.LongType())
    return dealt.mapInArrow(_shuffled(rows, shards, seed), out)


def _placed(keyed: DataFrame, often: DataFrame, buckets: int, scratch: Scratch) -> DataFrame:
    """row, ``bucket`` and ``place``, by hash; copies of a row that is there too ``often`` to stay in
    one bucket are numbered, and dealt out by number as well.

    They are numbered in order of a hash of the row, by sorted parts that are written.
    """
    if often.isEmpty():
        numbered = keyed.withColumn("copy", F.lit(0).cast("long"))
    else:
        several = keyed.join(often, KEY, "left_semi").withColumn("order", F.xxhash64("row"))
        several = with_totals(several, scratch, "several", KEY, [F.col("order")],
                              {"copy": F.lit(1).cast("long")})
        alone = keyed.join(often, KEY, "left_anti").withColumn("copy", F.lit(0).cast("long"))
        numbered = alone.unionByName(several.drop("order"))
    # Without a number a row is where its hash puts it.
    bucket, place = (F.when(F.col("copy") > 0, F.xxhash64(c, "copy")).otherwise(F.col(c)) for c in KEY)
    return numbered.select("row", F.pmod(bucket, F.lit(buckets)).cast("long").alias("bucket"),
                           place.alias("place"))


def write_shards(documents: DataFrame, path: str, **options) -> DataFrame:
    """Write the shards as folders ``shard=N`` of Parquet files in slot order, and read them."""
    spark = documents.sparkSession
    rows = shuffled(documents, **options)
    rows.write.partitionBy("shard").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def sharded(documents: DataFrame, **options) -> DataFrame:
    """The written shards as a table of ``row``, ``shard`` and ``slot``, in the shared folder."""
    return write_shards(documents, Scratch(documents.sparkSession, "shards").path("out"),
                        **options)
