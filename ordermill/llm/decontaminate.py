"""Find benchmark passages in documents: a prefix-filtered set join, verified exactly.

Every item is cut into windows of consecutive words. A window occurs in a document only if all
its words do, so one word is enough to look for: the prefix of the set join is the window's
rarest word, by counts over the whole corpus. Where a document has such a word, its place in the
window says where the window would start (positional bound), and the document must reach far
enough on both sides (length bound). What is left is looked up by hash and then compared
word by word.

The benchmark is cut into blocks of at most ``block_windows`` windows. A block is all that is sent
to the tasks, so its size is bounded, and no text is shuffled. One block is one pass over
the documents, or two with the count of its words.

Defined results: a NULL text, an empty one, or one without words is never hit. A NULL item has no
windows. Items with equal ids count as one item. Windows of a NULL id are hit like any others, but
are not listed or counted as an item. Rows are judged one by one, so repeated rows each get the
same result. Texts of any length are read whole. Words are told apart by 64-bit hashes, also where they
are compared one by one. Other columns of the input are not read.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import Scratch
from .words import ALPHANUMERIC, Polynomial, WordHasher

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW = 10                # words of a window
BLOCK_WINDOWS = 500_000    # windows sent to the tasks at once: about 100 bytes each
FOUND = "n_words long, starts array<int>, ends array<int>, items array<string>"


def item_windows(benchmark: DataFrame, item: str = "item_id", text: str = "text",
                 window: int = WINDOW) -> DataFrame:
    """Distinct windows as arrays of word hashes, with the ids of the items that hold them.

    The windows of an item are explicit rows from here on, so that a long item is no large task.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(ALPHANUMERIC)
        for batch in batches:
            for words in hasher.slices(batch.column(1)):
                hashes = words.hashes.view(np.int64)
                for t in range(words.texts()):
                    a, b = words.bounds[t], words.bounds[t + 1]
                    size = min(window, b - a)
                    if not size:
                        continue
                    for first in range(a, b - size + 1, 10_000):
                        last = min(first + 10_000, b - size + 1)
                        places = np.arange(first, last)[:, None] + np.arange(size)
                        values = pa.array(hashes[places].ravel())
                        offsets = pa.array(np.arange(0, len(values) + 1, size, dtype=np.int32))
                        ids = pa.array([batch.column(0)[words.first + t].as_py()] * (last - first),
                                       pa.string())
                        yield pa.RecordBatch.from_arrays(
                            [ids, pa.ListArray.from_arrays(offsets, values)],
                            names=["item", "window"])

    rows = benchmark.select(F.col(item).cast("string").alias("item"), F.col(text).alias("text"))
    return (rows.where("text is not null")
            .mapInArrow(cut, "item string, window array<long>").distinct())


class Block:
    """The windows of a block as sorted lookup arrays."""

    def __init__(self, windows: list[np.ndarray], items: list[str]):
        """``windows[i]`` occurs in ``items[i]``; a window in two items is there twice."""
        self.vocabulary = np.unique(np.concatenate(windows)) if windows else np.empty(0, np.uint64)
        self.by_size: dict[int, tuple] = {}
        polynomial = Polynomial()
        for size in sorted({len(w) for w in windows}):
            rows = [i for i, w in enumerate(windows) if len(w) == size]
            texts = np.stack([windows[i] for i in rows])
            places = np.arange(len(rows)) * size
            keys = polynomial.of(texts.ravel(), places, places + size)
            order = np.argsort(keys, kind="stable")
            texts, keys = texts[order], keys[order]
            new = np.ones(len(rows), bool)
            new[1:] = keys[1:] != keys[:-1]
            first = np.flatnonzero(new)
            # Two different windows with one key are told apart by the comparison; only the
            # first one would be found, so such a block is refused rather than answered wrongly.
            if not (texts == texts[first][np.cumsum(new) - 1]).all():
                raise ValueError("two windows have the same hash")
            holders = np.array([items[rows[i]] for i in order], dtype=object)
            self.by_size[size] = (texts[first], keys[first], np.append(first, len(rows)), holders)
        self.prefixes: dict[int, np.ndarray] = {}

    def choose_prefixes(self, counts: np.ndarray) -> None:
        """For each size and word, a bit mask of the places where it is a window's rarest word.

        Ties go to the smaller hash, which is the earlier word of the vocabulary.
        """
        for size, (texts, _, _, _) in self.by_size.items():
            word = np.searchsorted(self.vocabulary, texts)
            order = np.lexsort((np.arange(len(counts)), counts))
            rank = np.empty(len(counts), np.int64)
            rank[order] = np.arange(len(counts))
            place = np.argmin(rank[word], axis=1)
            masks = np.zeros(len(self.vocabulary), np.int64)
            np.bitwise_or.at(masks, word[np.arange(len(texts)), place], 1 << place)
            self.prefixes[size] = masks

    def known(self, hashes: np.ndarray) -> np.ndarray:
        """Positions in the vocabulary, -1 for a word of no window."""
        if not len(self.vocabulary):
            return np.full(len(hashes), -1)
        place = np.searchsorted(self.vocabulary, hashes)
        place[place == len(self.vocabulary)] = 0
        return np.where(self.vocabulary[place] == hashes, place, -1)

    def find(self, hashes: np.ndarray, first: np.ndarray, last: np.ndarray,
             polynomial: Polynomial) -> tuple[np.ndarray, np.ndarray, list]:
        """Starts and sizes of all occurrences of windows, and the ids each stands for.

        ``first`` and ``last`` bound, for each word, the text it is in.
        """
        known = self.known(hashes)
        at = np.flatnonzero(known >= 0)
        starts, sizes, ids = [], [], []
        for size, (texts, keys, holder_bounds, holders) in self.by_size.items():
            masks = self.prefixes[size][known[at]]
            for place in range(size):
                start = at[(masks >> place) & 1 == 1] - place
                word = start + place
                # length and positional bounds
                start = start[(start >= first[word]) & (start + size <= last[word])]
                if not len(start):
                    continue
                key = polynomial.of(hashes, start, start + size)
                row = np.searchsorted(keys, key)
                row[row == len(keys)] = 0
                hit = keys[row] == key
                start, row = start[hit], row[hit]
                hit = (hashes[start[:, None] + np.arange(size)] == texts[row]).all(axis=1)
                for s, r in zip(start[hit].tolist(), row[hit].tolist()):
                    starts.append(s)
                    sizes.append(size)
                    ids.append(holders[holder_bounds[r]:holder_bounds[r + 1]])
        return np.array(starts, np.int64), np.array(sizes, np.int64), ids


def _count_words(block: Block):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(ALPHANUMERIC)
        totals = np.zeros(len(block.vocabulary) + 1, np.int64)
        for batch in batches:
            for words in hasher.slices(batch.column(0)):
                totals += np.bincount(block.known(words.hashes) + 1, minlength=len(totals))
        word = np.flatnonzero(totals[1:])
        yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(totals[1:][word])],
                                         names=["word", "n"])
    return count


def _merged(starts: np.ndarray, ends: np.ndarray) -> tuple[list[int], list[int]]:
    """Overlapping or touching spans as one."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.ones(len(starts), bool)
    new[1:] = starts[1:] > ends[:-1]
    last = np.append(np.flatnonzero(new)[1:] - 1, len(starts) - 1)
    return starts[new].tolist(), ends[last].tolist()


def _search(block: Block, wide: bool):
    """Adds the found spans to each row of (row, text). ``wide``: rows without a hit stay."""
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, polynomial = WordHasher(ALPHANUMERIC), Polynomial()
        for batch in batches:
            n = batch.num_rows
            n_words = np.zeros(n, np.int64)
            spans = [[] for _ in range(n)], [[] for _ in range(n)], [[] for _ in range(n)]
            for words in hasher.slices(batch.column(1)):
                rows = np.arange(words.first, words.first + words.texts())
                n_words[rows] = np.diff(words.bounds)
                owner = words.owner()
                starts, sizes, ids = block.find(
                    words.hashes, words.bounds[owner], words.bounds[owner + 1], polynomial)
                if not len(starts):
                    continue
                text = owner[starts]
                for t in np.unique(text):
                    of = np.flatnonzero(text == t)
                    begin = starts[of] - words.bounds[t]
                    row = words.first + int(t)
                    spans[0][row], spans[1][row] = _merged(begin, begin + sizes[of])
                    spans[2][row] = sorted({i for k in of for i in ids[k]} - {None})
            out = pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words), pa.array(spans[0], pa.list_(pa.int32())),
                 pa.array(spans[1], pa.list_(pa.int32())), pa.array(spans[2], pa.list_(pa.string()))],
                names=["row", "n_words", "starts", "ends", "items"])
            yield out if wide else out.filter(pa.array([bool(s) for s in spans[0]]))
    return search


def _blocks(windows: DataFrame, block_windows: int) -> Iterator[Block]:
    """The windows, a bounded block at a time; equal windows are in the same block."""
    total = windows.count()
    n = max(1, -(-total // block_windows))
    for k in range(n):
        part = windows.where(F.pmod(F.xxhash64("window"), F.lit(n)) == k).toArrow()
        lists = part.column("window").combine_chunks()
        values = np.asarray(lists.flatten()).view(np.uint64)
        bounds = np.concatenate([[0], np.cumsum(np.asarray(lists.value_lengths()))]).astype(int)
        yield Block([values[a:b] for a, b in zip(bounds, bounds[1:])],
                    part.column("item").to_pylist())


def find_windows(documents: DataFrame, windows: DataFrame, text: str = "text",
                 block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """The documents as ``row`` (all their columns) with what was found in each.

    ``n_words``; ``starts`` and ``ends``, the merged spans of words hit; and the sorted ``items``.
    """
    spark = documents.sparkSession
    scratch = Scratch(spark, "decontaminate")
    windows = scratch.table(windows, "windows")
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"),
                            F.col(text).alias("text"))
    row_type = rows.schema["row"].dataType.simpleString()
    found = None
    for block in _blocks(windows, block_windows):
        counts = np.zeros(len(block.vocabulary), np.int64)
        if len(counts):
            tallied = (rows.select("text").mapInArrow(_count_words(block), "word long, n long")
                       .groupBy("word").agg(F.sum("n").alias("n")).toArrow())
            counts[np.asarray(tallied["word"])] = np.asarray(tallied["n"])
        block.choose_prefixes(counts)
        if found is None:
            found = rows.mapInArrow(_search(block, True), f"row {row_type}, {FOUND}")
        else:
            found = _with_more(found, rows, block, text)
    return found


def _with_more(found: DataFrame, rows: DataFrame, block: Block, text: str) -> DataFrame:
    """Add what a further block finds. Equal texts are hit alike, so the text's hash is the key."""
    def key(of: str):
        return [F.xxhash64(of).alias("key_1"), F.xxhash64(F.lit(1), of).alias("key_2")]
    texts = rows.select(F.struct(*key("text")).alias("row"), "text")
    more = (texts.mapInArrow(_search(block, False),
                             f"row struct<key_1:bigint,key_2:bigint>, {FOUND}")
            .groupBy("row").agg(*[F.first(c).alias(f"more_{c}")
                                  for c in ("starts", "ends", "items")])
            .select("row.key_1", "row.key_2", "more_starts", "more_ends", "more_items"))
    joined = (found.select("*", *key(f"row.`{text}`"))
              .join(more, ["key_1", "key_2"], "left"))

    def both(name: str):
        return F.concat(name, F.coalesce(f"more_{name}", F.array()))
    spans = F.array_sort(F.arrays_zip(both("starts").alias("s"), both("ends").alias("e")))
    # Spans in order: one that starts within the last is joined to it.
    merged = F.aggregate(
        spans, F.array().cast("array<struct<s:int,e:int>>"),
        lambda done, span: F.when(
            (F.size(done) > 0) & (span["s"] <= F.element_at(done, -1)["e"]),
            F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(
                F.element_at(done, -1)["s"].alias("s"),
                F.greatest(F.element_at(done, -1)["e"], span["e"]).alias("e")))))
        .otherwise(F.concat(done, F.array(span))))
    return (joined.withColumn("merged", merged)
            .select("row", "n_words", F.col("merged.s").alias("starts"),
                    F.col("merged.e").alias("ends"),
                    F.array_sort(F.array_distinct(both("items"))).alias("items")))


def judge(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW,
          block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """The documents as ``row``, with ``n_words``, ``n_hit``, spans, ``items``, ``contaminated``."""
    windows = item_windows(benchmark, window=window)
    found = find_windows(documents, windows, block_windows=block_windows)
    ends = F.aggregate("ends", F.lit(0).cast("long"), lambda a, x: a + x)
    hit = ends - F.aggregate("starts", F.lit(0).cast("long"), lambda a, x: a + x)
    return found.withColumn("n_hit", hit).withColumn("contaminated", F.col("n_hit") > 0)


def without_contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no benchmark window occurs, with their own columns."""
    return judge(documents, benchmark).where("not contaminated").select("row.*")
