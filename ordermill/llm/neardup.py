"""Near-duplicate groups by HyperMinHash, with every link confirmed on full shingle sets.

1. A document's set is its distinct shingles. Documents with equal sets form a class; only
   one sketch per class goes on.
2. A HyperMinHash sketch: the hash of a shingle picks one of 256 buckets, and a bucket stores
   of its smallest hash the number of leading zeros and ten mantissa bits. An empty bucket borrows
   from the first non-empty one in an order of its own, so short texts have full sketches.
3. Bands of six registers are hashed. In a band, classes with one key are candidates. At first each
   is paired with the smallest of them only, then with members picked anew in each round, so the
   pairs grow with the members and not with their square.
4. A pair whose collision-corrected Jaccard estimate is too low goes; the rest is confirmed on full
   sets. Confirmed links are contracted to components.
5. Buckets that hold more than one component go through further rounds. At last, members outside of
   a bucket's largest component are compared with all members of other components, blocks of
   sketches at a time. These are finer, the 512 smallest hashes of a set: exact for sets up to
   that size. Pairs are told within the task, so only those that are links, or may be in
   large sets, leave it, and only in the first band they share.

A link of similarity 0.8 is missed by all 42 bands with a probability of about 3e-6. The estimate, and the
fine sketch of a pair that is told by blocks, give a pair up five standard errors below the limit;
by the normal tail each misses some 3e-7 of links of exactly 0.8, and only a link that no other
joins is lost.

Defined results: NULL, empty and wordless texts have ``n_shingles`` 0 and are linked with nothing.
Rows with equal sets are one class whatever their ids, repeated rows included. A NULL id takes
part, but is never the smallest id; a component of NULL ids only has the id NULL, and its rows are
not kept. Texts of any length are read whole; one text's shingles are held in one task. Shingles are told
apart by 64-bit hashes, so "full sets" are sets of these. Other columns of the input are not read.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import Scratch
from .words import MIX_1, MIX_2, SPACED, WordHasher, mix

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WORDS = 5          # words of a shingle
SIMILAR = 80       # percent of the union that two linked sets share at least
BUCKETS = 256      # registers of a sketch
ROWS, BANDS = 6, 42
MANTISSA = 10      # bits of a register after the leading one
ROUNDS = 1         # rounds of random partners before the rest is compared in blocks
PARTNERS = (2, None)  # partners of an outsider in a component and block, round by round
FINE = 512         # smallest hashes in a fine sketch
MARGIN = 5         # standard errors of a sketch below the limit at which a pair is given up
BLOCK = 512        # sketches compared at a time
COLUMNS = 4096     # shingle hashes of a block that are counted at a time

ROW = ["doc_id", "text_1", "text_2"]  # what tells documents apart: the id and the text's hash
SKETCH = ("doc_id long, text_1 long, text_2 long, n long, set_1 long, set_2 long, "
          "sketch binary")


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct shingles of a text's words; fewer words are one shingle."""
    if not len(hashes):
        return hashes
    size = min(size, len(hashes))
    out = hashes[:len(hashes) - size + 1].copy()
    for k in range(1, size):
        out = mix(out * MIX_1 + hashes[k:len(hashes) - size + 1 + k])
    return np.unique(mix(out + np.full(1, size, np.uint64) * MIX_2))


def set_hash(values: np.ndarray) -> tuple[int, int]:
    """128 bits that tell sets of shingles apart."""
    sums = values.sum(dtype=np.uint64), mix(values ^ MIX_1).sum(dtype=np.uint64)
    return int(sums[0].view(np.int64)), int(sums[1].view(np.int64))


def probes() -> np.ndarray:
    """For each bucket, the order in which it looks for a non-empty one; itself first."""
    order = np.random.default_rng(20).permuted(
        np.tile(np.arange(BUCKETS), (BUCKETS, 1)), axis=1)
    order[np.arange(BUCKETS), np.argmax(order == np.arange(BUCKETS)[:, None], axis=1)] = order[:, 0]
    order[:, 0] = np.arange(BUCKETS)
    return order


def registers(values: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The sketch of sorted distinct 64-bit values: leading zeros and mantissa per bucket."""
    bucket = (values >> np.uint64(56)).astype(np.int64)
    first = np.flatnonzero(np.diff(bucket, prepend=-1))
    rest = (values[first] & np.uint64((1 << 56) - 1)) >> np.uint64(3)  # 53 bits: a double is exact
    bits = rest.astype(np.float64).view(np.uint64)
    zeros = np.clip(1023 + 52 - (bits >> np.uint64(52)).astype(np.int64), 0, 63)
    mantissa = ((bits >> np.uint64(52 - MANTISSA)) & np.uint64((1 << MANTISSA) - 1)).astype(np.int64)
    full = np.zeros(BUCKETS, bool)
    full[bucket[first]] = True
    own = np.zeros(BUCKETS, np.uint16)
    own[bucket[first]] = (zeros << MANTISSA) | mantissa
    lender = order[np.arange(BUCKETS), np.argmax(full[order], axis=1)]
    return own[lender]


def _sketches(size: int):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, order = WordHasher(SPACED), probes()
        for batch in batches:
            n, set_1, set_2, sketches = [], [], [], []
            for words in hasher.slices(batch.column(3)):
                for t in range(words.texts()):
                    s = shingles(words.hashes[words.bounds[t]:words.bounds[t + 1]], size)
                    n.append(len(s))
                    for column, value in zip((set_1, set_2), set_hash(s)):
                        column.append(value)
                    sketches.append(registers(s, order).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(n, pa.int64()), pa.array(set_1, pa.int64()),
                 pa.array(set_2, pa.int64()), pa.array(sketches, pa.binary())],
                names=[*ROW, "n", "set_1", "set_2", "sketch"])
    return sketch


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, node) for every band of every sketch."""
    band = mix(np.arange(1, BANDS + 1, dtype=np.uint64))
    for batch in batches:
        for at in range(0, batch.num_rows, 2000):
            part = batch.slice(at, 2000)
            table = _table(part.column(1))[:, :ROWS * BANDS].reshape(-1, BANDS, ROWS)
            keys = np.broadcast_to(band, table.shape[:2]).copy()
            for k in range(ROWS):
                keys = mix(keys * MIX_1 + table[:, :, k].astype(np.uint64))
            nodes = np.repeat(part.column(0).to_numpy(), BANDS)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.ravel().view(np.int64)),
                 pa.array(np.tile(np.arange(BANDS, dtype=np.int32), part.num_rows)),
                 pa.array(nodes)], names=["key", "band", "node"])


def _table(sketches: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(sketches.to_pylist()), np.uint16).reshape(-1, BUCKETS)


class Estimate:
    """Jaccard estimates from sketches, corrected for registers that agree by accident."""

    def __init__(self):
        self.accidents: dict[tuple[int, int], float] = {}

    def accident(self, n: float, m: float) -> float:
        """Probability that two unrelated sets of these sizes agree in a register.

        The smallest of n uniform hashes in a bucket falls into a cell of a register with the
        probability below; the cells of one zero count are summed as an integral.
        """
        a, b = max(1.0, n / BUCKETS), max(1.0, m / BUCKETS)
        key = round(4 * math.log2(a)), round(4 * math.log2(b))
        if key not in self.accidents:
            total = 0.0
            for zeros in range(48):
                low, high = 2.0 ** -(zeros + 1), 2.0 ** -zeros
                x = np.linspace(low, high, 33)
                width = (high - low) / (1 << MANTISSA)
                density = a * (1 - x) ** (a - 1) * b * (1 - x) ** (b - 1)
                total += float(np.trapezoid(density, x)) * width
            self.accidents[key] = min(total, 0.5)
        return self.accidents[key]

    def corrected(self, equal: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
        """``equal``: the share of registers that agree."""
        pairs = np.stack([np.log2(np.maximum(n, 1)) * 4, np.log2(np.maximum(m, 1)) * 4]).round()
        unique, where = np.unique(pairs, axis=1, return_inverse=True)
        by_size = np.array([self.accident(2 ** (x / 4), 2 ** (y / 4)) for x, y in unique.T])
        accident = by_size[where.ravel()]
        return (equal - accident) / (1 - accident)

    @staticmethod
    def least(n: np.ndarray, m: np.ndarray, similar: int) -> np.ndarray:
        """The estimate below which a pair is given up: ``MARGIN`` standard errors below the limit."""
        s = similar / 100
        return s - MARGIN * np.sqrt(s * (1 - s) / np.minimum(np.minimum(n, m), BUCKETS))


def _fits(n: Column, m: Column, similar: int) -> Column:
    """Sizes between which the similarity can be reached at all."""
    return F.least(n, m) * 100 >= F.greatest(n, m) * similar


def _plausible(similar: int):
    """Pairs (a, b, n_a, n_b, sketch_a, sketch_b) whose estimate may be a link."""
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        estimate = Estimate()
        for batch in batches:
            if batch.num_rows:
                n, m = batch.column(2).to_numpy(), batch.column(3).to_numpy()
                equal = (_table(batch.column(4)) == _table(batch.column(5))).mean(axis=1)
                good = estimate.corrected(equal, n, m) >= Estimate.least(n, m, similar)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(good))
    return check


def _sets(size: int):
    """(set_1, set_2, shingles, fine) of each text."""
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(SPACED)
        for batch in batches:
            for words in hasher.slices(batch.column(0)):
                values = [shingles(words.hashes[a:b], size)
                          for a, b in zip(words.bounds, words.bounds[1:])]
                offsets = np.concatenate([[0], np.cumsum([len(v) for v in values])])
                flat = np.concatenate(values).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(column, pa.int64()) for column in zip(*map(set_hash, values))),
                     pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat)),
                     pa.array([(v[:FINE] >> np.uint64(32)).astype(np.uint32).tobytes()
                               for v in values], pa.binary())],
                    names=["set_1", "set_2", "shingles", "fine"])
    return sets


class Fine:
    """Fine sketches of one side of a block: the smallest shingle hashes, all of a small set."""

    def __init__(self, sketches: pa.Array, n: np.ndarray):
        self.parts = [np.frombuffer(x, np.uint32) for x in sketches.to_pylist()]
        # up to this hash the sketch is complete
        self.upto = np.array([p[-1] if size > FINE else 0xFFFFFFFF
                              for p, size in zip(self.parts, n)], np.uint32)
        self.hashes = np.concatenate(self.parts)
        self.owner = np.repeat(np.arange(len(self.parts)), [len(p) for p in self.parts])

    def common(self, other: Fine) -> np.ndarray:
        """For each set and each of ``other``, how many hashes their sketches share.

        Hashes that stand on one side only count for nothing. The sketches are rows of zeros and ones
        over the others, ``COLUMNS`` of them at a time, and their products are the counts.
        """
        both = np.intersect1d(self.hashes, other.hashes)
        out = np.zeros((len(self.parts), len(other.parts)), np.float32)
        sides = []
        for side in (self, other):
            at = np.minimum(np.searchsorted(both, side.hashes), max(len(both) - 1, 0))
            here = both[at] == side.hashes if len(both) else np.zeros(len(at), bool)
            order = np.argsort(at[here], kind="stable")
            sides.append((len(side.parts), side.owner[here][order], at[here][order]))
        for first in range(0, len(both), COLUMNS):
            tables = []
            for rows, owner, column in sides:
                low, high = np.searchsorted(column, [first, first + COLUMNS])
                table = np.zeros((rows, min(COLUMNS, len(both) - first)), np.float32)
                table[owner[low:high], column[low:high] - first] = 1
                tables.append(table)
            out += tables[0] @ tables[1].T
        return out

    def within(self, upto: np.ndarray) -> np.ndarray:
        """For each set and each bound, how many hashes of the sketch are up to it."""
        return np.stack([np.searchsorted(p, upto, "right") for p in self.parts])

    def may_link(self, other: Fine, similar: int) -> np.ndarray:
        """For each set and each of ``other``, whether they may be similar enough.

        Both are compared up to the hash to which both sketches are complete. That is exact for
        small sets, and a uniform sample of the union for others.
        """
        common = self.common(other)
        # A sketch holds nothing beyond its own bound, so the other one's is the only one that cuts.
        union = self.within(other.upto) + other.within(self.upto).T - common
        upto = np.minimum(self.upto[:, None], other.upto[None, :])
        s = similar / 100
        margin = np.where(upto < 0xFFFFFFFF, MARGIN * np.sqrt(s * (1 - s) / np.maximum(union, 1)), 1e-9)
        return common >= (s - margin) * union


def _block_pairs(similar: int, most: int | None):
    """Pairs that may be links, from rows of (band, outsiders, members): blocks of sketches.

    A pair is told in the first band it shares only, if both its sketches agree well enough.
    ``most`` bounds the partners that an outsider gets from one component and block; one link to
    a component is enough, and a later round without the bound has the rest.
    """
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        estimate = Estimate()
        for batch in batches:
            for i in range(batch.num_rows):
                band = batch.column(0)[i].as_py()
                left, right = (batch.column(c)[i].values for c in (1, 2))
                if not len(left) or not len(right):
                    continue
                node_l, node_r = (x.field("node").to_numpy() for x in (left, right))
                root_l, root_r = (x.field("root").to_numpy() for x in (left, right))
                n_l, n_r = (x.field("n").to_numpy() for x in (left, right))
                table_l, table_r = (_table(x.field("sketch")) for x in (left, right))
                fine_l, fine_r = Fine(left.field("fine"), n_l), Fine(right.field("fine"), n_r)
                # What is exact for small sets comes first; few pairs are left for the registers.
                good = fine_l.may_link(fine_r, similar)
                good &= root_l[:, None] != root_r[None, :]
                good &= (np.minimum(n_l[:, None], n_r[None, :]) * 100
                         >= np.maximum(n_l[:, None], n_r[None, :]) * similar)
                found = []
                for x in np.flatnonzero(good.any(axis=1)).tolist():
                    places = np.flatnonzero(good[x])
                    same = table_r[places] == table_l[x]
                    shared = same[:, :ROWS * BANDS].reshape(-1, BANDS, ROWS).all(axis=2)
                    n, m = np.full(len(places), n_l[x]), n_r[places]
                    score = estimate.corrected(same.mean(axis=1), n, m)
                    keep = (shared.argmax(axis=1) == band) & shared[:, band]
                    keep &= score >= Estimate.least(n, m, similar)
                    places, score = places[keep], score[keep]
                    if most and len(places):
                        places = places[_best(score, root_r[places], most)]
                    found += [(node_l[x], y) for y in node_r[places].tolist()]
                pairs = np.sort(np.array(found, np.int64).reshape(-1, 2), axis=1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])
    return compare


def _best(score: np.ndarray, root: np.ndarray, most: int) -> np.ndarray:
    """At most ``most`` places of each root, the best ones."""
    order = np.lexsort((-score, root))
    first = np.flatnonzero(np.diff(root[order], prepend=-1))
    rank = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
    return order[rank < most]


class NearDuplicates:
    """One run over a table of documents; its intermediate tables are written."""

    def __init__(self, documents: DataFrame, words: int = WORDS, similar: int = SIMILAR,
                 doc_id: str = "doc_id", text: str = "text"):
        self.words, self.similar = words, similar
        self.scratch = Scratch(documents.sparkSession, "neardup")
        self.step = 0
        self.texts = documents.select(F.col(doc_id).cast("long").alias("doc_id"),
                                      *text_key(F.col(text)), F.col(text).alias("text"))
        sketches = self.scratch.table(
            self.texts.mapInArrow(_sketches(words), SKETCH), "sketches")
        # One row per distinct set. Its node id is fixed by being written.
        self.classes = self.scratch.table(
            sketches.where("n > 0").groupBy("set_1", "set_2")
            .agg(F.min("doc_id").alias("least"), F.first("n").alias("n"),
                 F.first("sketch").alias("sketch"))
            .withColumn("node", F.monotonically_increasing_id()), "classes")
        self.rows = self.scratch.table(sketches.drop("sketch"), "rows")
        self.scratch.drop("sketches")

    def _keep(self, rows: DataFrame, name: str) -> DataFrame:
        self.step += 1
        return self.scratch.table(rows, f"{name}_{self.step}")

    def _prepare(self) -> None:
        """Members of shared band keys, the classes they are, and the full sets of these."""
        bands = self.classes.select("node", "sketch").mapInArrow(
            _bands, "key long, band int, node long")
        shared = self._keep(bands.groupBy("key").agg(F.count(F.lit(1)).alias("size"))
                            .where("size > 1").select("key"), "keys")
        self.members = self._keep(bands.join(shared, "key"), "members")
        nodes = self._keep(self.members.select("node").distinct(), "nodes")
        self.candidates = self._keep(self.classes.join(nodes, "node", "left_semi"), "candidates")
        self.classes = self.scratch.table(self.classes.drop("n", "sketch"), "all_classes")
        self.scratch.drop("classes")
        # Rows with the id of a class may have other texts; the hash of the set tells them apart.
        ids = self.candidates.select(F.col("least").alias("doc_id")).distinct()
        texts = self.texts.alias("t").join(
            ids.alias("i"), F.col("t.doc_id").eqNullSafe(F.col("i.doc_id")), "left_semi")
        key = ["set_1", "set_2"]
        self.sets = self._keep(
            texts.select("text").where("text is not null")
            .mapInArrow(_sets(self.words),
                        "set_1 long, set_2 long, shingles array<long>, fine binary")
            .join(self.candidates.select(*key, "node"), key)
            .groupBy(*key, "node").agg(F.first("shingles").alias("shingles"),
                                       F.first("fine").alias("fine"))
            .select("node", "shingles", "fine"), "sets")
        self.labels = self._keep(nodes.select("node", F.col("node").alias("root")), "labels")

    def _links(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that are links, confirmed on their full sets."""
        side = self.candidates.select("node", "n", "sketch")

        def of(name: str, table: DataFrame) -> DataFrame:
            return table.select(*[F.col(c).alias(name if c == "node" else f"{c}_{name}")
                                  for c in table.columns])
        sketched = (pairs.join(of("b", side), "b").join(of("a", side), "a")
                    .where(_fits(F.col("n_a"), F.col("n_b"), self.similar))
                    .select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b"))
        plausible = self._keep(sketched.mapInArrow(
            _plausible(self.similar), "a long, b long"), "plausible")
        sets = self.sets.select("node", "shingles")
        both = plausible.join(of("b", sets), "b").join(of("a", sets), "a")
        common = F.size(F.array_intersect("shingles_a", "shingles_b"))
        union = F.size("shingles_a") + F.size("shingles_b") - F.col("common")
        return self._keep(both.withColumn("common", common)
                          .where(F.col("common") * 100 >= union * self.similar)
                          .select("a", "b"), "links")

    def _unite(self, links: DataFrame) -> None:
        """Contract the links: every root hooks to its smallest neighbour, over and over."""
        def rooted(name: str) -> DataFrame:
            return self.labels.select(F.col("node").alias(name),
                                      F.col("root").alias(f"root_{name}"))
        edges = self._edges(links.join(rooted("a"), "a").join(rooted("b"), "b")
                            .select(F.col("root_a").alias("a"), F.col("root_b").alias("b")))
        while not edges.isEmpty():
            both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
            up = self._keep(both.groupBy("a").agg(F.min("b").alias("b"))
                            .select("a", F.least("a", "b").alias("b")), "up")
            moved = True
            while moved:  # until each leads to the end of its chain
                far = up.select(F.col("a").alias("b"), F.col("b").alias("c"))
                jumped = self._keep(
                    up.join(far, "b", "left").select("a", "b", F.coalesce("c", "b").alias("c")),
                    "jumped")
                moved = not jumped.where("b <> c").isEmpty()
                up = jumped.select("a", F.col("c").alias("b"))
            self.labels = self._keep(
                self.labels.join(up.select(F.col("a").alias("root"), "b"), "root", "left")
                .select("node", F.coalesce("b", "root").alias("root")), "labels")
            ends = up.select(F.col("a").alias("a"), F.col("b").alias("x"))
            edges = self._edges(
                edges.join(ends, "a").join(ends.select(F.col("a").alias("b"),
                                                       F.col("x").alias("y")), "b")
                .select(F.col("x").alias("a"), F.col("y").alias("b")))

    def _edges(self, pairs: DataFrame) -> DataFrame:
        return self._keep(pairs.where("a <> b").select(
            F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")

    def _mixed(self) -> DataFrame:
        """Members with their roots, of band keys that hold more than one component."""
        rooted = self.members.join(self.labels, "node")
        keys = (rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"),
                                          F.count(F.lit(1)).alias("size"))
                # a pair alone was tested in the first round
                .where("low <> high and size > 2").select("key"))
        keys = self._keep(keys, "mixed_keys")
        mixed = self._keep(self.members.join(keys, "key", "left_semi").join(self.labels, "node"),
                           "mixed")
        self.members = mixed.drop("root")
        return mixed

    def _partners(self, rooted: DataFrame, order: Column) -> DataFrame:
        """Every member of a band key with the key's first member by ``order``."""
        chosen = self._keep(
            rooted.groupBy("key").agg(F.min_by(F.struct("node", "root"), order).alias("first"))
            .select("key", F.col("first.node").alias("b"), F.col("first.root").alias("root_b")),
            "chosen")
        return (rooted.join(chosen, "key").where("root <> root_b")
                .select(F.least("node", "b").alias("a"), F.greatest("node", "b").alias("b"))
                .distinct())

    def _from_blocks(self, mixed: DataFrame, most: int | None) -> DataFrame:
        sizes = mixed.groupBy("key", "root").agg(F.count(F.lit(1)).alias("size"))
        main = self._keep(sizes.groupBy("key").agg(
            F.max_by("root", F.struct("size", -F.col("root"))).alias("main"),
            F.sum("size").alias("members"), F.max("size").alias("in_main")), "main")
        outside = F.ceil((F.col("members") - F.col("in_main")) / BLOCK)  # blocks of a key
        inside = F.ceil(F.col("members") / BLOCK)
        rows = mixed.join(main, "key")

        def placed(part: DataFrame, own: str, blocks: Column, other: str,
                   times: Column) -> DataFrame:
            """A row for each block of the other side that the node's block is to meet."""
            return part.select(
                "key", "band", "node", "root", F.lit(own == "outsiders").alias("outsider"),
                F.pmod(F.xxhash64("node"), blocks).alias(own),
                F.explode(F.sequence(F.lit(0).cast("long"), times - 1)).alias(other))
        away = placed(rows.where("root <> main"), "outsiders", outside, "others", inside)
        pairs = away.unionByName(placed(rows, "others", inside, "outsiders", outside))
        # Sketches join last, so they are shuffled once.
        rich = pairs.join(self.candidates.select("node", "n", "sketch"), "node").join(
            self.sets.select("node", "fine"), "node")
        entry = F.struct("node", "root", "n", "sketch", "fine")
        return (rich.groupBy("key", "band", "outsiders", "others")
                .agg(F.collect_list(F.when(F.col("outsider"), entry)).alias("outsider_rows"),
                     F.collect_list(F.when(~F.col("outsider"), entry)).alias("member_rows"))
                .select("band", "outsider_rows", "member_rows")
                .mapInArrow(_block_pairs(self.similar, most), "a long, b long").distinct())

    def run(self) -> DataFrame:
        """(set_1, set_2, node, root) of every class; a class without links is its own root."""
        self._prepare()
        tested = None
        rooted = self.members.withColumn("root", F.col("node"))
        steps = ["first", *range(ROUNDS), *PARTNERS]
        for place, step in enumerate(steps):
            if place:
                rooted = self._mixed()
                if rooted.isEmpty():
                    break
            if place == 0:
                pairs = self._partners(rooted, F.col("node"))
            elif place <= ROUNDS:
                pairs = self._partners(rooted, F.xxhash64("node", F.lit(step)))
            else:
                pairs = told = self._keep(self._from_blocks(rooted, step), "told")
            if tested is not None:
                pairs = pairs.join(tested, ["a", "b"], "left_anti")
            pairs = self._keep(pairs, "pairs")
            tested = pairs if tested is None else tested.unionByName(pairs)
            links = self._links(pairs)
            self._unite(links)
            if place > ROUNDS and links.count() == told.count():
                break  # whoever may have a link to a component has one now
        return (self.classes.select("set_1", "set_2", "node", "least")
                .join(self.labels, "node", "left")
                .withColumn("root", F.coalesce("root", "node")))

    def documents(self) -> DataFrame:
        """ROW, n_shingles, component_id and root (NULL without shingles) of every document."""
        roots = self._keep(self.run(), "roots")
        least = self._keep(roots.groupBy("root").agg(F.min("least").alias("component_id")), "least")
        classes = self._keep(roots.join(least, "root")
                             .select("set_1", "set_2", "component_id", "root"), "components")
        rows = self.rows.select(*ROW, F.col("n").alias("n_shingles"), "set_1", "set_2")
        linked = rows.where("n_shingles > 0").join(classes, ["set_1", "set_2"])
        alone = rows.where("n_shingles = 0").select(
            *ROW, "n_shingles", F.col("doc_id").alias("component_id"),
            F.lit(None).cast("long").alias("root"))
        return linked.select(*alone.columns).unionByName(alone)


def text_key(text: Column) -> list[Column]:
    """128 bits that tell texts apart."""
    return [F.xxhash64(text).alias("text_1"), F.xxhash64(F.lit(1), text).alias("text_2")]


def near_duplicates(documents: DataFrame, words: int = WORDS, similar: int = SIMILAR,
                    doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept; one row per document."""
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
    return NearDuplicates(documents, words, similar, doc_id, text).documents().select(
        "doc_id", "n_shingles", "component_id", kept.alias("kept"))


def one_of_each_group(documents: DataFrame, words: int = WORDS,
                      similar: int = SIMILAR) -> DataFrame:
    """One document of each group, that with the smallest id; all columns of the input.

    Documents without shingles are linked with nothing, so all of them stay. Of several rows with
    the smallest id, that with the smallest text hash stays; of identical rows, any one.
    """
    run = NearDuplicates(documents, words, similar)
    found = run._keep(run.documents().where("root is not null")
                      .groupBy("root", *ROW).agg(F.count(F.lit(1)).alias("copies")), "found")
    best = F.struct(F.col("doc_id").isNull(), *ROW)
    chosen = found.groupBy("root").agg(F.min(best).alias("best")).select("root", "best.*")
    chosen = run._keep(chosen.select("root", *ROW), "best")
    mark = found.alias("f").join(chosen.withColumn("stays", F.lit(True)).alias("c"),
                                 F.expr("f.root = c.root and f.doc_id <=> c.doc_id "
                                        "and f.text_1 = c.text_1 and f.text_2 = c.text_2"), "left")
    mark = run._keep(mark.select(*[f"f.{c}" for c in ROW], "f.copies", "c.stays"), "mark")

    row = F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row")
    keyed = documents.select(row, F.col("doc_id").cast("long").alias("doc_id"),
                             *text_key(F.col("text")))
    same = F.expr("d.doc_id <=> m.doc_id and d.text_1 = m.text_1 and d.text_2 = m.text_2")
    repeated = mark.where("stays and copies > 1")
    out = keyed.alias("d").join(mark.where("stays is null or copies > 1").alias("m"), same,
                                "left_anti").select("row.*")
    if not repeated.isEmpty():
        once = (keyed.alias("d").join(repeated.alias("m"), same, "left_semi")
                .groupBy(*ROW).agg(F.first("row").alias("row")))
        out = out.unionByName(once.select("row.*"))
    return out
