"""The prefix trie of conversations, with a count-min sketch that finds what is not shared.

1. Turns are numbered within their conversation, and every conversation is rebuilt: it may begin with the
   first turns of another one. Only hashes, sizes and ids of turns move; texts stay where they are read.
2. The digest of a prefix is a running sum of hashes of (depth, turn), three times 31 bits wide, so a
   conversation of any length is summed in parts.
3. Every prefix is counted in a count-min sketch, whose counters stop at two. Each task fills one, blocks
   of them are added up, and the whole, of a fixed size, goes to all tasks. A prefix that is
   estimated at one, or continues such a one, is proven to be of one conversation only. Its node is
   complete without a shuffle, but for the parent of the first.
4. Only the other prefixes, shared or possibly so, are grouped by digest. What a subtree sums up comes from
   its members: a childless node counts for the smallest conversation in it, and so does what a
   node saves. Sums over the rest of a conversation are added up by node, so there are as many
   shuffles for a trie of any depth.
5. The ids that end in a node are ordered over ranges; each range joins the ids of a node to one piece of text,
   and only pieces meet for the hash.

More prefixes than the sketch has cells leave fewer proven and change no result.

Defined results: turns are ordered by number, NULL first, equal numbers by role and then by hash
of the text; NULL role or text counts as empty. Rows without a conv_id belong to no conversation.
Repeated rows are turns of their own. A hash of a turn's role and text has 128 bits, a prefix 93;
texts of any length count whole. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import Scratch
from .totals import with_totals
from .words import MIX_1, mix

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FAMILY = 5               # conversations begin like the last one before them that this divides
MOST_SHARED = 9          # the number of those turns is below this
CELLS = 1 << 24          # counters of a row of the sketch; four take a byte
SKETCH_ROWS = 2
BLOCK = 1 << 16          # counters that are added up together
PIECE_IDS = 100_000      # ids in one piece of text

DIGEST = ["depth", "d1", "d2", "d3"]
ABOVE = ["above_1", "above_2", "above_3"]


# --- the sketch ------------------------------------------------------------------------

def cells(rows: list[np.ndarray], row: int, width: int) -> np.ndarray:
    """The cell of each prefix in a row of the sketch."""
    h = np.full(len(rows[0]), row + 1, np.uint64)
    for values in rows:
        h = mix(h * MIX_1 + values.astype(np.uint64))
    return (h % np.uint64(width)).astype(np.int64)


def _columns(batch: pa.RecordBatch, names: list[str]) -> list[np.ndarray]:
    return [batch.column(n).to_numpy(zero_copy_only=False) for n in names]


def _fill(width: int):
    """Blocks of the counters of one task, saturated at 2, compressed; blocks of zeros are left out."""
    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = np.zeros((SKETCH_ROWS, width), np.uint8)
        for batch in batches:
            prefix = _columns(batch, DIGEST)
            for row in range(SKETCH_ROWS):
                cell, n = np.unique(cells(prefix, row, width), return_counts=True)
                counters[row, cell] = np.minimum(counters[row, cell] + np.minimum(n, 2), 2)
        flat = counters.reshape(-1, BLOCK)
        for block in np.flatnonzero(flat.any(axis=1)).tolist():
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int32()), pa.array([zlib.compress(flat[block], 1)])],
                names=["block", "counters"])
    return fill


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks, ordered by number, added up and packed to two bits a counter."""
    def done(block: int, total: np.ndarray) -> pa.RecordBatch:
        bits = np.stack([total & 1, total >> 1], axis=1).ravel()
        return pa.RecordBatch.from_arrays(
            [pa.array([block], pa.int32()), pa.array([np.packbits(bits).tobytes()])],
            names=["block", "counters"])
    now, total = -1, np.zeros(0, np.uint8)
    for batch in batches:
        for block, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            more = np.frombuffer(zlib.decompress(packed), np.uint8)
            if block == now:
                total = np.minimum(total + more, 2)
            else:
                if now >= 0:
                    yield done(now, total)
                now, total = block, more
    if now >= 0:
        yield done(now, total)


def sketch(prefixes: DataFrame, width: int = CELLS) -> np.ndarray:
    """Counters of all prefixes, 0 to 2: ``SKETCH_ROWS`` times ``width`` of them, whatever the input."""
    kind = "block int, counters binary"
    found = (prefixes.select(*DIGEST).mapInArrow(_fill(width), kind)
             .repartition("block").sortWithinPartitions("block").mapInArrow(_add_up, kind).toArrow())
    packed = np.zeros((SKETCH_ROWS * width // BLOCK, BLOCK // 4), np.uint8)
    for block, counters in zip(found["block"].to_pylist(), found["counters"].to_pylist()):
        packed[block] = np.frombuffer(counters, np.uint8)
    return packed.reshape(SKETCH_ROWS, width // 4)


def estimate(packed: np.ndarray, prefix: list[np.ndarray]) -> np.ndarray:
    """The least counter of each prefix; 1 proves that there is only one."""
    least = np.full(len(prefix[0]), 2, np.uint8)
    for row in range(SKETCH_ROWS):
        cell = cells(prefix, row, packed.shape[1] * 4)
        pair = packed[row, cell >> 2] >> (6 - 2 * (cell & 3)).astype(np.uint8) & 3
        least = np.minimum(least, (pair >> 1) + 2 * (pair & 1))
    return least


def _prove(packed: np.ndarray):
    """Adds ``alone`` and ``alone_above``: whether a prefix, and the one above, is proven single."""
    def prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            depth = batch.column("depth").to_numpy()
            above = estimate(packed, [depth - 1, *_columns(batch, ABOVE)]) == 1
            above &= depth > 1
            alone = above | (estimate(packed, _columns(batch, DIGEST)) == 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(alone), pa.array(above)],
                                             names=[*batch.schema.names, "alone", "alone_above"])
    return prove


# --- conversations ---------------------------------------------------------------------

def shared_turns(conv_id: Column) -> Column:
    return F.crc32(conv_id.cast("string").cast("binary")) % MOST_SHARED


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, bytes of the text, and two 64-bit hashes of role and text."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    return conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"),
        F.octet_length(text).cast("long").alias("bytes"),
        *[F.xxhash64(F.lit(seed), role, text).alias(name) for seed, name in ((1, "h1"), (2, "h2"))])


def rebuilt(conversations: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, depth, bytes, h1, h2), and conversations (conv_id, length), after rebuilding."""
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("h1"), F.col("h2"), F.col("bytes")]
    narrow = scratch.table(turns(conversations), "narrow")  # so that texts are read once
    numbered = scratch.table(
        with_totals(narrow, scratch, "turns", ["conv_id"], order, {"place": F.lit(1).cast("long")})
        .select("conv_id", "place", "bytes", "h1", "h2"), "numbered")
    first = F.col("conv_id") - F.col("conv_id") % FAMILY
    own = numbered.groupBy("conv_id").agg(F.count(F.lit(1)).alias("turns")).select(
        "*", first.alias("first"),
        F.when(first == F.col("conv_id"), 0).otherwise(shared_turns(F.col("conv_id")))
        .cast("long").alias("wanted"))
    heads = numbered.where((first == F.col("conv_id")) & (F.col("place") < MOST_SHARED))
    lengths = heads.groupBy("conv_id").agg(F.count(F.lit(1)).alias("head"))
    lists = scratch.table(
        own.alias("o").join(lengths.alias("l"), F.expr("o.first = l.conv_id"), "left").select(
            "o.conv_id", "first", "turns", "wanted",
            F.least("wanted", F.coalesce("head", F.lit(0))).cast("long").alias("given")), "lists")
    given = (lists.where("given > 0").alias("l")
             .join(heads.alias("h"), F.expr("l.first = h.conv_id and h.place <= l.given"))
             .select("l.conv_id", F.col("place").alias("depth"), "bytes", "h1", "h2"))
    rest = (numbered.alias("n").join(lists.alias("l"), "conv_id").where("place > wanted")
            .select("conv_id", (F.col("place") - F.col("wanted") + F.col("given")).alias("depth"),
                    "bytes", "h1", "h2"))
    length = F.col("given") + F.greatest(F.col("turns") - F.col("wanted"), F.lit(0))
    return given.unionAll(rest), lists.select("conv_id", length.alias("length"))


def prefixes(conversations: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Every prefix but the empty one: conv_id, length of the conversation, digest, the digest of the
    prefix above, and bytes of the last text; and the conversations' lengths."""
    each, lengths = rebuilt(conversations, scratch)
    bits = (1 << 31) - 1
    terms = [F.xxhash64(F.lit(seed), "depth", "h1", "h2").bitwiseAND(F.lit(bits).cast("long"))
             for seed in (11, 12, 13)]
    each = each.select("*", *[t.alias(f"t{i}") for i, t in enumerate(terms, 1)])
    summed = with_totals(each, scratch, "rebuilt", ["conv_id"], [F.col("depth")],
                         {f"d{i}": F.col(f"t{i}") for i in (1, 2, 3)})
    lengths = scratch.table(lengths, "lengths")
    out = summed.join(lengths, "conv_id").select(
        "conv_id", "length", "depth", "d1", "d2", "d3",
        *[(F.col(f"d{i}") - F.col(f"t{i}")).alias(f"above_{i}") for i in (1, 2, 3)], "bytes")
    return scratch.table(out, "prefixes"), lengths


# --- nodes -----------------------------------------------------------------------------

def _join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids in order, joined by commas: one piece per node and up to ``PIECE_IDS`` ids."""
    now, ids = None, []

    def piece() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [*[pa.array([v], pa.int64()) for v in now], pa.array([ids[0]], pa.int64()),
             pa.array([",".join(map(str, ids))])], names=[*DIGEST, "first_id", "ids"])
    for batch in batches:
        for *node, conv_id in zip(*(c.to_pylist() for c in batch.columns)):
            if node != now or len(ids) == PIECE_IDS:
                if ids:
                    yield piece()
                now, ids = node, []
            ids.append(conv_id)
    if ids:
        yield piece()


def _hash_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The SHA-256 over the pieces of each node, in order; one piece is held at a time."""
    now, state = None, hashlib.sha256()

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [*[pa.array([v], pa.int64()) for v in now], pa.array([state.hexdigest()])],
            names=[*DIGEST, "ends_sha256"])
    for batch in batches:
        for *node, _, ids in zip(*(c.to_pylist() for c in batch.columns)):
            if node != now:
                if now:
                    yield done()
                now, state = node, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
    if now:
        yield done()


def end_hashes(ends: DataFrame) -> DataFrame:
    """For each node in which conversations end: the hash of their ids. ``ends``: node and conv_id."""
    node = ", ".join(f"{c} long" for c in DIGEST)
    by = [F.col(c) for c in [*DIGEST, "conv_id"]]
    pieces = (ends.select(*by).repartitionByRange(*by).sortWithinPartitions(*by)
              .mapInArrow(_join_ids, f"{node}, first_id long, ids string"))
    return (pieces.repartition(*DIGEST).sortWithinPartitions(*DIGEST, "first_id")
            .mapInArrow(_hash_pieces, f"{node}, ends_sha256 string"))


def trie(conversations: DataFrame, width: int = CELLS) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256."""
    scratch = Scratch(conversations.sparkSession, "trie")
    every, lengths = prefixes(conversations, scratch)
    schema = f"{', '.join(f'{c} {t}' for c, t in every.dtypes)}, alone boolean, alone_above boolean"
    every = scratch.table(every.mapInArrow(_prove(sketch(every, width)), schema), "proven")
    alone = every.where("alone")

    # Possibly shared prefixes, and the root for every conversation.
    zero = [F.lit(0).cast("long").alias(c) for c in ("depth", "d1", "d2", "d3", *ABOVE, "bytes")]
    open_rows = every.where("not alone").drop("alone", "alone_above").unionByName(
        lengths.select("conv_id", "length", *zero))
    nodes = scratch.table(
        open_rows.groupBy(*DIGEST).agg(
            F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"),
            *[F.min(c).alias(c) for c in (*ABOVE, "bytes")],
            F.max(F.col("length") > F.col("depth")).alias("goes_on")), "nodes")

    # What hangs below an open node: open nodes, and the first proven node of a conversation.
    tops = alone.where("not alone_above")
    upper = [(F.col("depth") - 1).alias("depth"), *[F.col(a).alias(d) for a, d in zip(ABOVE, DIGEST[1:])]]
    below = nodes.where("depth > 0").select(*upper).unionAll(tops.select(*upper))
    children = below.groupBy(*DIGEST).agg(F.count(F.lit(1)).alias("n_children"))

    # Leaves and savings, each at the place of its conversation; sums from the end of a conversation
    # up to each of its open prefixes.
    at = ["conv_id", "depth"]
    none = F.lit(0).cast("long")
    leaves = alone.where("depth = length").select(*at, none.alias("saved"), F.lit(1).cast("long").alias("leaves"))
    kept = nodes.select(
        *at, ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"),
        F.when(F.col("goes_on"), 0).otherwise(1).cast("long").alias("leaves"))
    given = leaves.unionAll(kept).where("saved > 0 or leaves > 0").select(
        *at, "saved", "leaves", F.lit(0).alias("asks"), *[none.alias(c) for c in DIGEST[1:]])
    asked = open_rows.select(*at, none.alias("saved"), none.alias("leaves"), F.lit(1).alias("asks"),
                             *DIGEST[1:])
    sums = with_totals(given.unionAll(asked), scratch, "subtrees", ["conv_id"],
                       [F.col("depth").desc(), F.col("asks")],
                       {"all_saved": F.col("saved"), "all_leaves": F.col("leaves")})
    subtrees = (sums.where("asks = 1 and (all_saved > 0 or all_leaves > 0)").groupBy(*DIGEST)
                .agg(F.sum("all_saved").alias("saved_tokens"), F.sum("all_leaves").alias("n_leaves")))

    ends = end_hashes(open_rows.where("depth = length"))
    parents = nodes.select(*[F.col(c).alias(f"up_{c}") for c in DIGEST],
                           F.col("conv_id").alias("up_conv_id"))
    no_ends = F.sha2(F.lit("").cast("binary"), 256)
    own_end = F.when(F.col("depth") == F.col("length"),
                     F.sha2(F.col("conv_id").cast("string").cast("binary"), 256)).otherwise(no_ends)
    whole = nodes.join(children, DIGEST, "left").join(subtrees, DIGEST, "left").join(
        ends, DIGEST, "left").select(
        *at, *ABOVE, "n_convs", F.coalesce("n_children", none).alias("n_children"),
        F.coalesce("n_leaves", none).alias("n_leaves"),
        F.coalesce("saved_tokens", none).alias("saved_tokens"),
        F.coalesce("ends_sha256", no_ends).alias("ends_sha256"))
    one = F.lit(1).cast("long")
    single = [one.alias("n_convs"),
              F.when(F.col("depth") < F.col("length"), 1).otherwise(0).cast("long").alias("n_children"),
              one.alias("n_leaves"), none.alias("saved_tokens"), own_end.alias("ends_sha256")]
    linked = whole.unionAll(tops.select(*at, *ABOVE, *single)).alias("n").join(
        parents, F.expr("n.depth - 1 = up_depth and above_1 = up_d1 and above_2 = up_d2 "
                        "and above_3 = up_d3"), "left")
    out = ["n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    # A node that is open by chance has a proven parent, which is of the same conversation.
    parent = F.when(F.col("depth") > 0, F.coalesce("up_conv_id", "conv_id"))
    return linked.select(*at, parent.alias("parent_conv_id"), *out).unionAll(
        alone.where("alone_above").select(*at, F.col("conv_id").alias("parent_conv_id"), *single))
