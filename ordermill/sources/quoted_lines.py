"""Put together CSV records that run over several lines, without one task per file.

Seen from quotes, a line takes the reader from one of two states, outside or inside a quoted
field, to one of them. What a line does, a whole split of a file does too, so each task reads its
splits from both states at once, as Arrow batches, and joins the lines of a record. Both readings
agree from the first line on that ends both outside of quotes; that is soon, so most records are put together once.
Each record has a label, which says in which readings it is one.

With the records a task gives a summary of each split: "from outside it ends …, from inside it ends
…". Running over the splits of a file, this says how each one starts, hence which reading holds, in
which split the record that goes on there was begun, and which record of a file is its first, the header.
One pass over the text can so count what its records hold, for both readings, and one more makes the table.

Only pieces of records that are cut off by a split boundary are moved, at most two for each reading
of a split. Pieces above ``PIECE_BYTES`` are not, as an unlikely reading may take a whole split for one;
those that turn out to be real are fetched by another pass.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The task functions travel with the job; executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# A quoted field at its place between separators, and whatever follows its closing quote.
# Doubled quotes are taken out before.
QUOTED_FIELD = r'(^|,)"[^"]*+"[^,]*+'
OPENING_QUOTE = r'(^|,)"'
BLANKS = " \t"

# What a line or a split does: end outside quotes, turn the state around, leave it, end inside.
OUT, TURN, KEEP, IN = 0, 1, 2, 3

SPLIT = ["file", "block"]  # a split is known by the hash of its path and its offset
FROM_OUTSIDE, FROM_INSIDE, EITHER = 0, 1, 2  # labels: the readings in which a record is one
WHOLE, HEAD, TAIL, SUMMARY = 0, 1, 2, 3      # what a row holds
READ = "file bigint, block bigint, label int, sort int, first boolean, record string"
PIECE_BYTES = 1 << 20      # of a cut record, moved before it is known to be one
MOST_SPLITS = 4_000_000    # states that are broadcast: 25 bytes each


def unquoted_part(text: Column) -> Column:
    """What is left of a record, separators included, when its quoted fields are emptied."""
    plain = F.replace(text, F.lit('""'), F.lit(""))
    return F.when(text.contains('"'), F.regexp_replace(plain, QUOTED_FIELD, "$1")).otherwise(text)


def after_quotes(text: Column) -> Column:
    """What stands outside of quotes, text behind a closing quote included."""
    plain = F.replace(text, F.lit('""'), F.lit(""))
    return F.when(text.contains('"'), F.regexp_replace(plain, r'(^|,)"[^"]*+"', "$1")).otherwise(text)


def is_cut(line: Column) -> Column:
    """True if the line, read from outside quotes, ends inside them."""
    return line.contains('"') & unquoted_part(line).rlike(OPENING_QUOTE)


def is_blank(line: Column) -> Column:
    """Nothing but blanks and tabs: such a line is skipped."""
    return F.trim(line, F.lit(BLANKS)) == ""


def effect(line: Column) -> Column:
    """OUT, TURN, KEEP or IN. To start inside quotes is to start with one more quote."""
    from_outside, from_inside = is_cut(line), is_cut(F.concat(F.lit('"'), line))
    return (F.when(~line.contains('"'), KEEP)
            .otherwise(from_outside.cast("int") + 2 * from_inside.cast("int")))


def occurrences(character: str, text: Column) -> Column:
    without = F.octet_length(F.replace(text, F.lit(character), F.lit("")))
    return F.octet_length(text) - without


def _effects(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path).select(
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        effect(F.col("value")).alias("effect"), "value")


def both_readings(spark: SparkSession, path: str, whole: bool = True) -> DataFrame:
    """Records and pieces of them, labelled, and a summary of each split. Blank records are left out.

    ``first`` is the first record of its label and split that is not blank. Without ``whole`` there are
    no other whole records.
    """
    read = _effects(spark, path).mapInArrow(_read, READ)
    record = F.when(F.col("sort").isin(WHOLE), F.regexp_replace("record", r"\r\z", "")).otherwise(
        F.col("record"))
    wanted = F.col("first") | (F.col("sort") != WHOLE)
    if whole:
        wanted = wanted | ~is_blank(F.col("record"))
    return read.withColumn("record", record).where(wanted)


def split_starts(summaries: DataFrame) -> DataFrame:
    """Per split: whether it starts inside quotes, the split where that record begins, and
    whether it ends inside quotes. One row per split of the input.

    ``summaries``: the rows of sort SUMMARY.
    """
    by_place = Window.partitionBy("file").orderBy("block")
    until = by_place.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = by_place.rowsBetween(Window.unboundedPreceding, -1)

    # The state is that of the last split which settles it, turned as often as after that.
    effect = F.col("effect")
    turns = F.count_if(effect == TURN)
    settled = F.when(effect.isin(OUT, IN), (effect.bitwiseAND(1) + F.col("turns")) % 2)
    splits = (summaries.select(*SPLIT, F.substring("record", 1, 1).cast("int").alias("effect"),
                               (F.substring("record", 2, 1) == "1").alias("leaves"))
              .withColumn("turns", turns.over(until))
              .withColumn("settled", settled)
              .withColumn("inside", (
                  F.coalesce(F.last("settled", ignorenulls=True).over(earlier), F.lit(0))
                  + F.coalesce(turns.over(earlier), F.lit(0))) % 2))

    # The last record of a split is cut off if the split ends inside quotes, and it begins in
    # the split, unless the split starts inside quotes and no line of it ever leaves them.
    inside = F.col("inside") == 1
    ends_inside = F.when(inside, effect.isin(KEEP, IN)).otherwise(effect.isin(TURN, IN))
    begins = ends_inside & (~inside | F.col("leaves"))
    begun = F.last(F.when(begins, F.col("block")), ignorenulls=True).over(earlier)
    return splits.select(*SPLIT, inside.cast("int").alias("inside"), begun.alias("begun"),
                         ends_inside.alias("ends_inside"))


def counted(starts: DataFrame) -> tuple[int, int]:
    """Splits, and files whose last split ends inside quotes."""
    files = starts.groupBy("file").agg(F.max_by("ends_inside", "block").alias("open"),
                                       F.count(F.lit(1)).alias("splits"))
    found = files.agg(F.sum("splits").alias("splits"), F.count_if("open").alias("open")).first()
    return found["splits"] or 0, found["open"]


def true_rows(rows: DataFrame, starts: DataFrame) -> DataFrame:
    """The rows of the reading that holds, with ``begun``."""
    return (rows.join(starts.select(*SPLIT, "inside", "begun"), SPLIT)
            .where((F.col("label") == EITHER) | (F.col("label") == F.col("inside"))).drop("inside"))


def cut_records(spark: SparkSession, path: str, true: DataFrame) -> DataFrame:
    """Records that a split boundary cuts, put together: file, begun, record.

    In a file that does not end inside quotes the pieces put together are those of one record.
    ``true``: written rows of the reading that holds.
    """
    pieces = true.where(F.col("sort").isin(HEAD, TAIL)).select(
        *SPLIT, "label", "sort", "begun", "record")
    missing = pieces.where("record is null")
    n = missing.count()
    if n:
        # One pass for each MOST_SPLITS of them, whose places are broadcast.
        groups = -(-n // MOST_SPLITS)
        found = pieces.where("record is not null")
        for group in range(groups):
            wanted = missing.where(F.pmod(F.xxhash64(*SPLIT), F.lit(groups)) == group)
            places = wanted.select(*SPLIT).distinct()
            lines = _effects(spark, path).join(F.broadcast(places), SPLIT).select(
                *SPLIT, "effect", "value")
            fetched = lines.mapInArrow(lambda batches: _read(batches, None), READ).where(
                F.col("sort").isin(HEAD, TAIL))
            found = found.unionByName(wanted.drop("record").join(
                fetched.select(*SPLIT, "label", "sort", "record"), [*SPLIT, "label", "sort"])
                .select(*pieces.columns))
        pieces = found
    begun = F.when(F.col("sort") == HEAD, F.col("begun")).otherwise(F.col("block"))
    parts = F.array_sort(F.collect_list(F.struct("block", "record")))
    return (pieces.groupBy("file", begun.alias("begun")).agg(parts.alias("parts"))
            .select("file", "begun", F.regexp_replace(
                F.array_join("parts.record", "\n"), r"\r\z", "").alias("record")))


def headers(true: DataFrame, cut: DataFrame) -> DataFrame:
    """The first record of each file that is not blank: file, block, label and record.

    It is a whole record of its split, first those before both readings agree, or the cut one after
    them, which has no label.
    """
    firsts = true.where("first").select(
        "file", "block", F.when(F.col("label") == EITHER, 1).otherwise(0).alias("rank"), "label",
        "record")
    last = cut.select("file", F.col("begun").alias("block"), F.lit(2).alias("rank"),
                      F.lit(None).cast("int").alias("label"), "record")
    first = F.min_by(F.struct("block", "label", "record"), F.struct("block", "rank")).alias("first")
    return firsts.unionAll(last).groupBy("file").agg(first).select("file", "first.*")


def whole_records(spark: SparkSession, path: str, starts: DataFrame, header: DataFrame,
                  splits: int) -> DataFrame:
    """Column ``record``: the whole records of the reading that holds, without headers.

    The states of the splits are joined to records, not to lines, so any join is right: up to
    ``MOST_SPLITS`` of them are broadcast, beyond that Spark decides.
    """
    states = starts.select(*SPLIT, "inside").join(
        header.where("label is not null").select(*SPLIT, F.col("label").alias("header")), SPLIT, "left")
    # A split missing from the states would mean that the two scans were cut differently.
    unknown = F.raise_error("file splits differ between two scans of one extract").cast("int")
    rows = both_readings(spark, path).where(F.col("sort") == WHOLE).join(
        F.broadcast(states) if splits <= MOST_SPLITS else states, SPLIT, "left")
    inside = F.coalesce("inside", unknown)
    is_header = F.col("first") & F.col("label").eqNullSafe(F.col("header"))
    return rows.where(((F.col("label") == EITHER) | (F.col("label") == inside)) & ~is_header).select(
        "record")


def _states(start: int, effects: np.ndarray) -> np.ndarray:
    """The state after each line, 1 for inside quotes."""
    turns = np.cumsum(effects == TURN)
    settles = (effects == OUT) | (effects == IN)
    last = np.maximum.accumulate(np.where(settles, np.arange(len(effects)), -1))
    settled = (effects[last] & 1) + turns - turns[last]
    return np.where(last >= 0, settled, start + turns) % 2


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], pa.RecordBatch]]:
    """The lines of each split in a task, which arrive in order, a batch at a time."""
    for batch in batches:
        if batch.num_rows:
            files, blocks = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            changes = (np.diff(files) != 0) | (np.diff(blocks) != 0)
            bounds = [0, *(np.flatnonzero(changes) + 1).tolist(), batch.num_rows]
            for start, end in zip(bounds, bounds[1:]):
                yield (int(files[start]), int(blocks[start])), batch.slice(start, end - start)


def _read(batches: Iterator[pa.RecordBatch],
          piece_bytes: int | None = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Both readings of the splits of a task."""
    split: _Split | None = None
    for place, lines in _runs(batches):
        if split is None or split.place != place:
            if split is not None:
                yield from split.close()
            split = _Split(place, piece_bytes)
        yield from split.take(lines.column(2).to_numpy(), lines.column(3))
    if split is not None:
        yield from split.close()


class _Split:
    """The lines of one split, read from outside and from inside quotes until both agree."""

    def __init__(self, place: tuple[int, int], piece_bytes: int | None):
        self.place, self.states, self.leaves = place, [0, 1], False
        self.readings = [_Reading(place, FROM_OUTSIDE, piece_bytes),
                         _Reading(place, FROM_INSIDE, piece_bytes)]
        self.agreed = _Reading(place, EITHER, piece_bytes)

    def take(self, effects: np.ndarray, lines: pa.Array) -> Iterator[pa.RecordBatch]:
        if len(self.states) == 2:
            after = [_states(state, effects) for state in self.states]
            self.leaves |= not after[1].all()
            agree = np.flatnonzero((after[0] | after[1]) == 0)
            upto = int(agree[0]) + 1 if len(agree) else len(lines)
            for reading, states in zip(self.readings, after):
                yield from reading.take(states[:upto], lines.slice(0, upto))
            self.states = [0] if len(agree) else [int(a[-1]) for a in after]
            effects, lines = effects[upto:], lines.slice(upto)
        if len(lines):
            after = _states(self.states[0], effects)
            yield from self.agreed.take(after, lines)
            self.states = [int(after[-1])]

    def close(self) -> Iterator[pa.RecordBatch]:
        """What is still open goes on in the next split, or ends with the file."""
        for reading in (*self.readings, self.agreed):
            yield from reading.close()
        effect = self.states[0] + 2 * self.states[-1]
        yield _rows(self.place, EITHER, SUMMARY, pa.array([f"{effect}{int(self.leaves)}"]))


class _Reading:
    """The records of a split when read from one state."""

    def __init__(self, place: tuple[int, int], label: int, piece_bytes: int | None):
        self.place, self.label, self.piece_bytes = place, label, piece_bytes
        self.open: list[pa.Array] = []  # lines of the record that is not yet complete
        self.open_bytes = 0
        self.head = label == FROM_INSIDE  # what is open was begun in an earlier split
        self.first = True

    def take(self, after: np.ndarray, lines: pa.Array) -> Iterator[pa.RecordBatch]:
        """``after``: the state after each line; each 0 is the end of a record."""
        ends = np.flatnonzero(after == 0) + 1
        if not len(ends):
            self._keep(lines)
            return
        done = 0
        if self.open or self.head:
            done = int(ends[0])
            self._keep(lines.slice(0, done))
            yield self._opened(HEAD if self.head else WHOLE)
            ends = ends[1:]
        if len(ends):
            offsets = pa.array(np.concatenate([[done], ends]), pa.int32())
            yield self._whole(pc.binary_join(pa.ListArray.from_arrays(offsets, lines), "\n"))
            done = int(ends[-1])
        if done < len(lines):
            self._keep(lines.slice(done))

    def close(self) -> Iterator[pa.RecordBatch]:
        if self.open:
            yield self._opened(HEAD if self.head else TAIL)

    def _too_long(self) -> bool:
        return self.piece_bytes is not None and self.open_bytes > self.piece_bytes

    def _keep(self, lines: pa.Array) -> None:
        if not (self.head and self._too_long()):  # of a long head no more than a line is held
            self.open.append(lines)
            self.open_bytes += pc.sum(pc.binary_length(lines)).as_py() or 0
            if self.head and self._too_long():
                self.open = [lines.slice(0, 0)]

    def _opened(self, sort: int) -> pa.RecordBatch:
        if sort != WHOLE and self._too_long():
            text = pa.array([None], pa.string())
        else:
            lines = pa.chunked_array(self.open).combine_chunks()
            text = pc.binary_join(pa.ListArray.from_arrays(
                pa.array([0, len(lines)], pa.int32()), lines), "\n")
        self.open, self.open_bytes, self.head = [], 0, False
        return self._whole(text) if sort == WHOLE else _rows(self.place, self.label, sort, text)

    def _whole(self, texts: pa.Array) -> pa.RecordBatch:
        first = np.zeros(len(texts), dtype=bool)
        if self.first:  # blank lines may stand before a header
            filled = np.flatnonzero(pc.not_equal(pc.utf8_trim(texts, BLANKS + "\r"), "")
                                    .to_numpy(zero_copy_only=False))
            if len(filled):
                first[filled[0]] = True
                self.first = False
        return _rows(self.place, self.label, WHOLE, texts, first)


def _rows(place: tuple[int, int], label: int, sort: int, texts: pa.Array,
          first: np.ndarray | None = None) -> pa.RecordBatch:
    n = len(texts)
    first = np.zeros(n, dtype=bool) if first is None else first
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(n, place[0]), pa.int64()), pa.array(np.full(n, place[1]), pa.int64()),
         pa.array(np.full(n, label), pa.int32()), pa.array(np.full(n, sort), pa.int32()),
         pa.array(first), texts.cast(pa.string())],
        names=["file", "block", "label", "sort", "first", "record"])
