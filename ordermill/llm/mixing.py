"""Mix sources to target weights by Efraimidis-Spirakis sampling.

A source's target is its share by weight of the mix, at most ``most_epochs`` times its size; what is
cut off goes to the others by weight, until none is above. A source is taken whole as often as
its target holds it (complete epochs). The rest of the target is a weighted sample without
replacement: every document gets the key -ln(u) / quality, and documents are taken by ascending key
until their sizes add up to the rest. Only SQL functions are used.

A source may hold a third of all rows, so it is never sorted as a whole: keys fall into 4,096 ordered
cells, sizes are summed per cell (combined before the shuffle), and only the cell in which the sum
reaches the budget is ordered, in parts. That gives a greatest key per source, and then each row is
decided by itself. The document on the border is taken if that brings the sum nearer to the target.

Rows that are equal in id, text and source are counted before anything is shuffled, and numbered; the
number of a copy is part of its u, so each is decided by itself, and a document that is there very often
still meets the target. Which of several equal rows gets which number makes no difference; where
they differ in other columns, the order of their hashes decides.

Defined results: a NULL text has size 0; texts of any length count whole. NULL is a source like any
other, after all others. u depends on the id, the text and the number of the copy, so reruns agree.
Documents without a quality get weight 1. Other columns are not read, and clash with no name.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import Scratch
from .totals import with_totals

BLANK = r"[\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"
MIX_SHARE = 1.5        # size of the mix, as a share of all sizes
MOST_EPOCHS = 2        # a source is taken this often at most
CELLS = 4096           # ordered cells of keys per source
SEED = "mix-1"
WEIGHTS = (3, 1, 2)    # of the sources in code point order, repeating
GOOD, BAD = 2.0, 0.5   # quality weights of documents labelled 1 and 0

ROW = ["doc_id", "text_md5", "source", "copy"]  # copies are numbered from 0
BLOCK = 4096           # copies of a row that are numbered together


def word_count(text: Column) -> Column:
    """Words between white space; no array stays around for longer than its count."""
    bare = F.trim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(bare == "", 0).otherwise(F.size(F.split(bare, BLANK))).cast("long")


def uniform(doc_id: Column, text_md5: Column, copy: Column, seed: str = SEED) -> Column:
    """A number above 0 and below 1 for each document and copy of it, always the same."""
    name = F.concat_ws("|", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")),
                       F.coalesce(text_md5, F.lit("")), F.when(copy > 0, copy.cast("string")))
    bits = F.conv(F.substring(F.md5(name), 1, 13), 16, 10).cast("long")
    return (bits + 0.5) / float(1 << 52)


def numbered_copies(counted: DataFrame) -> DataFrame:
    """One row per copy of rows with ``copies``; those of a row with very many are dealt out."""
    last = F.col("copies") - 1
    blocks = counted.withColumn("block", F.explode(F.sequence(
        F.lit(0).cast("long"), F.floor(last / BLOCK))))
    few, many = blocks.where(F.col("copies") <= BLOCK), blocks.where(F.col("copies") > BLOCK)
    many = many.repartition("doc_id", "text_md5", "source", "block")
    first = F.col("block") * BLOCK
    return few.unionAll(many).withColumn("copy", F.explode(F.sequence(
        first, F.least(first + BLOCK - 1, last)))).drop("block", "copies")


def repeating_weights(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Weights by code point order of the source, NULL last; one row per source."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    choice = F.element_at(F.array(*[F.lit(w) for w in weights]), (place % len(weights) + 1))
    return sources.select("source", choice.cast("long").alias("weight"))


class Mix:
    """Sizes, targets and cut-off keys; all tables are written."""

    def __init__(self, documents: DataFrame, quality: DataFrame | None = None,
                 weights: DataFrame | None = None, share: float = MIX_SHARE,
                 most_epochs: int = MOST_EPOCHS, seed: str = SEED):
        """``quality``: doc_id and a weight above 0; ``weights``: source and weight of each."""
        self.scratch = Scratch(documents.sparkSession, "mixing")
        rows = documents.select("doc_id", "source", F.md5("text").alias("text_md5"),
                                word_count(F.col("text")).alias("size"))
        rows = numbered_copies(rows.groupBy("doc_id", "source", "text_md5", "size").agg(
            F.count(F.lit(1)).alias("copies")))
        if quality is None:
            rows = rows.withColumn("quality", F.lit(1.0))
        else:
            one = quality.where("doc_id is not null and quality > 0").groupBy("doc_id").agg(
                F.avg("quality").alias("quality"))
            rows = rows.join(one, "doc_id", "left").withColumn(
                "quality", F.coalesce("quality", F.lit(1.0)))
        key = -F.log(uniform(F.col("doc_id"), F.col("text_md5"), F.col("copy"), seed)) / F.col("quality")
        cell = F.least(F.floor((1 - F.exp(-F.col("key"))) * CELLS), F.lit(CELLS - 1)).cast("int")
        self.rows = self.scratch.table(
            rows.select(*ROW, "size", key.alias("key")).withColumn("cell", cell), "rows")
        sizes = self.scratch.table(
            self.rows.groupBy("source").agg(F.sum("size").alias("source_size")), "sizes")
        if weights is None:
            weights = repeating_weights(sizes)
        targets = self._targets(sizes, weights, share, most_epochs)
        epochs = F.when(F.col("source_size") > 0,
                        F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
        targets = targets.withColumn("epochs", epochs.cast("long")).withColumn(
            "budget", F.col("target") - F.col("epochs") * F.col("source_size"))
        self.targets = self.scratch.table(targets, "targets")
        self.rules = self.scratch.table(self._cut_offs(), "rules")

    def _targets(self, sizes: DataFrame, weights: DataFrame, share: float,
                 most_epochs: int) -> DataFrame:
        """Raise the level until the shares below their bounds use up the whole mix.

        Each step is one sum over the sources; the level only rises, and ends after as many steps
        as there are waves of sources that reach their bound.
        """
        sources = self.scratch.table(
            sizes.alias("s").join(weights.alias("w"), F.expr("s.source <=> w.source"))
            .select("s.source", "s.source_size", "w.weight"), "sources")
        bound = F.col("source_size") * most_epochs
        level = 0.0
        while True:
            above = F.col("weight") * level > bound
            got = sources.agg(
                F.sum("source_size").alias("all"),
                F.sum(F.when(above, bound).otherwise(0)).alias("bounded"),
                F.sum(F.when(above, 0).otherwise(F.col("weight"))).alias("weight")).first()
            if not got["all"] or not got["weight"]:
                break
            risen = (share * got["all"] - got["bounded"]) / got["weight"]
            if risen <= level:
                break
            level = risen
        return sources.withColumn("target", F.least(F.col("weight") * F.lit(level),
                                                    bound.cast("double")))

    def _cut_offs(self) -> DataFrame:
        """Per source the cell in which the budget ends, and the last key taken there."""
        by_key = Window.partitionBy("source").orderBy("cell")
        cells = (self.rows.groupBy("source", "cell").agg(F.sum("size").alias("size"))
                 .withColumn("end", F.sum("size").over(by_key)))
        last = (cells.alias("c").join(self.targets.alias("t"), F.expr("c.source <=> t.source"))
                .where("end > budget").groupBy("c.source", "budget")
                .agg(F.min(F.struct("cell", (F.col("end") - F.col("size")).alias("before")))
                     .alias("at"))
                .select("source", "budget", "at.*"))
        last = self.scratch.table(last, "last_cells")
        inside = (self.rows.alias("r").join(
            last.alias("l"), F.expr("r.source <=> l.source and r.cell = l.cell"))
            .groupBy("l.source", "budget", "before", "key").agg(F.sum("size").alias("size")))
        # The cell of a large source may be large itself, so its sums are taken in parts.
        inside = with_totals(inside, self.scratch, "inside", ["source"], [F.col("key")],
                             {"upto": F.col("size")})
        end = F.col("before") + F.col("upto")
        taken = ((F.col("end") <= F.col("budget"))
                 | (F.col("end") - F.col("budget")
                    < F.col("budget") - (F.col("end") - F.col("size"))))
        keys = (inside.withColumn("end", end).where(taken).groupBy("source")
                .agg(F.max("key").alias("last_key")))
        return (self.targets.alias("t")
                .join(last.alias("l"), F.expr("t.source <=> l.source"), "left")
                .join(keys.alias("k"), F.expr("t.source <=> k.source"), "left")
                .select("t.*", F.col("cell").alias("last_cell"), "last_key"))

    def decided(self) -> DataFrame:
        """One row per document with ``copies``, how often it is in the mix."""
        rows = self.rows.alias("r").join(self.rules.alias("t"), F.expr("r.source <=> t.source"))
        # a budget that no cell exceeds is the whole source
        sampled = (F.col("budget") > 0) & (
            F.col("last_cell").isNull() | (F.col("cell") < F.col("last_cell"))
            | ((F.col("cell") == F.col("last_cell"))
               & F.coalesce(F.col("key") <= F.col("last_key"), F.lit(False))))
        return rows.select(
            *[f"r.{c}" for c in ROW], "size", "source_size", "target",
            (F.col("epochs") + F.when(sampled, 1).otherwise(0)).alias("copies"))


def quality_weights(labels: DataFrame, good: float = GOOD, bad: float = BAD) -> DataFrame:
    """doc_id and weight from labels of 1 and 0."""
    return labels.where("quality is not null").select(
        "doc_id", F.when(F.col("quality") == 1, good).otherwise(bad).alias("quality"))


def shares(documents: DataFrame, quality: DataFrame | None = None, **options) -> DataFrame:
    """doc_id, source, size, source_size, target, copies and taken words of every document."""
    decided = Mix(documents, quality, **options).decided()
    return decided.withColumn("taken", F.col("size") * F.col("copies")).drop("text_md5", "copy")


def mixed(documents: DataFrame, quality: DataFrame | None = None, **options) -> DataFrame:
    """The documents of the mix, each as often as it is taken; all columns of the input."""
    mix = Mix(documents, quality, **options)
    key = ["doc_id", "text_md5", "source"]
    decided = mix.decided().where("copies > 0").select(*[F.col(c).alias(f"of_{c}") for c in ROW],
                                                       F.col("copies").alias("times"))
    row = F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row")
    keyed = documents.select(row, "doc_id", F.md5("text").alias("text_md5"), "source")

    # Rows that are there once need no number. The others, told by a written table of known size, are
    # numbered in the order of their hashes.
    repeated = mix.scratch.table(mix.rows.where("copy = 1").select(
        *[F.col(c).alias(f"of_{c}") for c in key]), "repeated")
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in key])
    numbered = keyed.withColumn("copy", F.lit(0).cast("long"))
    if not repeated.isEmpty():
        several = keyed.join(repeated, same, "left_semi").withColumn("hash", F.xxhash64("row"))
        several = with_totals(several, mix.scratch, "several", key, [F.col("hash")],
                              {"copy": F.lit(1).cast("long")}).withColumn("copy", F.col("copy") - 1)
        numbered = numbered.join(repeated, same, "left_anti").unionByName(several.drop("hash"))
    return (numbered.join(decided, same & (F.col("copy") == F.col("of_copy")))
            .select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times").cast("long"))))
            .select("row.*"))
