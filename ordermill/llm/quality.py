"""Quality rules: repetition inside a document, and lines that many documents of a host share.

A line is normalised (lower case, runs of digits as one 0, white space as one blank) and hashed. Its
context in a document is the least digest of the document's other lines. It is boilerplate of a host if
it has more than a limit of contexts there, and at least half as many as the host's distinct texts that
hold it. The limit does not depend on the size of the host. Near copies mostly share their contexts, so
a group of them, however large, does not make boilerplate of its own lines; copies of one text count
once. Boilerplate is removed, and a document of which too little is left is rejected. Only SQL
functions are used: a document is measured in its own row, and only line hashes are shuffled; contexts
only of lines that more texts than the limit hold.

Defined results: a NULL text has no words and fails the base rules. A NULL source is a host of its
own. Equal rows get equal verdicts. The id is only passed on. Other columns are not read, whatever
their names. Texts are measured whole, in the memory of one row's task. A line that is the only one of
its texts has one context, none. Of two lines with one hash (64 bits) both are counted as one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import Scratch

BLANK = r"[\x20\x09-\x0D]+"
NOT_BLANK = r"[^\x20\x09-\x0D]"
SYMBOLS = "[#*$%&|<>]"
WINDOW = 5            # words of a window that must not be repeated
LEAST_WORDS = 10      # fewer words fail, before and after lines are removed
MOST_REPEATED = 20    # percent of words in repeated windows
HOST_CONTEXTS = 20    # a line is boilerplate of a host in more than this many contexts …
CONTEXT_SHARE = 0.5   # … which are at least this share of the texts that have it
LEAST_LEFT = 0.3      # share of words that removing boilerplate must leave

KEY = ["source", "text_1", "text_2"]  # verdicts depend on the host and the text alone


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body mentions it."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, BLANK), lambda w: w != "")


def lines_of(text: Column) -> Column:
    """The lines that have a word."""
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(NOT_BLANK))


def normalised(line: Column) -> Column:
    one_zero = F.regexp_replace(F.lower(line), "[0-9]+", "0")
    return F.trim(F.regexp_replace(one_zero, BLANK, " "))


def line_hash(line: Column) -> Column:
    return F.xxhash64(normalised(line))


def measured_line(line: Column) -> Column:
    """Hash, words, and the digest that orders the lines of a text."""
    return bind(normalised(line), lambda n: F.struct(
        F.xxhash64(n).alias("hash"), F.size(words_of(line)).alias("words"), F.md5(n).alias("digest")))


def least_lines(lines: Column) -> Column:
    """The hashes of the two distinct lines with the least digests."""
    ordered = F.sort_array(F.array_distinct(F.transform(
        lines, lambda x: F.struct(x["digest"].alias("digest"), x["hash"].alias("hash")))))
    return F.transform(F.slice(ordered, 1, 2), lambda x: x["hash"])


def context(line: str, least: str) -> Column:
    """The least of the other lines; NULL if there is none."""
    first, second = F.get(least, F.lit(0)), F.get(least, F.lit(1))
    return F.when(F.col(line) == first, second).otherwise(first)


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words that lie in a window of words which occurs twice or more, the first one included."""
    def hashed(w: Column) -> Column:
        count = F.greatest(F.size(w) - window + 1, F.lit(0))
        shifted = [F.slice(w, k + 1, count).alias(f"w{k}") for k in range(window)]
        return F.transform(F.arrays_zip(*shifted), lambda z: F.xxhash64(z))

    def in_repeats(h: Column) -> Column:
        placed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
        return bind(placed, covered)

    def covered(rows: Column) -> Column:
        ahead = F.arrays_zip(F.slice(rows, 1, F.size(rows) - 1).alias("a"),
                             F.slice(rows, 2, F.size(rows) - 1).alias("b"))
        equal = F.filter(ahead, lambda z: z["a"]["h"] == z["b"]["h"])
        places = F.sort_array(F.array_distinct(F.concat(
            F.transform(equal, lambda z: z["a"]["p"]), F.transform(equal, lambda z: z["b"]["p"]))))
        start = F.struct(F.lit(0).alias("n"), F.lit(-window).alias("last"))
        return F.aggregate(places, start, lambda done, p: F.struct(
            (done["n"] + F.least(F.lit(window), p - done["last"])).alias("n"),
            p.alias("last")))["n"]

    return bind(hashed(words), lambda h: F.when(
        F.size(F.array_distinct(h)) < F.size(h), in_repeats(h)).otherwise(0))


def measures(text: Column) -> Column:
    """A struct of counts, the hash and the words of each line that has a word, and the least lines."""
    def of_words(w: Column) -> Column:
        return F.struct(F.size(w).cast("long").alias("n_words"),
                        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
                        repeated_words(w).cast("long").alias("n_repeat_words"))

    def of_lines(lines: Column) -> Column:
        repeats = F.size(lines) - F.size(F.array_distinct(lines))
        return bind(F.transform(lines, measured_line), lambda m: F.struct(
            repeats.cast("long").alias("n_dup_lines"),
            F.transform(m, lambda x: F.struct(
                x["hash"].alias("hash"), x["words"].alias("words"))).alias("lines"),
            least_lines(m).alias("least")))

    symbols = F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))
    return F.struct(bind(words_of(text), of_words).alias("w"),
                    bind(lines_of(text), of_lines).alias("l"),
                    symbols.cast("long").alias("n_symbols"))


class LineRules:
    """The measured documents, and which lines go; both are written tables."""

    def __init__(self, documents: DataFrame, host_contexts: int = HOST_CONTEXTS,
                 context_share: float = CONTEXT_SHARE, least_left: float = LEAST_LEFT):
        scratch = Scratch(documents.sparkSession, "quality")
        self.least_left = least_left
        text = F.coalesce("text", F.lit(""))
        # the measures of a row are one value, so none of them is computed twice
        measured = documents.select(
            "doc_id", "source", *text_key("text"), bind(text, measures).alias("m"))
        failed = ((F.col("n_words") < LEAST_WORDS)
                  | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED))
        self.measured = scratch.table(
            measured.select("doc_id", *KEY, "m.w.*", "m.l.*", "m.n_symbols"), "measured"
        ).withColumn("base_failed", failed)
        texts = scratch.table(
            self.measured.groupBy(*KEY).agg(F.first("lines").alias("lines"),
                                            F.first("least").alias("least")), "texts")
        # no more contexts than texts, so other lines need no contexts
        often = scratch.table(
            texts.select("source", F.explode(F.array_distinct("lines.hash")).alias("hash"))
            .groupBy("source", "hash").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > host_contexts), "often")
        each = texts.select(*KEY, "least", F.explode("lines").alias("line"))
        held = scratch.table(
            each.alias("e").join(often.alias("o"),
                                 F.expr("e.source <=> o.source and e.line.hash = o.hash"))
            .select(*[F.col(f"e.{c}") for c in KEY], "o.hash", "line.words",
                    context("o.hash", "least").alias("context"))
            .groupBy(*KEY, "hash", "context").agg(F.sum("words").alias("words")), "held")
        self.boilerplate = scratch.table(
            held.groupBy("source", "hash", "context").agg(F.count(F.lit(1)).alias("n"))
            .groupBy("source", "hash").agg(F.sum("n").alias("n"),
                                           F.count(F.lit(1)).alias("contexts"))
            .where((F.col("contexts") > host_contexts)
                   & (F.col("contexts") >= F.col("n") * context_share)), "boilerplate")
        self.removed = scratch.table(
            held.alias("h").join(self.boilerplate.alias("b"),
                                 F.expr("h.source <=> b.source and h.hash = b.hash"))
            .select(*[F.col(f"h.{c}") for c in KEY], "h.hash", "words")
            .groupBy(*KEY).agg(F.sum("words").alias("removed_words"),
                               F.collect_set("hash").alias("removed_lines")), "removed")

    def verdicts(self) -> DataFrame:
        """One row per document: its measures, what is removed, and ``kept``."""
        same = F.expr("d.source <=> r.source and d.text_1 = r.text_1 and d.text_2 = r.text_2")
        judged = self.measured.drop("lines", "least").alias("d").join(
            self.removed.select(*KEY, "removed_words").alias("r"), same, "left")
        left = F.col("n_words") - F.col("removed_words")
        return (judged.select("d.*", F.coalesce("removed_words", F.lit(0)).alias("removed_words"))
                .withColumn("kept", ~F.col("base_failed") & (left >= LEAST_WORDS)
                            & (left >= F.col("n_words") * self.least_left)))


def text_key(text: str) -> list[Column]:
    """128 bits that tell texts apart."""
    return [F.xxhash64(text).alias("text_1"), F.xxhash64(F.lit(1), text).alias("text_2")]


def judge(documents: DataFrame, **limits: float) -> DataFrame:
    """doc_id, source, the measures, base_failed, removed_words, kept."""
    return LineRules(documents, **limits).verdicts().drop("text_1", "text_2")


def clean(documents: DataFrame, **limits: float) -> DataFrame:
    """The kept documents without boilerplate lines; all columns of the input.

    ``n_chars``, where there is one, follows the text.
    """
    rules = LineRules(documents, **limits)
    columns = documents.columns
    row = F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row")
    keyed = documents.select(row, "source", *text_key("text"))
    verdicts = rules.verdicts()
    # one narrow table of all texts that do not simply stay as they are
    rejected = verdicts.where("not kept").select(
        *KEY, F.lit(True).alias("rejected"), F.lit(None).cast("array<bigint>").alias("removed_lines"))
    changed = rules.removed.select(*KEY, F.lit(False).alias("rejected"), "removed_lines")
    fate = Scratch(documents.sparkSession, "quality").table(
        rejected.unionByName(changed).groupBy(*KEY).agg(
            F.bool_or("rejected").alias("rejected"),
            F.first("removed_lines", ignorenulls=True).alias("removed_lines")), "fate")
    same = F.expr("d.source <=> f.source and d.text_1 = f.text_1 and d.text_2 = f.text_2")
    joined = keyed.alias("d").join(fate.alias("f"), same, "left").where("rejected is not true")
    lines = F.filter(F.split("row.text", "\n"), lambda line: ~F.array_contains(
        "removed_lines", line_hash(line)))
    text = F.when(F.col("removed_lines").isNull(), F.col("row.text")).otherwise(
        F.array_join(lines, "\n"))
    new = {"text": F.col("new_text")}
    if "n_chars" in columns:
        new["n_chars"] = F.when(F.col("removed_lines").isNull(), F.col("row.n_chars")).otherwise(
            F.length("new_text"))
    return joined.select("row", "removed_lines", text.alias("new_text")).select(
        *[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in columns])
