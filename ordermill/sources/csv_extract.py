"""Read a CSV extract: a file, or a folder of files with the same header.

All columns are read as text, and files of any size are split over many tasks. Where every record is
one line, Spark's CSV reader takes the splits as they are; where line breaks stand inside
quotes, ``quoted_lines`` puts the records together. Which of the two it is depends on what the
lines hold, not on their number, and both accept the same rows.
"""

from __future__ import annotations

import csv
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import Scratch
from . import quoted_lines
from .column_types import kind_counters, value_kind
from .quoted_lines import after_quotes, is_blank, is_cut, occurrences, unquoted_part

DIALECT = {"sep": ",", "quote": '"', "escape": '"', "mode": "PERMISSIVE"}
EXTRA = "extra_field"  # holds what stands beyond the last column of the header
PEEK_LINES = 1_000     # lines that are looked at to guess how records are written


class MalformedExtract(ValueError):
    """The extract cannot be read as a table."""


@dataclass(frozen=True)
class Extract:
    """Column names, the rows as text columns ``c0``, ``c1``, … , and the counts of one pass.

    ``kinds`` has, for each column, how many values are of each kind; ``records`` is the number
    of rows.
    """

    names: list[str]
    rows: DataFrame
    kinds: list[dict[str, int]]
    records: int


def field(position: int) -> str:
    return f"c{position}"


def column_names(header: list[str | None]) -> list[str]:
    """Header fields as unique names: ``a, a`` gives ``a, a.1``, no text ``Unnamed: 0``.

    Names that differ in case only count as equal, as they do in a catalog.
    """
    names: list[str] = []
    taken: set[str] = set()
    for position, text in enumerate(header):
        base = text or f"Unnamed: {position}"
        name, repeat = base, 0
        while name.lower() in taken:
            repeat += 1
            name = f"{base}.{repeat}"
        names.append(name)
        taken.add(name.lower())
    return names


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines, without the carriage return of a CR LF, and where they are from."""
    return_less = F.regexp_replace("value", r"\r\z", "")
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.when(F.endswith("value", F.lit("\r")), return_less).otherwise(F.col("value"))
        .alias("line"))


def read_extract(spark: SparkSession, path: str) -> Extract:
    """The rows, decided by one pass over the text, which counts the kinds of values as well.

    Refused: an extra field, even an empty one; a file with another header; a quote that is never
    closed; and a carriage return as a line end. A header is the first record that is not blank,
    of however many lines. Where the first lines show records of several lines, the pass takes the
    lines for such; otherwise it is repeated so if one turns up, or if the header is one.
    """
    line = F.col("line")
    first = _lines(spark, path).where(~is_blank(line)).select(line, is_cut(line)).first()
    if not first:
        raise MalformedExtract(f"{path} is empty or malformed")
    header, header_cut = first
    if header_cut:
        header = _first_record(spark, path)
    names = column_names(_fields(path, header))
    columns = [field(i) for i in range(len(names))]
    schema = ", ".join(f"{c} string" for c in columns) + f", {EXTRA} string"

    peeked = [] if header_cut else _lines(spark, path).select(is_cut(line).alias("cut")).head(PEEK_LINES)
    if not header_cut and not any(r["cut"] for r in peeked):
        found = _survey(_lines(spark, path), header, columns, schema)
        if not found["broken"]:
            _refuse_others(path, found["other"])
            _refuse_too_long(path, found["too_long"])
            rows = spark.read.schema(schema).options(header=True, **DIALECT).csv(path)
            # The header lines were counted like rows: each file has exactly one.
            headers = _counts(spark.createDataFrame([(header,)], "record string"), columns, schema)
            kinds = [{k: n - found["files"] * head[k] for k, n in found["kinds"][i].items()}
                     for i, head in enumerate(headers["kinds"])]
            return Extract(names, rows.select(*columns), kinds, found["rows"] - found["files"])
    return _quoted_extract(spark, path, header, names, columns, schema)


def _quoted_extract(spark: SparkSession, path: str, header: str, names: list[str],
                    columns: list[str], schema: str) -> Extract:
    """An extract with records of several lines: one pass counts, and one is the table."""
    scratch = Scratch(spark, "splits")
    read = quoted_lines.both_readings(spark, path)
    kept = F.col("first") | (F.col("sort") != quoted_lines.WHOLE)
    # A text that is no record, or is too long a one in a reading that does not hold, is not parsed.
    parsable = (F.col("sort") == quoted_lines.WHOLE) & (_separators() < len(columns))
    kinds = _with_kinds(_parsed(read.withColumn("text", F.when(kept, F.col("record"))), schema,
                                F.when(parsable, F.col("record"))), columns)
    # Records are counted by label and split; pieces, summaries and first records stand alone.
    key = [*quoted_lines.SPLIT, "label", "sort", "first", "text"]
    counts = scratch.table(kinds.groupBy(*key).agg(*_counters(columns)), "counts")

    true, cut, headers, starts, splits = _resolved(
        spark, path, scratch, counts.withColumnRenamed("text", "record"))
    _refuse_others(path, _parsed(headers, schema).where(~_is_like(header, columns, schema)).count())

    where = [*quoted_lines.SPLIT, "label"]
    at_header = headers.where("label is not null").select(*where, F.lit(True).alias("header"))
    body = (true.where(F.col("sort") == quoted_lines.WHOLE).join(at_header, where, "left")
            .where(~(F.col("first") & F.coalesce("header", F.lit(False)))))
    cut_header = headers.where("label is null").select("file", F.col("block").alias("begun"))
    cut = cut.join(cut_header, ["file", "begun"], "left_anti").select("record")
    counters = [n for n in true.columns if n not in (*key, "record", "begun")]
    total = _added([
        _collected(body.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in counters]), columns),
        _counts(cut, columns, schema)])
    if total["returns"]:
        raise MalformedExtract(f"{path}: carriage returns as line ends")
    _refuse_too_long(path, total["too_long"])
    whole = quoted_lines.whole_records(spark, path, starts, headers, splits)
    rows = _parsed(whole.unionAll(cut), schema).select(*[f"fields.{c}" for c in columns])
    return Extract(names, rows, total["kinds"], total["rows"])


def _resolved(spark: SparkSession, path: str, scratch: Scratch, rows: DataFrame):
    """Of both readings: the rows of the one that holds, cut records, headers, how splits start, and
    how many splits there are."""
    summary = F.col("sort") == quoted_lines.SUMMARY
    starts = scratch.table(quoted_lines.split_starts(rows.where(summary)), "starts")
    splits, unclosed = quoted_lines.counted(starts)
    if unclosed:
        raise MalformedExtract(f"{path}: {unclosed} files end inside quotes")
    true = quoted_lines.true_rows(rows.where(~summary), starts)
    cut = scratch.table(quoted_lines.cut_records(spark, path, true), "cut")
    return true, cut, scratch.table(quoted_lines.headers(true, cut), "headers"), starts, splits


def _first_record(spark: SparkSession, path: str) -> str:
    """The header of one of the files, if it runs over several lines: a pass that counts nothing."""
    scratch = Scratch(spark, "header")
    rows = scratch.table(quoted_lines.both_readings(spark, path, whole=False), "pieces")
    headers = _resolved(spark, path, scratch, rows)[2]
    return headers.orderBy("file").select("record").first()["record"]


def _fields(path: str, record: str) -> list[str]:
    try:
        return next(csv.reader([f"{t}\n" for t in record.split("\n")]))
    except csv.Error:
        raise MalformedExtract(f"{path}: carriage returns as line ends") from None


def _added(counts: list[dict]) -> dict:
    """Counts of several sets of records, added up."""
    first, *more = counts
    for other in more:
        first = {k: first[k] + other[k] for k in first if k != "kinds"} | {
            "kinds": [{k: a[k] + b[k] for k in a} for a, b in zip(first["kinds"], other["kinds"])]}
    return first


def _refuse_others(path: str, files: int) -> None:
    if files:
        raise MalformedExtract(f"{path}: {files} files have another header")


def _refuse_too_long(path: str, rows: int) -> None:
    if rows:
        raise MalformedExtract(f"{path}: {rows} rows have more fields than the header")


def _parsed(lines: DataFrame, schema: str, record: Column | None = None) -> DataFrame:
    """Adds ``fields``, the fields of each record."""
    text = F.col("record") if record is None else record
    parsed = F.from_csv(text, schema, {**DIALECT, "multiLine": "true"})
    return lines.select("*", parsed.alias("fields"))


def _separators() -> Column:
    return occurrences(",", unquoted_part(F.col("record")))


def _is_like(header: str, columns: list[str], schema: str) -> Column:
    """True for a parsed record with the header's fields."""
    wanted = F.from_csv(F.lit(header), schema, {**DIALECT, "multiLine": "true"})
    return F.coalesce((F.col("fields") == wanted) & (_separators() < len(columns)), F.lit(False))


def _counters(columns: list[str]) -> list[Column]:
    """Of records and their fields: rows, too long ones, stray returns, and kinds of values."""
    return [F.count(F.lit(1)).alias("rows"),
            F.count_if(_separators() >= len(columns)).alias("too_long"),
            F.count_if(after_quotes(F.col("record")).contains("\r")).alias("returns"),
            *[n for c in columns for n in kind_counters(c)]]


def _with_kinds(parsed: DataFrame, columns: list[str]) -> DataFrame:
    """The kind of each field, worked out once per value."""
    return parsed.select(*[c for c in parsed.columns if c != "fields"],
                         *[value_kind(f"fields.{c}").alias(c) for c in columns])


def _collected(counted: DataFrame, columns: list[str]) -> dict:
    row = counted.first().asDict()
    kinds = [{name.removeprefix(f"{c}_"): row.pop(name)
              for name in [n for n in row if n.startswith(f"{c}_")]} for c in columns]
    return {**row, "kinds": kinds}


def _counts(lines: DataFrame, columns: list[str], schema: str) -> dict:
    kinds = _with_kinds(_parsed(lines, schema), columns)
    return _collected(kinds.agg(*_counters(columns)), columns)


def _survey(lines: DataFrame, header: str, columns: list[str], schema: str) -> dict:
    """One pass over the lines, each taken for a record.

    ``broken`` lines are no whole record by themselves; if there is one, the other counts mean
    nothing. ``other`` files have a first line whose fields are not those of the header.
    """
    line = F.col("line")
    filled = lines.where(~is_blank(line)).select(
        "file", "block", line.alias("record"), (is_cut(line) | line.contains("\r")).alias("broken"),
        F.monotonically_increasing_id().alias("place"))
    kinds = _with_kinds(_parsed(filled, schema).withColumn(
        "like", _is_like(header, columns, schema)), columns)
    counters = _counters(columns)
    names = [n for n in kinds.limit(0).agg(*counters).columns]
    # A split is read in order by one task, so the smallest place is its first line.
    per_split = kinds.groupBy("file", "block").agg(
        F.count_if("broken").alias("broken"), F.min("place").alias("place"),
        F.min(F.when(F.col("like"), F.col("place"))).alias("like"), *counters)
    begins = F.min_by(F.col("place").eqNullSafe(F.col("like")), "block").alias("begins")
    per_file = per_split.groupBy("file").agg(
        begins, F.sum("broken").alias("broken"), *[F.sum(n).alias(n) for n in names])
    return _collected(per_file.agg(
        F.count(F.lit(1)).alias("files"), F.sum("broken").alias("broken"),
        F.count_if(~F.col("begins")).alias("other"), *[F.sum(n).alias(n) for n in names]), columns)
