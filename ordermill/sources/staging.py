"""From a CSV extract to a typed table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .column_types import column_type, typed
from .csv_extract import MalformedExtract, field, read_extract


@dataclass(frozen=True)
class TypedExtract:
    """The typed rows, and the counts the non-empty gate was passed with."""

    table: DataFrame
    rows: int
    columns: int


def typed_extract(spark: SparkSession, path: str) -> TypedExtract:
    """Read, decide the column types, and refuse an extract that is empty or malformed.

    The counts come from the pass that decides how to read; the returned table is a lazy pass of its
    own.
    """
    extract = read_extract(spark, path)
    columns = [F.col(field(i)) for i in range(len(extract.names))]
    table = extract.rows.select(*[
        typed(column, column_type(kinds)).alias(name)
        for column, kinds, name in zip(columns, extract.kinds, extract.names)])
    require_counts(extract.records, len(extract.names), path)
    return TypedExtract(table, extract.records, len(extract.names))


def require_counts(rows: int, columns: int, name: str) -> None:
    """The non-empty gate: an error if there are no rows or no columns."""
    if not rows or not columns:
        raise MalformedExtract(f"{name} is empty or malformed")


def passes_gate(table: DataFrame) -> DataFrame:
    """``rows``, ``columns``, and whether the table passes the gate, as one row."""
    return table.agg(F.count(F.lit(1)).alias("rows"),
                     F.lit(len(table.columns)).cast("bigint").alias("columns")).withColumn(
        "passes", (F.col("rows") > 0) & (F.col("columns") > 0))


def require_rows(table: DataFrame, name: str) -> DataFrame:
    """The table itself, or an error if it does not pass the gate."""
    found = passes_gate(table).first()
    require_counts(found["rows"], found["columns"], name)
    return table
