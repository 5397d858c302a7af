"""Column types of an all-text table, decided from its values in one pass.

A column gets the narrowest type that all its values allow. A missing value turns an
integer column into a double one.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Field texts that mean "missing".
MISSING_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
# The spellings of a boolean.
TRUE_TOKENS = ["True", "TRUE", "true"]
FALSE_TOKENS = ["False", "FALSE", "false"]

# Numbers are recognised by pattern. A trial cast would take "1d" for a double, and costs
# an exception for every text value. The quantifiers are possessive, so a text that only
# starts like a number is given up at once.
SHORT_DIGITS = r"\A\s*+[+-]?+[0-9]{1,18}+\s*+\z"  # fits 64 bits, whatever the digits
DIGITS = r"\A\s*+[+-]?+[0-9]++\s*+\z"
NUMBER = (r"\A\s*+[+-]?+(?:(?:[0-9]++(?:\.[0-9]*+)?+|\.[0-9]++)(?:[eE][+-]?+[0-9]++)?+"
          r"|[iI][nN][fF](?:[iI][nN][iI][tT][yY])?+)\s*+\z")

# What a value can be. A wide integer fits 64 bits without a sign only, a huge one not at all.
KINDS = ["missing", "boolean", "integer", "wide_integer", "huge_integer", "decimal", "text"]
MISSING, BOOLEAN, INTEGER, WIDE_INTEGER, HUGE_INTEGER, DECIMAL, TEXT = range(len(KINDS))


def without_missing(text: Column) -> Column:
    """NULL for a token that means "missing"."""
    return F.when(~text.isin(MISSING_TOKENS), text)


def _texts(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


# Long numbers and such with an exponent, tried by their value.
LONG_NUMBER_KIND = f"""CASE
    WHEN length(v) > 18 AND v RLIKE r'{DIGITS}' THEN CASE
        WHEN try_cast(trim(v) AS bigint) IS NOT NULL THEN {INTEGER}
        WHEN try_cast(trim(v) AS decimal(38,0)) >= 0
            AND try_cast(trim(v) AS decimal(38,0)) < {2 ** 64}BD THEN {WIDE_INTEGER}
        ELSE {HUGE_INTEGER} END
    WHEN (contains(v, 'e') OR contains(v, 'E') OR length(v) > 300)
        AND abs(try_cast(v AS double)) = double('inf') THEN {TEXT}
    ELSE {DECIMAL} END"""

# Numbers start with a blank, a sign, a dot, a digit or the i of inf. This spares most texts the patterns.
# The rare kinds stand in a lambda, which Spark does not compile into one method with the rest of the
# pass: the JVM only interprets a method that long, and a few columns are enough for one.
VALUE_KIND = f"""CASE
    WHEN {{0}} IS NULL OR {{0}} IN ({_texts(MISSING_TOKENS)}) THEN {MISSING}
    WHEN ascii({{0}}) <= ascii('9') OR ascii({{0}}) IN (ascii('i'), ascii('I')) THEN CASE
        WHEN {{0}} RLIKE r'{SHORT_DIGITS}' THEN {INTEGER}
        WHEN {{0}} RLIKE r'{NUMBER}' THEN CASE
            WHEN length({{0}}) > 18 OR contains({{0}}, 'e') OR contains({{0}}, 'E')
                THEN transform(array({{0}}), v -> {LONG_NUMBER_KIND})[0]
            ELSE {DECIMAL} END
        ELSE {TEXT} END
    WHEN {{0}} IN ({_texts(TRUE_TOKENS + FALSE_TOKENS)}) THEN {BOOLEAN}
    ELSE {TEXT} END"""


def value_kind(text: str) -> Column:
    """The position in KINDS of a column's value. One expression: built call by call, it would cost
    more than counting a small table."""
    return F.expr(VALUE_KIND.replace("{0}", text))


def kind_counters(kind: str) -> list[Column]:
    """Counts of a column of kinds, named ``<column>_<kind>``."""
    return [F.expr(f"count_if({kind} = {position})").alias(f"{kind}_{name}")
            for position, name in enumerate(KINDS)]


def kind_counts(texts: DataFrame, columns: list[str]) -> DataFrame:
    """One row per column: ``column_name``, ``rows``, and the count of each kind.

    One pass; a task sends on one row. The kind of a value is worked out once.
    """
    places = [f"c{i}" for i in range(len(columns))]
    kinds = texts.select(*[value_kind(f"`{c}`").alias(p) for c, p in zip(columns, places)])
    counted = kinds.agg(F.count(F.lit(1)).alias("rows"),
                        *[n for p in places for n in kind_counters(p)])
    return counted.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), "rows",
                 *[F.col(f"{p}_{kind}").alias(kind) for kind in KINDS])
        for c, p in zip(columns, places)])))


def column_type(counts: Mapping[str, int]) -> str:
    """The type of a column with these kind counts.

    Integers beyond 64 bits would lose digits as doubles, so with them decimals are text as well.
    """
    def only(*kinds: str) -> bool:
        return sum(counts[k] for k in kinds) == present
    missing = counts["missing"]
    present = sum(counts[k] for k in KINDS) - missing
    if not present:
        return "double"
    if only("boolean"):
        return "boolean"
    if only("integer"):
        return "double" if missing else "bigint"
    if only("integer", "wide_integer", "huge_integer"):
        return "string"
    return "double" if only("integer", "wide_integer", "decimal") else "string"


def typed(text: Column, data_type: str) -> Column:
    """The text as the decided type."""
    value = without_missing(text)
    if data_type == "string":
        return value
    if data_type == "boolean":
        return F.when(value.isNotNull(), value.isin(TRUE_TOKENS))
    return F.trim(value).cast(data_type)
