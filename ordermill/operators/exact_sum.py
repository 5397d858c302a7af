"""Sums of doubles that do not depend on the order of their rows.

A double below 2**53 is cut at fixed places into five whole numbers of 26 bits, which are added up as
such: exactly, in any order, and combined before a shuffle like any sum. Only the five totals
are put together and rounded: once up to about 2**46, beyond that in steps that are always the same.
What they cannot hold (parts below 2**-78, numbers of 2**53 or more, infinities and NaN) is
added up as doubles beside them. Up to 2**36 rows a group.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BITS = 26
PARTS = 5
STEP = 1 << BITS
MOST = 1 << 53
UNIT = 1 << (BITS * (PARTS - 2))  # the last part counts in 1 / UNIT
FITS = 1 << 20  # the greatest part's total must be below this, so that all have a place in 38 digits


def parts(value: str) -> list[str]:
    """Of a double, per row: the whole numbers, and last what they cannot hold. All NULL for a NULL."""
    usable = f"CASE WHEN abs({value}) < {MOST}D THEN {value} END"
    # A remainder of doubles is exact, and a cast cuts towards 0.
    whole = [f"{usable} / {STEP}D"] + [
        f"({usable} * {STEP ** place}D) % {STEP}D" for place in range(PARTS - 1)]
    beside = (f"CASE WHEN abs({value}) < {MOST}D THEN ({value} * {UNIT}D) % 1D / {UNIT}D "
              f"ELSE {value} END")
    return [f"bigint({part})" for part in whole] + [beside]


def put_together(sums: list[str]) -> str:
    """The sum of doubles, from the sums of their ``parts``; NULL if there was no value."""
    *sums, beside = sums
    totals = [f"coalesce({s}, 0)" for s in sums]
    scales = [STEP ** (PARTS - 1 - place) for place in range(PARTS)]
    whole = " + ".join(f"cast({t} AS decimal(20,0)) * {s}BD"
                       for t, s in zip(totals, scales))
    rounded = " + ".join(f"double({t}) * {s}D" for t, s in zip(totals, scales))
    # Where 64 bits hold two parts together, a carry leaves two doubles without error, added at once.
    first, *pairs = totals
    high, low = [f"({a} * {STEP} + {b})" for a, b in (pairs[:2], pairs[2:])]
    small = " AND ".join([f"{first} = 0"] + [
        f"abs({t}) < {1 << bits}" for t, bits in zip(pairs, (BITS - 1, 2 * BITS - 2, 35, 61))])
    plain = (f"double({high} + shiftright({low}, {2 * BITS})) / {STEP}D + "
             f"double({low} & {STEP ** 2 - 1}) / {UNIT}D")
    exact = (f"(CASE WHEN {small} THEN {plain} "
             f"ELSE (CASE WHEN abs({first}) < {FITS} THEN double({whole}) ELSE {rounded} END) / {UNIT}D END)")
    return f"({exact} + {beside})"


def _exact_sum(value: str) -> str:
    """As one expression: built call by call, it would cost more than a small sum."""
    return put_together([f"sum({part})" for part in parts(value)])


def exact_sum(value: str) -> Column:
    """The sum of a double column, rounded once; NULL if there is no value."""
    return F.expr(_exact_sum(f"double({value})"))


def exact_mean(value: str) -> Column:
    """The mean of a double column; NULL if there is no value."""
    return F.expr(f"CASE WHEN count({value}) > 0 THEN {_exact_sum(f'double({value})')} "
                  f"/ greatest(count({value}), 1) END")
