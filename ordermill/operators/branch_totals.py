"""Left joins of one parent to several one-to-many branches, one row per key.

Joining the branches row by row would multiply them: a key with 1,000 rows on each of
three branches becomes 1e9 rows. Here all branches are reduced to one row per key *before*
the join (eager aggregation). They are stacked into one table, so that one aggregation serves
them all, and one join attaches the result. Each branch also gives its row count, from
which a caller can work out what the multiplied form adds up to.

Everything is combined before it is shuffled, so no task gets the rows of a hot key: values to be
counted are shuffled by key and value first, and by key only when one row of them per task is left. Of
whole numbers, 64 neighbours are one value with a bit for each of them, so most keys have one row.

The rows of all branches share their columns, the parts of one exact sum. Only sums per key have
columns for each branch: a task holds a row for every key in it, and its memory is that of those rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .exact_sum import PARTS, parts, put_together

COPIES = "copies"
WHOLE_NUMBERS = ("tinyint", "smallint", "int", "bigint")
PART_SUMS = [f"part_{i}" for i in range(PARTS + 1)]


@dataclass(frozen=True)
class Branch:
    """Detail rows, and the names of the totals wanted of them per key.

    ``rows`` are counted, ``sum`` and ``mean`` are those of the column ``value``, which is taken as a
    double, and ``distinct`` is how many values the column ``counted`` has.
    """

    table: DataFrame
    value: str
    rows: str
    sum: str | None = None
    mean: str | None = None
    counted: str | None = None
    distinct: str | None = None

    def details(self, key: str, number: int) -> DataFrame:
        """Key, number of the branch, value, and for what is counted the group and its bit."""
        columns = [F.col(key), F.lit(number).alias("branch"), F.expr(f"double({self.value})").alias("value")]
        if self.counted:
            counted = F.col(self.counted)
            group, bit = counted, F.when(counted.isNotNull(), F.lit(1).cast("bigint"))
            if dict(self.table.dtypes)[self.counted] in WHOLE_NUMBERS:
                group = F.shiftright(counted.cast("bigint"), 6)
                bit = F.expr(f"shiftleft(1L, int(bigint(`{self.counted}`) & 63))")
            columns += [group.alias("group"), bit.alias("bits")]
        return self.table.where(F.col(key).isNotNull()).select(*columns)

    def totals(self, number: int) -> list[Column]:
        """From rows of all branches, with the sums of ``_per_group``."""
        def of(column: str) -> str:
            return f"sum(CASE WHEN branch = {number} THEN {column} END)"
        total = put_together([of(p) for p in PART_SUMS])
        found = [F.expr(f"coalesce({of('rows')}, 0)").alias(self.rows)]
        if self.sum:
            found.append(F.expr(total).alias(self.sum))
        if self.mean:
            n = f"coalesce({of('present')}, 0)"
            found.append(F.expr(f"CASE WHEN {n} > 0 THEN {total} / greatest({n}, 1) END").alias(self.mean))
        if self.distinct:
            found.append(F.expr(f"coalesce({of('bit_count(bits)')}, 0)").alias(self.distinct))
        return found


def _per_group(details: DataFrame, key: str) -> DataFrame:
    """One row per key, branch, and group of counted values."""
    keys = [key, "branch"]
    found = [F.count(F.lit(1)).alias("rows"), F.count("value").alias("present"),
             *[F.expr(f"sum({part})").alias(p) for part, p in zip(parts("value"), PART_SUMS)]]
    if "group" in details.columns:
        keys.append("group")
        found.append(F.bit_or("bits").alias("bits"))
    return details.groupBy(*keys).agg(*found)


def with_branch_totals(parents: DataFrame, key: str,
                       branches: Sequence[Branch]) -> DataFrame:
    """Distinct parent rows, their number of copies, and all branch totals.

    A NULL key matches nothing, so such parents do not reach the join.
    """
    columns = parents.columns
    copies = F.count(F.lit(1)).alias(COPIES)
    details = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True),
                     [branch.details(key, n) for n, branch in enumerate(branches)])
    totals = _per_group(details, key).groupBy(key).agg(
        *[t for n, branch in enumerate(branches) for t in branch.totals(n)])
    matched = (parents.where(F.col(key).isNotNull()).groupBy(*columns).agg(copies)
               .join(totals, key, "left"))
    alone = parents.where(F.col(key).isNull()).groupBy(*columns).agg(copies)
    return matched.unionByName(alone, allowMissingColumns=True)
