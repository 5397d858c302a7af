"""Running totals within groups, of which one may hold a third of all rows.

Rows are dealt out by ranges of (group, order), so that a large group is cut into parts, and written.
A total is the sum of the group's earlier parts, one row each, and a window inside the part. Only SQL
functions are used.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import Scratch


def _same(left: str, right: str, columns: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
                                       for c in columns])


def with_totals(rows: DataFrame, scratch: Scratch, name: str, group: list[str], order: list[Column],
                totals: dict[str, Column]) -> DataFrame:
    """``rows`` with, for each of ``totals``, the sum in the group up to and with the row.

    Rows that ``order`` does not tell apart should be alike, as any order among them may come out.
    """
    by = [F.col(c).asc_nulls_first() for c in group]
    dealt = rows.repartitionByRange(*by, *order).withColumn("part", F.spark_partition_id())
    dealt = scratch.table(dealt, name)
    added = {f"sum_{i}": F.sum(value) for i, value in enumerate(totals.values())}
    parts = dealt.groupBy(*group, "part").agg(*[v.alias(c) for c, v in added.items()])
    before = Window.partitionBy(*group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (parts.withColumn("cut", F.min("part").over(Window.partitionBy(*group)) < F.col("part"))
             .select(*group, "part", "cut", *[F.sum(c).over(before).alias(c) for c in added])
             .where("cut").drop("cut"))  # one row per part that a group runs on into
    inside = Window.partitionBy(*group, "part").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, 0)
    got = dealt.select("*", *[F.sum(value).over(inside).alias(c)
                              for c, value in totals.items()])
    columns = [c for c in rows.columns if c not in totals]
    return (got.alias("r").join(parts.alias("p"), _same("r", "p", [*group, "part"]), "left")
            .select(*[f"r.{c}" for c in columns],
                    *[(F.col(f"r.{c}") + F.coalesce(F.col(f"p.sum_{i}"), F.lit(0))).alias(c)
                      for i, c in enumerate(totals)]))
