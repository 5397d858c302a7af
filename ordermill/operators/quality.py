"""Column rules over a whole table, all counted in one pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

REPORT_SCHEMA = (
    "rule string, column string, min_value double, max_value double, element_count bigint, "
    "missing_count bigint, unexpected_count bigint, unexpected_percent double, success boolean")


@dataclass(frozen=True)
class Rule:
    """A condition every row has to meet. Bounds are inclusive."""

    kind: str
    column: str
    min_value: float | None = None
    max_value: float | None = None

    @property
    def name(self) -> str:
        return f"{self.column}_{self.kind}"

    @property
    def counts_missing(self) -> bool:
        return self.kind == "not_null"

    def broken(self) -> Column:
        """True for a row that breaks the rule, else false; a range ignores NULL."""
        value = F.col(self.column)
        if self.counts_missing:
            return value.isNull()
        outside = F.lit(False)
        if self.min_value is not None:
            outside = outside | (value < self.min_value)
        if self.max_value is not None:
            outside = outside | (value > self.max_value)
        return F.coalesce(outside, F.lit(False))


def not_null(column: str) -> Rule:
    return Rule("not_null", column)


def between(column: str, min_value: float | None = None,
            max_value: float | None = None) -> Rule:
    if min_value is None and max_value is None:
        raise ValueError("a range rule needs a bound")
    return Rule("between", column, min_value, max_value)


class QualityError(ValueError):
    """A suite failed; ``report`` holds one dict per rule.

    ``rows`` is the folder with the rows that broke a rule, if they were kept.
    """

    def __init__(self, suite: str, report: list[dict]):
        self.report = report
        self.rows: str | None = None
        broken = ", ".join(f"{r['rule']} ({r['unexpected_count']} rows)"
                           for r in report if not r["success"])
        super().__init__(f"{suite} failed: {broken}")


@dataclass(frozen=True)
class Suite:
    """A named, ordered list of rules."""

    name: str
    rules: Sequence[Rule]

    def _counts(self) -> list[Column]:
        counts = [F.count(F.lit(1)).alias("rows")]
        for i, rule in enumerate(self.rules):
            counts += [F.count_if(F.col(rule.column).isNull()).alias(f"missing_{i}"),
                       F.count_if(rule.broken()).alias(f"broken_{i}")]
        return counts

    def evaluate(self, table: DataFrame) -> DataFrame:
        """The report, one row per rule, from one aggregation of the table."""
        lines = []
        for i, rule in enumerate(self.rules):
            missing, broken = F.col(f"missing_{i}"), F.col(f"broken_{i}")
            judged = F.col("rows") if rule.counts_missing else F.col("rows") - missing
            lines.append(F.struct(
                F.lit(rule.name).alias("rule"), F.lit(rule.column).alias("column"),
                F.lit(rule.min_value).cast("double").alias("min_value"),
                F.lit(rule.max_value).cast("double").alias("max_value"),
                F.col("rows").alias("element_count"),
                missing.alias("missing_count"), broken.alias("unexpected_count"),
                F.when(judged > 0, broken * 100.0 / judged).alias("unexpected_percent"),
                (broken == 0).alias("success")))
        return table.agg(*self._counts()).select(F.inline(F.array(*lines)))

    def violations(self, table: DataFrame) -> DataFrame:
        """Rows that break a rule, once per broken rule, with its name. One scan."""
        names = F.array_compact(F.array(
            *[F.when(rule.broken(), F.lit(rule.name)) for rule in self.rules]))
        return (table.withColumn("broken", names).where(F.size("broken") > 0)
                .select(*table.columns, F.explode("broken").alias("rule")))

    def observe(self, table: DataFrame, observation: Observation) -> DataFrame:
        """The same table, whose counts are taken while it is being written."""
        return table.observe(observation, *self._counts())

    def report(self, counts: Mapping[str, int]) -> list[dict]:
        """The report from observed counts, one dict per rule."""
        lines = []
        for i, rule in enumerate(self.rules):
            rows, missing = counts["rows"], counts[f"missing_{i}"]
            broken = counts[f"broken_{i}"]
            judged = rows if rule.counts_missing else rows - missing
            lines.append({
                "rule": rule.name, "column": rule.column, "min_value": rule.min_value,
                "max_value": rule.max_value, "element_count": rows, "missing_count": missing,
                "unexpected_count": broken,
                "unexpected_percent": broken * 100.0 / judged if judged else None,
                "success": broken == 0})
        return lines

    def require(self, report: list[dict]) -> list[dict]:
        """The report itself, or a QualityError if a rule failed."""
        if not all(line["success"] for line in report):
            raise QualityError(self.name, report)
        return report

    def check(self, table: DataFrame) -> list[dict]:
        """Evaluate and require in one go."""
        return self.require([row.asDict() for row in self.evaluate(table).collect()])


# The four rules and their bounds.
FACT_ORDERS_SUITE = Suite("fact_orders_suite", [
    not_null("order_id"),
    between("total_items", min_value=0),
    between("total_order_value", min_value=1),
    between("avg_review_score", min_value=0, max_value=5),
])
