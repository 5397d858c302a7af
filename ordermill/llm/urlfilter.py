"""URL filter: rules first, then a tree of path templates that is pruned by labelled pages.

1. Segments that vary by their form (numbers, dates, long hexadecimal ids) become wildcards in the
   row. Pages are then summed per host and form.
2. Per host a tree is grown, a level at a time and as deep as the paths go. A child with
   ``LEAST_LABELLED`` labelled pages or more stays a branch of its own if its share of bad ones differs from that of its siblings
   (two-proportion z-test), however few of its parent's pages it has. Children that the test does
   not tell apart are merged into the wildcard. Levels that the labelled pages of a template share
   are passed in one step, and a template that no further test can part is done; its pages are
   told apart by the length of their paths only.
3. A template is rejected if its share of bad pages, smoothed towards its host's and that towards the
   whole table's, is above ``MOST_BAD`` on ``LEAST_LABELLED`` labelled pages or more.

Only SQL functions are used. A hot host is combined before each shuffle; the parents' sums are written
tables, so a join with them can be split or broadcast by size.

Defined results: a NULL url, or one without ``://``, has an empty host and path, fits no rule, and is
judged like any host. A NULL id has no label. Repeated rows count as often as they are there. Labels
of one id that contradict each other count as bad. A url of any length is read whole. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import Scratch

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_Z = 3.0           # difference of bad shares that keeps branches apart
SMOOTHING = 5.0         # labelled pages that the prior share counts for
MOST_BAD = 0.5
LEAST_LABELLED = 5

# The forms of variable segments, most special first; a file ending stays.
FORMS = [
    (r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}", "{id}"),
    (r"^[0-9]+(?![^.])", "{n}"),
    (r"^[0-9]{4}-[0-9]{2}-[0-9]{2}(?![^.])", "{date}"),
    (r"^(?=[0-9a-fA-F]*[0-9])[0-9a-fA-F]{12,}(?![^.])", "{id}"),
]


@dataclass(frozen=True)
class Rule:
    """Fits its host and all subdomains, if the path starts with the rule's."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def fits(self) -> Column:
        here = (F.col("host") == self.host) | F.endswith("host", F.lit(f".{self.host}"))
        return here & F.startswith("path", F.lit(self.path))


RULES = [Rule("allow", "com", "/"), Rule("block", "example.com", "/en/"),
         Rule("allow", "www.example.com", "/en/"), Rule("block", "net", "/es/"),
         Rule("block", "net", "/fr/")]


def host_and_path(url: Column) -> tuple[Column, Column]:
    mark = F.instr(url, "://")
    rest = F.when(mark > 0, F.substring(url, mark + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def first_rule(rules: list[Rule], value: str) -> Column:
    """``name`` or ``verdict`` of the longest rule that fits; NULL if none does."""
    longest = sorted(rules, key=lambda r: -len(r.name))
    out = F.lit(None).cast("string")
    for rule in reversed(longest):
        out = F.when(rule.fits(), F.lit(getattr(rule, value))).otherwise(out)
    return out


def form(path: Column) -> Column:
    """The segments of a path as an array, variable ones by their form."""
    def of(segment: Column) -> Column:
        # no more than one form fits, and its name starts with no digit
        return reduce(lambda text, f: F.regexp_replace(text, *f), FORMS, segment)
    return F.transform(F.split(F.regexp_replace(path, "^/", ""), "/"), of)


def shared_levels(low: str, high: str) -> Column:
    """How many segments two different forms have in common at their start."""
    pairs = F.arrays_zip(low, high)
    equal = F.transform(pairs, lambda z: z[low].eqNullSafe(z[high]))
    return (F.array_position(equal, False) - 1).cast("int")


def _share(bad: Column, labelled: Column, prior: Column) -> Column:
    return (bad + prior * SMOOTHING) / (labelled + SMOOTHING)


class TemplateTree:
    """Templates of the pages' paths; ``pages`` has host, form, and bad (1, 0, or NULL)."""

    def __init__(self, pages: DataFrame, scratch: Scratch):
        self.scratch, self.step = scratch, 0
        forms = pages.groupBy("host", "form").agg(
            F.count("bad").alias("labelled"), F.sum(F.coalesce("bad", F.lit(0))).alias("bad"))
        self.forms = self._keep(forms.select(
            "*", F.lit("").alias("template"), F.lit(0).alias("level")), "forms")

    def _keep(self, rows: DataFrame, name: str) -> DataFrame:
        self.step += 1
        return self.scratch.table(rows, f"{name}_{self.step}")

    def grow(self) -> DataFrame:
        """(host, form, template, labelled, bad) of all forms."""
        sums = [F.sum(c).alias(c) for c in ("labelled", "bad")]
        left, done = self.forms, []
        while not left.isEmpty():
            labelled = left.where((F.col("labelled") > 0) & (F.size("form") > F.col("level")))
            ahead = F.expr("slice(form, level + 1, size(form))")
            # what the least and the greatest of the forms share, all of them do
            parts = self._keep(labelled.groupBy("host", "template", "level").agg(
                *sums, F.min(ahead).alias("low"), F.max(ahead).alias("high"))
                .where((F.col("labelled") > LEAST_LABELLED) & (F.col("bad") > 0)
                       & (F.col("bad") < F.col("labelled")) & (F.col("low") != F.col("high")))
                .select("host", "template",
                        (F.col("level") + shared_levels("low", "high")).alias("at")), "parts")
            child = F.get("form", F.col("at")).alias("child")
            children = self._keep(labelled.join(parts, ["host", "template"]).select("*", child)
                                  .where("child is not null")
                                  .groupBy("host", "template", "child").agg(*sums), "children")
            parents = self._keep(children.groupBy("host", "template").agg(
                *[F.sum(c).alias(f"all_{c}") for c in ("labelled", "bad")]), "parents")
            own = children.join(parents, ["host", "template"]).where(self._differs())
            own = self._keep(own.select("host", "template", "child", F.lit(True).alias("own")), "own")
            rows = left.join(parts, ["host", "template"], "left").select("*", child)
            # a path holds no "?", so a template that is done is like no other
            passed = F.concat("template", F.expr("repeat('/*', at - level)"), F.lit("/"))
            grown = self._keep(rows.join(own, ["host", "template", "child"], "left").select(
                "host", "form", "labelled", "bad",
                F.when(F.col("child").isNull(), F.concat("template", F.lit("?"), F.size("form")))
                .otherwise(F.concat(passed, F.when(F.col("own"), F.col("child")).otherwise("*")))
                .alias("template"),
                F.when(F.col("child").isNotNull(), F.col("at") + 1).alias("level")), "forms")
            done.append(grown.where("level is null").drop("level"))
            left = grown.where("level is not null")
        return reduce(DataFrame.unionByName, done, self.forms.drop("level").limit(0))

    @staticmethod
    def _differs() -> Column:
        """Enough labelled pages, and another share of bad ones than the siblings together."""
        rest_labelled = F.col("all_labelled") - F.col("labelled")
        rest_bad = F.col("all_bad") - F.col("bad")
        pooled = F.col("all_bad") / F.col("all_labelled")
        error = F.sqrt(pooled * (1 - pooled) * (1 / F.col("labelled") + 1 / rest_labelled))
        gap = F.abs(F.col("bad") / F.col("labelled") - rest_bad / rest_labelled)
        tested = (F.col("labelled") >= LEAST_LABELLED) & (rest_labelled > 0)
        return F.when(tested, (gap > 0) & (gap >= error * LEAST_Z)).otherwise(False)

    def rejected(self) -> DataFrame:
        """(host, form) of the rejected templates."""
        forms = self.grow()
        whole = forms.agg(F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad")).first()
        base = F.lit((whole["bad"] or 0) / max(whole["labelled"] or 0, 1))
        hosts = forms.groupBy("host").agg(
            _share(F.sum("bad"), F.sum("labelled"), base).alias("host_share"))
        templates = forms.groupBy("host", "template").agg(
            F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad"))
        hosts = self._keep(hosts, "hosts")
        bad = self._keep(
            templates.join(hosts, "host")
            .where((_share(F.col("bad"), F.col("labelled"), F.col("host_share")) > MOST_BAD)
                   & (F.col("labelled") >= LEAST_LABELLED)).select("host", "template"), "bad")
        return self._keep(forms.join(bad, ["host", "template"], "left_semi")
                          .select("host", "form"), "rejected")


def bad_pages(labels: DataFrame) -> DataFrame:
    """(page_id, bad) from labels of quality and toxicity, by id."""
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    return labels.select(F.col("doc_id").alias("page_id"), bad.cast("int").alias("bad"))


def judge(pages: DataFrame, labels: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """page_id, host, path, the rule that fits, and verdict, of every page.

    ``labels``: page_id and bad (1 or 0).
    """
    scratch = Scratch(pages.sparkSession, "urls")
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    rows = rows.withColumn("form", form(F.col("path")))
    one = (labels.where("page_id is not null and bad is not null")
           .groupBy("page_id").agg(F.max("bad").alias("bad")))
    labelled = rows.select("page_id", "host", "form").join(one, "page_id", "left")
    rejected = TemplateTree(labelled, scratch).rejected().withColumn("rejected", F.lit(True))
    judged = rows.join(rejected, ["host", "form"], "left")
    by_method = F.when(F.col("rejected"), "block").otherwise("allow")
    return judged.select(
        "page_id", "host", "path", first_rule(rules, "name").alias("rule"),
        F.coalesce(first_rule(rules, "verdict"), by_method).alias("verdict"))
