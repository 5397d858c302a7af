"""Secrets in texts, told from widely copied examples by who owns the places that hold them.

1. Each text is searched for assignments of credentials, access keys and long hexadecimal numbers (the
   base kinds), and outside of these for long tokens of mixed characters (kind ``key``). Places are
   code points: a text is split at its matches, and the lengths of the parts are summed up.
2. The hash of every value found is counted over the corpus: distinct owners, and distinct
   repositories, a repository being known by its owner and name. Rows are combined before each
   shuffle, first by value, owner and repository.
3. A value with more than ``MOST_OWNERS`` owners or ``MOST_REPOSITORIES`` repositories is a widely
   copied example; any other looks live. Base findings are reported either way, with the counts and
   the verdict; a ``key`` counts as a finding if it looks live.

Only SQL functions are used. Both limits are numbers of owners and repositories, not shares, so a
verdict does not hang on the size of the corpus.

Defined results: a NULL text has no findings, like an empty one. Texts of any length are searched whole. NULL
is an owner, and a repository, like any other. Copies of a row are searched each, and count
as one repository; findings of equal id and text are joined once. Matches of one kind never overlap; those of
different base kinds may. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import Scratch

MOST_OWNERS = 2
MOST_REPOSITORIES = 100
BLOCK = 256  # places that are summed up one by one
LEAST_DIGITS, LEAST_LETTERS, LEAST_DIFFERENT = 3, 3, 10  # characters of a key


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


NAMES = "|".join(_either_case(w) for w in ("password", "passwd", "secret", "token", "api_?key"))


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    group: int   # of the value
    least: int   # characters of the value


BASE_KINDS = (
    Kind("assign", rf"""({NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Kind("access", "AKIA[A-Z0-9]{12,}", 0, 16),
    Kind("hex", "[0-9a-f]{32,}", 0, 32),
)
KEY = Kind("key", "[A-Za-z0-9+/_-]{20,}={0,2}", 0, 20)
ORDER = [k.name for k in (*BASE_KINDS, KEY)]

FINDING = "struct<start:bigint,kind:int,end:bigint,hash:string>"


def _none() -> Column:
    return F.array().cast(f"array<{FINDING}>")


def running(lengths: Column) -> Column:
    """Sums of an array of numbers up to each place, in blocks, so that time is near linear."""
    def sums(numbers: Column, first: Column) -> Column:
        return F.slice(F.aggregate(numbers, F.array(first), lambda got, n: F.concat(
            got, F.array(F.element_at(got, -1) + n))), F.lit(2), F.size(numbers))
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / BLOCK).cast("int")),
                         lambda b: F.slice(lengths, b * BLOCK + 1, F.lit(BLOCK)))
    zero = F.lit(0).cast("bigint")
    totals = F.transform(blocks, lambda block: F.aggregate(block, zero, lambda got, n: got + n))
    firsts = F.concat(F.array(zero), sums(totals, zero))
    return F.when(F.size(lengths) > 0, F.flatten(F.transform(
        F.arrays_zip(blocks.alias("block"), F.slice(firsts, F.lit(1), F.size(blocks)).alias("first")),
        lambda b: sums(b["block"], b["first"])))).otherwise(F.array().cast("array<bigint>"))


def _character_count(value: Column, characters: str) -> Column:
    return F.length(F.regexp_replace(value, f"[^{characters}]", ""))


def _mixed(value: Column) -> Column:
    return ((_character_count(value, "0-9") >= LEAST_DIGITS)
            & (_character_count(value, "A-Za-z") >= LEAST_LETTERS)
            & (F.size(F.array_distinct(F.split(value, ""))) >= LEAST_DIFFERENT))


def _search(rows: DataFrame, has: str, text: str, kind: Kind, out: str, wanted=None) -> DataFrame:
    """Adds the findings of a kind as ``out``; values too short, or not ``wanted``, are left out.

    Only rows with ``has`` are searched. ``text`` then has blanks for what was found.
    """
    at = rows.columns
    find = lambda group: F.when(F.col(has), F.regexp_extract_all(
        F.col(text), F.lit(kind.pattern), F.lit(group)))
    rows = rows.select("*", find(0).alias("matches"), find(kind.group).alias("values"),
                       F.when(F.col(has), F.split(F.col(text), kind.pattern)).alias("gaps"))
    steps = F.transform(
        F.arrays_zip("gaps", "matches"),
        lambda p: (F.length(p["gaps"]) + F.coalesce(F.length(p["matches"]), F.lit(0))).cast("bigint"))
    rows = rows.select(*at, "gaps", F.arrays_zip(F.when(F.col(has), running(steps)).alias("end"),
                                                 F.col("matches"), F.col("values")).alias("found"))

    def good(f: Column) -> Column:
        long_enough = F.length(f["values"]) >= kind.least
        return F.coalesce(long_enough if wanted is None else long_enough & wanted(f["values"]),
                          F.lit(False))
    findings = F.transform(F.filter("found", good), lambda f: F.struct(
        (f["end"] - F.length(f["matches"])).alias("start"),
        F.lit(ORDER.index(kind.name)).alias("kind"), f["end"].alias("end"),
        F.md5(f["values"].cast("binary")).alias("hash")))
    blank = F.array_join(F.transform(F.arrays_zip("gaps", "found"), lambda p: F.concat(
        p["gaps"], F.when(good(p["found"]), F.repeat(F.lit(" "), F.length(p["found"]["matches"])))
        .otherwise(F.coalesce(p["found"]["matches"], F.lit(""))))), "")
    return rows.select(*[F.when(F.col(has), blank).otherwise(F.col(text)).alias(c) if c == text
                         else c for c in at],
                       F.coalesce(findings.cast(f"array<{FINDING}>"), _none()).alias(out))


def candidates(documents: DataFrame, owner: str = "source", repository: str = "doc_id",
               doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text_md5, owner, repository and ``found``: base findings and possible keys by place."""
    assign = BASE_KINDS[0]
    body = F.coalesce(F.col(text), F.lit(""))
    rows = documents.select(
        F.col(doc_id).alias("doc_id"), F.col(owner).alias("owner"),
        F.col(repository).alias("repository"), F.md5(F.col(text).cast("binary")).alias("text_md5"),
        body.alias("text"), body.rlike(KEY.pattern).alias("has_key"),
        body.contains("AKIA").alias("has_access"), (body.contains("=") | body.contains(":")).alias("has_sign"))
    # A long hexadecimal number is a run that the pattern of a key finds, too.
    rows = rows.select("*", F.when(F.col("has_sign"), F.col("text").rlike(assign.pattern))
                       .otherwise(False).alias("has_assign"), F.col("text").alias("left"))
    for kind, has in zip(BASE_KINDS, ("has_assign", "has_access", "has_key")):
        # in the text as it is, and in what is left for the keys
        rows = _search(rows.withColumn("whole", F.col("text")), has, "whole", kind, kind.name)
        rows = _search(rows.drop("whole"), has, "left", kind, "again").drop("again")
    rows = _search(rows, "has_key", "left", KEY, KEY.name, _mixed)
    return rows.select("doc_id", "text_md5", "owner", "repository",
                       F.array_sort(F.concat(*ORDER)).alias("found"))


def ownership(found: DataFrame) -> DataFrame:
    """Owners and repositories of every value hash."""
    each = found.select("owner", "repository", F.explode("found").alias("finding")).select(
        "owner", "repository", F.col("finding.hash").alias("hash"))
    places = each.groupBy("hash", "owner", "repository").agg(F.lit(1).alias("one"))
    owners = places.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("repositories"))
    return owners.groupBy("hash").agg(F.count(F.lit(1)).alias("owners"),
                                      F.sum("repositories").alias("repositories"))


def scan(documents: DataFrame, most_owners: int = MOST_OWNERS,
         most_repositories: int = MOST_REPOSITORIES, **columns: str) -> DataFrame:
    """doc_id and ``findings`` of every row: start, end, kind, hash, owners, repositories, live."""
    scratch = Scratch(documents.sparkSession, "secrets")
    rows = scratch.table(candidates(documents, **columns), "found")
    some, none = rows.where(F.size("found") > 0), rows.where(F.size("found") == 0)
    counted = scratch.table(ownership(some), "ownership").withColumn(
        "live", (F.col("owners") <= most_owners) & (F.col("repositories") <= most_repositories))
    once = some.groupBy("doc_id", "text_md5").agg(F.first("found").alias("found"))
    each = once.select("doc_id", "text_md5", F.explode("found").alias("finding")).select(
        "doc_id", "text_md5", "finding.*")
    names = F.array(*[F.lit(n) for n in ORDER])
    judged = (each.join(counted, "hash")
              .where(F.col("live") | (F.col("kind") != ORDER.index(KEY.name)))
              .groupBy("doc_id", "text_md5").agg(F.array_sort(F.collect_list(F.struct(
                  "start", "kind", "end", "hash", "owners", "repositories", "live"))).alias("findings")))
    named = F.transform("findings", lambda f: F.struct(
        f["start"].alias("start"), f["end"].alias("end"),
        F.element_at(names, f["kind"] + 1).alias("kind"), f["hash"].alias("hash"),
        f["owners"].alias("owners"), f["repositories"].alias("repositories"), f["live"].alias("live")))
    empty = F.array().cast("array<struct<start:bigint,end:bigint,kind:string,hash:string,"
                           "owners:bigint,repositories:bigint,live:boolean>>")
    with_some = (some.alias("r").join(
        judged.alias("j"), F.expr("r.doc_id <=> j.doc_id and r.text_md5 <=> j.text_md5"), "left")
        .select("r.doc_id", F.coalesce(named, empty).alias("findings")))
    return with_some.unionAll(none.select("doc_id", empty.alias("findings")))


def span_list(findings: Column, base_only: bool = False) -> Column:
    """``kind:start:end`` of findings, comma-joined."""
    if base_only:
        findings = F.filter(findings, lambda f: f["kind"] != KEY.name)
    return F.array_join(F.transform(findings, lambda f: F.concat_ws(
        ":", f["kind"], f["start"].cast("string"), f["end"].cast("string"))), ",")
