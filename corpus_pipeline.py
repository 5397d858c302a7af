"""The corpus pipeline: documents in, shuffled shards of clean and mixed documents out.

In every stage: texts of any length are read whole, an empty table gives an empty table, and further
columns are carried along whatever their names (``shards`` alone replaces ``shard`` and ``slot``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ordermill.llm import decontaminate, mixing, neardup, quality, sharding
from ordermill.scratch import Scratch

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines go, and documents that the rules reject.

    NULL and empty texts are rejected. A NULL source is a host of its own; ids may be NULL. Equal rows
    share their fate.
    """
    return quality.clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group, on shingles of five words and a similarity of 0.8.

    That with the smallest id stays, a NULL id last; of equal ids that with the smallest text hash, of equal
    rows any one. Texts without words are in no group, so all of them stay.
    """
    return neardup.one_of_each_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go.

    NULL and empty texts hold none and stay, as do all documents if the benchmark is empty. Each row is
    judged by itself; passages of items without an id count.
    """
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.without_contaminated(docs, benchmark)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it.

    NULL is a source like any other, after all others. A NULL text has size 0. Documents without
    a label, or with a NULL id, have quality 1. Equal rows are numbered and decided one by one.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return mixing.mixed(docs, mixing.quality_weights(labels))


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The written shards: the documents with shard and slot, which replace columns so named.

    NULL ids and texts are hashed like others. Which of some equal rows has which slot is not defined.
    """
    kept = [f"row.`{c}`" for c in docs.columns if c not in ("shard", "slot")]
    return sharding.sharded(docs).select("shard", "slot", *kept)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing_sources", mixing_sources),
    ("shards", shards),
]

# The order inside a shard is that of a seeded shuffle, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each one's rows are written and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for position, (name, stage) in enumerate(STAGES):
        docs = scratch.table(stage(spark, docs, sf_dir), f"{position}_{name}")
    return docs
