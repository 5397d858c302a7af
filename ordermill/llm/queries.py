"""The operators as queries over the sample tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (decontaminate, langid, mixing, neardup, oracle, prefixtrie, quality, secrets,
               sharding, tokencount, toxicity, urlfilter, warc, whitening)

TOKENIZERS = "/opt/tokenizers"  # the folder of the vocabulary files

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _crc(remainder_of: int):
    return F.crc32(F.col("doc_id").cast("string")) % remainder_of


def op1_warc(spark: SparkSession, folder: str) -> DataFrame:
    names, place = warc.write_archives(_table(spark, folder, "pages"))
    return warc.read_archives(names, place).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, folder, "documents"), words=2)


def op3_language(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents")
    model = langid.fit(documents.where(F.coalesce(_crc(4) != 2, F.lit(True))))
    return langid.predict(documents, model).select(
        "doc_id", F.coalesce(_crc(4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    vocabulary = tokencount.load_vocabulary(f"{TOKENIZERS}/piece_bpe_32k.model")
    return tokencount.count_tokens(_table(spark, folder, "documents"), vocabulary)


def op5_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    weights = mixing.quality_weights(_table(spark, folder, "labels"))
    return mixing.shares(_table(spark, folder, "documents"), weights).select(
        "doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken")


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    model = toxicity.fit(documents, labels.where(_crc(5) != 0))
    return toxicity.score(documents, model).select(
        "doc_id", F.coalesce(_crc(5) == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("passages").alias("n_passages"))


def op7_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.judge(_table(spark, folder, "documents"),
                                _table(spark, folder, "benchmark"))
    return found.select(
        "row.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


def op8_shards(spark: SparkSession, folder: str) -> DataFrame:
    size = F.coalesce(F.octet_length("row.text"), F.lit(0)).cast("long") + sharding.RECORD_BYTES
    return sharding.sharded(_table(spark, folder, "documents")).select(
        "row.doc_id", size.alias("size"),
        F.crc32(F.coalesce("row.text", F.lit(""))).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(_table(spark, folder, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "removed_words")


def op10_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    bad = urlfilter.bad_pages(_table(spark, folder, "labels"))
    return urlfilter.judge(_table(spark, folder, "pages"), bad)


def op11_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.scan(_table(spark, folder, "documents"))

    def of_kind(name: str):
        return F.size(F.filter("findings", lambda f: f["kind"] == name)).cast("long")
    base = secrets.span_list(F.col("findings"), base_only=True).cast("binary")
    return found.select(
        "doc_id", *[of_kind(k.name).alias(f"n_{k.name}") for k in secrets.BASE_KINDS],
        F.sha2(base, 256).alias("base_sha256"),
        secrets.span_list(F.col("findings")).alias("spans"),
        F.size(F.filter("findings", lambda f: f["live"])).cast("long").alias("n_live"))


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """``deviation`` is NULL where it has more than 64 bits."""
    return whitening.whiten(_table(spark, folder, "embeddings")).select(
        "vec_id", "component", "n", F.expr("try_cast(deviation as bigint)").alias("deviation"),
        "whitened", "explained", "identity_error")


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefixtrie.trie(_table(spark, folder, "conversations"))


def queries() -> dict[str, Query]:
    return {
        "op1_warc": op1_warc,
        "op2_near_duplicates": op2_near_duplicates,
        "op3_language": op3_language,
        "op4_token_counts": op4_token_counts,
        "op5_mix_sources": op5_mix_sources,
        "op6_toxicity": op6_toxicity,
        "op7_decontaminate": op7_decontaminate,
        "op8_shards": op8_shards,
        "op9_quality_rules": op9_quality_rules,
        "op10_url_filter": op10_url_filter,
        "op11_secrets": op11_secrets,
        "op12_whitening": op12_whitening,
        "op13_prefix_trie": op13_prefix_trie,
    }


def oracle_sql() -> dict[str, str]:
    """Not for 3, 4, 6 (models, tokenizer), 8 (seeded shuffle) and 12 (eigenvectors)."""
    return {
        "op1_warc": oracle.WARC,
        "op2_near_duplicates": oracle.NEAR_DUPLICATES,
        "op5_mix_sources": oracle.MIX_SOURCES,
        "op7_decontaminate": oracle.DECONTAMINATE,
        "op9_quality_rules": oracle.QUALITY_RULES,
        "op10_url_filter": oracle.url_filter(),
        "op11_secrets": oracle.secret_scan(),
        "op13_prefix_trie": oracle.PREFIX_TRIE,
    }
