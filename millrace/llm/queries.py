"""The operators bound to the benchmark tables, each with its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontamination, mixing, ngram_lm, page_text, prefix_trie, quality, ranked_search, secret_scan, sharding, simhash, token_files, toxicity, warc
from millrace.llm.common import table, written

Query = Callable[[SparkSession, str], DataFrame]


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = warc.write_archives(table(spark, sf_dir, "pages"))
    return warc.read_archives(archives).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op2_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = written(sharding.sized(table(spark, sf_dir, "documents")), "shard-sizes")
    return sharding.byte_shards(rows, 40).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.searched(documents, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        (F.size("items") > 0).alias("contaminated"),
        F.col("items.item_id").alias("item_ids"),
        F.coalesce(F.array_max("items.share"), F.lit(0.0)).alias("share"),
    )


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_text.extracted(table(spark, sf_dir, "pages"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = toxicity.learnt(documents, table(spark, sf_dir, "labels"))
    return toxicity.scored(documents, model).select(
        "doc_id",
        toxicity.held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op7_ngram_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = ngram_lm.train(documents.filter(~ngram_lm.held_out()))
    return ngram_lm.scored(documents, model).select(
        "doc_id",
        ngram_lm.held_out().alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("bigint").alias("train_tokens"),
        "base_score",
        "score",
    )


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_fingerprint().alias("fingerprint"), "component_id")


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mixed(documents).select("doc_id", "size", "source_size", "target", "taken")


def op10_token_files(
    spark: SparkSession, sf_dir: str, vocabulary: str | None = None
) -> DataFrame:
    import public_tokenizers

    vocabulary = vocabulary or public_tokenizers.path("byte_bpe_50k.json")
    files = token_files.write_tokens(table(spark, sf_dir, "documents"), vocabulary, end_id=2)
    return token_files.read_tokens(files)


def op11_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scanned(table(spark, sf_dir, "documents"))
    secrets, kinds = F.col("secrets"), [d.kind for d in secret_scan.BASE]
    return found.select(
        "doc_id",
        *[
            F.size(secret_scan.of_kinds(secrets, [kind])).cast("bigint").alias(f"n_{kind}")
            for kind in kinds
        ],
        F.sha2(secret_scan.listed(secret_scan.of_kinds(secrets, kinds)), 256).alias("base_sha256"),
        secret_scan.listed(secrets).alias("spans"),
    )


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = written(prefix_trie.in_order(table(spark, sf_dir, "conversations")), "trie-order")
    return prefix_trie.nodes(*prefix_trie.spliced(turns)).select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        "ends_sha256",
    )


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (
        op1_warc,
        op2_byte_shards,
        op3_decontamination,
        op4_main_text,
        op5_quality_rules,
        op6_toxicity,
        op7_ngram_lm,
        op8_simhash,
        op9_source_mix,
        op10_token_files,
        op11_secrets,
        op12_prefix_trie,
        op13_ranked_search,
    )
}

ORACLES: dict[str, str] = {
    "op1_warc": warc.ORACLE,
    "op5_quality_rules": quality.oracle(),
    "op9_source_mix": mixing.ORACLE,
    "op12_prefix_trie": prefix_trie.ORACLE,
    "op13_ranked_search": ranked_search.ORACLE,
}
