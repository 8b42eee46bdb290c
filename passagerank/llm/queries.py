"""One query per operator, with production parameters over whole tables."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from passagerank.llm import (
    chat, mixing, pieces, pii, quality, shards, simhash, suffix_dedup, term_pipeline, token_counts, toxicity, variants, winnow,
)
from passagerank.llm.shared import table

#: Where the vocabulary files of public tokenizers lie; only the driver reads them.
TOKENIZERS = os.environ.get("TOKENIZERS_DIR", "/opt/tokenizers")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    field = pii.train_field(pii.labelled_examples(spark))
    found = pii.find_spans(table(spark, sf_dir, "documents"), field)
    exact = F.filter("spans", lambda s: s["base"])
    kinds = F.transform("exact", lambda s: s["kind"])
    counts = [
        (F.size("exact") - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}") for kind in pii.KINDS
    ]
    return found.withColumn("exact", exact).select(
        "doc_id", *counts, F.sha2(pii.listed(F.col("exact")), 256).alias("base_sha256"), pii.listed(F.col("spans")).alias("spans")
    )


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = "</s>[INST] ok [/INST]"
    rows = [(-1, 0, "user", probe), (-1, 1, "assistant", probe)]
    extra = spark.createDataFrame(rows, "conv_id BIGINT, turn BIGINT, role STRING, text STRING")
    return (
        chat.format_conversations(given.unionByName(extra))
        .withColumn("turns", chat.read_turns(F.col("formatted")))
        .withColumn("loss", chat.learned_text(F.col("segments")))
        .select(
            "conv_id", F.size("turns").cast("long").alias("n_turns"),
            F.sha2(
                F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256
            ).alias("turns_sha256"),
            F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
            F.length("formatted").cast("long").alias("formatted_chars"),
        )
    )


def op3_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{TOKENIZERS}/piece_bpe_32k.model"
    given = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = pieces.encode(given, path, seed=42, check="lossless")
    return found.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), F.xxhash64("ids").alias("pieces_hash"), "lossless")


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shards.assign_shards(table(spark, sf_dir, "documents"), 24)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.count_tokens(table(spark, sf_dir, "documents"), f"{TOKENIZERS}/word_bpe_49k.json")
    return counted.withColumn("over_limit", F.col("n_tokens") > 2048)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", *quality.COUNTS, "base_failed", "kept", *quality.ADDED)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_fingerprint().alias("fingerprint"), "component_id")


def op9_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = winnow.compare_with_next(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        winnow.shown(F.col("grams")).alias("fingerprint"), winnow.shown(F.col("edited_grams")).alias("edited_fingerprint"),
        "near_edited", "near_next",
    )


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(mixing.mix(table(spark, sf_dir, "documents")))


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.removed(table(spark, sf_dir, "documents"), length=400)
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return term_pipeline.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)


def op13_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.group_variants(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": op1_pii,
    "op2_chat": op2_chat,
    "op3_pieces": op3_pieces,
    "op4_sharding": op4_sharding,
    "op5_token_counts": op5_token_counts,
    "op6_quality": op6_quality,
    "op7_toxicity": op7_toxicity,
    "op8_simhash": op8_simhash,
    "op9_winnowing": op9_winnowing,
    "op10_mixing": op10_mixing,
    "op11_suffix_dedup": op11_suffix_dedup,
    "op12_ranked_search": op12_ranked_search,
    "op13_variants": op13_variants,
}
