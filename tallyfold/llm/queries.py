"""Registered queries of the operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .anchor_dedup import repeated_passages
from .attention_scoring import attention_scores
from .common import span_text
from .deobfuscated_pii import private_spans
from .kernel_langid import predict_language
from .line_blocks import main_texts
from .line_quality import line_first_quality
from .ordered import joined_sha256
from .packing import pack_documents
from .pfair_mixing import mix_sources
from .prefix_trie import numbered_turns, prefix_trie
from .secret_ledger import BASE_RULES, scan_versions
from .simhash_trees import simhash_groups
from .spherical_cells import near_vectors
from .structure_repair import repair_conversations


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def tokenizer_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def _kind_counts(spans, kinds):
    return [F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}") for kind in kinds]


def op1_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_versions(read(spark, sf_dir, "documents"), ["doc_id"], "text")
    kinds = [rule.kind for rule in BASE_RULES]
    base = F.filter("findings", lambda s: s["kind"].isin(kinds))
    return found.select(
        "doc_id",
        *_kind_counts(base, kinds),
        F.sha2(span_text(base), 256).alias("base_sha256"),
        span_text(F.col("findings")).alias("spans"),
    )


def op2_anchor_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(read(spark, sf_dir, "documents"), "doc_id", "text").select(
        "doc_id", "n_words", "n_removed", F.col("kept_text_sha256").alias("kept_sha256")
    )


def op3_deobfuscated_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = private_spans(read(spark, sf_dir, "documents"), "doc_id", "text")
    base = F.filter("spans", lambda s: s["base"])
    return found.select(
        "doc_id",
        *_kind_counts(base, ["email", "ip", "card", "phone"]),
        F.sha2(span_text(base), 256).alias("base_sha256"),
        span_text(F.col("spans")).alias("spans"),
    )


def op4_kernel_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    found = predict_language(documents, "doc_id", "text", "lang", learn=~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op5_line_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(read(spark, sf_dir, "pages"), ["page_id", "url"], "html")


def op6_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_first_quality(read(spark, sf_dir, "documents"), "doc_id", "text").drop("clean_text")


def op7_spherical_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(read(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label")


def op8_pfair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(read(spark, sf_dir, "documents"), "doc_id", "text", "source")
    return mixed.select("doc_id", "mix_source", "block", "slot", "place")


def op9_simhash_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(read(spark, sf_dir, "documents"), "doc_id", "text")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read(spark, sf_dir, "documents"), "doc_id", "text", tokenizer_path("word_bpe_49k.json"))


def op11_attention_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 10 == 0, F.lit(False))
    documents = read(spark, sf_dir, "documents")
    found = attention_scores(
        documents, "doc_id", "text", tokenizer_path("byte_bpe_multi_50k.tiktoken"), tokenizer_pattern(), learn=~held_out
    )
    return found.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns and ids after each conversation's first ``taken`` turns gave way to those of ``base``."""
    taken = (F.crc32(F.col("conv").cast("string")) % 9).alias("taken")
    size = turns.groupBy("conv").agg((F.max("pos") + 1).alias("size"))
    convs = size.select("conv", taken, (F.col("conv") - F.col("conv") % 5).alias("base"))
    sizes = size.select(F.col("conv").alias("base"), F.col("size").alias("base_size"))
    given = F.least("taken", F.coalesce("base_size", F.lit(0)))
    convs = convs.join(sizes, "base", "left").select("conv", "base", given.alias("given"))
    first = turns.where("pos < 9").select(F.col("conv").alias("base"), "pos", "turn", "bytes")
    first = first.join(convs, "base").where("pos < given").select("conv", "pos", "turn", "bytes")
    own = turns.where(F.col("pos") >= taken).join(convs, "conv")
    own = own.withColumn("pos", F.col("pos") - taken + F.col("given")).select("conv", "pos", "turn", "bytes")
    return first.union(own), convs.select("conv")


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = materialize(numbered_turns(read(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text"), "turns")
    return prefix_trie(*rebuilt(turns)).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )


def damaged(rows: DataFrame) -> DataFrame:
    """The rows after damage by the crc32 of ``conv_id:turn``; nulls are one space."""
    part = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn"))) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(part("text"), "[.!?]", "")).otherwise(part("text"))
    copies = F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.where(kind != 0).select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(part("role")).alias("role"), text.alias("text"),
        F.explode(copies).alias("copy"),
    )


def op13_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations")
    repaired = repair_conversations(damaged(rows), "conv_id", "turn", "role", "text")
    turns = repaired.turns.withColumn("line", F.concat_ws(":", "role", "text"))
    hashed = joined_sha256(turns, "conv", ["place", "sub"], "line", "\n")
    every = rows.select(F.col("conv_id").cast("bigint").alias("conv_id")).distinct()
    found = every.join(repaired.conversations, F.col("conv_id").eqNullSafe(F.col("conv")), "left").drop("conv")
    found = found.join(hashed, F.col("conv_id").eqNullSafe(F.col("conv")), "left")
    counts = [F.coalesce(n, F.lit(0)).alias(n) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return found.select(
        "conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


QUERIES = {
    "op1_secret_ledger": op1_secret_ledger,
    "op2_anchor_dedup": op2_anchor_dedup,
    "op3_deobfuscated_pii": op3_deobfuscated_pii,
    "op4_kernel_langid": op4_kernel_langid,
    "op5_line_blocks": op5_line_blocks,
    "op6_line_quality": op6_line_quality,
    "op7_spherical_cells": op7_spherical_cells,
    "op8_pfair_mixing": op8_pfair_mixing,
    "op9_simhash_trees": op9_simhash_trees,
    "op10_packing": op10_packing,
    "op11_attention_scores": op11_attention_scores,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_structure_repair": op13_structure_repair,
}
