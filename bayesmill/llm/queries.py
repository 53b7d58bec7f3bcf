"""The registered queries of this subpackage and their oracle SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bayesmill.llm import alignment, chat_format, chunk_dedup, decontaminate, divergence, host_quality, lpt_shards, minhash, ngram_join, packing, pii_boost, secret_ledger, toxicity
from bayesmill.sources.tables import read_table


def op1_host_quality(spark: SparkSession, sf: str) -> DataFrame:
    out = host_quality.host_quality(read_table(spark, sf, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                      F.round("host_rate", 9).alias("host_rate"))


def op2_pii(spark: SparkSession, sf: str) -> DataFrame:
    return pii_boost.digest(pii_boost.personal_data(read_table(spark, sf, "documents")))


def word_tokenizer() -> str:
    """Place of the public word tokenizer's file (on the driver)."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op3_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf, "documents"), word_tokenizer())


def op4_chunk_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return chunk_dedup.shared_spans(read_table(spark, sf, "documents"), within=True)


def op5_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.digest(decontaminate.contamination(read_table(spark, sf, "documents"), read_table(spark, sf, "benchmark")))


def op6_ngram_join(spark: SparkSession, sf: str) -> DataFrame:
    return ngram_join.ngram_components(read_table(spark, sf, "documents"))


def op7_lpt_shards(spark: SparkSession, sf: str) -> DataFrame:
    out = lpt_shards.shard_documents(read_table(spark, sf, "documents"), 40)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


# The conversation that the contract adds to the table.
CONTROL_CHAT = ((-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]"))


def op8_chat_format(spark: SparkSession, sf: str) -> DataFrame:
    rows = read_table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.range(1).select(F.inline(F.array(*[F.struct(
        F.lit(c).cast("long").alias("conv_id"), F.lit(n).cast("long").alias("turn"), F.lit(r).alias("role"), F.lit(t).alias("text"))
        for c, n, r, t in CONTROL_CHAT])))
    return chat_format.digests(chat_format.format_chats(rows.unionByName(added)))


def op9_secret_ledger(spark: SparkSession, sf: str) -> DataFrame:
    return secret_ledger.digest(secret_ledger.scan_paths(read_table(spark, sf, "documents")))


def op10_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity.train(docs, read_table(spark, sf, "labels")))
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
                         (F.size("spans") / 2).cast("long").alias("n_spans"))


def op11_alignment(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    return alignment.align(read_table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op12_divergence(spark: SparkSession, sf: str) -> DataFrame:
    return divergence.audit(read_table(spark, sf, "documents"))


def op13_minhash(spark: SparkSession, sf: str) -> DataFrame:
    return minhash.minhash_components(read_table(spark, sf, "documents"))


QUERIES = {
    "op1_host_quality": op1_host_quality,
    "op2_pii": op2_pii,
    "op3_packing": op3_packing,
    "op4_chunk_dedup": op4_chunk_dedup,
    "op5_decontaminate": op5_decontaminate,
    "op6_ngram_join": op6_ngram_join,
    "op7_lpt_shards": op7_lpt_shards,
    "op8_chat_format": op8_chat_format,
    "op9_secret_ledger": op9_secret_ledger,
    "op10_toxicity": op10_toxicity,
    "op11_alignment": op11_alignment,
    "op12_divergence": op12_divergence,
    "op13_minhash": op13_minhash,
}

SQL: dict[str, str] = {"op12_divergence": divergence.SQL}
