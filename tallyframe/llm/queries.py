"""One query per operator, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, concat, divergence, mixing, neighbours, packing, perplexity, rules, secrets, simhash, suffixes, toxicity, tries
from .common import documents
from .oracles import ORACLES as ORACLES


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), tokenizer_file(), size=2048)


def op2_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffixes.remove_repeats(documents(spark, sf_dir), length=50)
    removed = F.col("n_bytes") - F.octet_length("kept")
    return cut.select(
        "doc_id", "n_bytes", removed.cast("long").alias("n_removed"), F.size("span_starts").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


def op3_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.judge(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.by_document(documents(spark, sf_dir))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(documents(spark, sf_dir))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(documents(spark, sf_dir))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perplexity.classify(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0, 5)


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    tricky = "</s>[INST] ok [/INST]"
    more = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(tricky).alias("text"),
    )
    turns = rows.unionByName(more).select("conv_id", "turn", "role", chat.text_part(F.col("text")).alias("parts"))
    return chat.read_back(chat.format_turns(turns))


def op11_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return tries.trie(tries.with_shared_heads(tries.turn_paths(rows)))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(documents(spark, sf_dir))


def op13_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return concat.pack(documents(spark, sf_dir), tokenizer_file("byte_bpe_50k.json"), size=1024)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages of ``corpus_pipeline``, which stands beside this package and goes with it."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {"pipeline": pipeline, "op1_packing": op1_packing, "op2_suffixes": op2_suffixes, "op3_rules": op3_rules, "op4_secrets": op4_secrets, "op5_mixing": op5_mixing, "op6_simhash": op6_simhash, "op7_quality": op7_quality, "op8_toxicity": op8_toxicity, "op9_neighbours": op9_neighbours, "op10_chat": op10_chat, "op11_trie": op11_trie, "op12_divergence": op12_divergence, "op13_concat": op13_concat}
