"""One query for each operator, over whole tables and with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firmloom.llm import chat, decontaminate, fm_dedup, packing, pseudo_likelihood, repair, resample, secrets, simhash, token_blocks, token_counts, voronoi, whitening

BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 10)
    return found.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        F.col("n_hit").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    kinds = F.array(*map(F.lit, secrets.KINDS))

    def joined(spans):
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"], s["end"])), ","
        )

    def number(kind: int):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        number(0).alias("n_assign"),
        number(1).alias("n_access"),
        number(2).alias("n_hex"),
        F.sha2(joined(F.filter("spans", lambda s: s["kind"] < 3)), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
        number(3).alias("n_format"),
    )


def op3_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pseudo_likelihood.pseudo_likelihood(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_tokens", "pll", "mean_pll")


def op4_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("\\### Assistant: </turn> ok").alias("text"),
    )
    windows = chat.format_windows(turns.unionByName(odd), budget=1024, history=256)
    read = chat.read_windows(windows.withColumn("n_chars", F.length("text")), "n_chars")
    said = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    part = F.struct(
        "window", said.alias("said"), F.array_join("targets", "").alias("learnt"),
        F.size("turns").alias("n"), "n_chars",
    )

    def joined(field: str):
        return F.array_join(F.transform("parts", lambda p: p[field]), "")

    def summed(field: str):
        return F.aggregate("parts", F.lit(0).cast("long"), lambda acc, p: acc + p[field])

    whole = read.groupBy("conv_id", "conv_key").agg(F.sort_array(F.collect_list(part)).alias("parts"))
    return whole.select(
        "conv_id",
        summed("n").alias("n_turns"),
        F.sha2(joined("said"), 256).alias("turns_sha256"),
        F.length(joined("learnt")).cast("long").alias("loss_chars"),
        F.sha2(joined("learnt"), 256).alias("loss_sha256"),
        summed("n_chars").alias("formatted_chars"),
        F.size("parts").cast("long").alias("n_windows"),
    )


def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), 4, 4)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op6_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "log_weight", "gumbel_key", "kept")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.prefix_token_counts(table(spark, sf_dir, "documents"), BYTE_VOCABULARY, 512)
    return counted.withColumn("over_limit", F.col("n_tokens") > 512)


def op8_voronoi_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = voronoi.finite_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    scaled = vectors.withColumn("vec", F.transform("vec", lambda x: F.floor(x * 256).cast("double")))
    found = voronoi.knn_join(scaled, scaled.where(F.col("vec_id") % 50 == 0), 5)
    return found.withColumn("score", F.col("score").cast("long"))


def op9_shortest_pack_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), WORD_VOCABULARY, 4096, 2)


def op10_fm_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fm_dedup.without_repeats(table(spark, sf_dir, "documents"), 35)
    return found.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        F.col("n_removed").cast("long").alias("n_removed"),
        "kept_sha256",
    )


def op11_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_blocks.encode_documents(table(spark, sf_dir, "documents"), BYTE_VOCABULARY, 2)


def op12_feast_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a deviation beyond 64 bits is null here; the operator itself gives 38 digits
    found = whitening.whiten(table(spark, sf_dir, "embeddings"), 8, 1024.0, 100_000)
    return found.withColumn("deviation", F.col("deviation").try_cast("long"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return repair.repair(repair.damage(turns), turns)


QUERIES = {
    f.__name__: f
    for f in (
        op1_decontaminate,
        op2_secret_scan,
        op3_pseudo_likelihood,
        op4_chat_windows,
        op5_simhash_dedup,
        op6_importance_resampling,
        op7_token_counts,
        op8_voronoi_knn,
        op9_shortest_pack_first,
        op10_fm_substring_dedup,
        op11_token_blocks,
        op12_feast_whitening,
        op13_conversation_repair,
    )
}
