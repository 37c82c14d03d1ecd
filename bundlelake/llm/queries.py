"""The registered queries over the training-data tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bundlelake.llm import (
    byte_bpe,
    conversations,
    decontamination,
    html_text,
    licenses,
    mixing,
    near_dedup,
    quality_rules,
    sharding,
    substring_dedup,
    token_files,
    toxicity,
    variants,
)
from bundlelake.llm.common import table
from bundlelake.session import scratch


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"), licenses.known_licenses(spark))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.find_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        "repeats.n_words",
        "repeats.n_removed",
        F.sha2(F.col("repeats.kept_text").cast("binary"), 256).alias("kept_sha256"),
    )


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.assess(documents).select(
        "doc_id",
        *[f"quality.{c}" for c in (
            "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
        )],
    )


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    files = token_files.write(documents, scratch(spark, "tokens"), public_tokenizers.path("word_bpe_49k.json"))
    return token_files.read(files, "doc_id long, start long, n_tokens long, ids_crc32 long", token_files.facts)


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = mixing.plan(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return planned.select(
        F.col("key").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    seen = labels.where(~toxicity.held_out(F.col("doc_id")))
    model = toxicity.train(documents, seen)
    return toxicity.score(documents, model).select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(table(spark, sf_dir, "documents").select("doc_id"))


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.search(
        table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark")
    )
    hits = F.col("benchmark_hits")
    return found.select(
        "doc_id",
        hits["n_words"].alias("n_words"),
        hits["n_hit"].alias("n_hit"),
        hits["n_items"].alias("n_items"),
        F.sha2(F.array_join(hits["item_ids"], ",").cast("binary"), 256).alias("items_sha256"),
        (hits["n_hit"] > 0).alias("contaminated"),
    )


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.classes(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_text.main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = variants.count_words(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return variants.group_variants(words).select("word", "form", "root", "n", "n_near", "form_n")


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = byte_bpe.encode(documents, vocabulary, public_tokenizers.PATTERN).drop("text")
    ids = F.array_join(F.col("token_ids").cast("array<string>"), ",")
    return byte_bpe.decode(encoded, vocabulary).select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(ids.cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def damaged_conversations(rows: DataFrame) -> DataFrame:
    """Conversations with a known damage, chosen by the hash of each row's place."""
    def shown(name: str):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    damage = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    text = (
        F.when(damage == 1, "").when(damage == 2, F.regexp_replace(shown("text"), "[.!?]", "")).otherwise(shown("text"))
    )
    role = F.when(damage == 4, "user").otherwise(shown("role"))
    copies = F.when(damage == 0, 0).when(damage == 3, 2).otherwise(1)
    return rows.select(
        "conv_id", "turn", role.alias("role"), text.alias("text"),
        F.explode(F.array_repeat(F.lit(0), copies)).alias("copy"),
    ).drop("copy")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    found, lines = conversations.repair(damaged_conversations(rows))
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    every = rows.select("conv_id").distinct().withColumn("key", conversations.key_of("conv_id"))
    return (
        every.join(found.drop("conv_id"), "key", "left").join(conversations.digests(lines), "key", "left").select(
            "conv_id",
            *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts],
            F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
        )
    )


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_license_scan,
            op2_substring_dedup,
            op3_quality_rules,
            op4_token_files,
            op5_source_mix,
            op6_toxicity,
            op7_sharding,
            op8_benchmark_decontamination,
            op9_near_dedup,
            op10_html_text,
            op11_spelling_variants,
            op12_byte_bpe,
            op13_conversation_repair,
        )
    }
