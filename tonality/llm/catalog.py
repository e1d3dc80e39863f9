"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .minhash import near_duplicates

    classes, _ = near_duplicates(table(spark, sf_dir, "documents"))
    return classes.withColumn("kept", F.col("doc_id") == F.col("class_id"))


def op2_hilbert_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack

    pieces = pack(table(spark, sf_dir, "documents"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "curve"
    )


def op3_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sharding import shard

    return shard(table(spark, sf_dir, "documents"), shards=16).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "row_number",
    )


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .substring import remove_repeats

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import tokenizer_path
    from .token_counts import count_tokens

    return count_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path())


def op6_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix

    shares = {"clean": 0.9, "low": 0.1, "toxic": 0.0}
    return mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), shares)


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .licenses import scan_licenses

    return scan_licenses(table(spark, sf_dir, "documents"))


def op8_attention_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lm import score
    from .packing import tokenizer_path

    return score(table(spark, sf_dir, "documents"), tokenizer_path())


def op9_quality_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import quality_report

    return quality_report(table(spark, sf_dir, "documents"))


def op10_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .neighbours import near_vectors

    result, _, _ = near_vectors(table(spark, sf_dir, "embeddings"))
    return result.withColumn("kept", F.col("vec_id") == F.col("component_id"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .conversations import damage, repair

    return repair(damage(table(spark, sf_dir, "conversations")))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .spelling import count_words, typo, variants

    words = count_words(table(spark, sf_dir, "documents"), typo)
    return variants(words.where("n >= 5"))


def op13_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .bpe import byte_bpe_path, decode, encode

    path = byte_bpe_path()
    encoded = encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    digest = F.sha2(F.btrim(F.to_json("ids"), F.lit("[]")), 256)  # without a string for each id
    counted = encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), digest.alias("ids_sha256"), "ids")
    return decode(counted, path).select("doc_id", "n_tokens", "ids_sha256", F.sha2("text", 256).alias("decoded_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash_dedup": op1_minhash_dedup,
    "op2_hilbert_packing": op2_hilbert_packing,
    "op3_feistel_shards": op3_feistel_shards,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_token_counts": op5_token_counts,
    "op6_soft_mixing": op6_soft_mixing,
    "op7_license_scan": op7_license_scan,
    "op8_attention_scores": op8_attention_scores,
    "op9_quality_ledger": op9_quality_ledger,
    "op10_nn_descent": op10_nn_descent,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_bpe_round_trip": op13_bpe_round_trip,
}
