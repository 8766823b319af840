"""The opN_ queries: each operator over its whole table, with the columns of its contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, filter_audit, html_text, jaccard_join, language_id, merkle, mixing, quality_rules, secret_scan, sentencepiece_codec, simhash, suffix_sort, suffix_tree
from .sql import SQL


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(_table(spark, sf_dir, "embeddings"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = sentencepiece_codec.encode(_table(spark, sf_dir, "documents"), check=True)
    return encoded.select("doc_id", F.size("ids").alias("n_pieces"), "ids", "round_trip")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_sort.remove_repeats(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(_table(spark, sf_dir, "documents"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(_table(spark, sf_dir, "documents"), carry=["doc_id"])
    return found.select(
        "doc_id",
        *[secret_scan.count_kind(F.col("base_spans"), k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(secret_scan.spans_text(F.col("base_spans")), 256).alias("base_sha256"),
        secret_scan.spans_text(F.col("all_spans")).alias("spans"),
    )


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = quality_rules.ledger(_table(spark, sf_dir, "documents"))
    return entries.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        quality_rules.failed("v1").alias("base_failed"), (~quality_rules.failed("v2")).alias("kept"),
    )


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))[1]


def op9_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_tree.remove_repeats(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(_table(spark, sf_dir, "pages"))


def op11_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(_table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tampering adds 1 to n_chars of the rows that 7 divides the checksum of."""
    fields = lambda n_chars: (F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text"))
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    more = F.col("n_chars").cast("decimal(38,0)") + F.when(tampered, 1).otherwise(0)
    docs = _table(spark, sf_dir, "documents").withColumn("presented", merkle.leaf(*fields(more)))
    found = merkle.manifest(docs, merkle.leaf(*fields(F.col("n_chars"))), carry=["presented"])
    folded = found.withColumn("folded_root", merkle.fold(F.col("presented"), F.col("siblings"), F.col("sides")))
    return folded.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(F.array_join("siblings", ""), 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def queries() -> dict:
    found = {k: f for k, f in globals().items() if k.startswith("op") and callable(f)}
    return dict(sorted(found.items(), key=lambda x: int(x[0][2:].split("_")[0])))


def oracle_sql() -> dict[str, str]:
    """The other operators are tested against brute force."""
    return dict(SQL)
