"""A training-data pipeline: every stage works on all that the one before kept.

Stages, in order: language identification drops texts whose language cannot be
told; SimHash, completed to all links of a five-word similarity of 0.8, keeps
one document of each near-duplicate group; the secret scan redacts; mixing
draws documents so that sources come near their target weights; SentencePiece
turns what is left into ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterloom.llm import language_id, mixing, near_copies, secret_scan, sentencepiece_codec
from rasterloom.llm._common import cut

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Posterior under which a language counts as not told.
MIN_LANGUAGE_SCORE = 0.5


def _row(columns: list[str]) -> Column:
    """Tells apart rows that differ in their id or in `columns`, nulls included; null ids sort last and no part is null."""
    nulls = [F.col(c).isNull() for c in columns]  # the hash skips nulls, so their places go in too
    return F.struct(
        F.col("doc_id").isNull().alias("no_id"),
        F.coalesce("doc_id", F.lit(0)).alias("id"),
        F.xxhash64(*columns, *nulls).alias("rest"),
    )


def _by_row(docs: DataFrame, columns: list[str]) -> DataFrame:
    """(row, whole): one entry for all rows that `_row` does not tell apart, the least of them."""
    return docs.groupBy(_row(columns).alias("row")).agg(F.min(F.struct(*COLUMNS)).alias("whole"))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents whose language is told; the label column is left as it came."""
    model = language_id.train(docs.where(~language_id.held_out()))
    found = language_id.predict(docs, model, keep=["text", "lang", "source", "n_chars"])
    return found.where((F.col("lang_pred") != language_id.UNDETERMINED) & (F.col("score") >= MIN_LANGUAGE_SCORE)).select(COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group of documents linked by a five-word similarity of 0.8 or more.

    It is the row with the smallest id, null ids last; rows of one id go by a
    hash of their text. Texts without words are compared whole.
    """
    node = F.xxhash64("text", F.col("text").isNull())
    found = near_copies.groups(docs.where("text is not null").groupBy(node.alias("node")).agg(F.min("text").alias("text")))
    placed = docs.withColumn("node", node).join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = placed.groupBy("component").agg(F.min(F.struct(_row(["text"]).alias("row"), F.struct(*COLUMNS).alias("whole"))).alias("least"))
    return least.select("least.whole.*")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace every secret by a mark; no document is dropped."""
    found = secret_scan.find_secrets(docs, carry=COLUMNS)
    text = F.when(F.col("text").isNotNull(), secret_scan.redact(F.col("text"), F.col("all_spans")))
    return found.withColumn("text", text).withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Emit a document as often as the mix takes its words, to the nearest whole number (0 to 2); every row is a document."""
    rest = COLUMNS[1:]
    taken = mixing.mix(docs.select(_row(rest).alias("row"), "text", "source"), id_col="row")[1]
    copies = F.floor(F.col("taken") / F.greatest("size", F.lit(1)) + 0.5).cast("int")
    # equal rows stand for each other, so their copies add up
    emitted = taken.groupBy("row").agg(F.sum(copies).cast("int").alias("copies")).where("copies > 0")
    return _by_row(docs, rest).join(emitted, "row").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("whole.*")


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document, with a check that they decode to its text."""
    encoded = sentencepiece_codec.encode(docs, check=True)
    return encoded.select("doc_id", F.size("ids").alias("n_pieces"), "ids", "round_trip")


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("secret_scan", redact_secrets),
    ("source_mixing", mix_sources),
    ("sentencepiece", tokenize),
]

#: No stage but the redaction's base patterns can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each stage written to the checkpoint folder before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
