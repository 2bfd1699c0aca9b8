"""A training-data pipeline over `documents`: language, repeated lines, near-duplicates, benchmark passages, token ids.

Each stage works on all that the one before has kept, is written as Parquet to the shared folder and read again. All stages
but the last return the columns of `documents`. Documents that no stage has a reason to drop stay as they are.

Python workers live from stage to stage and keep some of the memory that they once took, so stages set
`spark.sql.execution.arrow.maxRecordsPerBatch` of the session to ROWS_AT_ONCE: texts go to them and come back in small batches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickseries.llm import bpe, decontaminate, langid, lines, simhash
from tickseries.llm.common import crc_remainder, materialize
from tickseries.llm.queries import HELD_OUT_THIRD, bpe_vocabulary, ship, table

#: A text whose n-grams lie further from every profile than this is in none of the languages.
LEAST_LANGUAGE_SCORE = 0.2
#: Rows that Spark hands to Python at a time. A task holds a batch of whole texts several times over.
ROWS_AT_ONCE = 1_000


def begin(spark: SparkSession) -> None:
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_AT_ONCE)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages. Null texts, texts without letters and texts far from every profile go."""
    begin(spark)
    learning = docs.where(~F.coalesce(crc_remainder("doc_id", 3) == HELD_OUT_THIRD, F.lit(False)))
    found = langid.identify(docs, langid.learn_profiles(learning), names=("_lang_pred", "_lang_score"))
    kept = found.where((F.col("_lang_pred") != langid.UNDETERMINED) & (F.col("_lang_score") >= LEAST_LANGUAGE_SCORE))
    return kept.select(*docs.columns)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without the lines that ten or more have. A text that loses lines gets its new length in n_chars."""
    begin(spark)
    kept = lines.dedup_lines(docs, names=("_lines", "_lines_dropped"))
    shorter = F.when(F.col("_lines_dropped") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", shorter).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    begin(spark)
    return simhash.drop_near_duplicates(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    begin(spark)
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every document, with digests of the ids and of the text that they decode to."""
    begin(spark)
    encoded = bpe.encode_documents(docs, bpe_vocabulary(), decoded=False)
    return encoded.select("doc_id", "lang", "source", "n_tokens", "ids", "ids_sha256", "decoded_sha256")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("repeated_lines", repeated_lines),
    ("near_duplicates", near_duplicates),
    ("benchmark_passages", benchmark_passages),
    ("token_ids", token_ids),
]

#: SQL has no rank-order profiles, no XXH64 and no tokenizer.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
