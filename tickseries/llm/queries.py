"""The registered queries of this package: each applies one operator with its production parameters to its whole table."""

from __future__ import annotations

import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickseries.llm import bpe, decontaminate, embeddings, htmltext, idfiles, langid, lines, ppm, secret_scan, simhash, spelling, vector_codes, warc
from tickseries.llm.common import crc_remainder

BPE_FILE = "byte_bpe_multi_50k.tiktoken"
WORD_FILE = "word_bpe_49k.json"
HELD_OUT_THIRD = 1
HELD_OUT_SEVENTH = 2

def ship(spark: SparkSession) -> None:
    """Let Python workers find this package where it lies, in case it is not installed."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bpe_vocabulary() -> bpe.Vocabulary:
    return bpe.Vocabulary(public_tokenizers.path(BPE_FILE), public_tokenizers.PATTERN)


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(crc_remainder("doc_id", 3) == HELD_OUT_THIRD, F.lit(False))
    profiles = langid.learn_profiles(docs.where(~held_out))
    found = langid.identify(docs.select("doc_id", "text", held_out.alias("held_out")), profiles)
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(crc_remainder("doc_id", 7) == HELD_OUT_SEVENTH, F.lit(False))
    return ppm.score(docs, ~held_out).withColumn("held_out", held_out)


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode_documents(docs, bpe_vocabulary(), contents=False).drop("text")


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_digest(table(spark, sf_dir, "documents"))


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_token_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoder = idfiles.WordEncoder(public_tokenizers.path(WORD_FILE))
    return idfiles.ids_round_trip(table(spark, sf_dir, "documents"), encoder)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.warc_round_trip(table(spark, sf_dir, "pages"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_digest(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"), spoil_divisor=spelling.SPOIL_DIVISOR)


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.vector_codes(table(spark, sf_dir, "embeddings"))


def op13_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_embedding_near_dedup,
        op2_language_id,
        op3_lm_scoring,
        op4_byte_bpe,
        op5_simhash_near_dedup,
        op6_line_dedup,
        op7_benchmark_decontamination,
        op8_token_id_files,
        op9_warc,
        op10_secret_scan,
        op11_spelling_variants,
        op12_vector_codes,
        op13_html_extraction,
    )
}
