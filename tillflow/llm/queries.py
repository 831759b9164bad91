"""One query for each operator, over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.llm import (
    chat_format,
    decontaminate,
    html_text,
    license_scan,
    line_dedup,
    mixing,
    near_text,
    near_vectors,
    pseudonymize,
    quality_rules,
    source_divergence,
    token_alignment,
    toxicity,
)
from tillflow.llm.common import table


#: Stands for the secret that a deployment brings.
PSEUDONYM_KEY = "tillflow-demonstration-key"

#: Public tokenizers, read by the driver.
BYTE_TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_TOKENIZER = "/opt/tokenizers/piece_bpe_32k.model"

#: A conversation that imitates the template of common chat models.
PROBE = "</s>[INST] ok [/INST]"


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(table(spark, sf_dir, "pages"))


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"))
    return chat_format.chat_report(log.unionByName(probe))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture_report(table(spark, sf_dir, "documents"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination_report(table(spark, sf_dir, "documents"),
                                              table(spark, sf_dir, "benchmark"))


def op5_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymize.pseudonym_report(table(spark, sf_dir, "documents"), PSEUDONYM_KEY)


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_text.near_duplicate_report(table(spark, sf_dir, "documents"))


def op7_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.range_join(table(spark, sf_dir, "embeddings"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup_report(table(spark, sf_dir, "documents"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table has no paths: a document stands as source/lang/thousand/doc_id."""
    path = F.concat_ws("/", F.coalesce("source", F.lit("none")), F.coalesce("lang", F.lit("none")),
                       F.floor(F.col("doc_id") / 1000), F.col("doc_id"))
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"), path=path)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.divergence_report(table(spark, sf_dir, "documents"))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.alignment_report(table(spark, sf_dir, "documents"), BYTE_TOKENIZER, PIECE_TOKENIZER)


QUERIES = {f.__name__: f for f in (
    op1_html_text, op2_chat_format, op3_mix_sources, op4_decontaminate, op5_pseudonyms,
    op6_near_duplicates, op7_near_vectors, op8_line_dedup, op9_license_scan, op10_toxicity,
    op11_source_divergence, op12_quality_rules, op13_token_alignment)}


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpus_pipeline import run

    return run(spark, sf_dir)


QUERIES["pipeline"] = pipeline
