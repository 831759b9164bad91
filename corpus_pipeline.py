"""The corpus pipeline: five stages, each over all that its predecessor kept.

Every stage is written as Parquet and read again.  ``run`` applies them to documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillflow.llm import decontaminate, line_dedup, mixing, near_text, toxicity
from tillflow.llm.common import table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 or more go; the model learns from the labelled documents."""
    model = toxicity.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.below(docs, model)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document has go, and documents of which nothing is left."""
    return line_dedup.deduplicated(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays."""
    return near_text.without_near_duplicates(docs)


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of the benchmark are cut out."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture by weight of source: each document as often as it was drawn."""
    return mixing.mixed(docs)


STAGES = [("toxicity", drop_toxic), ("line_dedup", drop_repeated_lines), ("near_duplicates", drop_near_duplicates),
          ("decontamination", cut_benchmark), ("mixing", mix_sources)]

#: Learned scores and similarity joins have no SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
