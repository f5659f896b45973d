"""The training-text pipeline over ``documents``.

Stages, each on all that its predecessor kept: quality rules, line dedup, near
duplicates, benchmark decontamination, packing. ``run`` writes every stage's
result to the cluster's shared folder and reads it again for the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycheck.llm import decontaminate, jaccard_join, line_dedup, packing, quality
from tallycheck.llm.common import written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the quality rules reject, and boilerplate lines."""
    return quality.filtered(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes passages that occur earlier, and documents that are nothing else."""
    found = line_dedup.deduplicated(docs)
    if "n_chars" not in docs.columns:
        return found
    return found.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(
        F.length("text").cast(docs.schema["n_chars"].dataType)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates."""
    return jaccard_join.distinct(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that leak a benchmark item."""
    return decontaminate.cleaned(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents into sequences of token ids; a row per piece."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json")).withColumnRenamed("id", "doc_id")


STAGES = [("quality", quality_rules), ("line dedup", dedup_lines), ("near duplicates", near_duplicates),
          ("decontamination", decontaminated), ("packing", packed)]

#: SQL has no tokenizer; the tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
