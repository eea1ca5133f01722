"""A corpus from raw documents: five stages, each reading what the one before wrote.

1. Documents that the quality classifier rejects go.
2. Of each group of near-duplicates one document stays.
3. Documents that hold benchmark items, as they are or with other numbers and names, go.
4. Secrets are masked in the texts that hold any.
5. Documents are repeated so that sources reach their target weights.

Odd rows have the result that the stage's operator defines in its docstring: nulls in any column, empty and very
long texts, ties and repeated rows pass or go as any other row, further columns of ``documents`` stay, and an empty
table gives an empty one. The stages stay under ``spark.checkpoint.dir`` until that is cleared.

All stages but the last return the columns of ``documents``; the last one too, a row per copy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm import decontaminate, mixing, near_duplicates, quality, secret_scan
from siltstone.runtime import scratch_path


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_duplicates.keep_one(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    masked = secret_scan.redact(docs)
    if "n_chars" not in docs.columns:
        return masked
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


STAGES = [
    ("quality classifier", keep_good),
    ("near-duplicates", keep_one_of_each),
    ("benchmark decontamination", drop_benchmark),
    ("secret scan", mask_secrets),
    ("source mix", mix_sources),
]

# The classifier and the compressor have no SQL form; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to shared storage and read back."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"stage-{k + 1}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
