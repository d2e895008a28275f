"""The corpus pipeline: five operators in a row over ``documents``.

Each stage works on what the one before kept, written as Parquet and read again.
All but the last return the columns of ``documents``; the last adds ``copy``, as
the mix may take a document up to three times.

SQL cannot express the classifier, so there is none; the tests hold every stage
against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermatch.llm import decontaminate, mixing, pii, quality, simhash_near
from ledgermatch.llm.scratch import ship_package, written


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose calibrated score reaches the threshold stay."""
    ship_package(spark)
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.accepted(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of fingerprint links (four words a shingle, four bits) the least id stays."""
    ship_package(spark)
    return simhash_near.representatives(docs, shingle=4, max_bits=4)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no test item is found stay."""
    ship_package(spark)
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay, their spans of personal data masked and their length counted anew."""
    masked = pii.redact(docs)
    return masked.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else masked


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources by weights 1, 2, 3 in turn, no document more than three times."""
    return mixing.mix(docs)


STAGES = [
    ("quality classifier", drop_low_quality),
    ("SimHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("PII", mask_personal_data),
    ("mixing sources", mix_sources),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, f"pipeline-{i}")
    return docs
