"""The corpus pipeline: five stages from raw documents to a training mix.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each result as Parquet in the folder that the cluster shares and reads it back
for the next. All stages but the last keep the columns of documents: ``text``
and ``n_chars`` follow what line dedup leaves of a text. The last one adds
``n_copies``, ``copy`` and ``shuffle_key``.

Defined results: each stage's operator says what it does with nulls, empty and
very long texts, ties and repeated rows; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.llm import decontaminate, line_dedup, nbsvm, near_dedup, poisson_mix
from citeloom.staging import staged


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return nbsvm.keep_good(docs, nbsvm.fit(docs, labels))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that many of them repeat."""
    return line_dedup.drop_repeated(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return near_dedup.keep_one(docs)


def benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents replicated to the target weights of their sources."""
    return poisson_mix.poisson_mix(docs)


STAGES = [("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates), ("benchmarks", benchmarks), ("mixing", mixing)]

#: SQL cannot express the trained classifier of the first stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
