"""Corpus pipeline: raw documents to a training mix.

Each stage is (name, function) with function(spark, docs, sf_dir) -> DataFrame;
its result is written as Parquet and reread as the next stage's ``docs``.  All
but the last return the columns of ``documents``.

1. quality     documents that the nearest-neighbour classifier rejects go
2. exact       one row of each group of equal texts stays
3. near        one document of each near-duplicate class stays
4. benchmark   runs of benchmark words are cut out of the texts (n_chars is set
               anew); documents that are mostly benchmark text go
5. mix         what the mix to the target weights takes: rows with copies >= 1,
               in the order of service, with copies, size, target and finish
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartlake.llm import decontaminate, exact_dedup, mixing, near_dup, quality_knn
from chartlake.llm.common import remove_folder, shared_folder, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_knn.keep_good(docs, table(spark, sf_dir, "labels"), threshold=0.7)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.dedup(docs, width=5, threshold=0.75)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), window=10, max_coverage=0.5, chars_col="n_chars")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs).where(F.col("copies") > 0)


STAGES = [("quality", quality), ("exact", exact), ("near", near), ("benchmark", benchmark), ("mix", mix)]

#: The classifier's scores cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES:
        folder = shared_folder(spark, "pipeline")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
        if before:
            remove_folder(spark, before)
        before = folder
    return docs
