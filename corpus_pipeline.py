"""A corpus from raw documents to packed sequences: five stages, each over all the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.functions.staging import new_path
from scoreloom.llm import langid, mixing, packing, pivots, toxicity
from scoreloom.llm.common import col, fresh, read


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from the labelled ones, scores under one half."""
    model = toxicity.fit_toxicity(docs, read(spark, sf_dir, "labels"), F.lit(True))
    score = fresh(docs.columns, "__score")
    return docs.withColumn(score, toxicity.toxicity_score(F.col("text"), model)).where(col(score) < 0.5).drop(score)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that was learned; texts without letters or far from every centroid go."""
    model = langid.fit_languages(docs, "doc_id", "text", "lang")
    found = fresh(docs.columns, "__language")
    return (docs.withColumn(found, langid.language_of(F.col("text"), model))
            .where(~col(found)["rejected"]).drop(found))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each near-duplicate group the document with the smallest id."""
    return pivots.keep_first_of_group(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, those of small sources again as the mixing weights ask."""
    return mixing.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 1,024 tokens."""
    return packing.pack(docs)


STAGES = [("toxicity", drop_toxic), ("language", known_language), ("simhash", one_of_each_group),
          ("mixing", mixed_sources), ("packing", packed)]

#: Classifiers, tokenizers and Hamming groups are beyond SQL; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
