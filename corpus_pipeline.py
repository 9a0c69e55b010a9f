"""From raw documents to packed training sequences, in five stages.

Each stage works on all rows that the one before it kept, and its result is written as Parquet to the
shared folder and read again. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from passagemill.llm import mixing, near_dups, packing, quality_rules, toxicity
from passagemill.session import new_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a quality rule rejects go."""
    return quality_rules.filter_quality(docs)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are predicted toxic go; the labels of those still here are learned from."""
    return toxicity.drop_toxic(docs, toxicity.read_labels(spark, sf_dir))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: five words, similarity 0.8."""
    return near_dups.drop_near_duplicates(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are taken as often as the target weights of their domains ask for."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    labelled = mixing.labelled_domains(docs, labels)
    return mixing.mix(docs, labelled, mixing.language_targets(), mixing.MOST)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents' tokens in sequences of 4096: one row per piece, with its ids and their checksum."""
    pieces = packing.pack(docs)
    return pieces.withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("quality_rules", quality),
    ("toxicity", toxic),
    ("near_duplicates", near_duplicates),
    ("source_mixing", source_mixing),
    ("packing", packed),
]

#: Tokenizer, classifiers and sketches cannot be written as SQL; tests hold the stages against
#: brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
