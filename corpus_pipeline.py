"""A training corpus from raw documents: filter, deduplicate, mix, pack."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tenura.llm import line_dedup, mixing, near_dedup, packing, quality
from tenura.llm.queries import vocabulary
from tenura.llm.shipping import ship
from tenura.settings import new_path


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the lines that ten or more of them share."""
    return line_dedup.drop_frequent_lines(docs).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, similarity of 0.8 or more)."""
    ship(spark)
    return near_dedup.keep_one(docs, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that sources approach the square root of their size."""
    return mixing.poisson_mix(docs).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in sequences of 4096 tokens."""
    ship(spark)
    return packing.pack(docs, vocabulary())


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", drop_shared_lines),
    ("MinHash near-dedup", drop_near_copies),
    ("mixing sources", mix_sources),
    ("best-fit packing", pack_sequences),
]

#: A fitted classifier and packing are not expressible in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        kept = stage(spark, docs, sf_dir)
        path = new_path(spark, name.replace(" ", "-").lower())
        kept.write.parquet(path)
        docs = spark.read.schema(kept.schema).parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
