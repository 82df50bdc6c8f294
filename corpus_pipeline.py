"""From raw documents to packed training sequences: five stages, each written as Parquet and read again by the next.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagestrata.llm.common import discard, materialize
from pagestrata.llm.mixing import mix_sources
from pagestrata.llm.ngram_join import drop_near_copies
from pagestrata.llm.packing import pack_documents
from pagestrata.llm.quality import quality_scores
from pagestrata.llm.queries import tokenizer_path
from pagestrata.llm.substring_dedup import substring_dedup


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_scores(docs, labels, threshold=0.7, keep_text=True).where("predicted = 1").select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: five-word shingles, similarity of 0.8 or more."""
    return drop_near_copies(docs, shingle=5, percent=80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 13 or more words that a document of smaller id holds; n_chars follows."""
    out = substring_dedup(docs, length=13)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks, at most twice."""
    mixed = mix_sources(docs, weights=(3.0, 1.0, 2.0), share=1.5, most=2)
    return mixed.where("copies > 0").select(*docs.columns, F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("_copy")).drop("_copy")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens and their places in sequences."""
    return pack_documents(docs, tokenizer_path(), capacity=1024)


STAGES = [("quality", quality), ("near copies", near_copies), ("repeated passages", repeated_passages), ("mixture", mixture), ("packing", packing)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        before, docs = docs, stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = materialize(docs)
            discard(before)
    return docs
