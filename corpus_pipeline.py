"""The corpus pipeline: toxicity, quality, near-dedup, substring dedup, packing.

Each stage is a function of (spark, docs, sf_dir). What it returns is written as
Parquet and read back as the next one's documents. All stages but the last
return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm.common import materialize_alone, table
from shelfline.llm.minhash import keep_one_of_each
from shelfline.llm.ngram_quality import drop_low_quality
from shelfline.llm.packing import pack_documents
from shelfline.llm.q_packing import public_tokenizer
from shelfline.llm.substring_dedup import remove_repeats
from shelfline.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine doesn't call toxic."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents within their language's perplexity quantile."""
    return drop_low_quality(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group of near duplicates."""
    return keep_one_of_each(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that earlier ones have; n_chars follows."""
    cut = remove_repeats(docs, spans="__removed").drop("__removed")
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all token pieces in sequences of 1024."""
    return pack_documents(docs, public_tokenizer())


STAGES = [
    ("toxicity", toxicity),
    ("quality classifier", quality),
    ("MinHash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("best-fit packing", packing),
]

#: SQL can express neither the fitted models nor the tokenizer; tests hold the pipeline against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn; each one's result is kept in the shared folder, what its
    operator wrote there on the way is removed."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize_alone(lambda stage=stage, docs=docs: stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
