"""Query of the toxicity machine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .toxicity import fit_toxicity, held_out, score_toxicity


def op1_toxicity_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    machine = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    scored = score_toxicity(docs, machine)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


QUERIES = {"op1_toxicity_machine": op1_toxicity_machine}
ORACLES: dict[str, str] = {}
