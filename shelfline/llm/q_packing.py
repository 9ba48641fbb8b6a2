"""Query of best-fit packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .common import table
from .packing import pack_documents


def public_tokenizer(name: str = "byte_bpe_50k.json") -> str:
    """Path of an installed public vocabulary."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pack_documents(docs, public_tokenizer()).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


QUERIES = {"op8_best_fit_packing": op8_best_fit_packing}
ORACLES: dict[str, str] = {}
