"""Query of SentencePiece encoding and decoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .piece_viterbi import decode_pieces, encode_pieces
from .q_packing import public_tokenizer


def op3_piece_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text to ids and back: how many ids, their hash, and whether the
    decoded text is the text. The installed vocabulary is a merge model, so its
    scores, and with them the ids, are those of the rank-frequency law."""
    path = public_tokenizer("piece_bpe_32k.model")
    docs = table(spark, sf_dir, "documents").select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), "text")
    ids = encode_pieces(docs, path, "text", ("doc_id", "text_hash"))
    hashed = ids.select("doc_id", "text_hash", F.size("ids").cast("bigint").alias("n_pieces"), F.xxhash64("ids").alias("ids_hash"), "ids")
    back = decode_pieces(hashed, path, "ids", ("doc_id", "text_hash", "n_pieces", "ids_hash"))
    return back.select("doc_id", "n_pieces", "ids_hash", F.length("decoded").cast("bigint").alias("n_chars"), (F.xxhash64("decoded") == F.col("text_hash")).alias("round_trip"))


QUERIES = {"op3_piece_viterbi": op3_piece_viterbi}
ORACLES: dict[str, str] = {}
