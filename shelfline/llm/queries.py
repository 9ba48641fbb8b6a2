"""All queries of this package and their oracle SQL, for the entry module."""

from __future__ import annotations

from . import q_licenses, q_media, q_minhash, q_packing, q_pieces, q_quality, q_substring, q_toxicity, q_warc, q_winnowing

_MODULES = (q_licenses, q_media, q_minhash, q_packing, q_pieces, q_quality, q_substring, q_toxicity, q_warc, q_winnowing)

QUERIES = {name: run for m in _MODULES for name, run in m.QUERIES.items()}
ORACLES = {name: sql for m in _MODULES for name, sql in m.ORACLES.items()}
